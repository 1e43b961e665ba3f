"""The dialect has no streams: statements run over tables as they are. Nothing is kept here."""
