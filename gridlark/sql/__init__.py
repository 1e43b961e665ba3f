"""The dialect: tokens, syntax tree, parser, printer."""
