"""Token counts of a byte-level BPE tokenizer with a whole-token shortcut.

The tokenizer cuts a text into pre-tokens by a pattern and merges each by itself. Before the job the driver tries every
string of the vocabulary alone: those that the merges turn into one token are proven whole. A pre-token that is one of
them counts 1 by a look-up; only the rest go through the merges, and what they gave is remembered.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from gridlark.llm.common import ship

#: How the byte-level pre-tokenizer splits a text (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: The same over texts of ASCII and Latin-1 letters alone, where the classes can be spelled out; the engine for such
#: patterns is twice as fast. The alternatives that start differently may stand in any order.
_LETTERS, _DIGITS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", "0-9"
PLAIN = rf" ?[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[{_DIGITS}]+| ?[^\s{_LETTERS}{_DIGITS}]+|\s+(?!\S)|\s+"
NOT_PLAIN = rf"[^\t\n\r\x20-\x7e{_LETTERS}]"

#: Merge results that a worker remembers as the younger half; when it is full, it becomes the older half, which goes.
REMEMBERED = 250_000

#: Longer pre-tokens are merged but not remembered, so that memory stays bounded.
REMEMBERED_CHARS = 64


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if it is printable Latin-1, else the next from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(rest)) for b in range(256)]


def prove_whole(definition: str) -> set[str]:
    """The strings of the vocabulary that, encoded alone, are one token, as ordinary text."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_str(definition).model
    back = {c: b for b, c in enumerate(byte_alphabet())}
    whole = set()
    for entry in json.loads(definition)["model"]["vocab"]:
        if len(model.tokenize(entry)) == 1 and all(c in back for c in entry):
            try:
                whole.add(bytes(back[c] for c in entry).decode())
            except UnicodeDecodeError:  # part of a character: no pre-token by itself
                pass
    return whole


def newer_letters(definition: str) -> str:
    """Letters and numerals of this Python's pattern engine that the library, with an older Unicode, does not know."""
    import unicodedata

    import regex
    from tokenizers import Tokenizer

    cut = Tokenizer.from_str(definition).pre_tokenizer.pre_tokenize_str
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    young = [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]
    return "".join(c for c in young if len(cut("a" + c)) > 1 and len(cut("1" + c)) > 1)


def pattern(newer: str) -> str:
    """PATTERN without the newer characters among the letters and numerals."""
    if not newer:
        return PATTERN
    letters, digits = rf"(?:(?![{newer}])\p{{L}})", rf"(?:(?![{newer}])\p{{N}})"
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letters}+| ?{digits}+| ?(?:[^\s\p{{L}}\p{{N}}]|[{newer}])+|\s+(?!\S)|\s+"


def check_supported(definition: str) -> list[str]:
    """The added tokens' strings, if the tokenizer is of the kind that this operator counts for."""
    d = json.loads(definition)
    pre = d.get("pre_tokenizer") or {}
    if (
        d["model"]["type"] != "BPE" or d.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
        or not pre.get("use_regex", True) or d["model"].get("ignore_merges") or d["model"].get("dropout")
    ):
        raise ValueError("only plain byte-level BPE tokenizers are supported")
    added = d.get("added_tokens", [])
    if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
        raise ValueError("added tokens that strip or ask for single words are not supported")
    return [a["content"] for a in added]


class _Counts(dict):
    """Number of tokens by pre-token; what is missing goes through the merges."""

    def __init__(self, definition: str, whole: set[str]):
        from tokenizers import Tokenizer

        super().__init__(dict.fromkeys(whole, 1))
        self._model = Tokenizer.from_str(definition).model
        self._whole, self._most = whole, len(whole) + REMEMBERED
        self._alphabet = {i: c for i, c in enumerate(byte_alphabet())}
        self._older: dict[str, int] = {}

    def __missing__(self, piece: str) -> int:
        n = self._older.get(piece)
        if n is None:
            n = len(self._model.tokenize(piece.encode().decode("latin-1").translate(self._alphabet)))
        if len(piece) <= REMEMBERED_CHARS:
            if len(self) >= self._most:
                self._older = dict(self)
                self.clear()
                self.update(dict.fromkeys(self._whole, 1))
            self[piece] = n
        return n


_counters: dict[int, tuple] = {}


def counter(definition: str, whole: set[str], newer: str = ""):
    """A function from a text to its number of tokens; a worker builds it once."""
    import regex

    key = hash(definition)
    if key not in _counters:
        special = check_supported(definition)
        _counters[key] = (
            _Counts(definition, whole),
            regex.compile(pattern(newer)).findall,
            regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None,
        )
    counts, cut_any, special = _counters[key]
    get = counts.__getitem__
    cut_plain, odd = re.compile(PLAIN).findall, re.compile(NOT_PLAIN).search

    def cut(text: str) -> list[str]:
        return cut_any(text) if odd(text) else cut_plain(text)

    def count(text: str) -> int:
        if special is not None and special.search(text):
            parts = special.split(text)
            return len(parts) - 1 + sum(sum(map(get, cut(p))) for p in parts)
        return sum(map(get, cut(text)))

    return count


def count_tokens(docs: DataFrame, definition: str, *, doc_id: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """A row per document: doc_id, n_bytes, n_tokens, over_limit.

    definition is the text of a tokenizer's JSON file; the driver reads it and broadcasts it with the whole-token
    proof, both as large as the vocabulary. A special string inside a text is one token, as the library takes it by
    default. A null text counts as empty, an empty one has 0 bytes and tokens, an empty table gives no rows; repeated
    rows are counted each. Columns besides the two that are named are not read.
    """
    check_supported(definition)
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((definition, prove_whole(definition), newer_letters(definition)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(*shared.value)
        for batch in batches:
            texts = batch.column(1)
            n_bytes, n_tokens = [], []
            for i in range(len(texts)):
                t = texts[i].as_py() or ""
                n_bytes.append(len(t) if t.isascii() else len(t.encode()))
                n_tokens.append(count(t))
            yield pa.record_batch(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = dict(docs.dtypes)[doc_id]
    return docs.selectExpr(f"`{doc_id}` AS doc_id", f"CAST(`{text}` AS STRING) AS text").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
