"""Benchmark decontamination by Wu-Manber search over words.

Windows of ten consecutive benchmark words are the test strings. A table gives, for every block of two words, how far
the search may move on when it stands on that block: the distance to the nearest place where the block ends inside a
test string, or past all of them if it is in none. Only a block that ends a test string stops the search; its bucket
holds the test strings that end so, and they are compared with the document's words directly.

The index is flat: the benchmark's words as one text, a byte for each place of the shift table, and sorted arrays for the
buckets. Overlapping windows share their text, and equal ones are one entry with a list of items.
"""

from __future__ import annotations

import hashlib
import uuid
from array import array
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlark.llm.common import checkpointed, ship, words_of

WINDOW = 10

#: Bytes of benchmark text that one pass searches for; the index of a pass takes up to ten times as many in each worker.
BLOCK_BYTES = 32 << 20


class Searcher:
    """Test strings of one length."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.far = length - self.block + 1
        self.text = bytearray()
        # of each window: the hash of its last block, its own hash, where it starts in the text, its item
        self.ends, self.marks, self.places, self.items = array("I"), array("q"), array("I"), array("I")
        self._blocks, self._steps = array("I"), array("B")

    def add(self, item: int, words: list[bytes]) -> None:
        blocks = [hash(b) & 0xFFFFFFFF for b in (zip(words, words[1:], strict=False) if self.block == 2 else words)]
        last = self.length - self.block
        self._blocks.extend(blocks)
        self._steps.extend(max(0, last - i) for i in range(len(blocks)))
        joined = b" ".join(words)
        starts = [0, *accumulate(len(w) + 1 for w in words)]
        n, base = len(words) - self.length + 1, len(self.text)
        self.ends.extend(blocks[last : last + n])
        self.marks.extend(hash(joined[starts[i] : starts[i + self.length] - 1]) for i in range(n))
        self.places.extend(base + starts[i] for i in range(n))
        self.items.extend([item] * n)
        self.text += joined + b" "

    def finish(self) -> None:
        blocks, steps = np.frombuffer(self._blocks, np.uint32), np.frombuffer(self._steps, np.uint8)
        size = 1 << max(8, (4 * len(blocks)).bit_length())
        shift = np.full(size, self.far, np.uint8)
        np.minimum.at(shift, blocks & np.uint32(size - 1), steps)
        self.shift, self.mask = shift.tobytes(), size - 1
        del blocks, steps, shift, self._blocks, self._steps
        order = np.lexsort([np.frombuffer(x, k) for x, k in ((self.items, np.uint32), (self.marks, np.int64), (self.ends, np.uint32))]).astype(np.uint32)
        for name, kind in (("ends", np.uint32), ("marks", np.int64), ("places", np.uint32), ("items", np.uint32)):
            held = getattr(self, name)
            setattr(self, name, array(held.typecode, np.frombuffer(held, kind)[order].tobytes()))
        ends, marks = np.frombuffer(self.ends, np.uint32), np.frombuffer(self.marks, np.int64)
        fresh = np.ones(len(ends), bool)
        for i in np.flatnonzero((ends[1:] == ends[:-1]) & (marks[1:] == marks[:-1])) + 1:
            fresh[i] = self._window(self.places[i]) != self._window(self.places[i - 1])
        # entries: windows that differ; the items of entry k are those from first[k] to first[k + 1]
        first = np.flatnonzero(fresh)
        self.ends, self.marks = array("I", ends[first].tobytes()), array("q", marks[first].tobytes())
        self.places = array("I", np.frombuffer(self.places, np.uint32)[first].tobytes())
        self.first = array("I", np.append(first, len(fresh)).astype(np.uint32).tobytes())

    def _window(self, place: int) -> bytes:
        end = place - 1
        for _ in range(self.length):
            end = self.text.index(b" ", end + 1)
        return bytes(self.text[place:end])

    def search(self, words: list[bytes], found: list, ids: set[int]) -> None:
        """Adds the first words of occurrences to found, as (start, end), and the items' numbers to ids."""
        length, n, at = self.length, len(words), self.length - 1
        shift, mask, two = self.shift, self.mask, self.block == 2
        while at < n:
            key = hash((words[at - 1], words[at])) if two else hash(words[at])
            if step := shift[key & mask]:
                at += step
                continue
            key &= 0xFFFFFFFF
            k = bisect_left(self.ends, key)
            if k < len(self.ends) and self.ends[k] == key:
                own = b" ".join(words[at - length + 1 : at + 1])
                mark = hash(own)
                k = bisect_left(self.marks, mark, k, self._past(key, k))
                while k < len(self.ends) and self.ends[k] == key and self.marks[k] == mark:
                    place = self.places[k]
                    if self.text[place : place + len(own) + 1] == own + b" ":
                        found.append((at - length + 1, at + 1))
                        ids.update(self.items[self.first[k] : self.first[k + 1]])
                        break  # equal strings are one entry
                    k += 1
            at += 1

    def _past(self, key: int, low: int) -> int:
        return bisect_left(self.ends, key + 1, low)


def searchers(items: Iterable[tuple[str, bytes]], window: int = WINDOW) -> tuple[list[Searcher], list[str]]:
    """The searchers, and the items' ids by their numbers."""
    by_length: dict[int, Searcher] = {}
    numbers: dict[str, int] = defaultdict(lambda: len(numbers))
    for item, text in items:
        words = words_of(text)
        if words:
            length = min(window, len(words))
            by_length.setdefault(length, Searcher(length)).add(numbers[item], words)
    for s in by_length.values():
        s.finish()
    return [s for _, s in sorted(by_length.items())], list(numbers)


def covered(spans: Iterable[tuple[int, int]]) -> int:
    """Number of words inside any span."""
    n = end = 0
    for a, b in sorted(spans):
        n += max(0, b - max(a, end))
        end = max(end, b)
    return n


def contamination(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, carry: list[str] | None = None, prefix: str = "") -> DataFrame:
    """A row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, with prefix before these names;
    columns in carry come along.

    Null and empty texts have no words and hit nothing, on either side; an item of fewer than `window` words is one
    test string of all of them. A null item id counts as the empty string; rows that repeat an item id are one item.
    An empty benchmark contaminates nothing; an empty table of documents gives no rows. The benchmark goes to the
    executors in blocks of about BLOCK_BYTES of its text (or one item, if that is longer), one index to a pass; a larger
    benchmark takes several passes, and what one has found is written out before the next.
    """
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("body")
    )
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    carry = carry or []
    held = [f"carried_{i}" for i in range(len(carry))]
    kinds = dict(docs.dtypes)
    # a text that comes along isn't sent twice
    body = held[carry.index(text)] if text in carry and kinds[text] == "string" else "body"
    df = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.lit(None).cast("array<int>").alias("spans"), F.lit(None).cast("array<string>").alias("items"),
        *[F.col(f"`{c}`").alias(h) for c, h in zip(carry, held, strict=True)], *([F.col(f"`{text}`").cast("string").alias("body")] if body == "body" else []),
    )
    head = f"doc_id {kinds[doc_id]}"
    tail = "".join(f", {h} {kinds[c]}" for c, h in zip(carry, held, strict=True))
    for k in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == k)
        shared = spark.sparkContext.broadcast([(r[0], r[1].encode()) for r in part.toLocalIterator()])
        last = k == blocks - 1
        between = f"{head}, spans array<int>, items array<string>{tail}{', body string' * (body == 'body')}"
        schema = f"{head}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean{tail}" if last else between
        df = df.mapInArrow(_pass(shared, window, last, body, held), schema)
        if not last:
            df = checkpointed(df)
            shared.destroy()
    own = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return df.select(*[F.col(c).alias(prefix + c) for c in own], *[F.col(h).alias(c) for c, h in zip(carry, held, strict=True)])


_built: dict[str, tuple[list[Searcher], list[str]]] = {}


def _tests(key: str, shared, window: int) -> tuple[list[Searcher], list[str]]:
    """Of the block called key; a worker builds them once."""
    if key not in _built:
        _built.clear()
        _built[key] = searchers(shared.value, window)
    return _built[key]


def _pass(shared, window: int, last: bool, body: str, carried: list[str]):
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests, names = _tests(key, shared, window)
        for batch in batches:
            n_words, spans, items = [], [], []
            for text, had, own in zip(batch.column(body).cast(pa.binary()), batch.column("spans"), batch.column("items"), strict=True):
                words = words_of(text.as_py() or b"")
                flat = had.as_py() or []
                found, ids = list(zip(flat[::2], flat[1::2], strict=True)), set()
                for t in tests:
                    t.search(words, found, ids)
                n_words.append(len(words))
                spans.append(found)
                items.append(sorted({names[i] for i in ids}.union(own.as_py() or [])))
            if last:
                hit = [covered(s) for s in spans]
                made = {
                    "n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(hit, pa.int64()), "n_items": pa.array([len(x) for x in items], pa.int64()),
                    "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()), "contaminated": pa.array([h > 0 for h in hit], pa.bool_()),
                }
            else:
                made = {"spans": pa.array([[x for s in f for x in s] for f in spans], pa.list_(pa.int32())), "items": pa.array(items, pa.list_(pa.string()))}
            along = [*carried, *(["body"] if body == "body" and not last else [])]
            columns = {"doc_id": batch.column("doc_id")} | made | {c: batch.column(c) for c in along}
            yield pa.record_batch(list(columns.values()), names=list(columns))

    return run


SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
test AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS t
  FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM item WHERE len(w) > 0)),
place AS (
  SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc, (SELECT DISTINCT n FROM test) WHERE len(w) >= n),
hit AS (
  SELECT p.doc_id, p.i, p.n, t.item FROM (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS t FROM place) p
  JOIN test t ON t.t = p.t AND t.n = p.n),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS j FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
