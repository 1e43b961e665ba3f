"""Near-duplicate join on word shingles: MinHash bands propose, Bayesian pruning thins out, exact sets decide.

1. Every text becomes a set of hashed shingles and a MinHash signature. Texts with equal sets are one class; only its
   first document goes on, with the class's size.
2. Classes that share a band of the signature are candidates. Their signatures are compared a few values at a time, and
   a pair goes as soon as the posterior probability that its similarity reaches the threshold is below a tolerance. Each
   group of candidates gives back a spanning forest of what is left, never its pairs.
3. Within each connected component of these forests, all pairs that the same pruning leaves are compared exactly.

Groups larger than a tile are split by hash and every two tiles meet in a task of their own, so no task holds more than
two tiles, and what comes back is one row per member and task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlark.llm.common import _WORD_BYTES, checkpointed, ship, small

WORDS, THRESHOLD = 5, 0.8
#: Signature: 24 bands of 4 values. A pair at the threshold shares no band with probability (1 - 0.8 ** 4) ** 24 = 3e-6.
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
#: Values compared between two looks at the posterior; pairs below this probability go.
LOOK, TOLERANCE = 16, 1e-6
#: Members of a tile.
TILE = 512

_r = np.random.default_rng(20240601)
_PLACES = _r.integers(0, 2**63, 1024, np.uint64) * np.uint64(2) + np.uint64(1)
_TURNS = _r.integers(0, 2**63, 16, np.uint64) * np.uint64(2) + np.uint64(1)
_A = _r.integers(0, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _r.integers(0, 2**63, HASHES, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)


def shingles(data: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of runs of so many words; of all words, if there are fewer; none without a word."""
    raw = np.frombuffer(data.translate(_WORD_BYTES), np.uint8)
    inside = raw != 32
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts = edge[::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = edge[1::2] - starts
    place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    weights = _PLACES[place & 1023]
    if int(place.max()) > 1023:  # the first places of every word keep their weights
        weights = weights + (_mix((place >> 10).astype(np.uint64)) << np.uint64(1))
    letters = (raw[inside].astype(np.uint64) + np.uint64(1)) * weights
    word = _mix(np.add.reduceat(letters, np.cumsum(length) - length))
    n = min(words, len(word))
    run = np.full(len(word) - n + 1, n, np.uint64)
    for k in range(n):
        run += word[k : len(word) - n + 1 + k] * _TURNS[k % 16]
    return np.unique(_mix(run))


def signature(sets: np.ndarray) -> np.ndarray:
    """HASHES values of 16 bits."""
    low = np.full(HASHES, 2**32 - 1, np.uint64)
    for at in range(0, len(sets), 2048):
        low = np.minimum(low, ((sets[at : at + 2048, None] * _A + _B) >> np.uint64(32)).min(0))
    return (_mix(low + np.uint64(1)) >> np.uint64(40)).astype(np.uint16)


def fewest_matches(threshold: float, tolerance: float = TOLERANCE, hashes: int = HASHES, look: int = LOOK) -> list[int]:
    """After each look, the least number of equal values with which a pair goes on.

    Under a uniform prior the similarity after m matches of n is Beta(m + 1, n - m + 1); it is at least t with the
    probability that of n + 1 coins of bias t at most m show heads.
    """
    out = []
    for n in range(look, hashes + 1, look):
        total, m = 0.0, 0
        for m in range(n + 1):
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
        out.append(m)
    return out


def prune(signatures: np.ndarray, i: np.ndarray, j: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs i, j those that no look throws out."""
    equal = np.zeros(len(i), np.int32)
    for k, m in enumerate(least):
        part = signatures[:, k * LOOK : (k + 1) * LOOK]
        equal += (part[i] == part[j]).sum(1, dtype=np.int32)
        keep = equal >= m
        if not keep.all():
            i, j, equal = i[keep], j[keep], equal[keep]
    return i, j


def components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member of each one's component."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, rows with equal first columns, with where each starts. A group has two tiles at most."""
    rest = None
    for batch in batches:
        new = pa.Table.from_batches([batch])
        table = new if rest is None else pa.concat_tables([rest, new]).combine_chunks()
        if not table.num_rows:
            continue
        starts = _starts(table, keys)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts[:-1]
        rest = table.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest, np.zeros(1, np.int64)


def _starts(table: pa.Table, keys: int) -> np.ndarray:
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for k in range(keys):
        column = table.column(k)
        if pa.types.is_binary(column.type):
            value = np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(table.num_rows, 2)
            change[1:] |= (value[1:] != value[:-1]).any(1)
        else:
            value = column.to_numpy()
            change[1:] |= value[1:] != value[:-1]
    return np.flatnonzero(change)


def _matrix(column, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _sketch(df: DataFrame, kind: str, words: int) -> DataFrame:
    """(doc_id, th, class, n, signature) of (doc_id, th, body); class and signature are null for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, sizes, signatures = [], [], []
            for body in batch.column(2):
                own = shingles(body.as_py() or b"", words)
                sizes.append(len(own))
                classes.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                signatures.append(signature(own).tobytes() if len(own) else None)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(classes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary())],
                names=["doc_id", "th", "class", "n", "signature"],
            )

    return df.mapInArrow(run, f"doc_id {kind}, th long, class binary, n long, signature binary")


def _tiled(df: DataFrame, members: Column, *keys: str) -> DataFrame:
    """Rows to the tasks of the two-tile pairs that their tile takes part in: columns a, b, tile beside the others."""
    tiles = F.ceil(members / F.lit(TILE)).cast("int")
    pairs = (
        df.withColumn("tiles", tiles)
        .withColumn("tile", F.when(F.col("tiles") <= 1, F.lit(0)).otherwise(F.pmod(F.xxhash64("class"), F.col("tiles")).cast("int")))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.greatest(F.col("tiles") - 1, F.lit(0)))))
        .withColumns({"a": F.least("tile", "other"), "b": F.greatest("tile", "other")})
        .drop("tiles", "other")
    )
    return pairs.repartition(*keys, "a", "b").sortWithinPartitions(*keys, "a", "b", "class")


def _forests(tiled: DataFrame, least: list[int]) -> DataFrame:
    """Edges (u, v) of a spanning forest of the candidate pairs that pruning leaves in each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _whole_groups(batches, 3):
            n = table.num_rows
            end = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
            cross, tile = table.column("a").to_numpy() != table.column("b").to_numpy(), table.column("tile").to_numpy()
            signatures = _matrix(table.column("signature"), np.uint16, HASHES)
            left, right = [], []
            live, d = np.flatnonzero(np.arange(n) + 1 < end), 1
            while len(live):
                i, j = live, live + d
                meant = ~cross[i] | (tile[i] != tile[j])
                i, j = prune(signatures, i[meant], j[meant], least)
                left.append(i)
                right.append(j)
                d += 1
                live = live[live + d < end[live]]
            i, j = np.concatenate([*left, np.zeros(0, np.int64)]), np.concatenate([*right, np.zeros(0, np.int64)])
            root = components(n, i.astype(np.int64), j.astype(np.int64))
            away = np.flatnonzero(root != np.arange(n))
            names = table.column("class").to_pylist()
            yield pa.record_batch([pa.array([names[k] for k in away], pa.binary()), pa.array([names[k] for k in root[away]], pa.binary())], names=["u", "v"])

    return tiled.select("bucket", "a", "b", "tile", "class", "signature").mapInArrow(run, "u binary, v binary").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge, root the least node of its component: large and small stars in turn.

    Each round every edge moves to the least neighbour of its larger, then of its smaller end. Components that are one
    star about their least node are done and leave the graph, before the first round, too; the rounds end when none is
    left. A node may have a neighbour in every row, so what the edges are joined to is summed up within tasks and written
    out before: those joins are broadcasts, or their large keys can be split.
    """
    edges = checkpointed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct())
    done = []
    while True:
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
        bent = checkpointed(ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR up > 0 AND down > 0"))
        if not bent.limit(1).count():
            done.append(edges)
            break
        touched = edges.join(small(bent.select(F.col("node").alias("u"))), "u", "left_semi").select("v")
        centres = small(checkpointed(touched.union(bent.filter("down > 0").select("node")).distinct()))
        done.append(edges.join(centres, "v", "left_anti").select("u", "v"))
        edges = checkpointed(edges.join(centres, "v", "left_semi").select("u", "v"))
        both = edges.union(edges.select("v", "u"))
        low = checkpointed(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = checkpointed(both.join(small(low), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct())
        least = checkpointed(large.groupBy("u").agg(F.min("v").alias("m")))
        moved = large.join(small(least), "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(moved.union(least.select("u", "m")).distinct())
    found = reduce(DataFrame.union, done)
    return found.select(F.col("u").alias("node"), F.col("v").alias("root")).union(found.select("v", "v").distinct())


def intersections(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs, by bits in blocks of columns."""
    out = np.zeros(len(i), np.int64)
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = times[column] > 1
    owner, column = owner[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 8192):
        a, b = np.searchsorted(column, [low, low + 8192])
        bits = np.zeros((len(sets), 8192), bool)
        bits[owner[a:b], column[a:b] - low] = True
        packed = np.packbits(bits, axis=1).view(np.uint64)
        for at in range(0, len(i), 8192):
            out[at : at + 8192] += np.bitwise_count(packed[i[at : at + 8192]] & packed[j[at : at + 8192]]).sum(1, dtype=np.int64)
    return out


def _verified(tiled: DataFrame, least: list[int], threshold: float) -> DataFrame:
    """(class, links, root) for each member and task: links to classes of the task count their copies; root is the least
    class that links lead to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _whole_groups(batches, 3):
            names_out, links_out, roots_out = [], [], []
            for at, to in zip(starts, np.append(starts[1:], table.num_rows), strict=True):
                part = table.slice(at, to - at)
                names = part.column("class").to_pylist()
                own = [k for k in range(len(names)) if not k or names[k] != names[k - 1]]  # a document read twice is one
                names = [names[k] for k in own]
                sets = [np.frombuffer(part.column("shingles")[k].as_py(), np.uint64) for k in own]
                copies, tile = part.column("copies").to_numpy()[own], part.column("tile").to_numpy()[own]
                signatures = _matrix(part.column("signature"), np.uint16, HASHES)[own]
                i, j = np.triu_indices(len(names), 1)
                if part.column("a")[0].as_py() != part.column("b")[0].as_py():
                    cross = tile[i] != tile[j]
                    i, j = i[cross], j[cross]
                i, j = prune(signatures, i, j, least)
                links, root = np.zeros(len(names), np.int64), np.arange(len(names))
                if len(i):
                    size = np.array([len(s) for s in sets])
                    common = intersections(sets, i, j)
                    linked = common >= threshold * (size[i] + size[j] - common) - 1e-9
                    i, j = i[linked], j[linked]
                    np.add.at(links, i, copies[j])
                    np.add.at(links, j, copies[i])
                    root = components(len(names), i, j)
                names_out += names
                links_out += links.tolist()
                roots_out += [names[k] for k in root]
            yield pa.record_batch([pa.array(names_out, pa.binary()), pa.array(links_out, pa.int64()), pa.array(roots_out, pa.binary())], names=["class", "links", "root"])

    held = tiled.select("group", "a", "b", "tile", "class", "copies", "signature", "shingles")
    return held.mapInArrow(run, "class binary, links long, root binary")


def _fetched(docs: DataFrame, active: DataFrame, again: DataFrame, words: int) -> DataFrame:
    """The classes' shingle sets, from the text of their first documents. again: the classes whose first document is
    several rows; of their texts each task passes on one before they meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(b.as_py() or b"", words) for b in batch.column(0)]
            keep = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() == c for s, c in zip(sets, batch.column(1).to_pylist(), strict=True)]
            out = pa.record_batch([*batch.columns[1:], pa.array([s.tobytes() for s in sets], pa.binary())], names=[*batch.schema.names[1:], "shingles"])
            yield out.filter(pa.array(keep, pa.bool_()))

    names = ["class", "group", "members", "copies", "signature"]
    texts = docs.select(_id_text("doc_id").alias("key"), "th", "body")
    if again.limit(1).count():
        once, twice = checkpointed(active.join(small(again), "class", "left_anti")), checkpointed(active.join(small(again), "class", "left_semi"))
        one = texts.join(small(twice), ["key", "th"]).groupBy("class").agg(F.first("body").alias("body"), *[F.first(c).alias(c) for c in names[1:]])
        joined = texts.join(small(once), ["key", "th"]).select("body", *names).unionByName(one.select("body", *names))
    else:
        joined = texts.join(small(active), ["key", "th"]).select("body", *names)
    return joined.mapInArrow(run, "class binary, group binary, members long, copies long, signature binary, shingles binary")


def _linked(docs: DataFrame, doc_id: str, text: str, words: int, threshold: float) -> DataFrame:
    """A row per row of docs: doc_id, th, class, n, lead, links. lead is (no, doc_id, th) of the first document that links
    lead to, itself among them; it is null for texts that are linked to nothing."""
    ship(docs.sparkSession)
    least = fewest_matches(threshold)
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), _text_hash(text).alias("th"), _body(text).cast("binary").alias("body"))
    rows = checkpointed(_sketch(own, dict(docs.dtypes)[doc_id], words))
    first = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "th")
    classes = checkpointed(
        rows.filter("class IS NOT NULL")
        .groupBy("class")
        .agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("copies"), F.min("signature").alias("signature"))
    )
    band = lambda k: F.xxhash64(F.lit(k), F.substring("signature", 1 + 2 * ROWS * k, 2 * ROWS))
    banded = classes.select("class", F.explode(F.array(*map(band, range(BANDS)))).alias("bucket"))
    # what is joined by a key that many rows may share is written out before, so that the join can split that key
    shared = checkpointed(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"))
    candidates = banded.join(small(shared), "bucket").join(classes.select("class", "signature"), "class")
    near = checkpointed(connected(_forests(_tiled(candidates, F.col("members"), "bucket"), least)))
    sized = near.join(small(checkpointed(near.groupBy("root").agg(F.count(F.lit(1)).alias("members")))), "root")
    active = checkpointed(
        sized.join(classes, sized["node"] == classes["class"]).select(
            _id_text("first.doc_id").alias("key"), F.col("first.th").alias("th"),
            "class", F.col("root").alias("group"), "members", "copies", "signature",
        )
    )
    firsts = rows.select("class", _id_text("doc_id").alias("key"), "th").join(small(active.select("class", "key", "th")), ["class", "key", "th"])
    again = checkpointed(firsts.groupBy("class").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("class"))
    fetched = _fetched(own, active, again, words)
    found = checkpointed(_verified(_tiled(fetched, F.col("members"), "group"), least, threshold))
    # a component within one tile is found whole by its task; only of larger ones do the tasks' roots have to meet
    wide = active.filter(F.col("members") > TILE).select("class")
    one = found.join(wide, "class", "left_anti").select("class", "root")
    many = connected(found.join(wide, "class", "left_semi").select(F.col("class").alias("u"), F.col("root").alias("v")))
    roots = one.union(many.select("node", "root")) if wide.limit(1).count() else one
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    leading = checkpointed(roots.join(classes.select("class", F.col("first").alias("own")), "class").groupBy("root").agg(F.min("own").alias("lead")))
    named = roots.join(small(leading), "root").select("class", "lead")
    told = checkpointed(
        classes.filter("copies > 1").select("class", "copies", F.col("first").alias("own"))
        .join(named, "class", "full")
        .join(links, "class", "left")
        .select("class", F.coalesce("lead", "own").alias("lead"), (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    )
    # written out, so that a text that stands everywhere can be split in the join, or the join be a broadcast
    return rows.select("doc_id", "th", "class", "n").join(small(told), "class", "left")


def _id_text(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def _body(text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))


def _text_hash(text: str) -> Column:
    return F.xxhash64(_body(text))


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """A row per row of docs: doc_id, class_id, n_links, n_shingles.

    Two documents are linked if the Jaccard similarity of their sets of `words`-word shingles is at least `threshold`; a
    text of fewer words has one shingle of them all. class_id is the least doc_id that links lead to, the document's own
    without any. n_links is its number of linked documents, copies among them. Texts without words, null or empty, are
    linked to nothing, not even to each other. Null ids count after all others; documents with equal ids are documents
    of their own. An empty table gives no rows; columns besides the two that are named are not read.
    """
    return _linked(docs, doc_id, text, words, threshold).select(
        "doc_id", F.coalesce("lead.doc_id", "doc_id").alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.col("n").alias("n_shingles")
    )


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The row of docs that leads each group, and those that are in none; columns as they are.

    The leader is the document of least id, a null id counting as greatest; of documents that share the least id the one
    whose text has the least hash, and of rows that repeat both one. Texts without words are in no group and all stay.
    """
    id_ = F.col(f"`{doc_id}`")
    key = [id_.isNull().alias("key_no"), F.coalesce(id_.cast("string"), F.lit("")).alias("key_id"), _text_hash(text).alias("key_th")]
    linked = checkpointed(_linked(docs, doc_id, text, WORDS, THRESHOLD).filter("links > 0").select("doc_id", "th", "lead"))
    names = ["key_no", "key_id", "key_th"]
    held = [F.col("doc_id").isNull().alias("key_no"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key_id"), F.col("th").alias("key_th")]
    leads = (F.col("th") == F.col("lead.th")) & F.col("doc_id").eqNullSafe(F.col("lead.doc_id"))
    gone = linked.filter(~leads).select(*held).distinct()
    again = linked.filter(leads).groupBy(*held).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*names)
    n_again = again.count()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept_row"), *key)
    kept = rows.join(small(gone), names, "left_anti")
    if n_again:  # only rows that repeat an id and a text meet in a shuffle, one of them for each task
        twice = small(again)
        once = kept.join(twice, names, "left_anti")
        kept = once.unionByName(kept.join(twice, names, "left_semi").dropDuplicates(names).select(*kept.columns))
    return kept.select(*[F.col(f"kept_row.`{c}`").alias(c) for c in docs.columns])


SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
shingle AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM doc WHERE len(w) > 0)),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
link AS MATERIALIZED (
  SELECT x, y FROM common JOIN size sx ON sx.doc_id = x JOIN size sy ON sy.doc_id = y WHERE 5 * c >= 4 * (sx.n + sy.n - c)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y),
class AS (SELECT x, min(y) AS class_id FROM reach GROUP BY x),
links AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT doc.doc_id, class_id, CAST(coalesce(links.n, 0) AS BIGINT) AS n_links, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles
FROM doc JOIN class ON class.x = doc.doc_id LEFT JOIN links ON links.x = doc.doc_id LEFT JOIN size ON size.doc_id = doc.doc_id
"""
