"""Approximate nearest neighbours by a forest of hash prefixes.

Each tree draws its own random directions, in groups of sixteen; of each group a vector's symbol is the direction it lies
along most, with its sign. The symbols of a tree are a string, and the tree is the sorted array of its strings. A query
descends to its longest prefix in each tree, then the trees ascend together, one symbol at a time, some trees in each
step, and what they reach is scored by the exact inner product. The ascent ends when the vectors found are so near that,
by the odds of sharing a prefix at that angle, the trees have missed hardly any as near. So a query among close
neighbours meets few rows, and one that is about as far from everything meets many. For the hashes alone, vectors get
one more component that brings all to one length, so that the nearest by inner product are the nearest by angle.

The rows are dealt to shards by hash. A task goes through its shards one after the other: it builds a shard's forest
once, then answers all queries, batch by batch as they come in.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlark.llm.common import checkpointed, ship

#: Rows of a shard, about.
SHARD = 16_384
#: Trees of a forest, symbols of a string, directions of a symbol.
TREES, SYMBOLS, DIRECTIONS = 192, 5, 16
#: Trees that ascend in one step, at least.
STEP = 4
#: The share of a query's nearest that the ascent goes on for, as estimated from the angles of those found.
WANTED = 0.95
#: So few distinct vectors are all scored.
LEAST = 256


@cache
def agreement() -> tuple[np.ndarray, np.ndarray]:
    """The probability that two vectors share a symbol, by the cosine between them; simulated once, never falling."""
    r = np.random.default_rng(5)
    a, b = r.normal(size=(2, 8_000, DIRECTIONS))
    cosines = np.linspace(-1, 1, 41)
    place = np.arange(len(a))
    shares = []
    for c in cosines:
        x = c * a + np.sqrt(1 - c * c) * b
        own, other = np.abs(a).argmax(1), np.abs(x).argmax(1)
        shares.append(((own == other) & ((a[place, own] > 0) == (x[place, own] > 0))).mean())
    return cosines, np.maximum.accumulate(shares)


class Forest:
    def __init__(self, ids: np.ndarray, times: np.ndarray, vectors: np.ndarray, nearest: int):
        """times: how often a row stands for itself; nearest: how many of a query's nearest the shard is asked to have."""
        order = np.argsort(ids, kind="stable")
        ids, times, vectors = ids[order], times[order], vectors[order]
        rows = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.shape[1] * vectors.dtype.itemsize))).ravel()
        _, first, leaf = np.unique(rows, return_index=True, return_inverse=True)
        self.vectors = vectors[first]
        by_leaf = np.argsort(leaf, kind="stable")
        self.rows, self.starts = by_leaf, np.searchsorted(leaf[by_leaf], np.arange(len(first) + 1))
        self.ids, self.times, self.nearest = ids, times, nearest
        norms = (self.vectors**2).sum(1)
        self.longest = float(np.sqrt(norms.max()))
        level = np.append(self.vectors, np.sqrt(np.maximum(0, norms.max() - norms))[:, None], axis=1)
        r = np.random.default_rng(97)
        self.width = (2 * DIRECTIONS - 1).bit_length()
        self.directions = [self._apart(r.normal(size=(level.shape[1], SYMBOLS * DIRECTIONS))) for _ in range(TREES)]
        self.trees = []
        for own in self.directions:
            code = self._codes(level.astype(np.float32), own)
            order = np.argsort(code, kind="stable")
            self.trees.append((code[order], order.astype(np.int32)))

    @staticmethod
    def _apart(group: np.ndarray) -> np.ndarray:
        """Directions of a symbol at right angles, where there are dimensions enough."""
        parts = np.split(group, SYMBOLS, axis=1)
        return np.concatenate([np.linalg.qr(p)[0] if len(p) >= DIRECTIONS else p for p in parts], axis=1).astype(np.float32)

    def _codes(self, x: np.ndarray, directions: np.ndarray) -> np.ndarray:
        along = (x @ directions).reshape(len(x), SYMBOLS, DIRECTIONS)
        most = np.abs(along).argmax(2)
        symbol = 2 * most + (np.take_along_axis(along, most[:, :, None], 2)[:, :, 0] > 0)
        return (symbol << (self.width * np.arange(SYMBOLS - 1, -1, -1))).sum(1)

    def nearest_of(self, own: np.ndarray, queries: np.ndarray, k: int):
        """(query's place, ids, scores, rows scored) of the k nearest found, own the query's id."""
        flat = np.append(queries, np.zeros((len(queries), 1)), axis=1).astype(np.float32)
        codes = np.stack([self._codes(flat, d) for d in self.directions])
        low, high = np.empty((SYMBOLS + 1, TREES, len(queries)), np.int32), np.empty((SYMBOLS + 1, TREES, len(queries)), np.int32)
        for length in range(SYMBOLS + 1):
            shift = self.width * (SYMBOLS - length)
            for t, (tree, _) in enumerate(self.trees):
                prefix = codes[t] >> shift
                low[length, t], high[length, t] = np.searchsorted(tree, prefix << shift), np.searchsorted(tree, (prefix + 1) << shift)
        begin, end = np.searchsorted(self.ids, own), np.searchsorted(self.ids, own, side="right")
        for q, mine in enumerate((end - begin).tolist()):
            leaves, score = self._ascend(queries[q], low[:, :, q], high[:, :, q], k, mine)
            scored, most = len(leaves), k + mine  # rows of the query's own id may be among the best
            if len(leaves) > most:
                edge = np.partition(score, len(score) - most)[len(score) - most]
                leaves, score = leaves[score >= edge], score[score >= edge]
            held = [self.rows[self.starts[leaf] : self.starts[leaf + 1]][:most] for leaf in leaves]
            rows = np.concatenate(held)
            score = np.repeat(score, [len(h) for h in held])
            other = self.ids[rows] != own[q]
            rows, score = rows[other], score[other]
            often = np.minimum(self.times[rows], k)
            ids, score = np.repeat(self.ids[rows], often), np.repeat(score, often)
            order = np.lexsort((ids, -score))[:k]
            yield q, ids[order], score[order], scored

    def _ascend(self, query: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, mine: int) -> tuple[np.ndarray, np.ndarray]:
        """The leaves that the trees reach, with their scores. mine: how many rows are of the query's own id."""
        if len(self.vectors) <= LEAST:
            return np.arange(len(self.vectors)), self.vectors @ query
        known = np.zeros(len(self.vectors), bool)
        leaves, scores = [], []
        length, best, wanted = float(np.sqrt(query @ query)) * self.longest, np.zeros(0), self.nearest + mine
        near = best
        # what longer prefixes reach is part of it: the first step takes all trees where that can be enough
        sums = (high - low).sum(1)
        first = max((d for d in range(SYMBOLS + 1) if sums[d] >= wanted), default=0)
        for depth in range(first, -1, -1):
            at = to = 0
            while at < TREES:
                to = TREES if depth == first else self._next(near / length, depth, at)
                new = known.copy()
                for t in range(at, to):
                    if (a := low[depth, t]) < (b := high[depth, t]):
                        new[self.trees[t][1][a:b]] = True
                new &= ~known
                found = np.flatnonzero(new)
                if len(found):
                    known |= new
                    leaves.append(found)
                    scores.append(self.vectors[found] @ query)
                    best = np.append(best, scores[-1])
                    best = np.sort(best if len(best) <= k + mine else np.partition(best, len(best) - k - mine)[-k - mine :])
                near = best[max(0, len(best) - wanted) : len(best) - mine]
                if len(best) >= wanted and self._reached(near / length, depth, np.array([to]))[0] >= WANTED:
                    return np.concatenate(leaves), np.concatenate(scores)
                at = to
        return np.concatenate(leaves), np.concatenate(scores)

    def _next(self, cosines: np.ndarray, depth: int, at: int) -> int:
        """How many trees have ascended after the next step: two thirds of the way to where those found so far would do,
        for what a step finds is nearer. With too few found, it is an eighth of all."""
        if len(cosines) < self.nearest:
            return min(at + TREES // 8, TREES)
        several = np.arange(at + STEP, TREES, STEP)
        enough = several[self._reached(cosines, depth, several) >= WANTED]
        whole = int(enough[0]) if len(enough) else TREES
        return min(max(at + STEP, (at + 2 * whole) // 3), TREES)

    @staticmethod
    def _reached(cosines: np.ndarray, depth: int, trees: np.ndarray) -> np.ndarray:
        """For each number of trees, the mean probability that vectors at these angles share `depth` symbols with the query
        in one of so many, or one more in another."""
        x, shares = agreement()
        p = np.minimum(np.interp(cosines, x, shares), 1 - 1e-12)
        missed = trees[:, None] * np.log1p(-(p**depth) * (1 - 1e-12)) + (TREES - trees[:, None]) * np.log1p(-(p ** (depth + 1)))
        return 1 - np.exp(missed).mean(1)


def _vectors(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _answers(batches: Iterator[pa.RecordBatch], nearest: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows come shard by shard, of each first the rows of the index, then the queries."""
    held: list[pa.RecordBatch] = []
    forest, key = None, None
    for batch in batches:
        keys = np.stack([batch.column("dim").to_numpy(), batch.column("shard").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False).astype(np.int64)], axis=1)
        edges = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1 if len(keys) else []
        for a, b in zip([0, *edges], [*edges, len(keys)], strict=True):
            part, (dim, shard, asks) = batch.slice(a, b - a), keys[a].tolist() if len(keys) else (0, 0, 0)
            if (dim, shard) != key:
                key, held, forest = (dim, shard), [], None
            if not asks:
                held.append(part)
                continue
            if forest is None:
                if not held:
                    continue
                rows = pa.Table.from_batches(held).combine_chunks()
                forest = Forest(rows["id"].to_numpy(), rows["times"].to_numpy(), _vectors(rows["v"].combine_chunks()), nearest)
                held = []
            names, same = part.column("id").to_numpy(), part.column("same").to_numpy()
            none = [np.zeros(0, np.int64)]
            query, mark, ids, scores, scored = [], [], [], [], []
            for at in range(0, part.num_rows, 256):
                few = slice(at, min(at + 256, part.num_rows))
                for q, found, score, met in forest.nearest_of(names[few], _vectors(part.column("v").slice(at, few.stop - at)), k):
                    query.append(np.full(len(found), names[at + q]))
                    mark.append(np.full(len(found), same[at + q]))
                    ids.append(found)
                    scores.append(score)
                    scored.append(np.full(len(found), met))
            yield pa.record_batch(
                [np.concatenate(x or none) for x in (query, mark, ids)] + [np.concatenate(scores or [np.zeros(0)]), np.concatenate(scored or none)],
                names=["query_id", "same", "vec_id", "score", "scored"],
            )


def search(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20) -> DataFrame:
    """Of each row whose id is divisible by `every`: query_id, rank, vec_id, score of its k nearest found among all others.

    Nearest is the largest inner product in double precision; ties go to the smaller id, fewer rows than k all come.
    Null ids, and vectors that are null, empty, zero or hold null or non-finite components, take no part; vectors of
    another length than the query's aren't compared with it. Rows that repeat an id are no candidates of each other;
    rows that repeat id and vector are one query, and as candidates each counts. An empty table gives no rows; columns
    besides the two that are named are not read.
    """
    return searched(vectors, vec_id=vec_id, vector=vector, every=every, k=k).select("query_id", "rank", "vec_id", "score")


def searched(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20) -> DataFrame:
    """As search(), with `scored`: how many distinct vectors were scored for the query in the shard that a row is from."""
    ship(vectors.sparkSession)
    x = F.col("v")
    sound = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & F.exists(x, lambda c: c != 0)
    rows = checkpointed(
        vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
        .filter(F.col("id").isNotNull() & x.isNotNull())
        .filter(sound)
        .groupBy("id", "v")
        .agg(F.count(F.lit(1)).alias("times"))
        .select("id", "v", "times", F.size("v").alias("dim"), F.xxhash64("id", "v").alias("same"))
    )
    n = rows.count()
    shards = max(1, -(-n // SHARD))
    # a shard has a random part of a query's nearest; so many but for odds of about one in a thousand
    nearest = min(k, int(np.ceil(k / shards + 3 * np.sqrt(k / shards))))
    index = rows.select("id", "v", "times", "dim", "same", F.pmod("same", F.lit(shards)).cast("long").alias("shard"), F.lit(False).alias("asks"))
    every_shard = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard")
    asked = rows.filter(F.col("id") % every == 0).select("id", "v", "times", "dim", "same", every_shard, F.lit(True).alias("asks"))
    dealt = index.union(asked).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "asks")
    found = dealt.mapInArrow(lambda batches: _answers(batches, nearest, k), "query_id long, same long, vec_id long, score double, scored long")
    best = Window.partitionBy("query_id", "same").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "scored")
