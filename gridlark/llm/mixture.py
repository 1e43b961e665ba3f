"""Mixing sources to target weights by hash-threshold histograms.

Every document gets 48-bit hashes: of its id, of its text, and where whole rows come out, of the row. Words are summed by
source and by the first twelve bits of the first hash; in the bucket where the running sum passes a source's budget the
next twelve bits are taken, and so on, so that four small histograms give the exact hash below which a document is in.
Only where several rows share that hash, as repeated and null ids do, the next hash is refined in the same way. Rows that
share all hashes are alike, so as many of them are taken as bring the source nearest to its target. No document is
sorted, and what is taken depends on the rows and their sources' sums alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlark.llm.common import checkpointed, small

LEVELS, BITS = 4, 12
SEED = "mix"
#: Alike rows are written out from their number in blocks of so many.
BLOCK = 100_000


def size_of(text: Column) -> Column:
    """Number of words, runs of anything but space and the characters 9 to 13."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def _hash(x: Column) -> Column:
    digest = F.md5(F.coalesce(F.concat(F.lit(f"{SEED}:"), x.cast("string")), F.lit(SEED)))
    return F.conv(F.substring(digest, 1, LEVELS * BITS // 4), 16, 10).cast("long")


def _row_hash(docs: DataFrame) -> Column:
    """Of all columns and which of them are null; maps, which have no hash, by their JSON."""
    columns = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in kind else F.col(f"`{c}`") for c, kind in docs.dtypes]
    return F.shiftrightunsigned(F.xxhash64(*columns, *[F.col(f"`{c}`").isNull() for c in docs.columns]), 64 - LEVELS * BITS)


def _key(source: Column) -> Column:
    """A string that is never null and orders as the sources do, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def targets(sized: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """A row per source: mx_key, source_size, target.

    Sources by code point, null last, weigh as `weights` does in turn. A source's share of all words is its target
    unless that is above `most` times its size; what is beyond goes to the others by weight, until none is above. That
    fixed point needs no loop: by ascending ratio of limit to weight, the limited sources come first.
    """
    everything = Window.partitionBy()
    sums = sized.groupBy("mx_key").agg(F.sum("mx_size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy("mx_key")) - 1) % len(weights) + 1
    weighed = sums.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), turn).cast("long")).withColumn(
        "limit", F.col("source_size") * most
    )
    before = Window.orderBy(F.col("limit") / F.col("w"), "mx_key").rowsBetween(Window.unboundedPreceding, -1)
    total, weight = F.sum("source_size").over(everything), F.sum("w").over(everything)
    level = (total - F.coalesce(F.sum("limit").over(before), F.lit(0))).cast("double") / (
        weight - F.coalesce(F.sum("w").over(before), F.lit(0))
    ).cast("double")
    flagged = weighed.withColumns({"total": total, "level": level}).withColumn(
        "limited", F.col("limit").cast("double") / F.col("w") <= F.col("level")
    )
    held = F.sum(F.when(F.col("limited"), F.col("limit")).otherwise(F.lit(0))).over(everything)
    free = F.sum(F.when(F.col("limited"), F.lit(0)).otherwise(F.col("w"))).over(everything)
    share = (F.col("total") - held).cast("double") / free.cast("double") * F.col("w").cast("double")
    return flagged.withColumn(
        "target", F.when(F.col("limited"), F.col("limit").cast("double")).otherwise(share)
    ).select("mx_key", "source_size", "target")


def _sized(docs: DataFrame, doc_id: str, text: str, source: str, keep: list[Column], whole_rows: bool) -> DataFrame:
    hashes = [_hash(F.col(doc_id)), _hash(F.col(text)), *([_row_hash(docs)] if whole_rows else [])]
    return docs.select(*keep, _key(F.col(source)).alias("mx_key"), size_of(F.col(text)).alias("mx_size"), *[h.alias(f"mx_hash{i}") for i, h in enumerate(hashes)])


def thresholds(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> tuple[DataFrame, int, bool]:
    """A row per source with its sums, its target and the hashes of its boundary; how many hashes have been refined, and
    whether rows share them all."""
    per_source = checkpointed(
        targets(sized, weights, most)
        .withColumn(
            "rounds",
            F.when(
                F.col("source_size") > 0,
                F.least(F.lit(most), F.floor(F.col("target") / F.col("source_size").cast("double"))),
            )
            .otherwise(0)
            .cast("long"),
        )
        .withColumn("rest", F.col("target") - (F.col("rounds") * F.col("source_size")).cast("double"))
    )
    hashes = [c for c in sized.columns if c.startswith("mx_hash")]
    state = per_source.select("mx_key", "rest", F.lit(0).cast("long").alias("below"))
    shared = False
    for used, name in enumerate(hashes):
        edges = [f"edge{i}" for i in range(used)]
        reached = reduce(Column.__and__, [F.col(h) == F.col(e) for h, e in zip(hashes, edges, strict=False)], F.lit(True))
        state = state.withColumn("prefix", F.lit(0).cast("long"))
        for level in range(LEVELS):
            shift = BITS * (LEVELS - 1 - level)
            inside = sized.join(small(state), "mx_key").filter(reached & (F.shiftright(name, shift + BITS) == F.col("prefix")))
            sums = inside.groupBy("mx_key", "rest", "below", *edges, F.shiftright(name, shift).alias("bucket")).agg(
                F.sum("mx_size").alias("words"), F.count(F.lit(1)).alias("rows")
            )
            upto = Window.partitionBy("mx_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
            state = checkpointed(
                sums.withColumn("upto", F.col("below") + F.sum("words").over(upto))
                .filter(F.col("upto") > F.col("rest"))
                .groupBy("mx_key", "rest", *edges)
                .agg(F.min_by(F.struct("bucket", "upto", "words", "rows"), "bucket").alias("at"))
                .select(
                    "mx_key", "rest", *edges, (F.col("at.upto") - F.col("at.words")).alias("below"), F.col("at.bucket").alias("prefix"),
                    F.col("at.words").alias("words"), F.col("at.rows").alias("rows"),
                )
            )
        state = state.withColumnRenamed("prefix", f"edge{used}")
        shared = bool(state.filter("rows > 1").limit(1).count())
        if not shared:
            break
    edges = [f"edge{i}" for i in range(used + 1)]
    # of rows that share all hashes, each of the same size, so many as come nearest
    nearest = F.floor((F.col("rest") - F.col("below").cast("double")) / (F.col("words") / F.col("rows")) + F.lit(0.5)).cast("long")
    boundary = state.select("mx_key", *edges, F.col("rows").alias("alike"), nearest.alias("whole"))
    return per_source.join(boundary, "mx_key", "left"), used + 1, shared


def _taken(rows: DataFrame, limits: DataFrame, used: int, shared: bool, out: list[str]) -> DataFrame:
    """The columns `out` of rows, with the columns of limits and mx_taken.

    Rows that share a source's boundary can't be told apart, so they are counted, and written out anew from their number.
    """
    joined = rows.join(small(limits), "mx_key")
    place, edge = F.struct(*[f"mx_hash{i}" for i in range(used)]), F.struct(*[F.col(f"edge{i}").alias(f"mx_hash{i}") for i in range(used)])
    size, all_rounds = F.col("mx_size"), F.col("mx_size") * F.col("rounds")
    columns = [*out, "mx_size", "source_size", "target"]
    beyond = F.col("edge0").isNull() | (place > edge)
    at = ~beyond & (place == edge)
    once = F.when(beyond, 0).when(at, F.col("whole") * size).otherwise(size)
    taken = F.when(F.col("source_size") > 0, all_rounds + once).otherwise(0).cast("long").alias("mx_taken")
    if not shared:
        return joined.select(*columns, taken)
    many = at & (F.col("alike") > 1)
    one = joined.filter(many).groupBy("mx_key").agg(
        *[F.first(F.col(c)).alias(c) for c in [*columns, "rounds", "whole"]], F.count(F.lit(1)).alias("alike")
    )
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("alike") - 1, F.lit(BLOCK).cast("long")))
    blocks = one.withColumn("start", start).repartition("mx_key", "start")
    nth = F.explode(F.sequence(F.col("start"), F.least(F.col("start") + BLOCK, F.col("alike")) - 1))
    again = blocks.withColumn("nth", nth).select(*columns, (all_rounds + F.when(F.col("nth") < F.col("whole"), size).otherwise(0)).cast("long").alias("mx_taken"))
    return joined.filter(~many).select(*columns, taken).unionByName(again)


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """A row per document: doc_id, size, source_size, target, taken.

    taken counts the words that the mix takes: the document's size for each whole round over its source, and once more
    if it lies below the source's boundary. The document at the boundary is taken if that brings the source nearer to
    its target, so each source comes within half a document of it. Rows that share an id part by their text; rows that
    share both are alike, and some of them are taken, the others not. A null or empty text has size 0 and nothing is
    taken; a null source is a source of its own, the last; an empty table gives no rows. Columns besides the three that
    are named are not looked at.
    """
    sized = checkpointed(_sized(docs, doc_id, text, source, [F.col(doc_id).alias("doc_id")], False))
    done = _taken(sized, *thresholds(sized, weights, most), ["doc_id"])
    return done.select("doc_id", F.col("mx_size").alias("size"), "source_size", "target", F.col("mx_taken").alias("taken"))


def mixed_rows(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
               weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """The rows of docs of which the mix takes something, with size, target and taken beside their columns.

    As mix() does otherwise; rows that share id and text but differ elsewhere part by all their columns. Columns of docs
    that have one of the three names give way to them.
    """
    sized = checkpointed(_sized(docs, doc_id, text, source, [], True))
    whole = _sized(docs, doc_id, text, source, [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("mx_row")], True)
    own = [F.col(f"mx_row.`{c}`").alias(c) for c in docs.columns if c not in ("size", "target", "taken")]
    done = _taken(whole, *thresholds(sized, weights, most), ["mx_row"])
    return done.filter(F.col("mx_taken") > 0).select(*own, F.col("mx_size").alias("size"), "target", F.col("mx_taken").alias("taken"))


SQL = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         substr(md5(coalesce('mix:' || CAST(doc_id AS VARCHAR), 'mix')), 1, 12) AS h, substr(md5(coalesce('mix:' || text, 'mix')), 1, 12) AS h2
  FROM documents),
sums AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY k),
weighed AS (
  SELECT k, source_size, (row_number() OVER (ORDER BY k) - 1) % 3 + 1 AS w, source_size * 3 AS lim FROM sums),
levelled AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total,
    CAST(sum(source_size) OVER () - coalesce(sum(lim) OVER b, 0) AS DOUBLE)
      / CAST(sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS DOUBLE) AS lev
  FROM weighed WINDOW b AS (ORDER BY CAST(lim AS DOUBLE) / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
flagged AS (SELECT *, CAST(lim AS DOUBLE) / w <= lev AS limited FROM levelled),
shared AS (
  SELECT *, CAST(sum(CASE WHEN limited THEN lim ELSE 0 END) OVER () AS BIGINT) AS held,
         CAST(sum(CASE WHEN limited THEN 0 ELSE w END) OVER () AS BIGINT) AS free FROM flagged),
per_source AS (
  SELECT k, source_size, CASE WHEN limited THEN CAST(lim AS DOUBLE)
         ELSE CAST(total - held AS DOUBLE) / CAST(free AS DOUBLE) * CAST(w AS DOUBLE) END AS target FROM shared),
ruled AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(3, CAST(floor(target / CAST(source_size AS DOUBLE)) AS BIGINT)) ELSE 0 END AS rounds
  FROM per_source),
summed AS (
  SELECT s.doc_id, s.k, s.size, s.h, s.h2, r.source_size, r.target, r.rounds,
         r.target - CAST(r.rounds * r.source_size AS DOUBLE) AS rest,
         sum(s.size) OVER (PARTITION BY s.k ORDER BY s.h, s.h2) AS upto,
         sum(s.size) OVER (PARTITION BY s.k, s.h, s.h2) AS words, row_number() OVER (PARTITION BY s.k, s.h, s.h2) AS nth
  FROM sized s JOIN ruled r USING (k)),
edged AS (SELECT *, min(CASE WHEN upto > rest THEN h || h2 END) OVER (PARTITION BY k) AS edge FROM summed)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN source_size = 0 THEN 0 ELSE size * rounds + CASE
    WHEN edge IS NULL OR h || h2 > edge THEN 0
    WHEN h || h2 < edge THEN size
    WHEN nth <= floor((rest - CAST(upto - words AS DOUBLE)) / CAST(size AS DOUBLE) + 0.5) THEN size ELSE 0 END END AS BIGINT) AS taken
FROM edged
"""
