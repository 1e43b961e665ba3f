"""What the operators of this subpackage share: reading tables, checkpoints, shipping code, broadcasts."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A DataFrame may be broadcast up to so many bytes and rows, both measured; beyond it the join shuffles.
BROADCAST_BYTES, BROADCAST_ROWS = 16 << 20, 250_000

#: Words are lower-cased (A-Z only) maximal runs of what is neither an ASCII separator nor punctuation.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(data: bytes) -> list[bytes]:
    """The words of UTF-8 bytes."""
    return data.translate(_WORD_BYTES).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch, unless the session sets fewer: texts are long, and a batch is held by both sides at once.
BATCH_ROWS = 2_000


_shipped: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, wherever the driver was started, and keeps their batches small: the
    session's limit of rows is lowered and stays so, for the rows are sent when the result is used. Every operator that
    runs Python calls it."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="gridlark-code-")) / f"{package.name}.zip"  # the driver serves it from here
        with zipfile.ZipFile(archive, "w") as z:
            for path in sorted(package.rglob("*.py")):
                z.write(path, path.relative_to(package.parent))
        sc.addPyFile(str(archive))
        _shipped[sc.applicationId] = str(archive)


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Only on a local master, as in tests, a temporary one is
    taken where none is set."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="gridlark-checkpoint-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the checkpoint folder and read from there from now on."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def _width(df: DataFrame) -> Column:
    """Bytes of a row, about: of its texts, binaries and nested columns, and a few for each column."""
    known = F.lit(16 * len(df.columns)).cast("long")
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            known += F.coalesce(F.octet_length(column), F.lit(0))
        elif "<" in kind:
            known += F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return known


def small(df: DataFrame) -> DataFrame:
    """df, which is written out or cheap to make, with a broadcast hint if its measured size is within the bound."""
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_width(df))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES else df


def crc_remainder(column: str, n: int) -> Column:
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def first_rows(docs: DataFrame, labels: DataFrame, most: int, seed: int) -> DataFrame:
    """Rows to learn from: doc_id, body, label, turn, at most `most`, the first by turn, a hash of the id.

    docs has doc_id and body, labels a row per doc_id. Of rows that share an id one stands for all, by a hash of its
    body, so the bound holds for rows however often ids repeat.
    """
    turned = labels.withColumn("turn", F.xxhash64(F.col("doc_id"), F.lit(seed)))
    # of ids that have a row, without their bodies; so many more are tried as labels may lack documents
    first = lambda df, n: checkpointed(df.orderBy("turn", "doc_id").limit(n))
    tried = first(turned, 4 * most)
    chosen = first(docs.select("doc_id").join(small(tried), "doc_id").distinct(), most)
    found = docs.join(small(chosen), "doc_id").groupBy("doc_id", "label", "turn")
    return checkpointed(found.agg(F.min_by(F.col("body"), F.xxhash64("body")).alias("body")).select("doc_id", "body", "label", "turn"))


def forget(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this program has written."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
