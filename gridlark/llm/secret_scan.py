"""Secrets, and how many owners share each: DataFrame functions only.

A pattern cuts a text into what stands between its matches and the matches; the lengths of both, summed up along the
text, are the offsets. Only lengths and matched values leave the scan. Candidates are then counted by value over the
corpus: a value that stands with several owners, or in many repositories of few, is a copied example; one that a single
owner has in a few repositories and that looks random is taken for live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlark.llm.common import checkpointed, small

#: The three kinds of the base, then those that the method adds. Kind, pattern, group of the secret.
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2),
    ("access", r"AKIA[A-Z0-9]{16,}", 0),
    ("hex", r"[0-9a-f]{24,}", 0),
)
#: A private key from its header on: to the END line if nothing but the body stands before it, else to the end of the
#: lines of base64 (parted by white space, escaped line ends, quotes or marks of comments), or the header alone.
_GAP = r"""(?:\s|\\+[nrt]|["'],?\s*+\+?\s*+["']|[>#*|,"'])"""
_KEY = (
    r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"
    r"(?:[^-]*+(?:-{1,4}+[^-]++)*+-----END [A-Z ]{0,30}PRIVATE KEY-----"
    rf"|(?:\s*+(?:Proc-Type|DEK-Info|Version|Comment):[^\n\\]*+)*+(?:{_GAP}*+[A-Za-z0-9+/]{{16,}}+={{0,2}}+)++(?:{_GAP}++[A-Za-z0-9+/]++={{1,2}}+)?+)?+"
)
ADDED = (
    ("private", _KEY, 0),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0),
    ("cloud", r"AIza[0-9A-Za-z_-]{35}", 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0),
)
#: One look for any of the added kinds; only texts that have a mark are searched for them.
MARKS = r"-----BEGIN|gh[pousr]_|xox[abprs]-|AIza|\.eyJ"

#: What of a private key isn't its body: the lines around it, escaped line ends, and whatever isn't base64.
_NO_BODY = r"-----(?:BEGIN|END) [A-Z ]{0,30}PRIVATE KEY-----|\\+[nrt]|[^A-Za-z0-9+/=_]"

#: A value that so many owners have, or so many repositories under however few owners, is a copied example.
SHARED_OWNERS, SHARED_REPOSITORIES = 3, 10

#: Least Shannon entropy, in bits a character, of a value that looks live.
LIVE_BITS = 2.5


def _pieces(text: Column, kind: str, pattern: str, group: int, maybe: Column | None = None) -> Column:
    """An array of (kind, order, gap, length, value): one entry for each match, in order."""
    order = [k for k, _, _ in (*BASE, *ADDED)].index(kind)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = matches if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    if kind == "private":  # the same key, however it is wrapped, is one value; without a body the header is
        values = F.transform(values, lambda x: F.coalesce(F.nullif(F.regexp_replace(x, _NO_BODY, ""), F.lit("")), x))
    zipped = F.arrays_zip(
        F.slice(gaps, F.lit(1), F.size(matches)).alias("gap"), F.transform(matches, F.length).alias("length"), values.alias("value")
    )
    cut = F.transform(
        zipped,
        lambda x: F.struct(
            F.lit(kind).alias("kind"), F.lit(order).alias("order"), x["gap"].cast("long").alias("gap"), x["length"].cast("long").alias("length"),
            x["value"].alias("value"),
        ),
    )
    found = text.rlike(pattern)
    return F.when(found if maybe is None else maybe & found, cut).otherwise(F.array().cast("array<struct<kind:string,order:int,gap:bigint,length:bigint,value:string>>"))


def _entropy(value: Column) -> Column:
    """Bits a character."""
    n = F.length(value)
    chars = F.split(value, "")
    share = lambda c: F.size(F.filter(chars, lambda x: x == c)) / n
    return F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))


def candidates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Every row of docs as (row, doc_id), and every match as (row, kind, order, start, end, hash, owner, repository, random)."""
    body = F.col("body")
    marked = F.col("marked")
    cut = F.concat(*[_pieces(body, *p) for p in BASE], *[_pieces(body, *p, maybe=marked) for p in ADDED])
    scanned = checkpointed(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{owner}`").cast("string"), F.lit("")).alias("owner"),
            F.coalesce(F.col(f"`{repository}`").cast("string"), F.lit("")).alias("repository"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("body"),
        )
        .withColumn("marked", F.col("body").rlike(MARKS))
        .select("doc_id", "owner", "repository", F.monotonically_increasing_id().alias("row"), cut.alias("cut"))
    )
    along = Window.partitionBy("row", "order").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    value = F.col("piece.value")
    one = scanned.filter(F.size("cut") > 0).select("row", "owner", "repository", F.posexplode("cut").alias("pos", "piece"))
    found = (
        one.withColumn("order", F.col("piece.order"))
        .withColumn("end", F.sum(F.col("piece.gap") + F.col("piece.length")).over(along))
        .filter((F.col("order") != 0) | (F.length(value) >= 6))
        .select(
            "row", "owner", "repository", F.col("piece.kind").alias("kind"), "order", (F.col("end") - F.col("piece.length")).alias("start"), "end",
            F.sha2(value, 256).alias("hash"), (_entropy(value) >= LIVE_BITS).alias("random"),
        )
    )
    return scanned.select("row", "doc_id"), checkpointed(found)


def ownership(found: DataFrame) -> DataFrame:
    """By hash: n_owners, n_repositories, distinct. Repeats go before the shuffle by hash, so a value that stands
    everywhere costs a row for each owner and repository and task at most."""
    pairs = found.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    # a repository under several owners is one: of each owner's and each repository's rows, one counts
    each = [pairs.groupBy("hash", c).agg(F.lit(1).alias("one")).select("hash", *[F.lit(int(c == k)).alias(k) for k in ("owner", "repository")]) for c in ("owner", "repository")]
    return each[0].unionAll(each[1]).groupBy("hash").agg(F.sum("owner").alias("n_owners"), F.sum("repository").alias("n_repositories"))


def _joined(order: list[str], only: Column | None = None) -> Column:
    entries = F.collect_list(F.when(F.lit(True) if only is None else only, F.struct("start", "order", "end", "kind")))
    return F.array_join(F.transform(F.array_sort(entries), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def find_secrets(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """A row per row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, most_owners,
    most_repositories.

    The counts and the digest are of the base kinds, spans has the added kinds too, by start, then kind; a private key's
    span runs from header to END line, its value is the body. n_live counts spans whose value looks random and stands with
    fewer than SHARED_OWNERS owners and in fewer than SHARED_REPOSITORIES repositories, n_example those of values that at
    least so many have of either. most_owners and most_repositories are those of the row's most shared value, 0 without
    any. Offsets count code points. A null text counts as empty, a null owner or repository is one called ''; repeated
    rows get a row each; an empty table gives none. Columns besides the four that are named are not read.
    """
    rows, found = candidates(docs, doc_id=doc_id, text=text, owner=owner, repository=repository)
    # of its own, so that a value that stands everywhere can be split in the join, or the join be a broadcast
    judged = found.join(small(checkpointed(ownership(found))), "hash")
    shared = (F.col("n_owners") >= SHARED_OWNERS) | (F.col("n_repositories") >= SHARED_REPOSITORIES)
    base = F.col("order") < len(BASE)
    names = [k for k, _, _ in (*BASE, *ADDED)]
    by_row = judged.groupBy("row").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k, _, _ in BASE],
        F.sha2(_joined(names, base), 256).alias("base_sha256"),
        _joined(names).alias("spans"),
        F.count(F.when(F.col("random") & ~shared, 1)).alias("n_live"),
        F.count(F.when(shared, 1)).alias("n_example"),
        F.max("n_owners").alias("most_owners"),
        F.max("n_repositories").alias("most_repositories"),
    )
    none = F.sha2(F.lit(""), 256)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return rows.join(by_row, "row", "left").select(
        "doc_id", zero("n_assign"), zero("n_access"), zero("n_hex"), F.coalesce("base_sha256", none).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"), zero("n_live"), zero("n_example"), zero("most_owners"), zero("most_repositories"),
    )


def rows_without_live(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """The rows of docs whose id has no row with a live-looking secret; columns as they are. Rows without an id stay."""
    found = find_secrets(docs, doc_id=doc_id, text=text, owner=owner, repository=doc_id)
    live = checkpointed(found.filter("n_live > 0 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("live")).distinct())
    return docs.join(small(live), F.col(f"`{doc_id}`") == F.col("live"), "left_anti")
