import math
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from gridlark.llm import decontam, jaccard, queries, secret_scan, toxicity
from gridlark.llm.common import table, words_of
from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_jaccard import brute as grouped
from tests.llm.test_mixture import brute as mixed_by_hand

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{t}'")
    return con


def plain(x):
    return round(x, 6) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_the_oracle(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    order = sorted(df.columns)
    want = duck.sql(queries.oracle_sql()[name])
    at = [want.columns.index(c) for c in order]
    assert sorted(([plain(r[c]) for c in order] for r in df.collect()), key=repr) == sorted(([plain(r[i]) for i in at] for r in want.fetchall()), key=repr)


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5


def toxic(every, marks):
    """Whether a text is predicted toxic, by counts and fits over plain lists."""
    counts = Counter(w.decode() for t, _ in every.values() for w in words_of((t or "").lower().encode()))
    runs = Counter()
    for w, n in counts.items():
        for r in toxicity.runs_of(w):
            runs[r] += n.bit_length()
    share = lambda c, least: {k: n for k, n in c.items() if n >= least * sum(c.values())}
    restorer = toxicity.Restorer(share(runs, toxicity.LEAST_RUN), frozenset(share(counts, toxicity.LEAST_WORD)))
    known = [(m, {f for w in toxicity.words_in(every[i][0] or "", restorer) for f in toxicity.features_of(w)}) for i, m in marks.items() if i in every and zlib.crc32(str(i).encode()) % 5]
    total, bad = len(known), sum(m for m, _ in known)
    n, p = Counter(f for _, own in known for f in own), Counter(f for m, own in known if m for f in own)
    frequent = [f for f in n if n[f] >= toxicity.LEAST_DOCUMENTS]

    def gain(f):
        parts = ((p[f], bad / total), (n[f] - p[f], 1 - bad / total))
        return sum(x * math.log(x / (n[f] * of)) for x, of in parts if x)

    chosen = sorted((f for f in frequent if gain(f) >= math.log(max(2, len(frequent)))), key=lambda f: f.decode("latin-1"))
    place = {f: i for i, f in enumerate(chosen)}
    weights = toxicity.fit_logistic(sorted((m, sorted(place[f] for f in own if f in place)) for m, own in known), len(chosen))
    return lambda t: weights[-1] + sum(weights[place[f]] for f in {f for w in toxicity.words_in(t, restorer) for f in toxicity.features_of(w)} if f in place) >= 0


def with_live(every):
    """Ids of rows with a value that looks random and that few owners and repositories have; base kinds."""
    kinds = [(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6), (r"(AKIA[A-Z0-9]+)", 20), (r"([0-9a-f]+)", 24)]
    found = [(i, s, m[1]) for i, (t, s) in every.items() for p, least in kinds for m in re.finditer(p, t or "") if len(m[1]) >= least]
    entropy = lambda v: -sum(v.count(c) / len(v) * math.log2(v.count(c) / len(v)) for c in set(v))
    owners, repositories = defaultdict(set), defaultdict(set)
    for i, s, v in found:
        owners[v].add(s)
        repositories[v].add(i)
    return {i for i, _, v in found if entropy(v) >= secret_scan.LIVE_BITS and len(owners[v]) < secret_scan.SHARED_OWNERS and len(repositories[v]) < secret_scan.SHARED_REPOSITORIES}


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    planted = [(900_001, "unlike all others password=Zq81LmPx02RtVw here", "en", "src1", 10), (900_002, "again another token = aaaaaaaaaaaa there", "en", "src2", 10)]
    docs = docs.unionByName(spark.createDataFrame(planted, docs.schema)).cache()
    bench = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: {r.doc_id: (r.text, r.source) for r in df.collect()}
    every = rows(docs)

    kept = stages["toxicity"](spark, docs, SF)
    predicted = toxic(every, {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()})
    assert kept.columns == docs.columns and set(rows(kept)) == {i for i, (t, _) in every.items() if not predicted(t or "")}

    kept = stages["near duplicates"](spark, docs, SF)
    lead = {i: c for (i, c, _, _) in grouped([(i, t, s) for i, (t, s) in every.items()])}
    assert kept.columns == docs.columns and set(rows(kept)) == {i for i, c in lead.items() if i == c}

    kept = stages["benchmark contamination"](spark, docs, SF)
    assert kept.columns == docs.columns and set(rows(kept)) == {i for i, (t, _) in every.items() if not contaminated(t, bench)[-1]}

    kept = rows(stages["secrets"](spark, docs, SF))
    assert set(kept) == set(every) - with_live(every) and 900_001 not in kept and 900_002 in kept

    mixed = stages["mixture"](spark, docs, SF)
    assert sorted((str(r.doc_id), r["size"], r.taken) for r in mixed.collect()) == [x for x in mixed_by_hand([(i, t, s) for i, (t, s) in every.items()]) if x[2]]


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "text", "lang", "source", "n_chars", "size", "target", "taken"} <= set(out.columns)
    rows = out.collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows) and all(r.taken > 0 for r in rows)
    assert decontam.contamination(out, table(spark, SF, "benchmark")).filter("contaminated").count() == 0
    assert jaccard.near_duplicates(out).filter("n_links > 0").count() == 0
