import numpy as np
import pytest

from gridlark.llm import ann
from tests.llm.helpers import collected


def table(spark, ids, vectors, extra=False):
    rows = [(None if i is None else int(i), None if v is None else [None if x is None else float(x) for x in v]) for i, v in zip(ids, vectors, strict=True)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.selectExpr("*", "'x' AS score", "1 AS rank", "2 AS id", "3 AS shard") if extra else df


def brute(ids, vectors, k=20):
    out = {}
    x = np.asarray(vectors, np.float32).astype(np.float64)
    for q in np.flatnonzero(np.asarray(ids) % 20 == 0):
        score = x @ x[q]
        other = np.asarray(ids) != ids[q]
        order = np.lexsort((np.asarray(ids)[other], -score[other]))[:k]
        out[int(ids[q])] = [(int(i), s) for i, s in zip(np.asarray(ids)[other][order], score[other][order], strict=True)]
    return out


def found(df):
    out = {}
    for g in sorted(collected(df), key=lambda g: (g["query_id"], g["rank"])):
        out.setdefault(g["query_id"], []).append((g["rank"], g["vec_id"], g["score"]))
    assert all([r for r, _, _ in x] == list(range(1, len(x) + 1)) for x in out.values())
    return out


def test_exact_where_all_are_candidates(spark):
    r = np.random.default_rng(2)
    v = r.normal(size=(200, 8)) * r.uniform(0.1, 5, (200, 1))
    got, want = found(ann.search(table(spark, range(200), v, extra=True))), brute(range(200), v)
    assert {q: [i for _, i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    assert all(s == pytest.approx(t, rel=1e-12) for q in want for (_, _, s), (_, t) in zip(got[q], want[q], strict=True))


def spread(r, n):
    return r.normal(size=(n, 32))


def clustered(r, n):
    centres = r.normal(size=(n // 60, 32))
    return centres[r.integers(0, len(centres), n)] + 0.15 * r.normal(size=(n, 32))


@pytest.mark.parametrize(("make", "shard", "share"), [(spread, 16_384, 0.7), (spread, 900, 1), (clustered, 16_384, 0.1), (clustered, 1500, 0.1)])
def test_recall_and_rows_scored(spark, monkeypatch, make, shard, share):
    monkeypatch.setattr(ann, "SHARD", shard)
    n = 6000
    v = make(np.random.default_rng(3), n)
    df = ann.searched(table(spark, range(n), v))
    scored = df.groupBy("query_id").agg({"scored": "max"}).toPandas()["max(scored)"].mean() / (n / -(-n // shard))
    got, want = found(df), brute(range(n), v)
    recall = np.mean([len({i for _, i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    print(f"{make.__name__}, shards of {shard}: recall {recall:.3f}, {scored:.3f} of a shard's rows scored")
    assert len(got) == n // 20 and recall >= 0.9 and scored <= share


def test_rows_of_the_own_id_take_no_places(spark):
    r = np.random.default_rng(8)
    ids, v = [20] * 200 + list(range(21, 100)), np.concatenate([np.full((200, 4), 3.0) + r.normal(size=(200, 4)) / 9, r.normal(size=(79, 4))])
    got = collected(ann.search(table(spark, ids, v)))
    of = [g for g in got if g["query_id"] == 20]
    assert len(of) == 200 * 20 and all(g["vec_id"] != 20 for g in of)


def test_copies_and_ties(spark):
    v = [[1.0, 0.0]] * 500 + [[0.0, 1.0]] * 100
    ids = list(range(599, -1, -1))
    got = found(ann.search(table(spark, ids, v)))
    assert got == {q: [(k + 1, i, s) for k, (i, s) in enumerate(x)] for q, x in brute(ids, v).items()}


def test_odd_rows(spark):
    rows = [(0, [1, 2]), (20, None), (40, [0, 0]), (60, [1, None]), (80, [float("nan"), 1]), (100, [float("inf"), 1]), (None, [5, 5]), (1, [3, 1]), (1, [3, 1]), (2, [1, 2, 3]), (120, [9, 9, 9]), (3, [])]
    got = found(ann.search(table(spark, *zip(*rows, strict=True))))
    assert got == {0: [(1, 1, 5.0), (2, 1, 5.0)], 120: [(1, 2, 54.0)]}
    assert found(ann.search(table(spark, [], []))) == {}
    assert found(ann.search(table(spark, [20], [[1.0]]))) == {}
