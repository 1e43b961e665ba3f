import random
from collections import Counter

import numpy as np

from gridlark.llm import jaccard
from gridlark.llm.common import words_of
from tests.llm.helpers import ODD, collected, docs


def sets(text):
    w = words_of((text or "").encode())
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def brute(rows):
    """(doc_id, class_id, n_links) of each row."""
    own = [sets(t) for _, t, _ in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if own[i] and own[j] and 5 * len(own[i] & own[j]) >= 4 * len(own[i] | own[j]):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    lead = {}
    for k, (i, _, _) in enumerate(rows):
        r = find(k)
        if i is not None and (lead.get(r) is None or i < lead[r]):
            lead[r] = i
        lead.setdefault(r, None)
    return Counter((i, lead[find(k)] if lead[find(k)] is not None else i, links[k], len(own[k])) for k, (i, _, _) in enumerate(rows))


def check(spark, rows):
    got = Counter((g["doc_id"], g["class_id"], g["n_links"], g["n_shingles"]) for g in collected(jaccard.near_duplicates(docs(spark, rows))))
    assert got == brute(rows)


def corpus(seed, groups, size, changes):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    out = []
    for _ in range(groups):
        base = [r.choice(vocabulary) for _ in range(r.randint(3, 120))]
        for _ in range(size):
            own = list(base)
            for _ in range(r.randint(0, changes)):
                own[r.randrange(len(own))] = r.choice(vocabulary)
            out.append((len(out), " ".join(own), "s"))
    r.shuffle(out)
    return out


def test_like_brute_force(spark):
    check(spark, ODD + [(1000 + i, t, s) for i, t, s in corpus(7, 40, 5, 4)])


def test_groups_larger_than_a_tile(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 16)
    check(spark, corpus(8, 2, 90, 6) + [(5000 + i, "one two three four five six seven", "s") for i in range(60)])


def test_small_and_empty(spark):
    check(spark, [])
    check(spark, [(1, None, "a"), (2, "", "a"), (3, "one two", "b"), (4, "One, two!", "b"), (5, "two one", "b")])
    check(spark, [(None, "a b c d e f g", "a"), (None, "a b c d e f g", "a"), (3, "a b c d e f g", "a")])


def test_pruning_keeps_what_may_reach_the_threshold():
    least = jaccard.fewest_matches(0.8)
    r = np.random.default_rng(1)
    lost = 0
    for _ in range(300):
        matches = r.random((1000, jaccard.HASHES)) < 0.8
        sums = matches.cumsum(1)[:, jaccard.LOOK - 1 :: jaccard.LOOK]
        lost += int((sums < np.array(least)).any(1).sum())
    assert lost <= 5
    assert least[0] >= 5 and least[-1] >= 50


def test_one_of_each(spark):
    df = docs(spark, ODD + [(20, ODD[0][1] + "!", "z"), (21, ODD[0][1], "z"), (22, "alone here among all of them", "z")])
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, 4, None, None, 5, 6, 7, 7, 8, 22])


def test_one_of_each_where_ids_repeat(spark):
    a, b = "a b c d e f g h i j k l", "quite another text that is like no other one here"
    rows = [(7, a, "s"), (7, b, "s"), (3, a, "s"), (3, a + " m", "s"), (3, a, "t"), (None, b, "s"), (None, b, "s"), (None, "z z z z z z z z", "s"), (None, "z z z z z z z z", "s"), (9, "", "s"), (9, "", "s")]
    kept = [(r.doc_id, r.text) for r in jaccard.one_of_each(docs(spark, rows)).collect()]
    assert Counter(i for i, _ in kept) == Counter([3, 7, None, 9, 9])
    assert (7, b) in kept and (None, "z z z z z z z z") in kept


def test_nodes_meet_at_the_least(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 120), (120, 110), (200, 200)]
    df = spark.createDataFrame([(bytearray(a.to_bytes(16, "big")), bytearray(b.to_bytes(16, "big"))) for a, b in edges], "u binary, v binary")
    got = {int.from_bytes(r.node, "big"): int.from_bytes(r.root, "big") for r in jaccard.connected(df).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 110: 100, 120: 100}


def test_random_graphs(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000, 1001 + i) for i in range(500)] + [(1003, 2000)]
    df = spark.createDataFrame([(bytearray(a.to_bytes(16, "big")), bytearray(b.to_bytes(16, "big"))) for a, b in edges], "u binary, v binary")
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    rows = [(int.from_bytes(x.node, "big"), int.from_bytes(x.root, "big")) for x in jaccard.connected(df).collect()]
    moved = {a for a, b in edges if a != b} | {b for a, b in edges if a != b}
    assert len(rows) == len(moved) and dict(rows) == {x: root[x] for x in moved}


def test_copies_without_an_id_send_their_set_once(spark, monkeypatch):
    a, b = "one two three four five six seven eight nine ten eleven twelve", "one two three four five six seven eight nine ten eleven twelve again"
    rows, sent, whole = [(None, a, "s")] * 1500 + [(None, b, "s")] * 1500, [], jaccard._fetched

    def counted(*args):
        out = whole(*args)
        sent.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "_fetched", counted)
    got = Counter((g["class_id"], g["n_links"], g["n_shingles"]) for g in collected(jaccard.near_duplicates(docs(spark, rows))))
    assert got == {(None, 2999, 8): 1500, (None, 2999, 9): 1500} and sent == [2]


def test_long_words_differ_where_letters_far_apart_are_swapped():
    word = bytearray(b"x" * 5000)
    word[10], word[10 + 1024], word[3000] = ord("a"), ord("b"), ord("c")
    other = bytearray(word)
    other[10], other[10 + 1024] = word[10 + 1024], word[10]
    assert jaccard.shingles(bytes(word)).tolist() != jaccard.shingles(bytes(other)).tolist()
    assert jaccard.shingles(b"ab " + bytes(word[:900])).tolist() == jaccard.shingles(b"AB  " + bytes(word[:900])).tolist()
