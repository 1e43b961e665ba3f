import hashlib
import random
import re
import tracemalloc

import pytest

from gridlark.llm import decontam
from tests.llm.helpers import LONG, ODD, collected, docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(text, items):
    words = WORD.findall(lower(text))
    hit, ids = set(), set()
    for item, body in items:
        own = WORD.findall(lower(body))
        n = min(10, len(own))
        tests = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in tests:
                hit |= set(range(i, i + n))
                ids.add("" if item is None else str(item))
    return len(words), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


def compare(spark, rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = collected(decontam.contamination(docs(spark, rows), bench))
    want = sorted((str(i), *brute(t, items)) for i, t, _ in rows)
    assert sorted((str(g["doc_id"]), g["n_words"], g["n_hit"], g["n_items"], g["items_sha256"], g["contaminated"]) for g in got) == want
    return want


@pytest.mark.parametrize("block", [1 << 24, 200])
def test_like_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
    r = random.Random(3)
    some = lambda n: " ".join(r.choice(["ab", "cd", "Ef", "été", "g1"]) for _ in range(n))
    items = [(k, some(r.choice([1, 2, 4, 9, 10, 11, 14]))) for k in range(25)] + [(30, LONG[:4000]), (31, None), (32, "!!"), (None, "quick brown FOX"), (2, "lazy dog"), (100, "ab")]
    rows = ODD + [(200 + i, f"{some(20)}, {r.choice(items)[1]} {some(6)}", "s") for i in range(60)]
    want = compare(spark, rows, items)
    assert any(w[3] > 1 for w in want)


def test_nothing_to_search_for(spark):
    for items in ([], [(1, None)], [(1, "?")]):
        assert not any(w[5] for w in compare(spark, ODD, items))
    compare(spark, [], [(1, "a b c")])


def test_carried_columns(spark):
    bench = spark.createDataFrame([(1, "quick brown fox")], "item_id long, text string")
    df = docs(spark)
    out = decontam.contamination(df, bench, carry=df.columns, prefix="z_")
    assert out.columns == ["z_doc_id", "z_n_words", "z_n_hit", "z_n_items", "z_items_sha256", "z_contaminated", *df.columns]
    assert out.filter("z_contaminated").count() == 2


def test_the_index_is_small():
    """At most ten bytes for each byte of the benchmark, also where every word is another."""
    r = random.Random(4)
    for words in ([f"w{i}" for i in range(2000)], [f"{i:x}word" for i in range(10**6)]):
        items = [(str(k), " ".join(r.choice(words) for _ in range(60)).encode()) for k in range(4000)]
        size = sum(len(t) for _, t in items)
        tracemalloc.start()
        found, names = decontam.searchers(items)
        held = tracemalloc.get_traced_memory()[0]
        tracemalloc.stop()
        assert held <= 10 * size and len(names) == 4000
        hits, ids = [], set()
        found[0].search(decontam.words_of(items[7][1]), hits, ids)
        assert len(hits) == 51 and 7 in ids


def test_windows_that_many_items_share():
    """Are one entry, found with all items; texts that share only their last block are others."""
    items = [(str(k), f"p{k} " + "a b c d e f g h i j".encode().decode() + f" q{k}") for k in range(50)] + [(f"x{k}", f"r{k} b c d e f g h i j") for k in range(50)]
    found, names = decontam.searchers([(i, t.encode()) for i, t in items])
    for text, n_hits, n_ids in (("z a b c d e f g h i j z", 1, 50), ("r7 b c d e f g h i j", 1, 1), ("a b c d e f g h i", 0, 0), ("p3 a b c d e f g h i j q3", 3, 50)):
        hits, ids = [], set()
        for s in found:
            s.search(text.encode().split(), hits, ids)
        assert (len(hits), len(ids)) == (n_hits, n_ids), text
