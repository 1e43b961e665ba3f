import hashlib
import random
import re
from collections import defaultdict

import pytest

from gridlark.llm import mixture
from tests.llm.helpers import ODD, collected, docs


def brute_targets(sizes):
    """Shares by weight with what is over the limit dealt out again, round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, held = {}, set()
    total = sum(sizes.values())
    while True:
        free = [s for s in order if s not in held]
        rest = total - sum(3 * sizes[s] for s in held)
        target = {s: 3 * sizes[s] for s in held} | {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if target[s] > 3 * sizes[s]]
        if not over:
            return target
        held |= set(over)


def check(spark, rows):
    """Sums by source, and that each comes within half of its largest document of the target."""
    got = collected(mixture.mix(docs(spark, rows)))
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sums, largest = defaultdict(int), defaultdict(int)
    for _, t, s in rows:
        sums[s] += size(t)
        largest[s] = max(largest[s], size(t))
    assert sorted((str(g["doc_id"]), g["size"]) for g in got) == sorted((str(i), size(t)) for i, t, _ in rows)
    targets = brute_targets(sums)
    taken = defaultdict(int)
    source_of = {(sums[s], round(targets[s], 6)): s for s in sums}
    for g in got:
        assert 0 <= g["taken"] <= 3 * g["size"]
        taken[source_of[g["source_size"], round(g["target"], 6)]] += g["taken"]
    for s, t in targets.items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1e-6, s
    return taken, targets, sums, got


def brute(rows):
    """(doc_id, size, taken) by sorting: below the boundary once more, at it if that is nearer, alike rows one by one."""
    digest = lambda x: hashlib.md5(b"mix" if x is None else f"mix:{x}".encode()).hexdigest()[:12]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sums = defaultdict(int)
    for _, t, s in rows:
        sums[s] += size(t)
    targets, out = brute_targets(sums), []
    for s in sums:
        own = sorted([(digest(i), digest(t), i, size(t)) for i, t, x in rows if x == s], key=lambda r: r[:2])
        rounds = min(3, int(targets[s] // sums[s])) if sums[s] else 0
        rest, upto, done = targets[s] - rounds * sums[s], 0, not sums[s]
        for _, _, i, n in own:
            once = 0
            if not done and upto + n <= rest:
                once, upto = n, upto + n
            elif not done and n:
                done = True
                once = n if rest - upto >= n / 2 else 0
            out.append((str(i), n, rounds * n + once))
    return sorted(out)


def test_targets_are_met(spark):
    r = random.Random(4)
    rows = [(i, "w " * r.randint(0, 40), r.choice(["a"] * 6 + ["b", "c", "d", None])) for i in range(1500)]
    _, _, _, got = check(spark, rows)
    assert sorted((str(g["doc_id"]), g["size"], g["taken"]) for g in got) == brute(rows)


@pytest.mark.parametrize("same", [None, 7])
def test_rows_that_share_an_id_meet_the_target(spark, same):
    r = random.Random(9)
    alike = [(same, "word", "a")] * 1000 + [(i, "w " * 10, "b") for i in range(1000, 1100)]
    several = [(same, "w" * (1 + i % 7) + " x" * (i % 5), "a") for i in range(900)] + [(i, "w " * r.randint(1, 30), r.choice("bc")) for i in range(200)]
    for rows in (alike, several):
        _, _, _, got = check(spark, rows)
        assert sorted((str(g["doc_id"]), g["size"], g["taken"]) for g in got) == brute(rows)


def test_alike_rows_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixture, "BLOCK", 7)
    check(spark, [(None, "one two", "a")] * 100 + [(i, "w " * 10, "b") for i in range(30)])
    rows = docs(spark, [(None, "one two", "a")] * 100 + [(3, "one two", "a")] * 50 + [(i, "w " * 10, "b") for i in range(30)])
    kept = collected(mixture.mixed_rows(rows))
    assert sorted((str(g["doc_id"]), g["size"], g["taken"]) for g in collected(mixture.mix(rows)) if g["taken"]) == sorted((str(g["doc_id"]), g["size"], g["taken"]) for g in kept)
    assert {(g["lang"], g["source"]) for g in kept} == {("en", "a"), ("en", "b")}


def test_odd_rows_and_reruns(spark):
    _, _, _, got = check(spark, ODD)
    assert sorted((str(g["doc_id"]), g["size"], g["taken"]) for g in got) == brute(ODD)
    again = sorted(map(repr, collected(mixture.mix(docs(spark)))))
    assert sorted(map(repr, got)) == again and len(got) == len(ODD)


def test_empty(spark):
    assert collected(mixture.mix(docs(spark, []))) == []
    assert mixture.mixed_rows(docs(spark, [])).count() == 0
    nothing = collected(mixture.mix(docs(spark, [(1, None, "a"), (2, "", None)])))
    assert [(g["size"], g["target"], g["taken"]) for g in nothing] == [(0, 0.0, 0)] * 2


def test_rows_come_with_their_columns(spark):
    kept = mixture.mixed_rows(docs(spark))
    assert kept.columns[:5] == ["doc_id", "text", "source", "lang", "n_chars"] and kept.columns[-3:] == ["size", "target", "taken"]
    assert len(kept.columns) == len(set(kept.columns))
    whole = sorted((str(g["doc_id"]), g["size"], g["taken"]) for g in collected(mixture.mix(docs(spark))) if g["taken"])
    assert sorted((str(g["doc_id"]), g["size"], g["taken"]) for g in collected(kept)) == whole
