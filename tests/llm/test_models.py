import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from gridlark.llm import license_scan, quality, toxicity
from gridlark.llm.common import crc_remainder, words_of
from tests.llm.helpers import LONG, ODD, collected, docs, labels


@pytest.fixture(scope="module")
def corpus():
    """(rows, labels): toxic documents hold a word of a small list, some behind disguises; junk is shouted or repeated."""
    r = random.Random(11)
    plain = ["river", "stone", "under", "morning", "letter", "garden", "silver", "window", "travel", "answer", "moron", "gentle"][:10] + ["gentle", "loud"]
    bad = ["moron", "scumbag", "idiot"]
    hide = {"o": "0", "i": "1", "a": "@", "s": "$"}
    rows, marks = [], []
    for i in range(900):
        words = [r.choice(plain) for _ in range(r.randint(20, 60))]
        toxic, junk = int(r.random() < 0.3), int(r.random() < 0.25)
        if toxic:
            for _ in range(2):
                w = r.choice(bad)
                way = r.random()
                w = w if way < 0.6 else "".join(hide.get(c, c) for c in w) if way < 0.8 else " ".join(w) if way < 0.9 else w.replace(w[1], w[1] * 4, 1)
                words.insert(r.randrange(len(words)), w)
        if junk:
            words = [w.upper() + "!!" for w in words] if r.random() < 0.5 else [w for w in words for _ in range(8)]
        rows.append((i, " ".join(words), "s"))
        if i % 3:
            marks.append((i, 1 - junk, toxic))
    truth = {i: (q, t) for i, q, t in marks}
    return rows, marks, truth


def accuracy(got, truth, place, held):
    return np.mean([g["predicted"] == truth[g["doc_id"]][place] for g in got if g["doc_id"] in truth and held(g["doc_id"])])


crc = lambda i: zlib.crc32(str(i).encode())


def test_toxicity_held_out(spark, corpus):
    rows, marks, truth = corpus
    got = collected(toxicity.score_toxicity(docs(spark, rows), labels(spark, marks), learn=crc_remainder("doc_id", 5) != 0))
    assert len(got) == len(rows) and all(0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= 0.5) for g in got)
    assert accuracy(got, truth, 1, lambda i: crc(i) % 5 == 0) >= 0.9


def test_held_out_labels_are_not_learnt_from(spark, corpus):
    rows, marks, _ = corpus
    flipped = [(i, 1 - q, 1 - t) if crc(i) % 5 == 0 else (i, q, t) for i, q, t in marks]
    a, b = (
        {g["doc_id"]: g["score"] for g in collected(toxicity.score_toxicity(docs(spark, rows), labels(spark, m), learn=crc_remainder("doc_id", 5) != 0))}
        for m in (marks, flipped)
    )
    assert a == b


def test_quality_held_out(spark, corpus):
    rows, marks, truth = corpus
    got = collected(quality.score_quality(docs(spark, rows), labels(spark, marks), learn=crc_remainder("doc_id", 4) != 2))
    assert len(got) == len(rows) and all(0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= 0.7) for g in got)
    assert accuracy(got, truth, 0, lambda i: crc(i) % 4 == 2) >= 0.95
    again = collected(quality.score_quality(docs(spark, rows), labels(spark, marks), learn=crc_remainder("doc_id", 4) != 2))
    assert sorted(g["score"] for g in got) == sorted(g["score"] for g in again)


@pytest.mark.parametrize("score", [toxicity.score_toxicity, quality.score_quality])
def test_odd_rows(spark, score):
    some = labels(spark, [(1, 1, 0), (1, 0, 1), (5, 1, 0), (7, 0, 1), (None, 1, 1), (8, None, None), (6, 3, 9), (99, 1, 1)])
    got = collected(score(docs(spark), some))
    assert len(got) == len(ODD) and all(0 <= g["score"] <= 1 for g in got)
    empty = {g["score"] for g in got if g["doc_id"] in (2, 3)}
    assert len(empty) == 1
    assert collected(score(docs(spark, []), some)) == []
    for few in ([], [(1, 1, 1)]):
        alone = collected(score(docs(spark), labels(spark, few)))
        assert len({g["score"] for g in alone}) == 1


def test_carried_columns(spark):
    df = docs(spark)
    out = toxicity.score_toxicity(df, labels(spark, [(1, 1, 0), (8, 1, 1)]), carry=df.columns, prefix="z_")
    assert out.columns == ["z_doc_id", "z_score", "z_predicted", *df.columns] and out.count() == len(ODD)


def model(words):
    """A restorer for a corpus of these words."""
    runs = Counter(r for w in words for r in toxicity.runs_of(w))
    return toxicity.Restorer(dict(runs), frozenset(words))


SYLLABLES = ["ba", "ed", "cor", "tho", "li", "man", "ro", "stu", "id", "ki", "le", "pa", "wor", "cha", "in", "ass", "ho"]


def invented(r, n):
    return ["".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 3))) for _ in range(n)]


def test_restoring():
    restorer = model("the moron and the idiot met a clown by the river".split() * 20 + invented(random.Random(3), 500))
    for shown, meant in (("m0r0n", "moron"), ("1d10t", "idiot"), ("c l o w n", "clown"), ("moooron", "moron"), ("i.d.i.o.t", "idiot"), ("id!ot", "idiot"), ("cl0wwwn", "clown"), ("idio+", "idiot"), ("cl*wn", "clown"), ("!diot", "idiot"), ("(m0r0n)", "moron"), ("the___m0r0n", "moron"), ("1d10t!", "idiot")):
        assert meant.encode() in toxicity.words_in(f"xx {shown} yy", restorer), shown
    assert restorer.restored("plain words! only (met) the| moron $$$words$$$ 'words!!'", {b"plain", b"words", b"only"}) == []
    assert restorer.restored("in 1337 of 2019, 4.5 and +3", set()) == []


def test_words_that_the_model_has_not_seen():
    """Under a model of a licence's English, which has none of them."""
    words = license_scan.all_templates()["GPL-3.0 full text"].lower().split()
    restorer = model(words)
    for shown, meant in (("k1ll", "kill"), ("455h0le", "asshole"), ("1d10t", "idiot"), ("you___1d10t", "idiot"), ("i   d   i   o   t", "idiot"), ("m0r0n", "moron"), ("w0rthle55", "worthless")):
        assert meant.encode() in toxicity.words_in(f"xx {shown} yy", restorer), shown


def test_the_search_finds_the_least_cost():
    """Of all paths through the lattice, under a model of invented words."""
    r = random.Random(6)
    language = model(invented(r, 800)).language

    def cost_of(path):
        state = start = " " * (toxicity.ORDER - 1)
        total, reading = 0.0, ""
        for x, price in path:
            total += price
            if x and (x != " " or state != start):
                total, reading = total + language.cost(state + x), reading + x
                state = start if x == " " else state[1:] + x
        return total + (language.cost(state + " ") if state != start else 0.0), reading

    for _ in range(150):
        stretch = "".join(r.choice("abdeilorst013457$@!|*( ._") for _ in range(r.randint(1, 6)))
        paths = [cost_of(p) for p in itertools.product(*toxicity.lattice(stretch))]
        best = min(p[0] for p in paths)
        assert any(total <= best + 1e-9 and reading == toxicity.decode(stretch, language) for total, reading in paths), stretch


def test_accents_are_letters_of_their_own():
    language = model(["çélà", "çéla", "idiot"] * 9).language
    assert language.cost("  çé") < language.cost("  çe") and language.cost("   ç") < language.cost("   x")


def test_counts_are_of_all_texts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "HELD_WORDS", 3)
    texts = ["The river, the RIVER", None, "", "naïve river 2x", "river " * 100 + LONG]
    want = Counter(w.decode() for t in texts for w in words_of((t or "").lower().encode()))
    counts = toxicity.word_counts(docs(spark, [(i, t, "s") for i, t in enumerate(texts)]), "text")
    assert {r.word: r.n for r in counts.collect()} == dict(want)
    runs = Counter()
    for w, n in want.items():
        for x in toxicity.runs_of(w):
            runs[x] += n.bit_length()
    assert {r.word: r.n for r in toxicity.run_counts(counts).collect()} == dict(runs)


def test_restoring_spelled_disguises_and_long_stretches():
    restorer = model("the moron and the idiot met a clown by the river".split() * 200)
    shown = [("m 0 r 0 n", "moron"), ("1 d 1 0 t", "idiot"), ("c l 0 w n", "clown"), ("m/o/r/o/n", "moron"), ("m,o,r,o,n", "moron"), ("c   l   o   w   n", "clown"), ('"m o r o n"', "moron"), ("(i d i o t)", "idiot")]
    for s, meant in shown:
        assert meant.encode() in toxicity.words_in(f"xx {s} yy", restorer), s
    for lead in range(70):  # wherever a step ends, the words come out whole
        long = " ".join("ab"[k % 2] for k in range(lead)) + "  " + "  ".join(" ".join(w) for w in ("the", "moron", "met", "the", "idiot", "by", "the", "clown") * 3)
        words = restorer.restored(long, set())
        assert [words.count(w) for w in ("moron", "idiot", "clown")] == [3, 3, 3], lead
    long = "_".join(["m0r0n", "id!ot"] * 900)
    assert len(long) > 10_000 and restorer.restored(long, set()) == ["moron", "idiot"] * 900


def test_a_word_too_many_is_learnt_from(spark):
    """No number bounds the words of the model; ids that repeat count as one row of the sample."""
    rows = [(i, f"{'bad' if i % 2 else 'good'}word{i % 1400 // 2} filler", "s") for i in range(8400)]
    marks = [(i, 1, i % 2) for i in range(8400)]
    got = collected(toxicity.score_toxicity(docs(spark, rows, extra=False), labels(spark, marks), learn=None))
    assert np.mean([g["predicted"] == g["doc_id"] % 2 for g in got]) > 0.95


@pytest.mark.parametrize(("module", "bound"), [(toxicity, "FIT_DOCUMENTS"), (quality, "FIT_DOCUMENTS")])
def test_the_sample_is_bounded_by_rows(spark, monkeypatch, module, bound):
    monkeypatch.setattr(module, bound, 10)
    seen, whole = [], module.first_rows

    def counted(*args):
        out = whole(*args)
        seen.append(out.count())
        return out

    monkeypatch.setattr(module, "first_rows", counted)
    score = toxicity.score_toxicity if module is toxicity else quality.score_quality
    rows = [(i % 2, f"text {i} of many", "s") for i in range(1000)] + [(10 + i, "other text", "s") for i in range(50)]
    got = collected(score(docs(spark, rows), labels(spark, [(0, 1, 0), (1, 0, 1), *[(10 + i, i % 2, i % 2) for i in range(50)]])))
    assert len(got) == 1050 and seen == [10]


def test_whole_bags_are_learnt_from(spark, monkeypatch):
    """A document of 300 passages whose label comes from one of them; and documents that don't fit are passed over whole."""
    fitted, whole = [], quality.fit_network
    monkeypatch.setattr(quality, "fit_network", lambda bags, y: fitted.append([len(b) for b in bags]) or whole(bags, y))
    plain = "plain words of a text that goes on and on in lower case for a while " * 8
    rows = [(i, plain * 290 if i < 2 else plain, "s") for i in range(8)]
    marks = labels(spark, [(i, i % 2, 0) for i in range(8)])
    assert len(collected(quality.score_quality(docs(spark, rows), marks))) == 8
    passages = {i: -(-len(t) // quality.PASSAGE) for i, t, _ in rows}
    assert sorted(fitted[0]) == sorted(passages.values()) and max(fitted[0]) >= 300
    monkeypatch.setattr(quality, "FIT_PASSAGES", 100)
    collected(quality.score_quality(docs(spark, rows), marks))
    assert max(fitted[1]) < 100 and sum(fitted[1]) <= 100


def test_scores_like_loops(spark):
    """The network's forward pass, passage by passage and number by number."""
    r = np.random.default_rng(4)
    net = quality.Network(r.normal(size=quality.WIDTH), r.uniform(0.5, 2, quality.WIDTH))
    texts = [b"some words. And MORE 12 words", b"", b"x " * 2000, "naïve text".encode() * 200]
    for text, score in zip(texts, quality._score(net, texts), strict=True):
        hs, es = [], []
        for x in quality.encode(text).astype(float):
            x = [(a - m) / s for a, m, s in zip(x, net.mean, net.scale, strict=True)]
            h = [math.tanh(sum(a * w for a, w in zip(x, column, strict=True)) + b) for column, b in zip(net.p["W"].T, net.p["b"], strict=True)]
            t = [math.tanh(sum(a * w for a, w in zip(h, column, strict=True))) for column in net.p["V"].T]
            g = [1 / (1 + math.exp(-sum(a * w for a, w in zip(h, column, strict=True)))) for column in net.p["U"].T]
            hs.append(h)
            es.append(math.exp(sum(a * b * w for a, b, w in zip(t, g, net.p["w"], strict=True))))
        z = [sum(e * h[k] for e, h in zip(es, hs, strict=True)) / sum(es) for k in range(net.HIDDEN)]
        assert score == pytest.approx(1 / (1 + math.exp(-sum(a * c for a, c in zip(z, net.p["c"], strict=True)) - net.p["d"][0])))


def test_gradient_is_right():
    r = np.random.default_rng(3)
    x, starts, y = r.normal(size=(9, quality.WIDTH)), np.array([0, 4, 5]), np.array([1.0, 0.0, 1.0])
    net = quality.Network(np.zeros(quality.WIDTH), np.ones(quality.WIDTH))
    loss = lambda: -np.mean(np.log(np.where(y == 1, net.forward(x, starts)["y"], 1 - net.forward(x, starts)["y"])))
    for name, g in net.gradient(net.forward(x, starts), y, starts).items():
        place = tuple(r.integers(0, n) for n in net.p[name].shape)
        kept = net.p[name][place]
        net.p[name][place] = kept + 1e-5
        up = loss()
        net.p[name][place] = kept - 1e-5
        down = loss()
        net.p[name][place] = kept
        assert g[place] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)


def test_long_texts_in_steps(monkeypatch):
    data = b"some words here and THERE!! " * 3000
    whole = quality.encode(data)
    monkeypatch.setattr(quality, "STEP", quality.PASSAGE * 8)
    assert len(quality.encode(data)) == len(whole) == -(-len(data) // quality.PASSAGE)
