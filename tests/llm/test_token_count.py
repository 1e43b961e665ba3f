import random

import pytest
import public_tokenizers
from tokenizers import Tokenizer

from gridlark.llm import token_count
from tests.llm.helpers import LONG, ODD, collected, docs

DEFINITION = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_str(DEFINITION)
    return lambda x: len(t.encode(x or "", add_special_tokens=False).ids)


def test_like_the_library(spark, library):
    r = random.Random(1)
    pool = ["don't", " I'LL", "  ", "\n\n", "été", "１２", "½", "naïve", "՘", " ", "\x1c", "<|endoftext|>", "日本", "!!", "a1b2", "\t x", "'", "’s", "😀"]
    rows = ODD + [(100 + i, "".join(r.choice(pool) + r.choice(["", " "]) for _ in range(30)), "s") for i in range(200)]
    got = collected(token_count.count_tokens(docs(spark, rows), DEFINITION))
    want = sorted((str(i), len((t or "").encode()), library(t), library(t) > 1024) for i, t, _ in rows)
    assert sorted((str(g["doc_id"]), g["n_bytes"], g["n_tokens"], g["over_limit"]) for g in got) == want
    assert any(w[3] for w in want)


def test_whole_tokens_are_proven(library):
    whole = token_count.prove_whole(DEFINITION)
    assert len(whole) > 40_000 and all(library(w) == 1 for w in random.Random(2).sample(sorted(whole), 300))


def test_remembering_is_bounded(library, monkeypatch):
    monkeypatch.setattr(token_count, "REMEMBERED", 5)
    token_count._counters.clear()
    count = token_count.counter(DEFINITION, token_count.prove_whole(DEFINITION))
    words = [f"zq{i}xw{i * 7}vv" for i in range(40)] * 2
    assert [count(w) for w in words] == [library(w) for w in words]
    assert count(LONG) == library(LONG)
    token_count._counters.clear()


def test_empty_and_unsupported(spark):
    assert collected(token_count.count_tokens(docs(spark, []), DEFINITION)) == []
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        token_count.check_supported(f.read())
