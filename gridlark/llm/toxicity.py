"""Toxicity behind disguises: a noisy channel restores words, a word model scores them.

A disguised stretch (signs or digits among letters, letters spelled with separators, letters repeated) is a lattice:
each place offers the letter it shows, the letters its sign may stand for, a word break, or nothing. A Viterbi search
finds the likeliest path under a character model of the whole corpus and the channel's costs. Places that offer one
reading only, all of an ordinary word, need no search.

The character model counts runs of four characters. The words of all texts are counted first, within tasks and then over
the corpus, and the runs are taken from the counted words.

The word model is a logistic regression over the words that tell toxic documents from others.
"""

from __future__ import annotations

import math
import os.path
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlark.llm.common import checkpointed, first_rows, ship, words_of

# Signs and digits, and the letters they are written for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "*": "aeiou"}

#: The word model is fitted on at most so many rows, the first by a hash of the id.
FIT_DOCUMENTS = 20_000
#: Its words stand in so many of the fitted documents.
LEAST_DOCUMENTS = 4
#: Channel costs in nats: a sign for a letter; a digit amid letters, a digit elsewhere, or another sign, for a word break; a
#: sign at the edge of a stretch for none; an asterisk for a vowel; a letter or sign that repeats the one before, where three or more stand together,
#: and a letter where two do; a separator inside a word between single characters, and elsewhere; a dropped place.
SUBSTITUTE, AMID, DIGIT_BREAK, SIGN_BREAK, EDGE, VOWEL, REPEAT, DOUBLE, SPACED, JOINED, DROP = 1.0, 16.0, 8.0, 4.0, 1.0, 3.0, 0.5, 8.0, 0.5, 4.0, 16.0
#: After so many places what all paths share is put out, so that memory and time don't grow with a stretch's square.
STRETCH = 64

#: Characters in a run; runs and words of less than these shares of all are left out of the models, so that there are at
#: most 500,000 runs and 100,000 words.
ORDER, LEAST_RUN, LEAST_WORD = 4, 2e-6, 1e-5
#: So many occurrences of a run count as much as what its shorter end tells.
SMOOTH = 30
#: Distinct words that a task holds before it passes them on.
HELD_WORDS = 200_000

_SIGNS = "".join(k for k in LEET if not k.isdigit())
_SIGN = re.compile("[0-9" + re.escape(_SIGNS) + "]")
# single letters, digits or signs, parted alike; a quote, bracket or the like may stand before the first
_UNIT = r"(?:[^\W_]|[" + re.escape("".join(k for k in LEET if not k.isdigit() and LEET[k])) + r"])(?![^\W_])"
_PART = r"(?:[ \t]++[._*~/,-]?[ \t]*+|[._*~/,-]{1,2}+[ \t]*+)"
_SPACED = re.compile(rf"(?<![^\W_])(?<![^\W_]['’]){_UNIT}(?:{_PART}{_UNIT}){{2,}}")
_MAYBE_SPACED = re.compile(rf"[ \t._*~/,-]{_UNIT}[ \t._*~/,-]++{_UNIT}")
_PARTS = re.compile(r"[ \t._*~/,-]+")
_REPEATED = re.compile(r"([^\W\d_])\1\1")
_WHITE = re.compile(r"[ \n\t]")
_LETTERS = re.compile(r"[^\W\d_]+")
#: What may stand around a stretch; signs that letters are written with stay.
_AROUND = ".,;:?\"')[]{}<>-_#&%=/\\~`^’‘“”«»"


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word, n) of all texts in lower case."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for body in batch.column(0):
                held.update(words_of((body.as_py() or "").lower().encode()))
                if len(held) > HELD_WORDS:
                    yield _counted(held)
                    held.clear()
        yield _counted(held)

    body = docs.select(F.col(f"`{text}`").cast("string").alias("body")).filter("body IS NOT NULL")
    return body.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(held: Counter) -> pa.RecordBatch:
    words = [w if isinstance(w, str) else w.decode() for w in held]
    return pa.record_batch([pa.array(words, pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])


def runs_of(word: str) -> Iterator[str]:
    """The runs of characters that end in each letter of a word, and in the break after it."""
    for m in _LETTERS.finditer(word):
        padded = f"{' ' * (ORDER - 1)}{m[0]} "
        for i in range(len(m[0]) + 1):
            yield padded[i : i + ORDER]


def run_counts(words: DataFrame) -> DataFrame:
    """(word, n) of the runs of characters in (word, n). A word counts by its length in bits of n, not by n: a model of
    words that may be meant is not to be ruled by the few that are everywhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for r in runs_of(word):
                    held[r] += n.bit_length()
            if len(held) > HELD_WORDS:
                yield _counted(held)
                held.clear()
        yield _counted(held)

    return words.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, share: float) -> dict[str, int]:
    """The rows of at least this share of all, which are 1 / share at most."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    return {r["word"]: r["n"] for r in counts.filter(F.col("n") >= share * total).toLocalIterator()}


def read_corpus(docs: DataFrame, text: str) -> tuple[dict[str, int], frozenset[str]]:
    """Counts of runs of characters, and the words that are no disguise, for they are common."""
    words = checkpointed(word_counts(docs, text))
    return _frequent(checkpointed(run_counts(words)), LEAST_RUN), frozenset(_frequent(words, LEAST_WORD))


class Language:
    """Costs, negative log probabilities, of a character after others, smoothed by what follows fewer of them."""

    def __init__(self, runs: dict[str, int]):
        self.counts: dict[str, int] = defaultdict(int)
        self.sums: dict[str, int] = defaultdict(int)
        for run, n in runs.items():
            for k in range(ORDER):
                self.counts[run[k:]] += n
                self.sums[run[k:-1]] += n
        self.letters = sum(len(r) == 1 for r in self.counts) + 1
        self.known: dict[str, float] = {}

    def cost(self, run: str) -> float:
        """Of the last character after those before it."""
        found = self.known.get(run)
        if found is None:
            if len(self.known) > 1_000_000:
                self.known.clear()
            found = self.known[run] = -math.log(self._probability(run))
        return found

    def _probability(self, run: str) -> float:
        p = (self.counts.get(run[-1], 0) + 1) / (self.sums.get("", 0) + self.letters)
        for k in range(2, len(run) + 1):
            p = (self.counts.get(run[-k:], 0) + SMOOTH * p) / (self.sums.get(run[-k:-1], 0) + SMOOTH)
        return p


def lattice(stretch: str) -> Iterator[list[tuple[str, float]]]:
    """For each place of a lower-case stretch what it may be read as, and at what cost."""
    first, last = len(stretch) - len(stretch.lstrip(_SIGNS)), len(stretch.rstrip(_SIGNS))
    parts = [not (c.isalnum() or c in LEET) for c in stretch]

    def spelled(at: int) -> bool:
        """Whether a separator stands between single characters."""
        a, b = at, at + 1
        while a and parts[a - 1]:
            a -= 1
        while b < len(parts) and parts[b]:
            b += 1
        return (a < 2 or parts[a - 2]) and (b + 1 >= len(parts) or parts[b + 1])

    for at, c in enumerate(stretch):
        if c.isalpha():
            offers = [(c, 0.0)]
        elif c in LEET:
            price = VOWEL if c == "*" else SUBSTITUTE
            amid = any(x.isalpha() for x in stretch[max(0, at - 1) : at]) and any(x.isalpha() for x in stretch[at + 1 : at + 2])
            rest = (AMID if amid else DIGIT_BREAK) if c.isdigit() else SIGN_BREAK if first <= at < last else EDGE
            offers = [*[(x, price) for x in LEET[c]], (" ", rest), ("", SPACED if c == "*" else DROP)]
        elif c.isdigit():
            offers = [(" ", DIGIT_BREAK), ("", DROP)]
        else:
            offers = [(" ", 0.0), ("", SPACED if spelled(at) else JOINED)]
        if at and c == stretch[at - 1]:
            if c * 3 in stretch[max(0, at - 2) : at + 3]:
                offers += [("", REPEAT)] if c.isalpha() or c in LEET else []
            elif c.isalpha():
                offers.append(("", DOUBLE))
        yield offers


def decode(stretch: str, language: Language) -> str:
    """The likeliest reading of a lower-case stretch: words of letters, parted by spaces."""
    start, cost = " " * (ORDER - 1), language.cost
    # state: the last characters put out; value: cost, reading
    states: dict[str, tuple[float, str]] = {start: (0.0, "")}
    done = ""
    for at, offers in enumerate(lattice(stretch)):
        if at and at % STRETCH == 0:
            same = os.path.commonprefix([reading for _, reading in states.values()])
            done += same
            states = {k: (total, reading[len(same) :]) for k, (total, reading) in states.items()}
        new: dict[str, tuple[float, str]] = {}
        for state, (so_far, reading) in states.items():
            for x, price in offers:
                total, put, after = so_far + price, reading, state
                if x and (x != " " or state != start):  # a break after a break is none
                    total, put, after = total + cost(state + x), reading + x, start if x == " " else state[1:] + x
                if after not in new or total < new[after][0]:
                    new[after] = (total, put)
        states = new
    return done + min((total + (cost(state + " ") if state != start else 0.0), reading) for state, (total, reading) in states.items())[1]


class Restorer:
    """Reads the disguised stretches of texts."""

    def __init__(self, runs: dict[str, int], common: frozenset[str]):
        self.language, self.common = Language(runs), common
        self.known: dict[str, list[str]] = {}

    def read(self, stretch: str) -> list[str]:
        if len(stretch) > STRETCH:
            return decode(stretch, self.language).split()
        if stretch not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            self.known[stretch] = decode(stretch, self.language).split()
        return self.known[stretch]

    def restored(self, low: str, plain: set[bytes]) -> list[str]:
        """The words that the disguised stretches of a lower-case text are read as; plain: its words as they are."""
        stretches = [*self._signed(low)]
        if _MAYBE_SPACED.search(low):
            stretches += [_narrowed(m[0]) for m in _SPACED.finditer(low) if any(c.isalpha() for c in m[0])]
        own = b" ".join(plain).decode()
        if _REPEATED.search(own):
            stretches += [w for w in sorted(own.split()) if _REPEATED.search(w) and w.isalpha()]
        return [w for s in stretches for w in self.read(s)]

    def _signed(self, low: str) -> Iterator[str]:
        """The pieces between white space that have letters and signs or digits. A piece without letters is a number or a
        sign. Signs that stand around are none of it where one is repeated, where they are an exclamation mark after or a
        bracket before, or where the word is common."""
        end = 0
        for m in _SIGN.finditer(low):
            if (at := m.start()) < end:
                continue
            start = low.rfind(" ", 0, at) + 1
            start = max(start, low.rfind("\n", start, at) + 1, low.rfind("\t", start, at) + 1)
            end = found.start() if (found := _WHITE.search(low, at)) else len(low)
            piece = low[start:end].strip(_AROUND)
            core = piece.strip(_AROUND + _SIGNS)
            if core != piece and not _SIGN.search(core):
                lead, tail = piece[: piece.find(core)].strip(_AROUND), piece[piece.find(core) + len(core) :].strip(_AROUND)
                lead = "" if lead == "(" or len(lead) > 1 and len(set(lead)) == 1 else lead
                tail = "" if len(set(tail)) == 1 and (len(tail) > 1 or tail == "!") else tail
                piece = lead + core + tail
                if not lead + tail or len(set(lead + tail)) == 1 and core in self.common:
                    continue
            if _LETTERS.search(piece) and (len(core) > 1 or len(piece) > 2):
                yield piece


def _narrowed(spaced: str) -> str:
    """A spelled stretch with the narrowest parts between its letters as one place each, wider ones as they are."""
    least = min(len(x) for x in _PARTS.findall(spaced))
    return _PARTS.sub(lambda m: m[0][0] if len(m[0]) == least else m[0], spaced)


#: Words that share their first bytes share a feature for each of these lengths.
STEMS = (4, 5)


def words_in(text: str, restorer: Restorer) -> set[bytes]:
    """The words of a text as it is and as restored."""
    low = text.lower()
    plain = set(words_of(low.encode()))
    plain.update(w.encode() for w in restorer.restored(low, plain))
    return plain


def features_of(word: bytes) -> list[bytes]:
    """A word and its stems."""
    return [word, *[word[:n] + b"*" for n in STEMS if len(word) > n]]


def _words_of_rows(df: DataFrame, corpus) -> DataFrame:
    """(label, words) of (label, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(*corpus.value)
        for batch in batches:
            found = [sorted({f.decode("latin-1") for w in words_in(t.as_py() or "", restorer) for f in features_of(w)}) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["label", "words"])

    return df.select("label", "body").mapInArrow(run, "label int, words array<string>")


def fit_logistic(rows: list[tuple[int, list[int]]], n_words: int, penalty: float = 0.1, rounds: int = 600) -> np.ndarray:
    """Weights of the words, the intercept last; ridge penalty, accelerated gradient steps, so the same every time.

    The curvature along a word is at most a quarter of its documents times the most words of any, so each has its step.
    """
    row = np.concatenate([np.full(len(w), i) for i, (_, w) in enumerate(rows)] or [np.zeros(0)]).astype(np.int64)
    col = np.concatenate([np.asarray(w, np.int64) for _, w in rows] or [np.zeros(0)]).astype(np.int64)
    y = np.array([label for label, _ in rows], float)
    w, momentum = np.zeros(n_words + 1), np.zeros(n_words + 1)
    rate = y.mean()
    w[-1] = momentum[-1] = math.log(rate / (1 - rate))
    widest = np.bincount(row, minlength=len(y)).max(initial=0) + 1
    step = 1 / (0.25 * widest * np.append(np.bincount(col, minlength=n_words), len(y)) + penalty)
    t = 1.0
    for _ in range(rounds):
        z = np.bincount(row, momentum[col], len(y)) + momentum[-1]
        gap = 1 / (1 + np.exp(-z)) - y
        gradient = np.append(np.bincount(col, gap[row], n_words) + penalty * momentum[:-1], gap.sum())
        new = momentum - step * gradient
        later = (1 + math.sqrt(1 + 4 * t * t)) / 2
        momentum, w, t = new + (t - 1) / later * (new - w), new, later
    return w


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str, text: str, label: str, corpus, learn) -> tuple[dict[str, float], float]:
    """Weights of words and the intercept. learn: a condition on doc_id that tells which labels may be learnt from."""
    usable = (
        labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    few = first_rows(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("body")), usable, FIT_DOCUMENTS, 7)
    fitted = checkpointed(_words_of_rows(few, corpus))
    totals = {r["label"]: r["count"] for r in fitted.groupBy("label").count().toLocalIterator()}
    positive, negative = totals.get(1, 0), totals.get(0, 0)
    if not positive or not negative:
        rate = (positive + 0.5) / (positive + negative + 1.0)
        return {}, math.log(rate / (1 - rate))
    by_word = fitted.select("label", F.explode("words").alias("word")).groupBy("word").agg(F.sum("label").cast("double").alias("p"), F.count(F.lit(1)).cast("double").alias("n"))
    # the odds of such counts by chance are at most exp(-gain): fewer than one word of all may pass
    by_word = checkpointed(by_word.filter(F.col("n") >= LEAST_DOCUMENTS))
    share = positive / (positive + negative)
    part = lambda x, of: F.when(x > 0, x * F.log(x / (F.col("n") * F.lit(of)))).otherwise(0.0)
    gain = part(F.col("p"), share) + part(F.col("n") - F.col("p"), 1 - share)
    chosen = by_word.filter(gain >= math.log(max(2, by_word.count()))).select("word")
    vocabulary = sorted(r["word"] for r in chosen.toLocalIterator())
    place = {w: i for i, w in enumerate(vocabulary)}
    held = fitted.select("label", F.array_intersect("words", F.array(*map(F.lit, vocabulary)).cast("array<string>")).alias("words"))
    # in an order of their own, so that reruns add up the same
    weights = fit_logistic(sorted((r["label"], sorted(place[w] for w in r["words"])) for r in held.toLocalIterator()), len(vocabulary))
    return dict(zip(vocabulary, weights.tolist(), strict=False)), float(weights[-1])


class Scorer:
    """Scores of texts under the word model."""

    def __init__(self, weights: dict[str, float], intercept: float, restorer: Restorer):
        self.weights = {w.encode("latin-1"): x for w, x in weights.items()}
        self.intercept, self.restorer = intercept, restorer
        self.known: dict[bytes, tuple[bytes, ...]] = {}

    def score(self, text: str) -> float:
        found: set[bytes] = set()
        for w in words_in(text, self.restorer):
            own = self.known.get(w)
            if own is None:
                if len(self.known) > 200_000:
                    self.known.clear()
                own = self.known[w] = tuple(f for f in features_of(w) if f in self.weights)
            if own:
                found.update(own)
        z = self.intercept + sum(self.weights[f] for f in sorted(found))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def score_toxicity(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", learn=None,
                   carry: list[str] | None = None, prefix: str = "") -> DataFrame:
    """A row per document: doc_id, score, predicted, with prefix before these names; columns in carry come along.

    The character model counts all texts. Labels are looked up by doc_id and learnt from where `learn` holds; null ids
    and labels other than 0 and 1 are passed over, of several labels of a document the highest counts, of several texts
    the one of least hash is learnt from. A null text counts as empty, and an empty one gets the score of a document
    without any of the model's words. With labels of one class only, or none, every score is that class's smoothed share.
    Repeated rows get a row each; an empty table gives none.
    """
    spark = docs.sparkSession
    ship(spark)
    corpus = spark.sparkContext.broadcast(read_corpus(docs, text))
    model = spark.sparkContext.broadcast(fit(docs, labels, doc_id=doc_id, text=text, label=label, corpus=corpus, learn=F.lit(True) if learn is None else learn))
    carry = carry or []
    held = [f"carried_{i}" for i in range(len(carry))]
    kinds = dict(docs.dtypes)
    # a text that comes along isn't sent twice
    at = 1 + carry.index(text) if text in carry and kinds[text] == "string" else len(carry) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*model.value, Restorer(*corpus.value))
        for batch in batches:
            scores = [scorer.score(body.as_py() or "") for body in batch.column(at)]
            yield pa.record_batch(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), *[batch.column(1 + i) for i in range(len(held))]],
                names=["doc_id", "score", "predicted", *held],
            )

    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), *[F.col(f"`{c}`").alias(h) for c, h in zip(carry, held, strict=True)],
        *([F.col(f"`{text}`").cast("string").alias("text")] if at > len(carry) else []),
    )
    schema = f"doc_id {kinds[doc_id]}, score double, predicted int" + "".join(f", {h} {kinds[c]}" for c, h in zip(carry, held, strict=True))
    return rows.mapInArrow(run, schema).select(*[F.col(c).alias(prefix + c) for c in ("doc_id", "score", "predicted")], *[F.col(h).alias(c) for c, h in zip(carry, held, strict=True)])
