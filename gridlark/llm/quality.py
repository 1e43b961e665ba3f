"""Quality by attention over passages (multiple-instance learning).

A document is a bag of passages. Each passage is encoded by what its bytes are and how they follow each other; a gated
attention network (tanh and sigmoid branches, softmax over the bag) weighs the passages, and a logistic output scores
the weighted representation. Encoder scale, attention and output are learnt from document labels alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlark.llm.common import first_rows, ship

#: A passage is so many bytes of the UTF-8 text, the last what remains.
PASSAGE = 512

#: The network is fitted on the whole texts of at most so many labelled documents that have so many passages at most
#: between them: by a hash of the id, a document is passed over if its passages don't fit with those before it.
FIT_DOCUMENTS, FIT_PASSAGES = 12_000, 200_000

#: Texts are encoded together up to so many bytes, longer ones in steps, so memory doesn't grow with a text.
STEP = PASSAGE * 4096

# Byte classes: white space, lower, upper, digit, sentence marks, quotes and brackets, other signs, bytes beyond ASCII.
_KINDS = 8
_CLASS = np.full(256, 6, np.int64)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 7
_CLASS[[ord(c) for c in ".,;:?"]] = 4
_CLASS[[ord(c) for c in "\"'()[]{}"]] = 5
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

#: Class pairs, then: repeated bytes, repeated words, words met before in the passage, words and mean word length.
WIDTH = _KINDS * _KINDS + 5


def encode(data: bytes) -> np.ndarray:
    """A row for each passage of a text; an empty text has one passage, of zeros."""
    if not data:
        return np.zeros((1, WIDTH), np.float32)
    return np.concatenate([_encode(data[at : at + STEP]) for at in range(0, len(data), STEP)])


def _encode(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    n = -(-len(raw) // PASSAGE)
    kind = _CLASS[raw]
    passage = np.arange(len(raw)) // PASSAGE
    size = np.bincount(passage, minlength=n).astype(np.float64)
    pair = kind[:-1] * _KINDS + kind[1:]
    inside = passage[:-1]
    out = np.zeros((n, WIDTH))
    out[:, : _KINDS**2] = np.bincount(inside * _KINDS**2 + pair, minlength=n * _KINDS**2).reshape(n, -1) / size[:, None]
    out[:, -5] = np.bincount(inside, raw[:-1] == raw[1:], n) / size
    # a word's hash: the sum of its bytes times powers by place, from running sums
    space = kind == 0
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    if len(starts):
        ends = np.flatnonzero(~space & np.concatenate((space[1:], [True]))) + 1
        place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw)))) if starts[0] == 0 else np.concatenate((np.zeros(starts[0], np.int64), np.arange(starts[0], len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))))
        mixed = np.where(space, np.uint64(0), (_LOWER[raw] + np.uint64(1)) * ((place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * _MULTIPLIER))
        word = np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), starts)
        own = passage[starts]
        words = np.maximum(1, np.bincount(own, minlength=n))
        if len(starts) > 1:
            out[:, -4] = np.bincount(own[1:], word[1:] == word[:-1], n) / words
        order = np.lexsort((word, own))
        again = (word[order][1:] == word[order][:-1]) & (own[order][1:] == own[order][:-1])
        out[:, -3] = np.bincount(own[order][1:], again, n) / words
        out[:, -2] = words / size
        out[:, -1] = np.bincount(own, ends - starts, n) / words / 16
    return out.astype(np.float32)


class Network:
    """h = tanh(W x + b); weight of a passage ~ exp(w . (tanh(V h) * sigmoid(U h))); score = sigmoid(c . sum(weight h) + d)."""

    HIDDEN, GATE = 24, 12

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 17):
        r = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        h, g = self.HIDDEN, self.GATE
        self.p = {
            "W": r.normal(0, WIDTH**-0.5, (WIDTH, h)), "b": np.zeros(h), "V": r.normal(0, h**-0.5, (h, g)), "U": r.normal(0, h**-0.5, (h, g)),
            "w": r.normal(0, g**-0.5, g), "c": r.normal(0, h**-0.5, h), "d": np.zeros(1),
        }

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict:
        """x: the passages of all bags one after the other; starts: where each bag starts, none empty."""
        p, v = self.p, {}
        v["x"] = (x - self.mean) / self.scale
        v["h"] = np.tanh(v["x"] @ p["W"] + p["b"])
        v["t"], v["s"] = np.tanh(v["h"] @ p["V"]), 1 / (1 + np.exp(-(v["h"] @ p["U"])))
        e = (v["t"] * v["s"]) @ p["w"]
        v["bag"] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        e = np.exp(e - np.maximum.reduceat(e, starts)[v["bag"]])
        v["a"] = e / np.add.reduceat(e, starts)[v["bag"]]
        v["z"] = np.add.reduceat(v["a"][:, None] * v["h"], starts)
        v["y"] = 1 / (1 + np.exp(-np.clip(v["z"] @ p["c"] + p["d"], -30, 30)))
        return v

    def gradient(self, v: dict, label: np.ndarray, starts: np.ndarray) -> dict:
        p, n = self.p, len(label)
        gap = (v["y"] - label) / n
        g = {"d": np.array([gap.sum()]), "c": v["z"].T @ gap}
        to_z = gap[:, None] * p["c"]
        spread = to_z[v["bag"]]
        to_a = (spread * v["h"]).sum(1)
        to_e = v["a"] * (to_a - np.add.reduceat(v["a"] * to_a, starts)[v["bag"]])
        g["w"] = (v["t"] * v["s"]).T @ to_e
        to_t = to_e[:, None] * p["w"] * v["s"] * (1 - v["t"] ** 2)
        to_s = to_e[:, None] * p["w"] * v["t"] * v["s"] * (1 - v["s"])
        g["V"], g["U"] = v["h"].T @ to_t, v["h"].T @ to_s
        to_h = (v["a"][:, None] * spread + to_t @ p["V"].T + to_s @ p["U"].T) * (1 - v["h"] ** 2)
        g["W"], g["b"] = v["x"].T @ to_h, to_h.sum(0)
        return g


def fit_network(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.004, decay: float = 1e-4) -> Network:
    """Adam over shuffled batches with a fixed seed: the same bags in the same order give the same network."""
    every = np.concatenate(bags)
    net = Network(every.mean(0, dtype=np.float64), every.std(0, dtype=np.float64) + 1e-3)
    del every
    r = np.random.default_rng(23)
    m = {k: np.zeros_like(x) for k, x in net.p.items()}
    s = {k: np.zeros_like(x) for k, x in net.p.items()}
    step, total = 0, epochs * -(-len(bags) // batch)
    for _ in range(epochs):
        order = r.permutation(len(bags))
        for at in range(0, len(order), batch):
            own = [bags[i] for i in order[at : at + batch]]
            starts = np.cumsum([0, *map(len, own)])[:-1]
            v = net.forward(np.concatenate(own), starts)
            step += 1
            speed = rate * (1 - step / (total + 1))
            for k, g in net.gradient(v, labels[order[at : at + batch]], starts).items():
                g = g + decay * net.p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                net.p[k] = net.p[k] - speed * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return net


def _score(net: Network, texts: list[bytes]) -> list[float]:
    """Of all passages of each text; many short texts at a time, a long one by itself."""
    out: list[float] = []
    bags: list[np.ndarray] = []

    def flush() -> None:
        if bags:
            starts = np.cumsum([0, *map(len, bags)])[:-1]
            out.extend(net.forward(np.concatenate(bags).astype(np.float64), starts)["y"].tolist())
            bags.clear()

    held = 0
    for t in texts:
        bags.append(encode(t))
        held += len(bags[-1])
        if held >= 2048:
            flush()
            held = 0
    flush()
    return out


def score_quality(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", learn=None, threshold: float = 0.7) -> DataFrame:
    """A row per document: doc_id, score, predicted (1 from `threshold` on).

    Labels are looked up by doc_id and learnt from where `learn` holds; null ids and labels other than 0 and 1 are
    passed over, of several labels of a document the lowest counts, of several texts the one of least hash is learnt from. A null text counts as empty: one passage without
    content, scored as any other. With labels of one class only, or none, every score is that class's smoothed share.
    Repeated rows get a row each, an empty table none; columns besides those named are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    usable = (
        labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (F.lit(True) if learn is None else learn))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    body = F.col(f"`{text}`").cast("string").cast("binary").alias("body")
    few = first_rows(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), body), usable, FIT_DOCUMENTS, 11)
    sizes = few.select(F.col("doc_id").cast("string"), "turn", F.greatest(F.lit(1), F.ceil(F.octet_length("body") / F.lit(PASSAGE))).alias("passages"))
    total, names = 0, []
    for name, _, passages in sorted(sizes.toLocalIterator(), key=lambda r: (r[1], r[0])):
        if total + passages <= FIT_PASSAGES:
            total += passages
            names.append((name,))
    chosen = F.broadcast(spark.createDataFrame(names, "name string"))

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [encode(b.as_py() or b"").tobytes() for b in batch.column(1)]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(bags, pa.binary())], names=["doc_id", "label", "bag"])

    encoded = few.withColumn("name", F.col("doc_id").cast("string")).join(chosen, "name", "left_semi").select("name", "body", "label")
    rows = sorted((r["doc_id"], r["bag"], r["label"]) for r in encoded.mapInArrow(passages, "doc_id string, label int, bag binary").toLocalIterator())
    y = np.array([label for _, _, label in rows], float)
    if len(set(y.tolist())) == 2:
        fitted = fit_network([np.frombuffer(b, np.float32).reshape(-1, WIDTH) for _, b, _ in rows], y)
        model = spark.sparkContext.broadcast(fitted)
    else:
        model = spark.sparkContext.broadcast(float((y.sum() + 0.5) / (len(y) + 1.0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model.value
        for batch in batches:
            texts = [b.as_py() or b"" for b in batch.column(1)]
            scores = [net] * len(texts) if isinstance(net, float) else _score(net, texts)
            yield pa.record_batch(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())], names=["doc_id", "score", "predicted"]
            )

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), body).mapInArrow(run, f"doc_id {dict(docs.dtypes)[doc_id]}, score double, predicted int")
