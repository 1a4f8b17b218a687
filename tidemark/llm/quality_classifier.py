"""Supervised subword embeddings for text quality.

A document is the average of learned vectors of its words and character n-grams (of three and four bytes of UTF-8, so a
letter outside ASCII is two to four of them; words bounded by spaces), found by hashing into tables; a softmax layer over the average gives the class. Vectors and layer
are trained by stochastic gradient descent in numpy on labelled rows, of which at most `most` are used, those with
the least hashes of their ids. As the layer is linear, scoring needs one number per table entry, the difference of the
two classes' logits.

Defined results: null and empty texts get the score of the bias alone; one row per input row; several labels of one
id count as their mean, rounded up; without labelled rows of both classes every score is the share of ones (0.5
if there is none); an empty table gives no rows; a text is scored in one piece, which takes about a hundred times its
bytes; only id and text are read, and only labels by id in training.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_parts, text_bytes, word_hashes, words

WORD_BITS, GRAM_BITS = 17, 16
#: Besides, each word tells by a feature of its own whether the word so many places before it is the same.
BACK = (1, 2)
_GRAMS = 1 << WORD_BITS
_SAME = _GRAMS + 2 * (1 << GRAM_BITS)
N_FEATURES = _SAME + 2 * len(BACK)


def features(raw: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(place, feature) of the words, their repeats, the 3-grams and the 4-grams of the texts in raw, each by place."""
    starts, ends = words(raw)
    hashes = word_hashes(raw, starts, ends)
    out = [(starts, (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64))]
    doc = np.searchsorted(offsets, starts, side="right")
    for k, back in enumerate(BACK):
        same = np.zeros(len(starts), dtype=np.int64)
        same[back:] = (hashes[back:] == hashes[:-back]) & (doc[back:] == doc[:-back])
        out.append((starts, _SAME + 2 * k + same))
    space = np.ones(len(raw) + 4, dtype=bool)
    space[1 : len(raw) + 1] = (raw == 0x20) | ((raw >= 9) & (raw <= 13))
    codes = np.full(len(raw) + 4, 0x20, dtype=np.uint32)
    codes[1 : len(raw) + 1] = np.where(space[1 : len(raw) + 1], np.uint32(0x20), raw)
    n = len(raw)
    three = codes[:n] | codes[1 : n + 1] << np.uint32(8) | codes[2 : n + 2] << np.uint32(16)
    four = three | codes[3 : n + 3] << np.uint32(24)
    inner = ~space[1 : n + 1]
    for k, (gram, valid) in enumerate(((three, inner), (four, inner & ~space[2 : n + 2]))):
        place = np.flatnonzero(valid)
        out.append((place, (gram[place] * np.uint32(0x9E3779B1) >> np.uint32(32 - GRAM_BITS)).astype(np.int64) + _GRAMS + k * (1 << GRAM_BITS)))
    return out


@dataclass
class Model:
    weight: np.ndarray  # of each feature, in the mean
    bias: float

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total, count = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
        for place, feature in features(raw, offsets):
            run = np.concatenate([[0.0], np.cumsum(self.weight[feature], dtype=np.float64)])
            at = np.searchsorted(place, offsets)
            total += run[at[1:]] - run[at[:-1]]
            count += np.diff(at)
        logit = np.clip(total / np.maximum(count, 1) + self.bias, -30, 30)
        return 1 / (1 + np.exp(-logit))


def train(texts: list[str], labels: np.ndarray, dim: int = 8, epochs: int = 6, rate: float = 0.4, seed: int = 7) -> Model:
    """Softmax regression on averaged hashed vectors, both learned, one document at a time."""
    labels = np.asarray(labels, dtype=np.int64)
    if not len(labels) or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 0.5
        return Model(np.zeros(N_FEATURES, np.float32), float(np.log(np.clip(share, 1e-6, 1 - 1e-6) / (1 - np.clip(share, 1e-6, 1 - 1e-6)))))
    held = []
    for t in texts:
        raw, offsets = text_bytes(pa.array([t], pa.string()))
        found, counts = np.unique(np.concatenate([f for _, f in features(raw, offsets)]), return_counts=True)
        held.append((found, (counts / max(1, counts.sum())).astype(np.float32)))
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / dim, 1 / dim, (N_FEATURES, dim)).astype(np.float32)
    layer, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    layer[:, 1] = random.uniform(-1, 1, dim)
    layer[:, 0] = -layer[:, 1]
    n = epochs * len(held)
    for step, i in enumerate(np.concatenate([random.permutation(len(held)) for _ in range(epochs)])):
        lr = rate * (1 - step / n)
        found, share = held[i]
        mean = share @ vectors[found]
        logits = mean @ layer + bias
        p = np.exp(logits - logits.max())
        p /= p.sum()
        p[labels[i]] -= 1
        back = layer @ p
        layer -= lr * np.outer(mean, p)
        bias -= lr * p
        # a mean of many entries moves little by a step in each; the step is taken on the scale of the mean
        vectors[found] -= (lr * 20 * share)[:, None] * back
    return Model((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, most: int) -> tuple[list[str], np.ndarray]:
    """Texts and labels of at most `most` labelled rows that allowed (a condition on doc_id) lets through."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(allowed).groupBy("doc_id").agg(F.ceil(F.avg(F.col(label).cast("double"))).cast("int").alias("_label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.min("_label").alias("y")).toArrow()
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    rows = rows.take(pa.array(order))
    return rows.column("text").to_pylist(), np.clip(rows.column("y").to_numpy().astype(np.int64), 0, 1)


def score_with(docs: DataFrame, scores, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) per row; scores(raw, offsets) comes with the tasks as a broadcast object's method."""
    model = docs.sparkSession.sparkContext.broadcast(scores)

    def scored(batches):
        for batch in batches:
            for part in in_parts(batch, text_col):
                raw, offsets = text_bytes(part.column(text_col))
                yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(model.value.scores(raw, offsets))], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(scored, f"id {kind}, score double").withColumnRenamed("id", id_col)


def remainder(modulus: int) -> Column:
    """crc32(doc_id as text) mod modulus; -1 for a null id, which no label is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus, F.lit(-1))


def quality_model(docs: DataFrame, labels: DataFrame, most: int = 3000) -> Model:
    texts, y = labelled_sample(docs, labels, "quality", remainder(4) != 2, most)
    return train(texts, y)


def quality_scores(docs: DataFrame, labels: DataFrame, train_docs: DataFrame | None = None, most: int = 3000) -> DataFrame:
    """(doc_id, score) of docs by a model learned from the labelled rows of train_docs (docs itself by default)."""
    return score_with(docs, quality_model(docs if train_docs is None else train_docs, labels, most))


def keep_good(docs: DataFrame, model: Model, least: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of docs that score at least `least`, unchanged.

    Every column goes through the scoring task and back, so nothing is joined and repeated ids keep their own rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches):
        for batch in batches:
            for part in in_parts(batch, text_col):
                raw, offsets = text_bytes(part.column(text_col))
                yield part.filter(pa.array(held.value.scores(raw, offsets) >= least))

    return docs.mapInArrow(kept, docs.schema)
