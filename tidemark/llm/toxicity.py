"""Toxicity by weak supervision.

Many voters look at a document: lexicon voters (one per listed or mined word), stem voters (words that begin with a
mined stem) and pattern voters (shouting, insulting phrases, masked letters). A voter votes or abstains. A generative
label model says how votes come about: on toxic and on other documents each voter has its own rate (its accuracy), and
within the classes votes have one covariance (their correlations), so voters that repeat each other don't count twice.
Rates and covariance are estimated by expectation maximisation over rows with and without labels; the labels stand in
for the hidden class where they are known, and give the prior. Its posteriors, of all rows alike, are the only targets
of a linear classifier over the presence of hashed words and word stems, trained by gradient descent; its bias is set
so that as large a share of the labelled rows scores 0.5 or more as the prior says.

Voters are mined and both models are fitted on at most `most` rows with labels that may be learned from and
`most_unlabelled` rows without any label, those with the least hashes of their ids (the latter out of the first four
times as many ids); every text is scored whole. The models have at most 400 mined voters and 4,000 features.

Defined results: null and empty texts get the score of the bias; one row per input row; several labels of one id
count as one if any is 1; without toxic or without other labelled rows every score is the share of ones; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, powers, text_bytes
from .quality_classifier import labelled_sample, remainder, score_with

#: Seed words of the lexicon voters.
SEED_WORDS = (
    "idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown", "imbecile", "filth", "vermin", "dumb", "kill yourself",
    "idiota", "estúpido", "imbécil", "basura", "asqueroso", "idiote", "stupide", "ordure", "dégoûtant", "minable", "dumm", "abschaum", "müll", "ekelhaft", "wertlos",
)
#: Stems are the first so many bytes of a word, with a two-byte character counting twice.
STEMS = (4, 5, 6)
_WORD, _STEM = 0, 1

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[0x80:] = True


def word_features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of the words, lower case, and of their stems; features are 64-bit hashes."""
    low = _FOLD[raw]
    # capital letters with diacritics (two bytes, C3 80 to C3 9E) in lower case as well
    after = np.concatenate([[0], low[:-1]]) == 0xC3
    low = np.where(after & (low >= 0x80) & (low <= 0x9E) & (low != 0x97), low + 0x20, low).astype(np.uint8)
    letter = _LETTER[low]
    before = np.concatenate([[False], letter[:-1]])
    starts = np.flatnonzero(letter & ~before)
    ends = np.flatnonzero(np.concatenate([before[1:], letter[-1:]]) & ~np.concatenate([letter[1:], [False]]))
    up, down = powers(len(low))
    total = np.zeros(len(low) + 1, dtype=np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: len(low)], out=total[1:])
    doc = np.searchsorted(offsets, starts, side="right") - 1
    docs, found = [doc], [mix((total[ends] - total[starts]) * down[starts] + np.uint64(_WORD))]
    for n in STEMS:
        long = ends - starts >= n
        s = starts[long]
        docs.append(doc[long])
        found.append(mix((total[s + n] - total[s]) * down[s] + np.uint64(_STEM + n)))
    return np.concatenate(docs), np.concatenate(found)


def _phrase(low: np.ndarray, phrase: str) -> np.ndarray:
    """Where the phrase begins."""
    found = np.ones(len(low), dtype=bool)
    for k, c in enumerate(phrase.encode()):
        found &= np.concatenate([low[k:], np.zeros(k, np.uint8)]) == c
    return found


def patterns(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Votes (documents × patterns): many capitals, doubled exclamation marks, masked letters, listed phrases."""
    run = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
    upper = run((raw >= 65) & (raw <= 90))
    lower = run((raw >= 97) & (raw <= 122))
    following = np.concatenate([raw[1:], [0x20]])
    bangs = run((raw == 33) & (following == 33))
    masked = run((raw == 42) & _LETTER[_FOLD[following]])
    phrases = [run(_phrase(_FOLD[raw], p)) > 0 for p in SEED_WORDS if " " in p]
    return np.stack([upper > lower + 10, bangs > 1, masked > 0, *phrases], axis=1)


@dataclass
class LabelModel:
    """Rates of the votes on toxic and on other documents, their covariance within the classes, the share of toxic ones."""

    on_toxic: np.ndarray
    on_other: np.ndarray
    covariance: np.ndarray
    prior: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The chance of being toxic given all votes, which are taken as normal around the class's rates."""
        weight = np.linalg.solve(self.covariance, self.on_toxic - self.on_other)
        logit = np.log(self.prior / (1 - self.prior)) + (votes - (self.on_toxic + self.on_other) / 2) @ weight
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit_label_model(votes: np.ndarray, known: np.ndarray, rounds: int = 8, unlabelled: float = 0.3, shrink: float = 0.3) -> LabelModel:
    """Expectation maximisation. known: labels (0 or 1), or -1. A row without label counts `unlabelled` times.

    The covariance is drawn towards its diagonal by `shrink`, as rare voters have few rows to tell their correlations.
    """
    votes = votes.astype(np.float64)
    has = known >= 0
    p, weight = np.where(has, known, 0.0), has.astype(np.float64)
    prior = float(np.clip(known[has].mean(), 1e-4, 1 - 1e-4))
    for _ in range(rounds):
        toxic, other = weight * p, weight * (1 - p)
        on_toxic = (toxic @ votes + 0.05) / (toxic.sum() + 1)
        on_other = (other @ votes + 0.05) / (other.sum() + 1)
        spread = (votes * weight[:, None]).T @ votes - toxic.sum() * np.outer(on_toxic, on_toxic) - other.sum() * np.outer(on_other, on_other)
        covariance = (1 - shrink) * spread / weight.sum()
        covariance[np.diag_indices_from(covariance)] /= 1 - shrink
        covariance[np.diag_indices_from(covariance)] += 1e-3
        model = LabelModel(on_toxic, on_other, covariance, prior)
        p = np.where(has, known, model.posterior(votes))
        weight = np.where(has, 1.0, unlabelled)
    return model


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        logit = np.full(len(offsets) - 1, self.bias)
        doc, at = present(self.features, raw, offsets)
        np.add.at(logit, doc, self.weights[at])
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def present(features: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (document, index in features) that occur."""
    if not len(features):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc, found = word_features(raw, offsets)
    # a small table over the first bits tells most others apart before the search
    first = np.zeros(1 << 20, dtype=bool)
    first[(features >> np.uint64(44)).astype(np.int64)] = True
    maybe = first[(found >> np.uint64(44)).astype(np.int64)]
    doc, found = doc[maybe], found[maybe]
    at = np.minimum(np.searchsorted(features, found), len(features) - 1)
    hit = features[at] == found
    pairs = np.unique(doc[hit] * np.int64(len(features)) + at[hit])
    return pairs // len(features), pairs % len(features)


def train(texts: list[str], labels: np.ndarray, most_voters: int = 400, most_features: int = 4000, steps: int = 300) -> Model:
    """labels: 0, 1, or -1 for rows without."""
    labels = np.asarray(labels, dtype=np.int64)
    has = labels >= 0
    share = float(labels[has].mean()) if has.any() else 0.5
    if share in (0.0, 1.0) or not has.any():
        share = float(np.clip(share, 1e-6, 1 - 1e-6))
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    docs, found, shape = [], [], []
    for i in range(0, len(texts), 200):
        raw, offsets = text_bytes(pa.array(texts[i : i + 200], pa.string()))
        d, f = word_features(raw, offsets)
        _, first = np.unique(mix(f + mix(d)), return_index=True)
        docs.append(d[first] + i), found.append(f[first]), shape.append(patterns(raw, offsets))
    docs, found, shape = np.concatenate(docs), np.concatenate(found), np.concatenate(shape)
    kinds, at = np.unique(found, return_inverse=True)

    def evidence(p: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each feature: the logarithm of the ratio of its rates over its standard error, and how many rows have it."""
        n, toxic = np.bincount(at, weights=weight[docs], minlength=len(kinds)), np.bincount(at, weights=(p * weight)[docs], minlength=len(kinds))
        other = n - toxic
        rate = np.log((toxic + 0.5) / ((p * weight).sum() + 1)) - np.log((other + 0.5) / (((1 - p) * weight).sum() + 1))
        return rate / np.sqrt(1 / (toxic + 0.5) + 1 / (other + 0.5)), n

    seeds = np.isin(kinds, _seed_features()[0])
    z, n = evidence(np.maximum(labels, 0).astype(np.float64), has.astype(np.float64))
    mined = np.flatnonzero((z > 3) & (n >= 5))
    voters = np.union1d(mined[np.argsort(-z[mined], kind="stable")][:most_voters], np.flatnonzero(seeds))
    column = np.full(len(kinds), -1)
    column[voters] = np.arange(len(voters))
    votes = np.zeros((len(texts), len(voters) + shape.shape[1]), dtype=bool)
    of_voter = column[at] >= 0
    votes[docs[of_voter], column[at[of_voter]]] = True
    votes[:, len(voters) :] = shape
    model = fit_label_model(votes, labels)
    p = model.posterior(votes.astype(np.float64))
    # the classifier: features that tell the posteriors apart
    z, n = evidence(p, np.ones(len(p)))
    kept = np.flatnonzero((z > 2.5) & (n >= 4))
    kept = np.union1d(kept[np.argsort(-z[kept], kind="stable")][:most_features], np.flatnonzero(seeds))
    column = np.full(len(kinds), -1)
    column[kept] = np.arange(len(kept))
    use = column[at] >= 0
    row, col = docs[use], column[at[use]]

    def logits(weights: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.bincount(row, weights=weights[col], minlength=len(texts))

    weights, bias = np.zeros(len(kept)), float(np.log(model.prior / (1 - model.prior)))
    speed, speed_bias = np.full(len(kept), 1e-8), 1e-8
    for _ in range(steps):
        error = 1 / (1 + np.exp(-np.clip(logits(weights, bias), -30, 30))) - p
        grad = np.bincount(col, weights=error[row], minlength=len(kept)) + 0.3 * weights
        speed += grad * grad
        speed_bias += error.sum() ** 2
        weights -= 0.3 * grad / np.sqrt(speed)
        bias -= 0.3 * error.sum() / np.sqrt(speed_bias)
    ranked = np.sort(logits(weights, bias)[has])[::-1]
    border = int(np.clip(round(model.prior * len(ranked)), 1, len(ranked) - 1))
    bias -= (ranked[border - 1] + ranked[border]) / 2
    used = np.abs(weights) > 0.01
    return Model(kinds[kept][used], weights[used], float(bias))  # kinds are sorted


def _seed_features() -> tuple[np.ndarray, tuple[str, ...]]:
    raw, offsets = text_bytes(pa.array([w for w in SEED_WORDS if " " not in w], pa.string()))
    doc, found = word_features(raw, offsets)
    _, first = np.unique(doc, return_index=True)  # the word itself stands before its stems
    return found[first], SEED_WORDS


def training_rows(docs: DataFrame, labels: DataFrame, most: int, most_unlabelled: int) -> tuple[list[str], np.ndarray]:
    """Texts and labels (-1 for none) to fit on."""
    texts, y = labelled_sample(docs, labels, "toxic", remainder(5) != 0, most)
    some = docs.select("doc_id").where(F.col("doc_id").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(4 * most_unlabelled).distinct()
    told = labels.select("doc_id").join(F.broadcast(some), "doc_id").distinct()
    free = some.join(F.broadcast(told), "doc_id", "left_anti").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_unlabelled)
    more = docs.select("doc_id", "text").join(F.broadcast(free), "doc_id").groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")).orderBy(F.xxhash64("doc_id"), "doc_id").select("text").toArrow()
    return texts + more.column("text").to_pylist(), np.concatenate([y, np.full(len(more), -1)])


def toxicity_model(docs: DataFrame, labels: DataFrame, most: int = 4_000, most_unlabelled: int = 2_000) -> Model:
    return train(*training_rows(docs, labels, most, most_unlabelled))


def toxicity_scores(docs: DataFrame, labels: DataFrame, train_docs: DataFrame | None = None, most: int = 4_000) -> DataFrame:
    """(doc_id, score) of docs by a model learned from the labelled rows of train_docs (docs itself by default)."""
    return score_with(docs, toxicity_model(docs if train_docs is None else train_docs, labels, most))
