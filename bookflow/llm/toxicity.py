"""Toxicity by a convolutional text classifier in numpy, with thresholds calibrated by language.

A word's embedding is the sum of the hashed embeddings of the word, its first 4 to 8 and its last 4 bytes, so unseen
forms of a known stem have one. Filters of widths 1, 2 and 3 run over all words of a text, their largest outputs over
the whole text (max pooling, then ReLU) go through one dense layer. What the filters give for a distinct word is
worked out once a slice; a text's outputs are sums of these over neighbouring words.

The net is fitted on the whole texts of a bounded sample of labelled documents that aren't held out: at most ``SAMPLE``
of each label, by hash, in batches of bounded size. A fifth of the sample sets
a threshold for each language: scores are moved so that it becomes ``CUT``. The language is guessed from the text by
the frequent words of the sample's languages; the column lang is no input of a score.

Texts without a word score as the net scores nothing found; null text is empty; without labels of both kinds all score
0; repeated rows are scored each; labels for one document count once, toxic if any says so; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookflow.llm.common import small_batches, text_slices, utf8
from bookflow.llm.language_id import held_out
from bookflow.llm.words import Words

SAMPLE = 2500
CUT = 0.3
BUCKETS = 1 << 16
SIZE = 12
FILTERS = 12
WIDTHS = (1, 2, 3)
EPOCHS = 12
_PREFIXES = (4, 5, 6, 7, 8)
_FREQUENT = 300


def features(words: Words) -> np.ndarray:
    """The distinct words' rows of the embedding table."""
    all_of = np.concatenate((words.hash[:, None], words.affixes(_PREFIXES, 2), words.affixes((4,), 3, suffix=True)), axis=1)
    return (all_of % np.uint64(BUCKETS)).astype(np.int64)


class Model:
    def __init__(self, languages: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.002, (BUCKETS, SIZE)).astype(np.float32)  # next to nothing: unseen features say nothing
        self.filters = [rng.normal(0, 0.3, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.dense = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.offset = np.float32(-1)
        self.languages = languages
        self.votes: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.uint64), np.zeros((0, len(languages)), np.float32))
        self.shift = np.zeros(max(1, len(languages)))
        self.trained = False

    def pooled(self, words: Words, embedded: np.ndarray, where: bool = False):
        """The largest output of each filter for each text with words, and (if asked for) the word it begins at."""
        n = len(words.inverse)
        has = np.flatnonzero(words.count)
        begin = (np.cumsum(words.count) - words.count)[has]
        out, place = [], []
        left = np.repeat(begin + words.count[has], words.count[has]) - np.arange(n)  # words up to the text's end
        for width, f in zip(WIDTHS, self.filters):
            total = (embedded @ f[0])[words.inverse]
            for k in range(1, width):
                part = (embedded @ f[k])[words.inverse[k:]]
                inside = left[:n - k] > k
                total[:n - k] += part * inside[:, None]
            top = np.maximum.reduceat(total, begin, axis=0)
            out.append(top)
            if where:
                at = np.where(total == np.repeat(top, words.count[has], axis=0), np.arange(n)[:, None], n)
                place.append(np.minimum.reduceat(at, begin, axis=0))
        return has, np.concatenate(out, axis=1), place

    def logits(self, words: Words) -> np.ndarray:
        out = np.zeros((len(words.count), len(self.bias)), np.float32)
        if len(words.inverse):
            embedded = self.table[features(words)].sum(axis=1)
            has, top, _ = self.pooled(words, embedded)
            out[has] = np.maximum(top + self.bias, 0)
        return out @ self.dense + self.offset

    def language(self, words: Words) -> np.ndarray:
        """The number of each text's language, by its frequent words."""
        total = np.zeros((len(words.count), max(1, len(self.languages))))
        known, vote = self.votes
        if len(known) and len(words.hash):
            at = np.minimum(np.searchsorted(known, words.hash), len(known) - 1)
            own = np.where((known[at] == words.hash)[:, None], vote[at], 0)
            for j in range(vote.shape[1]):
                total[:, j] = np.bincount(words.row, weights=own[words.inverse, j], minlength=len(total))
        return total.argmax(axis=1)

    def score(self, words: Words) -> np.ndarray:
        if not self.trained:
            return np.zeros(len(words.count))
        z = self.logits(words).astype(np.float64) + self.shift[self.language(words)]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _words(texts) -> Words:
    return Words(*utf8(pa.array(texts, pa.string())))


class _Adam:
    def __init__(self, value, rate):
        self.value, self.rate = value, rate
        self.m, self.v, self.t = np.zeros_like(value), np.zeros_like(value), 0

    def step(self, g):
        self.t += 1
        self.m += 0.1 * (g - self.m)
        self.v += 0.001 * (g * g - self.v)
        self.value -= (self.rate * self.m / (1 - 0.9 ** self.t) / (np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-8)).astype(self.value.dtype)


def _train(model: Model, texts: list[str], label: np.ndarray, epochs: int) -> None:
    rng = np.random.default_rng(5)
    rest = [_Adam(x, 0.01) for x in (*model.filters, model.bias, model.dense)]
    power = np.full(BUCKETS, 1e-2, np.float32)
    offset, size = np.array([model.offset], np.float32), np.array([len(t) for t in texts])
    offset_step = _Adam(offset, 0.01)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        batches, now, total = [], [], 0
        for i in order.tolist():
            now.append(i)
            total += size[i]
            if len(now) == 32 or total > 400_000:
                batches.append(now)
                now, total = [], 0
        for batch in [*batches, *([now] if now else [])]:
            words = _words([texts[i] for i in batch])
            if not len(words.inverse):
                continue
            rows = features(words)
            embedded = model.table[rows].sum(axis=1)
            has, top, place = model.pooled(words, embedded, where=True)
            hidden = np.maximum(top + model.bias, 0)
            z = hidden @ model.dense + offset[0]
            d = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[np.array(batch)[has]]) / len(batch)).astype(np.float32)
            back = d[:, None] * model.dense * (hidden > 0)
            grads, ge = [], np.zeros_like(embedded)
            end = np.cumsum(words.count)[has]
            for w, (width, f, at) in enumerate(zip(WIDTHS, model.filters, place)):
                part = back[:, w * FILTERS:(w + 1) * FILTERS]
                g = np.zeros_like(f)
                for k in range(width):
                    r, c = np.nonzero((part != 0) & (at + k < end[:, None]))
                    u, v = words.inverse[at[r, c] + k], part[r, c]
                    np.add.at(g[k].T, c, v[:, None] * embedded[u])
                    np.add.at(ge, u, v[:, None] * f[k].T[c])
                grads.append(g)
            touched = np.flatnonzero(np.any(ge != 0, axis=1))
            if len(touched):  # no filter of the batch may be open
                flat, index = np.unique(rows[touched], return_inverse=True)
                gt = np.zeros((len(flat), SIZE), np.float32)
                np.add.at(gt, index.reshape(len(touched), -1), ge[touched][:, None, :])
                power[flat] += (gt * gt).mean(axis=1) * len(batch)
                model.table[flat] -= 0.1 * gt / np.sqrt(power[flat])[:, None]
            for step, g in zip(rest, (*grads, back.sum(axis=0), d @ hidden)):
                step.step(g)
            offset_step.step(np.array([d.sum()], np.float32))
    model.offset = offset[0]
    model.trained = True


def _threshold(z: np.ndarray, label: np.ndarray) -> float:
    """The logit that separates the labels with the best F1, in the middle of its gap."""
    order = np.argsort(-z, kind="stable")
    z, label = z[order], label[order]
    hit = np.cumsum(label)
    f1 = 2 * hit / (np.arange(1, len(z) + 1) + label.sum())
    best = int(f1.argmax())
    return (z[best] + z[best + 1]) / 2 if best + 1 < len(z) else z[best] - 0.5


def fit(texts: list[str], labels: list[int], languages: list[str | None], epochs: int = EPOCHS) -> Model:
    names = sorted({x for x in languages if x is not None})
    model = Model(names)
    label = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        return model
    known: dict[int, np.ndarray] = {}
    for j, name in enumerate(names):
        seen: dict[int, int] = {}
        own = [t for t, x in zip(texts, languages) if x == name]
        for i in range(0, len(own), 64):
            words = _words(own[i:i + 64])
            for h, n in zip(words.hash.tolist(), np.bincount(words.inverse, minlength=len(words.hash)).tolist()):
                seen[h] = seen.get(h, 0) + n
        total = sum(seen.values())
        for h in sorted(seen, key=lambda h: (-seen[h], h))[:_FREQUENT]:
            known.setdefault(h, np.zeros(len(names), np.float32))[j] = seen[h] / total
    if known:
        votes = np.array([known[h] for h in sorted(known)], np.float32)
        model.votes = np.array(sorted(known), np.uint64), votes / votes.sum(axis=1, keepdims=True)
    check = np.arange(len(texts)) % 5 == 4
    trial = Model(names)
    trial.votes = model.votes
    _train(trial, [t for t, c in zip(texts, check) if not c], label[~check], epochs)
    rest = [t for t, c in zip(texts, check) if c]
    seen = [(trial.logits(w).astype(np.float64), trial.language(w)) for w in (_words(rest[i:i + 64]) for i in range(0, len(rest), 64))]
    z, language = (np.concatenate(x) for x in zip(*seen))
    common = _threshold(z, label[check])
    for j in range(len(model.shift)):
        own = language == j
        enough = min(label[check][own].sum(), (1 - label[check][own]).sum()) >= 10
        model.shift[j] = np.log(CUT / (1 - CUT)) - (_threshold(z[own], label[check][own]) if enough else common)
    _train(model, texts, label, epochs)
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> Model:
    """The net for the labelled documents that aren't held out; the driver gets the sample alone."""
    toxic = (labels.filter("toxic is not null").filter(~held_out())
             .groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("y")))
    some = toxic.filter("y = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).union(
        toxic.filter("y = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (docs.filter("text is not null").select("doc_id", "text", "lang").join(F.broadcast(some), "doc_id")
            .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * sample).select("text", "y", "lang").collect())
    return fit([r.text for r in rows], [r.y for r in rows], [r.lang for r in rows], epochs)


def _scored(shared):
    def rows(batches):
        for batch, data, off in text_slices(batches):
            score = shared.value.score(Words(data, off))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], names=["row", "text", "score"])
    return rows


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (text, any others) with score and predicted (1 from ``CUT`` on)."""
    own = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    held = small_batches(docs).select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in own if c != "text")).alias("row"), "text")
    kind = held.schema["row"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: the table's size
    out = held.mapInArrow(_scored(shared), f"row {kind}, text string, score double").select(
        *((F.col("text") if c == "text" else F.col("row")[c]).alias(c) for c in own), "score")
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
