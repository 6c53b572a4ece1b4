"""Language ID of the words of code-switched text by a linear-chain conditional random field.

A word's features are its affixes (first and last 1 to 4 bytes), byte trigrams and itself, hashed into a table with a
weight per language, and its languages in a lexicon (the frequent words of each language in the sample). A chain is up
to ``CHAIN`` consecutive words of a text; transitions between languages are learned together with the weights, from
chains put together of pieces in different languages. Forward-backward gives every word's probabilities; all words of
a text count, and the text's language is the one with the most.

The model is fitted in numpy on the whole texts of at most ``SAMPLE`` labelled documents (by hash, spread over the
languages, ``EACH`` of one at most), read ``FIT_BYTES`` at a time; of a text only its words' numbers are kept. The
languages are those in the sample.

Null text and text without a letter is ``und`` with score 0; without any labelled document everything is ``und``;
repeated rows are predicted each; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookflow.llm.common import small_batches, text_slices, utf8
from bookflow.llm.words import Words

SAMPLE = 2000
EACH = 800
FIT_BYTES = 1 << 20
CHAIN = 64
BUCKETS = 1 << 17
LEXICON = 500
UNKNOWN = "und"
_STEPS, _BATCH, _RATE = 250, 48, 0.5


def held_out(doc_id: str = "doc_id"):
    """Documents that nothing is learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of the distinct words end to end, and where each word's begin."""
    fixed = np.concatenate((words.hash[:, None], words.affixes((1, 2, 3, 4), 0), words.affixes((1, 2, 3, 4), 1, suffix=True)), axis=1)
    grams, begin = words.ngrams()
    number = np.append(begin[1:], len(grams)) - begin
    first = np.cumsum(number + fixed.shape[1]) - (number + fixed.shape[1])
    out = np.empty(len(grams) + fixed.size, np.uint64)
    at = first[:, None] + np.arange(fixed.shape[1])
    out[at] = fixed
    rest = np.ones(len(out), bool)
    rest[at] = False
    out[rest] = grams
    return (out % np.uint64(BUCKETS)).astype(np.int64), first


class Model:
    def __init__(self, languages: list[str], lexicon: dict[int, np.ndarray]):
        n = len(languages)
        self.languages = languages
        self.weights = np.zeros((BUCKETS, n), np.float32)
        self.transition = np.zeros((n, n))
        self.lexicon_weight = np.zeros((n, n), np.float32)  # in the lexicon of one language, for another
        self.lexicon = np.array(sorted(lexicon), np.uint64)
        self.member = np.array([lexicon[h] for h in sorted(lexicon)], np.float32).reshape(len(lexicon), n)

    def members(self, words: Words) -> np.ndarray:
        out = np.zeros((len(words.hash), len(self.languages)), np.float32)
        if len(self.lexicon):
            at = np.minimum(np.searchsorted(self.lexicon, words.hash), len(self.lexicon) - 1)
            known = self.lexicon[at] == words.hash
            out[known] = self.member[at[known]]
        return out

    def emissions(self, words: Words) -> np.ndarray:
        """The score of each language for the distinct words."""
        if not len(words.hash):
            return np.zeros((0, len(self.languages)), np.float32)
        bucket, first = features(words)
        total = np.stack([np.add.reduceat(self.weights[:, j][bucket], first) for j in range(len(self.languages))], axis=1)
        return total + self.members(words) @ self.lexicon_weight


def forward_backward(emission: np.ndarray, length: np.ndarray, transition: np.ndarray):
    """Marginals of chains (chain, place, label) and, over chains, the expected transitions."""
    chains, places, n = emission.shape
    e = np.exp(emission - emission.max(axis=2, keepdims=True))
    a = np.exp(transition)
    live = np.arange(places)[None, :] < length[:, None]
    e[~live] = 1
    forward, backward = np.empty_like(e), np.empty_like(e)
    forward[:, 0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, places):
        f = (forward[:, t - 1] @ a) * e[:, t]
        forward[:, t] = f / f.sum(axis=1, keepdims=True)
    backward[:, -1] = 1 / n
    for t in range(places - 2, -1, -1):
        b = (e[:, t + 1] * backward[:, t + 1]) @ a.T
        b = np.where(live[:, t + 1][:, None], b, 1.0)  # nothing comes after a chain's end
        backward[:, t] = b / b.sum(axis=1, keepdims=True)
    p = forward * backward
    p /= p.sum(axis=2, keepdims=True)
    p *= live[:, :, None]
    pair = np.zeros((n, n))
    for t in range(places - 1):
        on = live[:, t + 1]
        x = forward[on, t][:, :, None] * a * (e[on, t + 1] * backward[on, t + 1])[:, None, :]
        pair += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return p, pair


class Sample:
    """The words of the fitting texts: each distinct word's hash and features, and every text's words by number."""

    def __init__(self, texts: list[str]):
        self.number: dict[int, int] = {}
        parts, sizes, words, counts = [], [], [], []
        for lo, hi in _batches(texts):
            w = Words(*utf8(pa.array(texts[lo:hi], pa.string())))
            counts.append(w.count)
            if not len(w.hash):
                continue
            bucket, first = features(w)
            size = np.diff(np.append(first, len(bucket)))
            known = len(self.number)
            at = np.array([self.number.setdefault(h, len(self.number)) for h in w.hash.tolist()], np.int32)
            new = np.flatnonzero(at >= known)
            parts.append(bucket[np.repeat(first[new] - (np.cumsum(size[new]) - size[new]), size[new]) + np.arange(size[new].sum())])
            sizes.append(size[new])
            words.append(at[w.inverse])
        none = np.zeros(0, np.int64)
        self.hash = np.array(list(self.number), np.uint64)
        self.bucket, self.size = np.concatenate([none, *parts]), np.concatenate([none, *sizes])
        self.word, self.count = np.concatenate([none.astype(np.int32), *words]), np.concatenate([none, *counts])


def _batches(texts: list[str]):
    """Ranges of texts of about ``FIT_BYTES`` characters."""
    lo = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= FIT_BYTES or i == len(texts) - 1:
            yield lo, i + 1
            lo, total = i + 1, 0


def fit(texts: list[str], languages: list[str]) -> Model:
    """The field for texts with a language each."""
    names = sorted(set(languages))
    label = np.array([names.index(x) for x in languages], np.int64)
    words = Sample(texts)
    lexicon: dict[int, np.ndarray] = {}
    of_word = np.repeat(label, words.count)
    for j in range(len(names)):
        seen = np.bincount(words.word[of_word == j], minlength=len(words.hash))
        for i in np.lexsort((words.hash, -seen))[:LEXICON].tolist():
            if seen[i] > 1:
                lexicon.setdefault(int(words.hash[i]), np.zeros(len(names), np.float32))[j] = 1
    model = Model(names, lexicon)
    has = np.flatnonzero(words.count)
    if len(names) < 2 or not len(has):
        return model
    bucket, size = words.bucket, words.size
    first = np.cumsum(size) - size
    member = model.members(words)
    begin = np.cumsum(words.count) - words.count
    by_language = [has[label[has] == j] for j in range(len(names))]
    by_language = [(j, x) for j, x in enumerate(by_language) if len(x)]
    rng = np.random.default_rng(7)
    power, power_t, power_l = np.full(model.weights.shape, 1e-3, np.float32), np.full(model.transition.shape, 1e-3), np.full(model.lexicon_weight.shape, 1e-3)
    for _ in range(_STEPS):
        word = np.full((_BATCH, CHAIN), -1)
        gold = np.zeros((_BATCH, CHAIN), np.int64)
        for c in range(_BATCH):  # a chain of pieces of texts, each in a language drawn anew
            at = 0
            while at < CHAIN:
                j, docs = by_language[rng.integers(len(by_language))]
                doc = docs[rng.integers(len(docs))]
                n = min(int(rng.integers(4, CHAIN)), CHAIN - at, int(words.count[doc]))
                s = begin[doc] + rng.integers(words.count[doc] - n + 1)
                word[c, at:at + n] = words.word[s:s + n]
                gold[c, at:at + n] = j
                at += n
        distinct, inverse = np.unique(word, return_inverse=True)
        inverse = inverse.reshape(word.shape)
        number = size[distinct]
        flat = bucket[np.repeat(first[distinct] - (np.cumsum(number) - number), number) + np.arange(number.sum())]
        start = np.cumsum(number) - number
        score = np.add.reduceat(model.weights[flat], start, axis=0) + member[distinct] @ model.lexicon_weight
        p, pair = forward_backward(score[inverse].astype(np.float64), np.full(_BATCH, CHAIN), model.transition)
        wrong = p
        np.put_along_axis(wrong, gold[:, :, None], np.take_along_axis(wrong, gold[:, :, None], axis=2) - 1, axis=2)
        grad = np.zeros((len(distinct), len(names)))
        np.add.at(grad, inverse.ravel(), wrong.reshape(-1, len(names)))
        rows, back = np.unique(flat, return_inverse=True)
        owner = np.repeat(np.arange(len(distinct)), number)
        g = np.stack([np.bincount(back, weights=grad[owner, j], minlength=len(rows)) for j in range(len(names))], axis=1) / _BATCH
        power[rows] += g * g
        model.weights[rows] -= _RATE * g / np.sqrt(power[rows])
        gl = member[distinct].T @ grad / _BATCH
        power_l += gl * gl
        model.lexicon_weight -= (_RATE * gl / np.sqrt(power_l)).astype(np.float32)
        true = np.zeros_like(pair)
        np.add.at(true, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
        gt = (pair - true) / _BATCH
        power_t += gt * gt
        model.transition -= 0.1 * gt / np.sqrt(power_t)
    model.weights *= 0.25  # long words have many features: temper the certainty of single words
    model.lexicon_weight *= 0.25
    return model


def label_words(model: Model, words: Words) -> np.ndarray:
    """The probability of each language for every word, by chains of at most ``CHAIN`` words of one text."""
    n = len(words.inverse)
    if not n:
        return np.zeros((0, len(model.languages)))
    score = model.emissions(words)
    index = np.arange(n) - np.repeat(np.cumsum(words.count) - words.count, words.count)
    begin = np.flatnonzero(index % CHAIN == 0)
    length = np.diff(np.append(begin, n))
    out = np.empty((n, len(model.languages)))
    for lo in range(0, len(begin), 4096):
        b, size = begin[lo:lo + 4096], length[lo:lo + 4096]
        place = b[:, None] + np.arange(CHAIN)
        live = np.arange(CHAIN)[None, :] < size[:, None]
        p = _marginals(score[words.inverse[np.minimum(place, n - 1)]], live, model.transition)
        out[place[live]] = p[live]
    return out


def _marginals(emission, live, transition):
    """forward_backward without the transitions' counts, place by place."""
    e = np.exp(emission - emission.max(axis=2, keepdims=True)).transpose(1, 0, 2).astype(np.float32)
    e[~live.T] = 1
    a = np.exp(transition).astype(np.float32)
    forward = np.empty_like(e)
    f = e[0] / e[0].sum(axis=1, keepdims=True)
    forward[0] = f
    for t in range(1, len(e)):
        f = (f @ a) * e[t]
        f /= f.sum(axis=1, keepdims=True)
        forward[t] = f
    b = np.ones_like(e[0])
    for t in range(len(e) - 2, -1, -1):
        b = np.where(live[:, t + 1][:, None], (e[t + 1] * b) @ a.T, 1)
        b /= b.sum(axis=1, keepdims=True)
        forward[t] *= b
    forward /= forward.sum(axis=2, keepdims=True)
    return forward.transpose(1, 0, 2)


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """The field for the documents that aren't held out; the driver gets the sample alone."""
    known = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # ids alone are ranked, so no text is dealt out; rank by rank until the sample is full: a rare language is in it first
    ids = known.select("lang", "doc_id").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    for keys in (["lang", "part"], ["lang"]):  # the first of each part of a language, then of those
        ids = ids.withColumn("n", F.row_number().over(W.partitionBy(*keys).orderBy(F.xxhash64("doc_id"), "doc_id"))).filter(F.col("n") <= EACH)
    ids = ids.orderBy("n", "lang").limit(sample).select("lang", "doc_id", "n")
    rows = (known.select("lang", "doc_id", "text").join(F.broadcast(ids.distinct()), ["lang", "doc_id"])
            .orderBy("n", "lang", "text").limit(sample).select("lang", "text").collect())
    return fit([r.text for r in rows], [r.lang for r in rows])


def _predicted(shared):
    def rows(batches):
        model = shared.value
        n = len(model.languages)
        for batch, data, off in text_slices(batches):
            words = Words(data, off)
            best = [UNKNOWN] * batch.num_rows
            score = np.zeros(batch.num_rows)
            if n:
                p = label_words(model, words)
                total = np.stack([np.bincount(words.row, weights=p[:, j], minlength=batch.num_rows) for j in range(n)], axis=1)
                top = total.argmax(axis=1)
                texts = batch.column(batch.schema.get_field_index("text"))
                for i in np.flatnonzero(words.count).tolist():
                    raw = data[off[i]:off[i + 1]]
                    if ((raw | 32) - 97 < 26).any() or any(c.isalpha() for c in texts[i].as_py()):
                        best[i] = model.languages[top[i]]
                        score[i] = min(1.0, total[i, top[i]] / words.count[i])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.string()), pa.array(score, pa.float64())], names=["row", "text", "lang_pred", "score"])
    return rows


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (text, any others) with lang_pred and score (the share of the words, by probability, in it)."""
    own = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    held = small_batches(docs).select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in own if c != "text")).alias("row"), "text")
    kind = held.schema["row"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: buckets x languages
    return held.mapInArrow(_predicted(shared), f"row {kind}, text string, lang_pred string, score double").select(
        *((F.col("text") if c == "text" else F.col("row")[c]).alias(c) for c in own), "lang_pred", "score")


def word_languages(text: str, model: Model) -> list[tuple[str, str]]:
    """Each word of one text with its language."""
    data, off = utf8(pa.array([text or ""], pa.string()))
    words = Words(data, off)
    p = label_words(model, words)
    return [(data[a:b].tobytes().decode(), model.languages[j]) for a, b, j in zip(words.start, words.end, p.argmax(axis=1))]
