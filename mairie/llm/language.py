"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's vector is the mean of the embeddings of all byte n-grams of its words (with word edges),
hashed into ``BUCKETS`` rows.  The classes are linear in it, so scoring needs only each bucket's
class scores; they are summed once per distinct word of a batch and then over the whole texts.
Training is stochastic gradient descent in numpy on a bounded sample of labelled documents; a fifth
of it, set aside, calibrates the temperature of the scores and the limit below which a prediction
is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mairie.llm.textbytes import buffer_of, mix, slices, word_spans

BUCKETS = 1 << 14
WIDTHS = (2, 3, 4)
SAMPLE = 1_500  # labelled documents that the model is trained and calibrated on
DIM = 16
EPOCHS = 12
ACCEPT = 0.99  # share of correct held-back predictions that the rejection limit lets through
_U64 = np.uint64
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _grams(words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of the words, and where each word's begin (one more entry than words)."""
    data, at = buffer_of(words)
    n = len(at) - 1
    # Each word stands between two spaces.
    padded = np.full(len(data) + 2 * n, 32, np.uint8)
    word = np.repeat(np.arange(n), np.diff(at))
    padded[np.arange(len(data)) + 2 * word + 1] = _LOWER[data]
    begin = at[:-1] + 2 * np.arange(n)
    end = at[1:] + 2 * np.arange(1, n + 1)
    owner = np.repeat(np.arange(n), end - begin)
    buckets, owners = [], []
    for width in WIDTHS:
        count = len(padded) - width + 1
        if count <= 0:
            continue
        h = np.full(count, width, _U64)
        for k in range(width):
            h = h * _U64(0x100000001B3) + padded[k : k + count]
        inside = owner[:count] == owner[width - 1 :]
        buckets.append((mix(h[inside]) % _U64(BUCKETS)).astype(np.int32))
        owners.append(owner[:count][inside])
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
    owners, buckets = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(owners, kind="stable")
    return buckets[order], np.searchsorted(owners[order], np.arange(n + 1))


def _words(texts: pa.Array) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
    """Distinct words, the word of each occurrence, and where each row's occurrences begin."""
    data, rows = buffer_of(texts)
    begin, end = word_spans(data, rows)
    sizes = end - begin
    packed = data[np.arange(sizes.sum()) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    found = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(packed.tobytes()))
    found = found.dictionary_encode()
    return found.dictionary, found.indices.to_numpy(), np.searchsorted(begin, rows)


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` over [at[i], at[i+1])."""
    out = np.zeros((len(at) - 1, values.shape[1]), np.float64)
    full = np.flatnonzero(np.diff(at) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, at[:-1][full], axis=0)
    return out


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # class scores of each bucket
    bias: np.ndarray
    temperature: float = 1.0
    limit: float = 0.0

    def probabilities(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        z = (sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def score(self, texts: pa.Array) -> np.ndarray:
        words, which, at = _words(texts)
        if not len(words):
            return self.probabilities(np.zeros((len(texts), len(self.bias))), np.zeros(len(texts)))
        buckets, begins = _grams(words)
        per_word = np.concatenate([_sums(self.table[buckets], begins), np.diff(begins)[:, None]], axis=1).astype(np.float32)
        out = np.empty((len(texts), per_word.shape[1]))
        for row in range(0, len(texts), 256):  # occurrences of a few rows at a time
            upto = min(row + 256, len(texts))
            local = at[row : upto + 1]
            out[row:upto] = _sums(per_word[which[local[0] : local[-1]]].astype(np.float64), local - local[0])
        return self.probabilities(out[:, :-1], out[:, -1])


def train(samples: list[tuple[np.ndarray, np.ndarray, str]], seed: int = 5) -> Model | None:
    """Model from (buckets, counts, language) of each sample; None without samples."""
    if not samples:
        return None
    languages = sorted({s[2] for s in samples})
    label = np.array([languages.index(s[2]) for s in samples])
    held = np.arange(len(samples)) % 5 == 4
    if held.sum() < 10:
        held[:] = False
    rng = np.random.default_rng(seed)
    table = rng.normal(scale=0.1, size=(BUCKETS, DIM))
    weights, bias = np.zeros((DIM, len(languages))), np.zeros(len(languages))
    shares = [s[1] / s[1].sum() for s in samples]
    fit = np.flatnonzero(~held)
    for epoch in range(EPOCHS):
        rate = 1.0 * (1 - epoch / EPOCHS)
        for k in rng.permutation(fit):
            buckets, share = samples[k][0], shares[k]
            x = share @ table[buckets]
            z = x @ weights + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label[k]] -= 1
            back = weights @ p
            weights -= rate * np.outer(x, p)
            bias -= 0.1 * rate * p
            # A bucket's own share is tiny; steps are taken relative to the largest one.
            table[buckets] -= rate * (share / share.max())[:, None] * back[None, :] * 0.1
    model = Model(languages, (table @ weights).astype(np.float32), bias)
    check = np.flatnonzero(held) if held.any() else fit
    z = np.array([shares[k] @ model.table[samples[k][0]] + bias for k in check])
    target = label[check]

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), target]).mean())

    model.temperature = min(np.geomspace(0.05, 5, 40), key=loss)
    p = np.exp(z / model.temperature - (z / model.temperature).max(axis=1, keepdims=True))
    best = (p / p.sum(axis=1, keepdims=True)).max(axis=1)
    right = z.argmax(axis=1) == target
    model.limit = float(np.quantile(best[right], 1 - ACCEPT)) if right.any() else 1.0
    return model


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 1 << 20):
        for k in range(batch.num_rows):
            words, which, _ = _words(batch.column("text").slice(k, 1))
            buckets, begins = _grams(words)
            times = np.repeat(np.bincount(which, minlength=len(words)), np.diff(begins))
            total = np.bincount(buckets, weights=times, minlength=BUCKETS)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").slice(k, 1), pa.array([used.tolist()], pa.list_(pa.int32())), pa.array([total[used].tolist()], pa.list_(pa.float64()))],
                names=["lang", "buckets", "counts"],
            )


def fit(docs: DataFrame, learn: Column, sample: int = SAMPLE) -> Model | None:
    """Model from at most ``sample`` documents that satisfy ``learn``, in a hashed order of doc_id."""
    usable = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = usable.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # The ids are bounded by ``sample``.
    chosen = usable.join(F.broadcast(ids.distinct()), "doc_id", "left_semi")
    rows = chosen.select("lang", "text").mapInArrow(_features, "lang string, buckets array<int>, counts array<double>")
    found = rows.toArrow().to_pylist()
    samples = [(np.array(r["buckets"]), np.array(r["counts"]), r["lang"]) for r in found if r["buckets"]]
    samples.sort(key=lambda s: (s[2], s[0].tobytes(), s[1].tobytes()))
    order = np.random.default_rng(3).permutation(len(samples))
    return train([samples[k] for k in order])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) of each row, from its whole text.

    ``und`` with score 0 where the text is null or has no letter, and everywhere without a model.
    ``accepted`` is false for these and for scores below the calibrated limit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 4 << 20):
            texts = batch.column("_text")
            data, rows = buffer_of(texts)
            plain = np.concatenate([[0], np.cumsum(_LETTER[data])])[rows]
            known = np.diff(plain) > 0
            for k in np.flatnonzero(~known):
                known[k] = any(c.isalpha() for c in texts[int(k)].as_py() or "")
            best, score = ["und"] * len(texts), np.zeros(len(texts))
            if model is not None:
                p = model.score(texts)
                pick = p.argmax(axis=1)
                best = [model.languages[i] if ok else "und" for i, ok in zip(pick, known, strict=True)]
                score = np.where(known, p[np.arange(len(p)), pick], 0.0)
            accepted = known & (score >= (model.limit if model else np.inf))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(best, pa.string()), pa.array(score), pa.array(accepted)],
                names=["doc_id", "lang_pred", "score", "accepted"],
            )

    rows = docs.select("doc_id", F.col("text").alias("_text"))
    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double, accepted boolean")
