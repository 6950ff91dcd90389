"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are runs of 3 and 4 letters of the lower-cased text, with marks for word begin and end; each is hashed to one of
``BUCKETS`` rows of an embedding table. A text is the average of its subwords' rows, a linear softmax turns that into a
distribution. Both tables are trained by stochastic gradient descent in numpy on at most ``TRAIN_DOCUMENTS`` labelled
documents: each language gets an equal share, rows are taken by the hash of the id. A fifth of the sample is kept apart: on it the
temperature is fitted, and the smallest score from which accepted texts reach ``PRECISION`` becomes the limit for rejection.

Scoring covers whole texts. As the softmax is linear, the product of both tables is applied (buckets x languages).
A null text, or one without a letter, is ``und`` with score 0, and rejected; without any label every text is. Repeated rows are
judged alike. Only the named columns are read.
"""

from __future__ import annotations

import functools
import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.llm.common import batch_of, chunks, columns_of, remainder, staged, table, utf8

#: Bound on the labelled documents that the model is trained on.
TRAIN_DOCUMENTS = 4_000
BUCKETS = 1 << 16
DIMENSION = 16
EPOCHS = 6
#: A small sample is gone through more often, until so many steps are made.
LEAST_STEPS = 1_000
BATCH = 16
RATE = 4.0
SEED = 7
PRECISION = 0.99
UNKNOWN = "und"

_SPREAD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


@functools.cache
def _letters() -> np.ndarray:
    """Which code points are letters or marks on letters."""
    return np.array([unicodedata.category(chr(i))[0] in "LM" for i in range(0x110000)])


def subwords(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all subwords, the place of each subword's text, and whether each text has a letter."""
    decoded = [(t or b"").decode("utf-8", "replace").lower() for t in texts]
    joined = "\n" + "\n".join(decoded) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in decoded])
    letter = _letters()[np.minimum(points, 0x10FFFF)]
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]
    # One boundary (0) between words; the first row is the boundary before the first text.
    codes = np.where(letter, points, 0)[keep].astype(np.uint64)
    owners = np.concatenate(([0], owner))[:len(points)][keep] if len(texts) else np.zeros(len(codes), dtype=np.int64)
    has = np.zeros(len(texts), dtype=bool)
    has[owners[codes > 0]] = True
    buckets, places = [], []
    for n in (3, 4):
        if len(codes) < n:
            continue
        width = len(codes) - n + 1
        mixed = np.full(width, n, dtype=np.uint64)
        inner = np.ones(width, dtype=bool)
        for j in range(n):
            part = codes[j:j + width]
            mixed = (mixed ^ part) * _SPREAD[j]
            mixed ^= mixed >> np.uint64(29)
            if 0 < j < n - 1:
                inner &= part > 0
        at = np.flatnonzero(inner)
        buckets.append((mixed[at] >> np.uint64(48)).astype(np.int64))
        places.append(owners[at + 1])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has
    return np.concatenate(buckets), np.concatenate(places), has


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray  # buckets x languages: embeddings times the softmax's matrix, over the temperature
    bias: np.ndarray
    limit: float  # scores below are rejected


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def logits(model: Model, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    buckets, places, has = subwords(texts)
    sums = np.stack([np.bincount(places, weights=model.weights[buckets, k], minlength=len(texts))
                     for k in range(len(model.languages))], axis=1)
    counts = np.bincount(places, minlength=len(texts))
    return sums / np.maximum(counts, 1)[:, None] + model.bias, has & (counts > 0)


def predict(model: Model | None, texts: list[bytes | None]) -> tuple[list[str], list[float], list[bool]]:
    """Language, score and whether the score suffices, of each text."""
    if model is None:
        return [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
    x, has = logits(model, texts)
    p = softmax(x)
    best = p.argmax(axis=1)
    score = p[np.arange(len(texts)), best]
    names = [model.languages[k] if h else UNKNOWN for k, h in zip(best, has)]
    return names, [float(s) if h else 0.0 for s, h in zip(score, has)], [bool(h and s >= model.limit) for s, h in zip(score, has)]


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = SEED) -> Model | None:
    """Train on (language, distinct buckets, their shares of the text)."""
    rows = [r for r in rows if len(r[1])]
    languages = sorted({r[0] for r in rows})
    if not rows:
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    apart = {i for k, i in enumerate(order) if k % 5 == 0} if len(rows) >= 50 else set()
    learn = [i for i in order if i not in apart]
    y = np.array([languages.index(r[0]) for r in rows])
    table_ = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (BUCKETS, DIMENSION)).astype(np.float32)
    out = np.zeros((DIMENSION, len(languages)), dtype=np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)
    epochs = max(EPOCHS, math.ceil(LEAST_STEPS / math.ceil(len(learn) / BATCH)))
    steps, step = epochs * math.ceil(len(learn) / BATCH), 0
    for _ in range(epochs):
        rng.shuffle(learn)
        for at in range(0, len(learn), BATCH):
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            some = learn[at:at + BATCH]
            idx = np.concatenate([rows[i][1] for i in some])
            share = np.concatenate([rows[i][2] for i in some]).astype(np.float32)
            sizes = np.array([len(rows[i][1]) for i in some])
            begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            hidden = np.add.reduceat(table_[idx] * share[:, None], begins)
            g = softmax(hidden @ out + bias)
            g[np.arange(len(some)), y[some]] -= 1
            g = (g / len(some)).astype(np.float32)
            back = g @ out.T
            out -= rate * (hidden.T @ g)
            bias -= rate * g.sum(axis=0)
            np.add.at(table_, idx, -rate * share[:, None] * np.repeat(back, sizes, axis=0))
    weights = table_ @ out
    held = sorted(apart) or list(range(len(rows)))
    x = np.stack([(weights[rows[i][1]] * rows[i][2][:, None]).sum(axis=0) + bias for i in held])
    temperature = min(np.geomspace(0.1, 10, 81), key=lambda t: -np.log(
        np.maximum(softmax(x / t)[np.arange(len(held)), y[held]], 1e-12)).sum())
    p = softmax(x / temperature)
    score, right = p.max(axis=1), p.argmax(axis=1) == y[held]
    down = np.argsort(-score, kind="stable")
    enough = np.flatnonzero(np.cumsum(right[down]) >= PRECISION * np.arange(1, len(held) + 1))
    limit = float(score[down][enough[-1]]) if len(enough) else 1.0
    return Model(languages, (weights / temperature).astype(np.float32), bias / temperature, limit)


_FEATURES = pa.schema([("lang", pa.string()), ("buckets", pa.list_(pa.int32())), ("shares", pa.list_(pa.float32()))])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, texts = columns_of(batch, "lang", "text")
        for begin, end in chunks(texts, 1 << 20):
            buckets, places, _ = subwords(texts[begin:end])
            order = np.argsort(places, kind="stable")
            edges = np.searchsorted(places[order], np.arange(1, end - begin))
            rows = []
            for lang, own in zip(langs[begin:end], np.split(buckets[order], edges)):
                found, counts = np.unique(own, return_counts=True)
                rows.append((lang, found, counts / max(1, len(own))))
            yield batch_of(_FEATURES, zip(*rows))


def train(docs: DataFrame, bound: int = TRAIN_DOCUMENTS) -> Model | None:
    """Fit on a sample of ``docs`` (id, text, lang): about ``bound / languages`` rows of each language, never more than ``bound``."""
    known = docs.where(F.col("lang").isNotNull())
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(bound).collect()
    if not counts:
        return None
    share = bound / len(counts)
    rate = F.create_map(*(F.lit(v) for r in counts for v in (r["lang"], min(1.0, share / r["count"]))))[F.col("lang")]
    drawn = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    sample = known.withColumn("drawn", drawn).where(F.col("drawn") < rate).where(F.col("text").isNotNull()) \
        .select("lang", utf8().alias("text"), (F.col("drawn") / rate).alias("drawn"))
    features = sample.mapInArrow(_featured, "lang string, buckets array<int>, shares array<float>")
    rows = staged(features, "subwords").orderBy(F.xxhash64("lang", "buckets")).limit(bound).toArrow()
    return fit([(r["lang"], np.array(r["buckets"], np.int64), np.array(r["shares"], np.float32))
                for batch in rows.to_batches(200) for r in batch.to_pylist()])


_PREDICTED = pa.schema([("id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())])


def identify(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Language, calibrated score and acceptance of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model and model.__dict__)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value and Model(**shared.value)
        for batch in batches:
            ids, texts = batch.column(batch.schema.get_field_index("id")), columns_of(batch, "text")[0]
            for begin, end in chunks([t or b"" for t in texts], 1 << 20):
                yield batch_of(_PREDICTED, [ids.slice(begin, end - begin), *predict(model, texts[begin:end])])

    slim = docs.select(F.col(id_column).cast("long").alias("id"), utf8(text).alias("text"))
    return slim.mapInArrow(predicted, "id long, lang_pred string, score double, accepted boolean") \
        .withColumnRenamed("id", id_column)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = docs.where(~remainder("doc_id", 3).isin(1, -1)).select(F.col("doc_id").alias("id"), "text", "lang")
    return identify(docs, train(learn)).select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "accepted")
