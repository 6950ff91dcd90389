"""Toxicity: maximum-scoring segments of token log-odds, with extreme-value significance.

1. Of toxic and other training documents the numbers that hold a token give log-odds with an informative Dirichlet prior (each
   token's prior weight is its share of all counts); tokens whose z-score stands out among all tokens of the vocabulary are
   evidence, every other token costs a little, so that a passage ends after about ``GAP`` neutral tokens. Near copies within the
   training documents (same smallest window hash, same label) count once, as their least text. Words and word beginnings (4 to 7 letters) are both
   counted; a token scores by itself if it is evidence, else by its longest beginning that is.
2. A linear scan of a text finds all maximal-scoring segments. With the background distribution the highest score of a text of n
   tokens follows an extreme-value law, P(S >= s) = 1 - exp(-K n exp(-lambda s)); lambda solves sum p exp(lambda s) = 1.
   Segments with ``P <= SIGNIFICANT`` are the toxic passages.
3. A document's evidence is the sum of its passages' bits above the expected maximum; a logistic curve fitted on the training
   documents turns it into a probability.

The classifier is fitted on at most ``TRAIN_LABELS`` labelled documents (those with the smallest id hashes), whose ids and labels are
broadcast; everything else, scores included, covers whole texts. A document with several labels is toxic if one says so. Null
and empty texts have no tokens and get the score of a text without evidence; repeated rows are scored alike; without usable
labels every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewick.llm.common import batch_of, columns_of, remainder, staged, table, utf8

#: Bound on the labelled rows that the classifier is fitted on.
TRAIN_LABELS = 20_000
#: Bound on the tokens with evidence that the model keeps, by z-score.
MAX_TERMS = 20_000
#: Weight of the prior, as a share of the toxic documents' counts.
PRIOR = 0.5
GAP = 20
SIGNIFICANT = 0.01
#: Tokens in fewer distinct training texts are no evidence.
MIN_TEXTS = 3
#: Most files of a staged table of the training texts, whose number is bounded. Without native libraries Hadoop starts a ``chmod`` for
#: each file, which counts as all memory of the executor a second time until its program is loaded.
FILES = 12

_TOKEN = re.compile(r"[^\W_]+")


#: Lengths of word beginnings, longest first.
BEGINNINGS = (7, 6, 5, 4)
#: Most scores of tokens that a task remembers before it starts anew.
REMEMBERED = 500_000


def features(word: str) -> list[str]:
    """The word, then its proper beginnings, marked by a dash, longest first."""
    return [word, *(word[:n] + "-" for n in BEGINNINGS if n < len(word))]


class Scores(dict):
    """Score of each token met so far (None: no evidence), from the scores of features."""

    def __init__(self, evidence: dict[str, float]) -> None:
        super().__init__()
        self.evidence = evidence

    def __missing__(self, word: str) -> float | None:
        if len(self) >= REMEMBERED:
            self.clear()
        score = next((self.evidence[f] for f in features(word) if f in self.evidence), None)
        self[word] = score
        return score


def tokens(text: bytes | None) -> list[str]:
    return _TOKEN.findall(text.decode("utf-8", "replace").lower()) if text else []


@dataclass(frozen=True)
class Model:
    """Scores of tokens with evidence, cost of any other, Karlin-Altschul parameters, logistic curve."""

    scores: dict[str, float]
    cost: float
    lam: float
    k: float
    slope: float
    intercept: float


def segments(hits: list[tuple[int, float]], cost: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (begin, end, score), end exclusive, by the linear scan of Ruzzo and Tompa.

    ``hits``: places and scores of the positive tokens; every token between costs ``cost``.
    """
    found: list[tuple[float, float, int, int]] = []  # cumulative score before and after, begin, end
    total, last = 0.0, 0
    for place, score in hits:
        total -= cost * (place - last)
        left, total = total, total + score
        last, begin, right = place + 1, place, total
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][0] >= left:
                k -= 1
            if k < 0 or found[k][1] >= right:
                found.append((left, right, begin, place + 1))
                break
            left, begin = found[k][0], found[k][2]
            del found[k:]
    return [(begin, end, right - left) for left, right, begin, end in found]


def p_value(model: Model, score: float, n: int) -> float:
    return -math.expm1(-model.k * n * math.exp(-model.lam * score))


def passages(model: Model, scores: Scores, text: bytes | None,
             significant: float = SIGNIFICANT) -> tuple[list[tuple[int, int, float]], float]:
    """The significant segments (begin, end, p) in tokens, and the document's evidence."""
    words = tokens(text)
    hits = [(i, s) for i, s in enumerate(map(scores.__getitem__, words)) if s is not None]
    n, out, evidence = len(words), [], 0.0
    for begin, end, score in segments(hits, model.cost):
        p = p_value(model, score, n)
        if p <= significant:
            out.append((begin, end, p))
            evidence += max(0.0, model.lam * score - math.log(model.k * n))
    return out, evidence


def _probability(model: Model, evidence: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, model.slope * math.log1p(evidence) + model.intercept))))


_COUNTS = pa.schema([("token", pa.string()), ("toxic", pa.int64()), ("other", pa.int64())])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, labels = columns_of(batch, "text", "toxic")
        for at in range(0, len(texts), 1000):
            found = (Counter(), Counter())
            for text, label in zip(texts[at:at + 1000], labels[at:at + 1000]):
                found[0 if label else 1].update({f for word in set(tokens(text)) for f in features(word)})
            names = list(found[0].keys() | found[1].keys())
            yield batch_of(_COUNTS, [names, *([c[n] for n in names] for c in found)])


_KEYED = pa.schema([("key", pa.int64()), ("text", pa.string()), ("toxic", pa.int32())])


def _copy_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A key that near copies mostly share: the smallest hash of eight words in a row."""
    for batch in batches:
        texts, labels = columns_of(batch, "text", "toxic")
        keys = []
        for text in texts:
            words = tokens((text or "").encode())
            keys.append(min((xxhash.xxh3_64_intdigest(" ".join(words[i:i + 8])) for i in range(max(1, len(words) - 7)))) - (1 << 63))
        yield batch_of(_KEYED, [keys, texts, [int(bool(v)) for v in labels]])


def _lambda(p: np.ndarray, s: np.ndarray, rest: float, cost: float) -> float:
    """The positive root of sum p exp(lambda s) = 1, by bisection."""
    low, high = 1e-6, 1.0
    value = lambda lam: float(p @ np.exp(lam * s)) + rest * math.exp(-lam * cost) - 1
    while value(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return low


def labelled(docs: DataFrame, labels: DataFrame, fold: Column, bound: int = TRAIN_LABELS) -> DataFrame:
    """Training texts with their label, near copies once: key, toxic, text. ``labels``: id, toxic; ``fold``: rows to learn from."""
    known = labels.where(F.col("id").isNotNull() & F.col("toxic").isNotNull()).where(fold) \
        .groupBy("id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(bound)
    joined = docs.join(F.broadcast(staged(known, "labels")), "id").select("text", F.col("toxic").cast("int"))
    return joined.mapInArrow(_copy_keys, "key long, text string, toxic int").groupBy("key", "toxic").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, fold: Column, bound: int = TRAIN_LABELS) -> Model:
    """Fit the model. ``docs``: id, text; ``labels``: id, toxic (0 or 1); ``fold``: condition on id to learn from."""
    texts = staged(labelled(docs, labels, fold, bound).coalesce(FILES), "toxic-texts").select(utf8().alias("text"), "toxic")
    counts = staged(texts.mapInArrow(_counted, "token string, toxic long, other long")
                    .groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).coalesce(FILES), "token-counts")
    vocabulary, n_toxic, n_other = counts.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0)),
                                              F.coalesce(F.sum("other"), F.lit(0))).first()
    n_all = n_toxic + n_other
    if not n_toxic or not n_other:
        return Model({}, 1.0, 1.0, 1.0, 0.0, -30.0)
    weight = PRIOR * n_toxic
    prior = (F.col("toxic") + F.col("other")) * (weight / n_all)
    in_toxic, in_other = F.col("toxic") + prior, F.col("other") + prior
    odds = F.log(in_toxic / (n_toxic + weight - in_toxic)) - F.log(in_other / (n_other + weight - in_other))
    bar = NormalDist().inv_cdf(1 - 0.5 / max(vocabulary, 2))  # half a token by chance in the whole vocabulary
    terms = counts.where(F.col("toxic") >= MIN_TEXTS).select("token", odds.alias("odds"), (in_other / (n_other + weight)).alias("p"), (
        odds / F.sqrt(1 / in_toxic + 1 / in_other)).alias("z")).where((F.col("z") > bar) & (F.col("odds") > math.log(4))) \
        .orderBy(F.desc("z"), "token").limit(MAX_TERMS).collect()
    if not terms:
        return Model({}, 1.0, 1.0, 1.0, 0.0, -30.0)
    scores = {r["token"]: float(r["odds"]) for r in terms}
    s, p = _background(texts.where("toxic = 0"), scores)
    rest = max(1e-9, 1 - float(p.sum()))
    # The expected score of background text must be negative.
    cost = max(float(np.median(list(scores.values()))) / GAP, 1.5 * float(p @ s) / rest)
    lam = _lambda(p, s, rest, cost)
    # K for scores of which few are positive: the chance that a segment begins at a token.
    model = Model(scores, cost, lam, max(1e-12, float(p @ np.exp(lam * s))), 1.0, 0.0)
    slope, intercept = _logistic(texts, model)
    return Model(model.scores, model.cost, model.lam, model.k, slope, intercept)


def _background(texts: DataFrame, evidence: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct positive scores of tokens and their share of all tokens in ``texts``, with one count added."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(evidence)
        for batch in batches:
            (bodies,) = columns_of(batch, "text")
            count = Counter(scores[word] for body in bodies for word in tokens(body))
            yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.float64()), pa.array(list(count.values()), pa.int64())],
                                             names=["score", "n"])

    found = {r["score"]: r["n"] for r in texts.mapInArrow(counted, "score double, n long")
             .groupBy("score").agg(F.sum("n").alias("n")).collect()}
    values = sorted(set(evidence.values()))
    return np.array(values), np.array([found.get(v, 0) + 1 for v in values]) / (sum(found.values()) + len(values) + 1)


def _logistic(texts: DataFrame, model: Model) -> tuple[float, float]:
    """Slope and intercept by Newton's steps, on a histogram of the training texts' evidence."""
    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(model.scores)
        for batch in batches:
            bodies, labels = columns_of(batch, "text", "toxic")
            yield pa.RecordBatch.from_arrays([pa.array([round(math.log1p(passages(model, scores, t)[1]), 2) for t in bodies], pa.float64()),
                                              pa.array([int(bool(v)) for v in labels], pa.int32())], names=["x", "y"])

    rows = texts.mapInArrow(evidence, "x double, y int").groupBy("x", "y").count().collect()
    x, y, w = (np.array([r[i] for r in rows], dtype=float) for i in range(3))
    a, b = 1.0, -2.0
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([w @ ((q - y) * x) + 0.01 * a, w @ (q - y)])  # a slight pull to zero keeps separable data finite
        h = w * q * (1 - q)
        hess = np.array([[h @ (x * x) + 0.01, h @ x], [h @ x, h.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        step = step / max(1.0, float(np.abs(step).max()))
        a, b = a - step[0], b - step[1]
    return float(max(a, 0.0)), float(b)


_SCORED = pa.schema([("score", pa.float64()), ("passages", pa.list_(pa.struct([
    ("begin", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])))])


def score_texts(df: DataFrame, model: Model, keep: list[str], text: str = "_cw_text") -> DataFrame:
    """The columns ``keep`` with ``_cw_score`` and ``_cw_passages``; ``text``: bytes."""
    shared = df.sparkSession.sparkContext.broadcast(model.__dict__)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        scores = Scores(model.scores)
        for batch in batches:
            (texts,) = columns_of(batch, text)
            found = [passages(model, scores, t) for t in texts]
            spans = [[{"begin": b, "end": e, "p": p} for b, e, p in spans] for spans, _ in found]
            new = [pa.array([_probability(model, e) for _, e in found], pa.float64()), pa.array(spans, _SCORED[1].type)]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), *new],
                                             names=[*keep, "_cw_score", "_cw_passages"])

    schema = df.select(*(F.col(f"`{c}`") for c in keep)).withColumns({
        "_cw_score": F.lit(0.0), "_cw_passages": F.lit(None).cast("array<struct<begin:int,end:int,p:double>>")}).schema
    return df.mapInArrow(scored, schema)


def train_on(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """The model from the labelled documents whose fold is not held out."""
    return train(docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")),
                 labels.select(F.col(id_column).alias("id"), F.col(label).alias("toxic")), remainder("id", 5) > 0)


def toxicity(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Score, prediction and toxic passages (places of tokens) of every document."""
    slim = docs.select(F.col(id_column).alias(id_column), utf8(text).alias("_cw_text"))
    return score_texts(slim, model, [id_column]).select(
        id_column, (remainder(id_column, 5) == 0).alias("held_out"), F.col("_cw_score").alias("score"),
        (F.col("_cw_score") >= 0.5).cast("int").alias("predicted"), F.col("_cw_passages").alias("passages"))


def drop_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    marked = docs.withColumn("_cw_text", utf8(text))
    return score_texts(marked, model, docs.columns).where("_cw_score < 0.5").drop("_cw_score", "_cw_passages")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity(docs, train_on(docs, table(spark, sf_dir, "labels"))) \
        .withColumn("n_passages", F.size("passages"))
