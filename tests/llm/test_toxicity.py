import math
import random

import pytest

from candlewick.llm import toxicity as T


def brute_segments(scores):
    """All maximal-scoring segments by their definition: the best segment, then the same left and right of it."""
    def best(low, high):
        top, where = 0.0, None
        for i in range(low, high):
            total = 0.0
            for j in range(i, high):
                total += scores[j]
                if total > top + 1e-9:
                    top, where = total, (i, j + 1)
        if where is None:
            return []
        return [*best(low, where[0]), (*where, top), *best(where[1], high)]
    return best(0, len(scores))


def test_segments_against_the_definition():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(1, 40)
        scores = [rng.choice([-0.7] * 4 + [rng.uniform(0.5, 4)]) for _ in range(n)]  # no ties
        hits = [(i, s) for i, s in enumerate(scores) if s > 0]
        got = sorted(T.segments(hits, 0.7))
        want = sorted(brute_segments(scores))
        assert [round(s, 6) for *_, s in got] == [round(s, 6) for *_, s in want]
        assert [g[:2] for g in got] == [w[:2] for w in want]


def test_lambda_solves_its_equation():
    import numpy as np
    p, s = np.array([0.01, 0.02]), np.array([3.0, 1.5])
    lam = T._lambda(p, s, 0.97, 0.2)
    assert lam > 0 and p @ np.exp(lam * s) + 0.97 * math.exp(-0.2 * lam) == pytest.approx(1)


def make(spark, n=400):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(["the", "of", "sea", "boat", "wind", "harbour", "sail"]) + rng.choice(["", ",", "."]) for _ in range(rng.randrange(20, 80))]
        bad = i % 5 == 0
        if bad:
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(["Frub!", "GRONK", "zlarg,"]) for _ in range(3)]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return (spark.createDataFrame(rows, "doc_id long, text string").repartition(4),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = make(spark)
    return docs, labels, T.train_on(docs, labels)


def test_held_out_documents(fitted):
    docs, _, model = fitted
    assert {"frub", "gronk", "zlarg"} <= set(model.scores) and not {"sea", "the"} & set(model.scores)
    rows = T.toxicity(docs, model).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 30 and all(r["predicted"] == (r["doc_id"] % 5 == 0) for r in held)
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert (len(r["passages"]) > 0) == (r["doc_id"] % 5 == 0)
        assert all(p["p"] <= T.SIGNIFICANT and p["end"] > p["begin"] for p in r["passages"])


def test_held_out_labels_are_not_read(fitted, spark):
    """Turning the labels of the held-out fold around changes nothing."""
    from pyspark.sql import functions as F
    from candlewick.llm.common import remainder
    docs, labels, model = fitted
    turned = labels.withColumn("toxic", F.when(remainder("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert T.train_on(docs, turned) == model


def test_awkward_documents(fitted, awkward, nothing):
    _, labels, model = fitted
    rows = T.toxicity(awkward, model).collect()
    assert len(rows) == awkward.count() and {r["predicted"] for r in rows} == {0}
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert T.toxicity(nothing, model).count() == 0
    kept = T.drop_toxic(awkward, model)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    for docs, lab in ((awkward, labels.limit(0)), (nothing, labels), (awkward, labels)):
        assert {r["predicted"] for r in T.toxicity(awkward, T.train_on(docs, lab)).collect()} == {0}


def test_labels_with_nulls_and_doubles(fitted, spark):
    docs, labels, model = fitted
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 1), (7, 1, None), (1, 1, 0)], labels.schema))
    assert T.train_on(docs, odd) == model


def test_training_writes_few_files(fitted, spark):
    """However many partitions the shuffles have: each file of a task starts processes in its executor."""
    from pathlib import Path
    from candlewick.llm import common
    docs, labels, model = fitted
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    known = len(common._STAGED)
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        again = T.train_on(docs, labels)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert (again.scores, again.cost, again.lam, again.k) == (model.scores, model.cost, model.lam, model.k)
    assert (again.slope, again.intercept) == pytest.approx((model.slope, model.intercept))
    files = {Path(p).name.rsplit("-", 1)[0]: len(list(Path(p.removeprefix("file:")).glob("part-*"))) for p in common._STAGED[known:]}
    assert {"labels", "toxic-texts", "token-counts"} == set(files) and all(1 <= n <= 12 for n in files.values()), files
