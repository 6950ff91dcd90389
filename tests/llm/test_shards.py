import zlib

import numpy as np

from candlewick.llm import shards


def test_the_curve_visits_every_cell_and_neighbours_touch():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        index = shards.hilbert_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        path = cells[np.argsort(index)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shards_of_awkward_documents(awkward):
    got = shards.shard_documents(awkward, 5).collect()
    rows = awkward.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    data = lambda t: (t or "").encode()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, len(data(r["text"])) + 1, zlib.crc32(data(r["text"]))) for r in rows)
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(5)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}


def test_fewer_documents_than_shards_and_none(awkward, nothing):
    assert shards.shard_documents(nothing).count() == 0
    got = shards.shard_documents(awkward.limit(3), 16).collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(0, 0), (1, 0), (2, 0)]


def test_files_are_narrow_in_every_dimension(spark, documents, tmp_path):
    path = str(tmp_path / "shards")
    shards.write_shards(documents, path, 8)
    back = spark.read.parquet(path)
    assert back.count() == documents.count() and set(back.columns) == {*documents.columns, "shard"}
    at = shards.shard_documents(documents, 8)
    assert {(r["doc_id"], r["shard"]) for r in back.select("doc_id", "shard").collect()} == {(r["doc_id"], r["shard"]) for r in at.collect()}
    spread = back.groupBy("shard").agg({"source": "count"}).count()
    assert spread == 8
    per_shard = back.selectExpr("shard", "lang").distinct().groupBy("shard").count().agg({"count": "avg"}).first()[0]
    assert per_shard < documents.select("lang").distinct().count()


def test_whole_values_and_one_cell_for_equal_texts(spark):
    """Values that begin alike get cells of their own, and copies lie side by side whatever their source."""
    rows = [(i, f"text {i % 40}", f"https://host{i % 8}", "en") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    edges = shards.text_edges(df, "source")
    assert edges == [f"https://host{i}" for i in range(8)]
    at = sorted((r["shard"], r["slot"], rows[r["doc_id"]][1]) for r in shards.shard_documents(df, 5).collect())
    order = [text for _, _, text in at]
    assert sum(a != b for a, b in zip(order, order[1:])) == 39
