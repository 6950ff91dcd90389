import zlib

import corpus_pipeline
from candlewick.llm import common, queries


def test_stages_one_after_the_other(spark, documents):
    sf_dir = "/root/testdata/sf0.001"
    docs, sizes = documents, [documents.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = common.staged(stage(spark, docs, sf_dir), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == documents.columns and [f.dataType for f in out.schema] == [f.dataType for f in documents.schema]
        ids = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert ids <= {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = out
        sizes.append(out.count())
    assert sizes == sorted(sizes, reverse=True) and 0.5 * sizes[0] < sizes[-1] < sizes[0]
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, docs.collect()))
    common.release(spark)
    assert not common._STAGED


def test_stage_decisions_are_the_operators(spark, documents):
    sf_dir = "/root/testdata/sf0.001"
    by_name = dict(corpus_pipeline.STAGES)
    kept = {r["doc_id"] for r in queries.QUERIES["op6_quality_rules"](spark, sf_dir).where("kept").collect()}
    assert {r["doc_id"] for r in by_name["quality_rules"](spark, documents, sf_dir).collect()} == kept
    clean = {r["doc_id"] for r in queries.QUERIES["op5_toxicity"](spark, sf_dir).where("predicted = 0").collect()}
    assert {r["doc_id"] for r in by_name["toxicity"](spark, documents, sf_dir).collect()} == clean
    one = {r["component_id"] for r in queries.QUERIES["op10_simhash_neardup"](spark, sf_dir).collect()}
    assert {r["doc_id"] for r in by_name["near_duplicates"](spark, documents, sf_dir).collect()} == one


def test_stages_on_awkward_and_no_documents(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert out.count() <= docs.count()
            assert name == "sentencepiece" or out.columns == docs.columns


def test_queries_and_folds(spark, documents):
    folds = {"op1_language_id": (3, 1), "op5_toxicity": (5, 0), "op7_lm_scoring": (7, 2)}
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    for name, (n, held) in folds.items():
        rows = queries.QUERIES[name](spark, "/root/testdata/sf0.001").select("doc_id", "held_out").collect()
        assert len(rows) == documents.count()
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % n == held) for r in rows)
    assert set(queries.ORACLES) <= set(queries.QUERIES)
