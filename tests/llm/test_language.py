import numpy as np

from candlewick.llm import language
from candlewick.llm.common import remainder


def test_subwords_stay_in_words_and_texts():
    buckets, places, has = language.subwords(["Ab c".encode(), None, b"12 !", "é".encode(), b"ab"])
    assert has.tolist() == [True, False, False, True, True]
    count = np.bincount(places, minlength=5).tolist()
    # "_ab_": _ab, ab_, _ab_; "_c_": itself.
    assert count == [4, 0, 0, 1, 3]
    assert set(buckets[places == 4]) < set(buckets[places == 0])
    alone, _, _ = language.subwords([b"ab"])
    assert sorted(alone) == sorted(buckets[places == 4])


def test_held_out_accuracy(documents):
    learn = documents.where(remainder("doc_id", 3) != 1).selectExpr("doc_id AS id", "text", "lang")
    model = language.train(learn)
    truth = {r["doc_id"]: r["lang"] for r in documents.where(remainder("doc_id", 3) == 1).collect()}
    got = {r["doc_id"]: r for r in language.identify(documents, model).collect()}
    assert np.mean([got[i]["lang_pred"] == lang for i, lang in truth.items()]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_awkward_documents(documents, awkward, nothing):
    model = language.train(documents.selectExpr("doc_id AS id", "text", "lang"))
    rows = language.identify(awkward, model).collect()
    assert len(rows) == awkward.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], set()).add((r["lang_pred"], r["score"], r["accepted"]))
    for i in (1, 2, 3, 8):
        assert by_id[i] == {("und", 0.0, False)}
    assert len(by_id[4]) == 1 and by_id[4] == by_id[5]
    assert by_id[6] != {("und", 0.0, False)}
    assert language.identify(nothing, model).count() == 0
    assert language.train(nothing.selectExpr("doc_id AS id", "text", "lang")) is None
    assert {r["lang_pred"] for r in language.identify(awkward, None).collect()} == {"und"}


def test_the_sample_is_bounded(documents):
    assert language.train(documents.selectExpr("doc_id AS id", "text", "lang"), bound=20) is not None
