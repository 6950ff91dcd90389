import random

import numpy as np
import pytest

from candlewick.llm import pieces as P

TEXTS = ["", " ", "  a  b ", "Hello world, this is a test.", "a\n\n b\r\n\tc", "日本語 テスト 😀", "x" * 300 + " " + "ab" * 200, "ﬁ é ½  ", "12345 % ###",
         "The   quick brown fox\njumps", "\x00\x01", " leading and trailing "]


@pytest.fixture(scope="module")
def vocabulary():
    return P.load_vocabulary()


def encode(v, texts, ids=None, **options):
    found, count = P.encode(v, [t if isinstance(t, bytes) or t is None else t.encode() for t in texts], ids or list(range(len(texts))), **options)
    edges = np.concatenate(([0], np.cumsum(count)))
    return [found[a:b].tolist() for a, b in zip(edges, edges[1:])]


def test_without_dropout_as_the_library(vocabulary, documents):
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=P.model_path())
    texts = TEXTS + [r["text"] for r in documents.limit(60).collect()]
    assert encode(vocabulary, texts, dropout=0) == sp.encode(texts)


def brute(v, unit, key, dropout):
    """One unit by scanning for the best candidate again and again."""
    spans = [(i, i + 1) for i in range(len(unit))]
    ids = [int(v.char_ids[ord(c)]) for c in unit]
    pairs = dict(zip(v.pair_keys.tolist(), v.pair_merged.tolist()))
    while True:
        best = None
        for k in range(len(ids) - 1):
            merged = pairs.get(ids[k] * v.size + ids[k + 1]) if min(ids[k], ids[k + 1]) >= 0 else None
            args = (np.array([key], np.uint64), np.array([spans[k][0]]), np.array([spans[k + 1][0]]), np.array([spans[k + 1][1]]))
            if merged is not None and not P.dropped(*args, dropout)[0]:
                best = min(best or (1 << 62, 0, 0), (int(v.rank[merged]), k, merged))
        if best is None:
            return ids
        _, k, merged = best
        ids[k:k + 2] = [merged]
        spans[k:k + 2] = [(spans[k][0], spans[k + 1][1])]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_units_against_brute_force(vocabulary, monkeypatch, dropout):
    rng = random.Random(2)
    units = ["▁" + "".join(rng.choice(["th", "er", "ing", "a", "x", "0", "é"]) for _ in range(rng.randrange(8))) for _ in range(150)]
    variants = np.arange(150) % 3
    sizes = np.array([len(u) for u in units])
    keys = P.unit_keys(np.array([ord(c) for u in units for c in u]), sizes, variants, 5)
    want = [i for u, k in zip(units, keys) for i in brute(vocabulary, u, k, dropout)]
    for longest in (48, 4):  # together, and one by one with a heap
        monkeypatch.setattr(P, "LONG_UNIT", longest)
        got, count = P.merge_units(vocabulary, units, variants, 5, dropout)
        assert got.tolist() == want and count.sum() == len(got)


def test_every_text_comes_back(vocabulary):
    texts = TEXTS + ["▁x ▁▁ a", b"\xff\xfe bad \xed\xa0\x80", "\U0010ffff"]
    raw = [t if isinstance(t, bytes) else t.encode() for t in texts]
    for dropout in (0.0, 0.1, 0.7):
        assert [P.decode(vocabulary, ids) for ids in encode(vocabulary, texts, dropout=dropout)] == raw


def test_seeds_and_ids_vary_the_cut(vocabulary):
    text = "international considerations " * 20
    one, two, again = encode(vocabulary, [text] * 3, [1, 2, 1], dropout=0.3)
    assert one == again != two
    assert encode(vocabulary, [text], [1], dropout=0.3, seed=9) != [one]
    cuts = set()
    for ids in encode(vocabulary, ["considerations"] * 60, dropout=0.4):
        cuts.add(tuple(ids))
    assert 1 < len(cuts) <= P.VARIANTS
    # The work does not depend on what else is in the batch.
    assert encode(vocabulary, ["noise here", text], [7, 1], dropout=0.3)[1] == one


def test_frames(awkward, nothing, vocabulary):
    got = P.encode_texts(awkward, vocabulary)
    rows = got.collect()
    assert len(rows) == awkward.count() and all(r["lossless"] for r in rows)
    assert [r["ids"] for r in rows if r["doc_id"] == 1] == [None]
    assert [(r["ids"], r["n_pieces"]) for r in rows if r["doc_id"] == 2] == [([], 0)]
    assert len({tuple(r["ids"]) for r in rows if r["doc_id"] == 4}) == 1
    assert all(r["n_pieces"] == len(r["ids"] or []) for r in rows)
    back = sorted(map(repr, map(tuple, P.decode_ids(got, vocabulary).collect())))
    assert back == sorted(repr((r["doc_id"], r["text"])) for r in awkward.collect())
    assert P.encode_texts(nothing, vocabulary).count() == 0
