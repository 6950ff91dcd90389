"""SentencePiece (BPE) encoding with seeded merge-dropout, and decoding.

The vocabulary is read from a model file on the driver and broadcast. A text gets a space in front, spaces become the mark
U+2581, and merges never cross a line feed or go from a letter to a following mark, so it falls into units (a word with the spaces before
it) that are encoded apart. In a unit the agenda holds every two neighbours whose concatenation is a piece; the best score, then the
leftmost, is merged first. With dropout a candidate merge is skipped for good if a keyed hash of (seed, variant, unit, begin,
middle, end) falls below ``dropout``: the same candidate always meets the same fate, whatever the order of work. Each occurrence of a
unit in a text draws one of ``VARIANTS`` variants by a hash of (seed, id, place), so a word is cut in varied ways, and each
(unit, variant) needs to be worked out once. ``dropout=0`` is the plain encoding.

Characters without a piece, and the mark itself, become byte pieces, so that decoding gives back every text exactly. Null
gives no ids; the empty text none either (and decodes to itself). A null id counts as 0. Repeated rows give equal ids.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.llm.common import chunks, table, utf8

MARK = "▁"
DROPOUT = 0.1
SEED = 20_011
VARIANTS = 4
#: Units longer than this are encoded one by one with a heap; shorter ones together.
LONG_UNIT = 48

_UNIT = re.compile(r"\n| *[^ \n]+| +")
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    """Where the installed public vocabulary lies."""
    import public_tokenizers
    return public_tokenizers.path(name)


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[str]
    bytes_of: list[bytes]  # what each id decodes to
    rank: np.ndarray  # order of merging by score, 0 first; equal scores have equal ranks
    char_ids: np.ndarray  # id of each code point, -1 without a piece
    byte_ids: np.ndarray  # ids of the byte pieces
    pair_keys: np.ndarray  # sorted left * size + right
    pair_merged: np.ndarray

    @property
    def size(self) -> int:
        return len(self.pieces)


def load_vocabulary(path: str | None = None) -> Vocabulary:
    """Read a BPE model with byte pieces, identity normalisation and a space put in front."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=path or model_path())
    size = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(size)]
    plain = {p: i for i, p in enumerate(pieces) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))}
    byte_ids = np.zeros(256, dtype=np.int64)
    bytes_of = [p.replace(MARK, " ").encode() for p in pieces]
    for i in range(size):
        if sp.is_byte(i):
            value = int(pieces[i][3:5], 16)
            byte_ids[value], bytes_of[i] = i, bytes([value])
        elif sp.is_control(i) or sp.is_unknown(i):
            bytes_of[i] = b""
    scores = np.array([sp.get_score(i) for i in range(size)])
    rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
    char_ids = np.full(0x110000, -1, dtype=np.int64)
    for p, i in plain.items():
        if len(p) == 1:
            char_ids[ord(p)] = i
    pairs = sorted((plain[p[:k]] * size + plain[p[k:]], i) for p, i in plain.items() for k in range(1, len(p))
                   if p[:k] in plain and p[k:] in plain)
    return Vocabulary(pieces, bytes_of, rank, char_ids, byte_ids, *(np.array(x, dtype=np.int64) for x in zip(*pairs)))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def dropped(unit_key: np.ndarray, begin: np.ndarray, middle: np.ndarray, end: np.ndarray, dropout: float) -> np.ndarray:
    """Which candidate merges are skipped; places count characters of the unit."""
    if dropout <= 0:
        return np.zeros(len(unit_key), dtype=bool)
    x = _mix(unit_key + _M1 * (begin.astype(np.uint64) + np.uint64(1)))
    x = _mix(x + _M1 * (middle.astype(np.uint64) + np.uint64(1)))
    x = _mix(x + _M1 * (end.astype(np.uint64) + np.uint64(1)))
    return (x >> np.uint64(11)).astype(np.float64) < dropout * (1 << 53)


def unit_keys(points: np.ndarray, sizes: np.ndarray, variants: np.ndarray, seed: int) -> np.ndarray:
    """A keyed hash of each unit's characters and its variant."""
    begins = np.cumsum(sizes) - sizes
    place = np.arange(len(points)) - np.repeat(begins, sizes)
    each = _mix(points.astype(np.uint64) * _M1 + place.astype(np.uint64) * _M3 + np.uint64(seed))
    return _mix(np.add.reduceat(each, begins) + _M1 * (variants.astype(np.uint64) + np.uint64(1)))


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], -1)


def _merge_long(v: Vocabulary, start: np.ndarray, key: np.uint64, dropout: float) -> list[tuple[int, int]]:
    """(id or -1, first character) of each symbol of one unit, by a heap as agenda."""
    ids, n = start.tolist(), len(start)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    agenda: list[tuple[int, int, int, int, int]] = []

    def offer(left: np.ndarray, right: np.ndarray) -> None:
        a, b = np.array([ids[i] for i in left]), np.array([ids[i] for i in right])
        merged = np.where((a >= 0) & (b >= 0), _lookup(v.pair_keys, v.pair_merged, a * v.size + b), -1)
        ends = np.array([end[i] for i in right])
        skip = dropped(np.full(len(left), key, np.uint64), np.array(left), np.array(right), ends, dropout)
        for i, j, m, e, s in zip(left, right, merged.tolist(), ends.tolist(), skip):
            if m >= 0 and not s:
                heapq.heappush(agenda, (int(v.rank[m]), i, j, e, m))

    offer(list(range(n - 1)), list(range(1, n)))
    alive = [True] * n
    while agenda:
        _, i, j, e, m = heapq.heappop(agenda)
        if not (alive[i] and alive[j] and after[i] == j and end[j] == e):
            continue
        ids[i], end[i], after[i], alive[j] = m, e, after[j], False
        if after[i] < n:
            before[after[i]] = i
        pairs = [(a, b) for a, b in ((before[i], i), (i, after[i])) if a >= 0 and b < n]
        if pairs:
            offer([a for a, _ in pairs], [b for _, b in pairs])
    return [(ids[i], i) for i in range(n) if alive[i]]


def merge_units(v: Vocabulary, units: list[str], variants: np.ndarray, seed: int = SEED, dropout: float = DROPOUT
                ) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all units (spaces already marked, marks of the text escaped) in a row, and how many each has."""
    sizes = np.array([len(u) for u in units], dtype=np.int64)
    points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    keys = unit_keys(points, sizes, variants, seed)
    start = v.char_ids[points]
    begins = np.cumsum(sizes) - sizes
    out_ids, out_unit, out_place = [], [], []
    for k in np.flatnonzero(sizes > LONG_UNIT):
        rows = _merge_long(v, start[begins[k]:begins[k] + sizes[k]], keys[k], dropout)
        out_ids.append(np.array([i for i, _ in rows]))
        out_place.append(np.array([p for _, p in rows]))
        out_unit.append(np.full(len(rows), k))
    short = np.repeat(sizes <= LONG_UNIT, sizes)
    unit = np.repeat(np.arange(len(units)), sizes)[short]
    place = (np.arange(len(points)) - np.repeat(begins, sizes))[short]
    ids, end = start[short], place + 1

    def candidates(at: np.ndarray) -> np.ndarray:
        """What the symbols at these places and their right neighbours merge to; -1 for nothing, or skipped."""
        out = np.full(len(at), -1)
        fit = np.flatnonzero(at + 1 < len(ids))
        left = at[fit]
        ok = (unit[left] == unit[left + 1]) & (ids[left] >= 0) & (ids[left + 1] >= 0)
        fit, left = fit[ok], left[ok]
        merged = _lookup(v.pair_keys, v.pair_merged, ids[left] * v.size + ids[left + 1])
        ok = merged >= 0
        fit, left, merged = fit[ok], left[ok], merged[ok]
        skip = dropped(keys[unit[left]], place[left], place[left + 1], end[left + 1], dropout)
        out[fit] = np.where(skip, -1, merged)
        return out

    # All units at once: each round merges the top of every unit's agenda; units without candidates leave.
    agenda = candidates(np.arange(len(ids)))
    while len(ids):
        pair = np.flatnonzero(agenda >= 0)
        owner = unit[pair]
        busy = np.zeros(len(units), dtype=bool)
        busy[owner] = True
        stay = busy[unit]
        gone, changed = np.zeros(len(ids), dtype=bool), np.zeros(len(ids), dtype=bool)
        if len(pair):
            edge = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            value = v.rank[agenda[pair]] * (LONG_UNIT + 1) + place[pair]
            best = np.minimum.reduceat(value, edge)
            left = pair[value == np.repeat(best, np.diff(np.append(edge, len(pair))))]
            ids[left], end[left] = agenda[left], end[left + 1]
            gone[left + 1] = changed[left] = True
            changed[left[left > 0] - 1] = True
        done, keep = ~stay, stay & ~gone
        out_ids.append(ids[done])
        out_unit.append(unit[done])
        out_place.append(place[done])
        ids, unit, place, end, agenda, changed = (x[keep] for x in (ids, unit, place, end, agenda, changed))
        again = np.flatnonzero(changed)
        agenda[again] = candidates(again)
    all_ids, all_unit, all_place = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
                                    for x in (out_ids, out_unit, out_place))
    order = np.argsort(begins[all_unit] + all_place) if len(all_ids) else np.zeros(0, np.int64)
    ids, char = all_ids[order], (begins[all_unit] + all_place)[order]
    return _with_bytes(v, ids, all_unit[order], points[char], len(units))


def _with_bytes(v: Vocabulary, ids: np.ndarray, unit: np.ndarray, points: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Replace characters without a piece by their byte pieces."""
    missing = np.flatnonzero(ids < 0)
    if len(missing):
        # The escape of the mark stands for the mark itself.
        found, which = np.unique(points[missing], return_inverse=True)
        spelled = [np.array([v.byte_ids[b] for b in (MARK if p == ESCAPE else chr(p)).encode("utf-8", "surrogateescape")]) for p in found]
        width = np.ones(len(ids), dtype=np.int64)
        width[missing] = np.array([len(s) for s in spelled])[which]
        begin = np.cumsum(width) - width
        out, unit = np.repeat(ids, width), np.repeat(unit, width)
        for k, s in enumerate(spelled):
            at = begin[missing[which == k]]
            for j, b in enumerate(s):
                out[at + j] = b
        ids = out
    return ids, np.bincount(unit, minlength=n)


#: Stands for a mark in the text while it is encoded: no text decoded from UTF-8 holds a lone surrogate.
ESCAPE = 0xDFFF


def encode(v: Vocabulary, texts: list[bytes | None], ids: list[int | None], seed: int = SEED, dropout: float = DROPOUT
           ) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts in a row, and how many each has."""
    units, sizes = [], np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        if text:
            found = _UNIT.findall(" " + text.decode("utf-8", "surrogateescape").replace(MARK, chr(ESCAPE)))
            units += found
            sizes[i] = len(found)
    known = dict.fromkeys(units)
    known = dict(zip(known, range(len(known))))
    flat = np.fromiter(map(known.__getitem__, units), dtype=np.int64, count=len(units))
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    variants = VARIANTS if dropout > 0 else 1
    text_keys = np.array([(i or 0) & ((1 << 64) - 1) for i in ids], dtype=np.uint64)
    drawn = _mix(_mix(text_keys * _M1 + np.uint64(seed))[owner] + place.astype(np.uint64) * _M3)
    combined = flat * variants + (drawn % np.uint64(variants)).astype(np.int64)
    used = np.zeros(len(known) * variants, dtype=bool)
    used[combined] = True
    wanted = np.flatnonzero(used)
    names = [u.replace(" ", MARK) for u in known]
    pieces, count = merge_units(v, [names[k] for k in wanted // variants], wanted % variants, seed, dropout)
    begin = np.cumsum(count) - count
    number = np.zeros(len(used), dtype=np.int64)
    number[wanted] = np.arange(len(wanted))
    unit = number[combined]
    lengths = count[unit]
    at = np.repeat(begin[unit] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
    return pieces[at], np.bincount(owner, weights=lengths, minlength=len(texts)).astype(np.int64)


def decode(v: Vocabulary, ids: list[int]) -> bytes:
    """The text; the space put in front by ``encode`` is taken off."""
    text = b"".join(map(v.bytes_of.__getitem__, ids))
    return text[1:] if text[:1] == b" " else text


def encode_texts(docs: DataFrame, vocabulary: Vocabulary, seed: int = SEED, dropout: float = DROPOUT, id_column: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Id, ids, number of pieces, number of byte pieces, and whether the ids decode to the text, of every document."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.__dict__, seed, dropout))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, seed, dropout = shared.value
        v = Vocabulary(**fields)
        is_byte = np.zeros(v.size, dtype=bool)
        is_byte[v.byte_ids] = True
        for batch in batches:
            names, texts = batch.column(0), batch.column(1).to_pylist()
            for begin, end in chunks([t or b"" for t in texts], 2 << 20):
                some, own = texts[begin:end], names.slice(begin, end - begin)
                ids, count = encode(v, some, own.to_pylist(), seed, dropout)
                edges = np.concatenate(([0], np.cumsum(count)))
                listed = ids.tolist()
                same = [text is not None and decode(v, listed[a:b]) == text for text, a, b in zip(some, edges, edges[1:])]
                byte_sum = np.concatenate(([0], np.cumsum(is_byte[ids])))
                empty = pa.array([t is None for t in some])
                yield pa.RecordBatch.from_arrays([
                    own, pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids, pa.int32()), mask=empty), pa.array(count),
                    pa.array(byte_sum[edges[1:]] - byte_sum[edges[:-1]]), pa.array([s or t is None for s, t in zip(same, some)])],
                    names=["id", "ids", "n_pieces", "n_byte_pieces", "lossless"])

    slim = docs.select(F.col(id_column).cast("long").alias("id"), utf8(text).alias("text"))
    return slim.mapInArrow(encoded, "id long, ids array<int>, n_pieces long, n_byte_pieces long, lossless boolean") \
        .withColumnRenamed("id", id_column)


def decode_ids(encoded: DataFrame, vocabulary: Vocabulary, id_column: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Id and text of rows of piece ids; null ids give null."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary.__dict__)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(**shared.value)
        for batch in batches:
            texts = [None if row is None else decode(v, row) for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["id", "text"])

    slim = encoded.select(F.col(id_column).cast("long").alias("id"), F.col(ids).alias("ids"))
    return slim.mapInArrow(decoded, "id long, text binary").select(F.col("id").alias(id_column), F.col("text").cast("string").alias("text"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"), load_vocabulary())
