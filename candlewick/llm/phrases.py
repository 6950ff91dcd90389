"""Phrase collocation mining by dynamic itemset counting.

Texts are lower-cased (A-Z), cut at ``[.,;:!?]`` and line ends into pieces, pieces into words. Per language (null: ``und``) phrases of up to
``LONGEST`` words are counted wherever they stand within a piece. Texts are read in chunks, whose words are coded once, as places in the
chunk's own list of words, and the coded corpus is staged in ``SHARDS`` shards that are scanned in turn. Words are counted from the first
scan on; a longer phrase becomes active after the scan in which both its subphrases (without the last and without the first word) have
reached ``LEAST``, is counted in the scans that follow, whatever its length, and is complete after one full cycle, in which it has met every
shard once. As no phrase is more frequent than its parts, all frequent ones are found, and all counts are exact.

Which subphrases have reached the limit is known to the tasks as one array a length: the scan after which the first phrase of a hash
slot has done so. The arrays have ``SLOTS`` bytes for any corpus. Phrases that share a slot only become active earlier than they
would alone: the scan from which a phrase is active follows from its parts' slots, so it is still counted once in every shard, and what is
not frequent is left out at the end. Tasks write one row for each phrase of a chunk, its words as 64-bit hashes with the language in
the seed. The words are counted with their text, so two words of one hash would show, and then all is counted again with another seed.
Running counts are kept by a 64-bit hash of the phrase (a collision again only makes active); the final counts are by all words.
A phrase found ``LEAST`` times in all shards is found ``LEAST / SHARDS`` times or more in one of them, so only counts of a shard that are
this large are kept from scan to scan. What the others can add at most counts when a phrase is complete: it has then reached ``LEAST`` if it
may have, which again only makes active. The rare phrases, nearly all, are shuffled once and not written again. Phrases whose slot has
reached the limit are not counted there any more.

A frequent phrase of two to four words scores by its weakest cut, as in ``scored``; phrases that stand mostly within a longer one
are dropped. Null and empty texts have no words; texts of any length are read in chunks, whole; repeated rows count each time; ties
go by phrase; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from candlewick.llm.common import batch_of, columns_of, release_path, stage, staged, table, utf8

LONGEST = 4
LEAST = 30
REPORT = 2000
SHARDS = 4
SLOT_BITS = 23
#: Bytes of text that are counted together.
CHUNK = 8 << 20
#: Values that are hashed together, so that they stay in a core's cache.
BLOCK = 1 << 14
UNKNOWN = "und"
COVERED = 80

_END = b"\xff"  # never in UTF-8
_MARKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", _END * 10 + b" ")
_NEVER = 255
_ROW = "length byte, w1 long, w2 long, w3 long, w4 long, lang string, word binary, n long, last short, open boolean"
_WORDS = [f"w{k}" for k in range(1, LONGEST + 1)]
#: The primes of XXH64, and the seed of Spark's ``xxhash64``.
_P1, _P2, _P3, _P4, _P5 = map(np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
_SEED = 42


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def chained(values: np.ndarray, before: np.ndarray) -> np.ndarray:
    """XXH64 of 8-byte values, seeded with the hashes before them: what Spark's ``xxhash64`` makes of several longs."""
    out, before = np.empty_like(values), np.broadcast_to(before, values.shape)
    for begin in range(0, len(values), BLOCK):
        part = slice(begin, begin + BLOCK)
        out[part] = _chained(values[part], before[part])
    return out


def _chained(values: np.ndarray, before: np.ndarray) -> np.ndarray:
    h = before + (_P5 + np.uint64(8))
    h ^= _rotated(values * _P2, 31) * _P1
    h = _rotated(h, 27) * _P1 + _P4
    h ^= h >> np.uint64(33)
    h *= _P2
    h ^= h >> np.uint64(29)
    h *= _P3
    return h ^ (h >> np.uint64(32))


def pieces_of(text: bytes) -> bytes:
    """Lower-cased, with one mark in place of every character that ends a piece, and blanks in place of tabs."""
    return text.lower().translate(_MARKS)


def runs(text: bytes, most: int) -> Iterator[tuple[bytes, int]]:
    """``text`` in runs of about ``most`` bytes, cut where pieces end. Where none does, the next run begins with the last words of the
    one before, and their number is given, as the phrases among them are counted already."""
    carried = begin = 0  # words carried over, and where the text after them begins
    while len(text) - begin > most:
        cut = text.rfind(_END, begin, begin + most)
        if cut < 0:
            cut = text.rfind(b" ", begin, begin + most)
        if cut < 0:
            after = [at for at in (text.find(_END, begin + most), text.find(b" ", begin + most)) if at >= 0]
            if not after:
                break
            cut = min(after)
        yield text[:cut], carried
        words = [] if text[cut:cut + 1] == _END else text[text.rfind(_END, 0, cut) + 1:cut].split()[1 - LONGEST:]
        carried, before = len(words), b"".join(word + b" " for word in words)
        text, begin = before + text[cut + 1:], len(before)
    yield text, carried


def coded(text: bytes) -> tuple[pa.Scalar, np.ndarray]:
    """The different words of a run of pieces, first of all the mark, with blanks between, and the place of each of its words among them."""
    letters = np.frombuffer(_END + b" " + text.replace(_END, b" " + _END + b" "), np.uint8)
    filled = letters != ord(" ")
    edges = np.flatnonzero(np.diff(filled, prepend=False, append=False))
    ends = np.cumsum(np.concatenate(([0], edges[1::2] - edges[::2])))
    words = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(letters[filled])]).dictionary_encode()
    known = words.dictionary.cast(pa.binary())
    return pc.binary_join(pa.ListArray.from_arrays([0, len(known)], known), b" ")[0], words.indices.to_numpy().view(np.uint32)[1:]


def _unique(words: np.ndarray, at: np.ndarray, length: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The index in ``at`` of one place, and the number, of each different phrase of ``length`` words among those that begin at ``at``."""
    codes = words[at]
    for k in range(1, length):
        if k > 1 and int(codes.max()) * size >= 2 ** 62:
            codes = np.unique(codes, return_inverse=True)[1]
        codes = codes * size + words[at + k]
    order = np.argsort(codes)
    codes = codes[order]
    begins = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return order[begins], np.diff(begins, append=len(codes))


_CODED = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("carried", pa.int32()), ("size", pa.int64()), ("known", pa.binary()),
                    ("codes", pa.binary())])
_CODED_ROW = "shard int, lang string, carried int, size long, known binary, codes binary"
_COUNTS = pa.schema([("length", pa.int8()), *[(w, pa.int64()) for w in _WORDS], ("lang", pa.string()), ("word", pa.binary()),
                     ("n", pa.int64()), ("last", pa.int16()), ("open", pa.bool_())])


def phrase_counts(known: list[bytes], codes: np.ndarray, carried: int, lang: str, seed: int, scan: int, reached: list[np.ndarray],
                  shards: int) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases active in ``scan``, for one coded run of pieces: one batch for each length.

    ``reached``: for lengths 1 to 3 the scan after which a slot had a frequent phrase, or 255. ``open``: the phrase's slot had none so far.
    """
    words = codes.astype(np.int64)
    salt = xxhash.xxh3_64_intdigest(lang.encode(), seed)
    keys = np.fromiter((xxhash.xxh3_64_intdigest(word, salt) for word in known), np.uint64, len(known))
    signed = keys.view(np.int64)

    def batch(length: int, columns: list, lang_, word, counts: np.ndarray, last, open_) -> pa.RecordBatch:
        n = len(counts)
        columns = [*columns, *[pa.nulls(n, pa.int64())] * (LONGEST - length)]
        return batch_of(_COUNTS, [np.full(n, length, dtype=np.int8), *columns, lang_, word, counts, last, open_])

    shift = np.uint64(64 - (len(reached[0]).bit_length() - 1))
    hashes = chained(keys, np.uint64(_SEED))
    own = reached[0][hashes >> shift].copy()
    own[0] = _NEVER
    if scan < shards:
        counts = np.bincount(words[carried:], minlength=len(known))
        counts[0] = 0
        some = np.flatnonzero(counts)
        if len(some):
            every = pa.array(known, pa.binary())
            yield batch(1, [signed[some]], [lang] * len(some), every.take(pa.array(some)), counts[some],
                        np.full(len(some), shards - 1, np.int16), own[some] == _NEVER)
    at, since, hashed = np.arange(len(words)), own[words], hashes[words]
    for length in range(2, LONGEST + 1):
        # Phrases of this length at ``at``: both subphrases, at ``at`` and one further, are there and have reached the limit.
        after = np.full(len(words) + 1, _NEVER, dtype=np.uint8)
        after[at] = since
        both = (after[at] != _NEVER) & (after[at + 1] != _NEVER)
        at, hashed = at[both], hashed[both]
        begun = np.maximum(after[at], after[at + 1]).astype(np.int16) + 1
        slots = None  # of the longest phrases they are not needed
        if length < LONGEST:
            hashed = chained(keys[words[at + length - 1]], hashed)
            slots = reached[length - 1][hashed >> shift]
        now = (begun <= scan) & (scan < begun + shards) & (at + length > carried)
        if now.any():
            chosen = np.flatnonzero(now)
            one, counts = _unique(words, at[chosen], length, len(known))
            one = chosen[one]
            yield batch(length, [signed[words[at[one] + k]] for k in range(length)], pa.nulls(len(one), pa.string()),
                        pa.nulls(len(one), pa.binary()), counts, begun[one] + (shards - 1),
                        np.ones(len(one), dtype=bool) if slots is None else slots[one] == _NEVER)
        if length < LONGEST:
            # Another phrase of the slot may have reached the limit before this one was counted at all.
            since = np.maximum(slots, begun.astype(np.uint8))


def _coding(shards: int, chunk: int):
    """Arrow batches of (lang, text) to coded chunks, dealt to the shards in turn."""
    def coding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = defaultdict(list)
        held: dict[str, int] = defaultdict(int)
        made = TaskContext.get().partitionId()

        def rows(lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
            nonlocal made
            for run, carried in runs(_END.join(texts), chunk):
                known, codes = coded(run)
                yield batch_of(_CODED, [[made % shards], [lang], [carried], [len(codes)], [known],
                                        [pa.compress(codes.tobytes(), "zstd", asbytes=True)]])
                made += 1

        for batch in batches:
            for begin in range(0, len(batch), 500):
                for lang, text in zip(*columns_of(batch.slice(begin, 500), "lang", "text")):
                    waiting[lang].append(pieces_of(text))
                    held[lang] += len(text) + 1
                if sum(held.values()) >= chunk:
                    for lang in sorted(held, key=held.get, reverse=True):
                        yield from rows(lang, waiting.pop(lang))
                        if sum(held.values()) - held.pop(lang) < chunk // 2:
                            break
        for lang, texts in waiting.items():
            yield from rows(lang, texts)

    return coding


def _scan(scan: int, seed: int, shared, shards: int):
    """Arrow batches of coded chunks to counts by chunk."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = shared.value.arrays
        for batch in batches:
            for at in range(len(batch)):
                lang, carried, size, known, codes = (batch.column(batch.schema.get_field_index(name))[at] for name in _CODED.names[1:])
                codes = np.frombuffer(pa.decompress(codes.as_buffer(), 4 * size.as_py(), "zstd"), np.uint32)
                for found in phrase_counts(known.as_py().split(), codes, carried.as_py(), lang.as_py(), seed, scan, reached, shards):
                    for begin in range(0, len(found), 1 << 15):
                        yield found.slice(begin, 1 << 15)

    return counted


def count_phrases(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, shards: int = SHARDS,
                  slot_bits: int = SLOT_BITS, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """All phrases (lang, length, phrase, n) of one to ``LONGEST`` words found ``least`` times or more, staged; and (lang, n), all words."""
    if not 1 <= shards <= 60:
        raise ValueError("shards must be 1 to 60")
    spark = docs.sparkSession
    corpus = staged(docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(utf8(f"`{text}`"), F.lit(b"")).alias("text"))
        .where(F.octet_length("text") > 0).mapInArrow(_coding(shards, chunk), _CODED_ROW), "shards", "shard")
    seed = 0
    while True:
        totals, reached = _scanned(corpus, least, shards, slot_bits, seed)
        words = staged(totals.where("length = 1").groupBy("w1", "lang", "word").agg(F.sum("n").alias("n")), "words")
        if words.groupBy("w1").count().where("count > 1").isEmpty():
            break
        seed += 1
    named = words.select(F.col("w1").alias("w"), "lang", F.col("word").cast("string").alias("word"), "n")
    # Most rows are of rare phrases, and go before the phrases are shuffled.
    shared = spark.sparkContext.broadcast(Slots([np.concatenate(reached)]))
    slot = F.shiftleft((F.col("length") - 1).cast("long"), slot_bits) + F.shiftrightunsigned(F.xxhash64(*_WORDS), 64 - slot_bits)
    longer = totals.where("length > 1").where(_in_slot(shared)(slot)) \
        .groupBy("length", *_WORDS).agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    longer = staged(longer.withColumn("id", F.monotonically_increasing_id()), "frequent-keys")
    spelled = longer.select("id", F.posexplode(F.array_compact(F.array(*_WORDS))).alias("at", "w")).join(
        named.where(F.col("n") >= least).select("w", "lang", "word"), "w") \
        .groupBy("id").agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    phrases = longer.join(spelled, "id").select(
        "lang", "length", F.array_join(F.transform("words", lambda w: w["word"]), " ").alias("phrase"), "n")
    single = named.where(F.col("n") >= least).select("lang", F.lit(1).cast("byte").alias("length"), F.col("word").alias("phrase"), "n")
    return staged(single.unionByName(phrases), "frequent-phrases"), named.groupBy("lang").agg(F.sum("n").alias("n"))


def _scanned(corpus: DataFrame, least: int, shards: int, slot_bits: int, seed: int) -> tuple[DataFrame, list[np.ndarray]]:
    """All scans until every phrase that became active has met every shard: the counts they wrote, and for each length the scans after
    which the slots reached the limit."""
    spark = corpus.sparkSession
    reached = [np.full(1 << slot_bits, _NEVER, dtype=np.uint8) for _ in range(LONGEST)]
    local = -(-least // shards)  # a phrase with less in every shard has less than ``least`` in all
    counts, open_, path, scan, final = None, None, None, 0, shards - 1
    while scan <= final:
        shared = spark.sparkContext.broadcast(Slots(reached[:-1]))
        here = staged(corpus.where(F.col("shard") == scan % shards).drop("shard").mapInArrow(_scan(scan, seed, shared, shards), _ROW), f"scan{scan}")
        shared.destroy()  # its counts are written
        counts = here if counts is None else counts.unionByName(here)
        # Running counts of the phrases that are still counted and have not reached the limit; ``met``: the scans that are in them.
        running = here.where("open").groupBy("length", F.xxhash64(*_WORDS).alias("hash")).agg(F.sum("n").alias("n"), F.max("last").alias("last")) \
            .where(F.col("n") >= local).withColumn("met", F.lit(1).cast("long"))
        if open_ is not None:
            running = running.unionByName(open_.where((F.col("n") < least) & (F.col("last") >= scan))) \
                .groupBy("length", "hash").agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.sum("met").alias("met"))
        done = path
        open_, path = stage(running, f"running{scan}")
        if done:
            release_path(spark, done)
        most = F.col("n") + (shards - F.col("met")) * (local - 1)
        slots = open_.where((F.col("n") >= least) | (F.col("last") <= scan) & (most >= least)).select(
            "length", F.shiftrightunsigned("hash", 64 - slot_bits).cast("int").alias("slot")).distinct().toArrow()
        final = max(final, here.agg(F.max("last")).first()[0] or 0)
        length, slot = (slots.column(c).to_numpy() for c in ("length", "slot"))
        for k, known in enumerate(reached, 1):
            new = slot[length == k]
            new = new[known[new] == _NEVER]
            known[new] = scan
            if len(new) and k < LONGEST:
                final = max(final, scan + shards)
        scan += 1
    release_path(spark, path)
    return counts, reached


class Slots:
    """For each length the scan after which a slot reached the limit; sent compressed, unpacked once by each Python worker."""

    def __init__(self, reached: list[np.ndarray]) -> None:
        self.size, self.packed = len(reached[0]), [pa.compress(x.tobytes(), "zstd", asbytes=True) for x in reached]

    @cached_property
    def arrays(self) -> list[np.ndarray]:
        return [np.frombuffer(pa.decompress(x, self.size, "zstd"), dtype=np.uint8) for x in self.packed]


def _in_slot(shared):
    @F.pandas_udf("boolean")
    def passes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        (reached,) = shared.value.arrays
        for slot in batches:
            yield pd.Series(reached[slot.to_numpy()] != _NEVER)

    return passes


def _exact(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def scored(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, length, a, l, r, score, covered) of all phrases of two words or more.

    For a cut after k words, l and r count its parts and the score is floor(2000000 * a / (l + r)); the lowest counts, then the
    smallest k. ``covered``: the phrase stands in a longer frequent one that has ``COVERED`` percent of its count.
    """
    words = F.split("phrase", " ")
    size = F.col("length").cast("int")
    part = lambda begin, count: F.array_join(F.slice("words", begin, count), " ")
    longer = frequent.where(F.col("length") > 1).withColumn("words", words)
    cuts = longer.select("lang", "phrase", "words", "length", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k")) \
        .select("lang", "phrase", "length", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, size - F.col("k")).alias("rest"))
    known = frequent.select("lang", F.col("phrase").alias("known"), F.col("n").alias("count"))
    left = known.withColumnsRenamed({"known": "first", "count": "l"})
    right = known.withColumnsRenamed({"known": "rest", "count": "r"})
    score = F.expr("cast(cast(2000000 * cast(a AS decimal(30,0)) AS decimal(38,0)) div cast(l + r AS decimal(38,0)) AS long)")
    weakest = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", score) \
        .groupBy("lang", "phrase", "length", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = longer.where(F.col("length") > 2).select("lang", "words", "n", size.alias("size")) \
        .select("lang", "words", "n", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("count")) \
        .select("lang", "words", "n", "count", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("count") + 1)).alias("begin")) \
        .select("lang", part(F.col("begin"), F.col("count")).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    covered = F.coalesce(_exact(F.col("most")) * 100 >= _exact(F.col("a")) * COVERED, F.lit(False))
    return weakest.join(inner, ["lang", "phrase"], "left").select(
        "lang", "phrase", "length", "a", "cut.l", "cut.r", "cut.score", covered.alias("covered"))


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, most: int = REPORT, **scans: int) -> DataFrame:
    """The first ``most`` phrases of every language that are not covered by a longer one: lang, rank, phrase, a, l, r, n, score."""
    frequent, words = count_phrases(docs, lang, text, least, **scans)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # First the best of each sixty-fourth of a language's phrases, so that no task ranks all of them.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    best = scored(frequent).where(~F.col("covered")).withColumn("part", part) \
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= most)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _oracle() -> str:
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS length, " + " || ' ' || ".join(f"w{i}" for i in range(k)) + f" AS phrase, count(*) AS n FROM grams "
        f"WHERE w{k - 1} IS NOT NULL GROUP BY ALL" for k in range(1, LONGEST + 1))
    leads = ", ".join(f"lead(w0, {k}) OVER o AS w{k}" for k in range(1, LONGEST))
    return rf"""
WITH pieces AS (SELECT row_number() OVER () AS piece, lang, words FROM
       (SELECT lang, unnest(list_transform(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]'), lambda p: regexp_extract_all(p, '[^\x20\x09]+'))) AS words
        FROM (SELECT coalesce(lang, '{UNKNOWN}') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents))),
words AS (SELECT piece, lang, unnest(words) AS w0, unnest(range(len(words))) AS i FROM pieces),
grams AS MATERIALIZED (SELECT lang, w0, {leads} FROM words WINDOW o AS (PARTITION BY piece ORDER BY i)),
totals AS (SELECT lang, count(*) AS n FROM grams GROUP BY 1),
frequent AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS words FROM ({grams}) WHERE n >= {LEAST}),
cuts AS (SELECT lang, phrase, length, n AS a, words, unnest(range(1, length)) AS k FROM frequent WHERE length > 1),
parts AS (SELECT *, array_to_string(words[:k], ' ') AS first, array_to_string(words[k + 1:], ' ') AS rest FROM cuts),
weak AS (SELECT p.lang, p.phrase, p.a, min(struct_pack(score := ((2000000::HUGEINT * p.a) // (l.n + r.n))::BIGINT, k := k, l := l.n, r := r.n)) AS cut
         FROM parts p JOIN frequent l ON l.lang = p.lang AND l.phrase = p.first JOIN frequent r ON r.lang = p.lang AND r.phrase = p.rest
         GROUP BY ALL),
begins AS (SELECT lang, n, words, length, unnest(range(2, length)) AS size FROM frequent WHERE length > 2),
inside AS (SELECT lang, n, words, size, unnest(range(1, length - size + 2)) AS begin FROM begins),
longer AS (SELECT lang, array_to_string(words[begin:begin + size - 1], ' ') AS phrase, max(n) AS most FROM inside GROUP BY ALL),
ranked AS (SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY cut.score DESC, a DESC, w.phrase) AS rank, w.phrase, a,
                  cut.l AS l, cut.r AS r, cut.score AS score
           FROM weak w LEFT JOIN longer g ON w.lang = g.lang AND w.phrase = g.phrase
           WHERE most IS NULL OR 100::HUGEINT * most < {COVERED}::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {REPORT}"""


ORACLE = _oracle()
