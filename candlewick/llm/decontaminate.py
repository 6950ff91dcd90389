"""Benchmark decontamination: templates of texts whose numbers, names and units stand open, joined window by window.

Words lose the punctuation around them and are typed: numbers become ``<num>``, units ``<unit>``, capitalised words that do not begin
a sentence or line ``<name>`` (several in a row are one name), anything else its lower-case form; tokens without letters or
digits (and punctuation) are passed by. Every ``WINDOW`` tokens in a row are a template window; its slots hold the values.

Windows of benchmark items and documents meet in a hash join. Before it, document windows are tested against a bitmap of the
items' window hashes, of fixed size whatever the benchmark's, so only windows that (almost surely) match are shuffled. Matches of one
item and document at one distance are an alignment; within it the same value of the item must always stand for the same value of the
document (by slot type). A re-parameterised question passes, an accidental match of placeholders does not.

Phrases that many items share ("what is the value of the") would pair every document that has one with all these items. So an item's
rarest windows are its probes: as few as leave too little covered without them. A document without a probe of an item cannot
hold it, and only the pairs that meet in a probe are matched in full. The filter is exact.

A document is contaminated by an item if its consistent alignments cover at least ``COVERAGE`` of the item's tokens. Items of
fewer than ``WINDOW`` tokens, or whose windows are nearly all slots (fewer than ``LITERALS`` literal words), cannot be found.
Equal items count as one, named by the smallest item_id; different texts with one item_id are items of their own, and one without
item_id contaminates without being named. Null texts have no windows; repeated rows are judged alike.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.llm.common import batch_of, chunks, columns_of, staged, table, text_key, utf8

WINDOW = 5
COVERAGE = 0.8
LITERALS = 2
#: Bits of the bitmap as a power of two: 16 MiB.
BITMAP = 27

NUM, NAME, UNIT = "<num>", "<name>", "<unit>"
#: Words taken for units of measure, money and time.
UNITS = frozenset(("mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons tonnes lb lbs "
                   "pound pounds oz ounce ounces ml l liter liters litre litres gallon gallons second seconds sec minute minutes min hour "
                   "hours day days week weeks month months year years percent degree degrees celsius fahrenheit kelvin watt watts kw volt "
                   "volts amp amps joule joules newton newtons hz khz mhz ghz kb mb gb tb dollar dollars cent cents euro euros usd eur "
                   "gbp yen kmh mph m2 m3 km2 cm2 cm3").split())
_CORE = re.compile(r"^[\W_]*(.*?)[\W_]*$", re.S)
_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*(?:[eE][+-]?\d+)?(?:st|nd|rd|th)?$")
_MIXED = re.compile(r"([+-]?\d[\d.,]*)([a-zA-Z%]+\d?)$")
_SYMBOL_UNITS = "$€£%°"


def word_tokens(word: str) -> tuple[tuple[tuple[str, str], ...], bool]:
    """(template, value) of a word, and whether it ends a sentence. A capitalised word has template NAME and must be judged by place."""
    if word.isalpha() and word.islower() and word not in UNITS:
        return ((word, word),), False
    core = _CORE.match(word)[1]
    stops = word.rstrip("\"')]}»”’")[-1:] in (".", "!", "?", ":")
    if not core:
        return (), stops
    signs = tuple((UNIT, c) for c in word if c in _SYMBOL_UNITS)
    if _NUMBER.match(core):
        return (*((s for s in signs if s[1] != "%" and s[1] != "°")), (NUM, core), *((s for s in signs if s[1] in "%°"))), stops
    mixed = _MIXED.match(core)
    if mixed and mixed[2].lower() in UNITS:
        return ((NUM, mixed[1]), (UNIT, mixed[2].lower())), stops
    low = core.lower()
    if low in UNITS:
        return ((UNIT, low),), stops
    if core[0].isupper() and not (len(core) > 1 and core.isupper()):
        return ((NAME, low),), stops
    return ((low, low),), stops


class Lexicon(dict):
    """Number of each word met so far, and by number: how many tokens it has, whether it ends a sentence, whether it is
    capitalised, the hash of its (first) token's template, and whether that is a slot."""

    def __init__(self) -> None:
        super().__init__()
        self.words: list[str] = []
        self.count, self.stops, self.capital, self.slot = (array("b") for _ in range(4))
        self.hash = array("Q")

    def __missing__(self, word: str) -> int:
        tokens, stops = word_tokens(word)
        number = self[word] = len(self.words)
        self.words.append(word)
        kind, value = tokens[0] if tokens else ("", "")
        self.count.append(len(tokens))
        self.stops.append(stops)
        self.capital.append(kind is NAME)
        self.slot.append(kind in (NUM, UNIT))
        self.hash.append(kind_hash(value if kind is NAME else kind))
        return number


def kind_hash(kind: str) -> int:
    return xxhash.xxh3_64_intdigest(kind)


_SLOTS = frozenset((NUM, NAME, UNIT))
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) | 1 for k in range(1, WINDOW + 1)], dtype=np.uint64)
_NAME_HASH = np.uint64(kind_hash(NAME))


def template_windows(texts: list[bytes | None], lexicon: Lexicon, bitmap: np.ndarray | None = None) -> Iterator[tuple]:
    """(place of the text, hash, position, template, slots, tokens of the text) of the windows with literals enough; with a bitmap
    only those whose hash it has."""
    if len(lexicon) > 500_000:
        lexicon.clear()
        lexicon.__init__()
    lines = [(i, words) for i, text in enumerate(texts) if text
             for line in text.decode("utf-8", "replace").split("\n") if (words := line.split())]
    sizes = np.array([len(words) for _, words in lines], dtype=np.int64)
    word = np.fromiter(map(lexicon.__getitem__, chain.from_iterable(words for _, words in lines)), np.int64, int(sizes.sum()))
    if not len(word):
        return
    line = np.repeat(np.arange(len(lines)), sizes)
    count, stops, capital, slot = (np.frombuffer(x, dtype=np.int8)[word] for x in (
        lexicon.count, lexicon.stops, lexicon.capital, lexicon.slot))
    # One row for each token; where sentences begin shows in how many ended (or lines passed) before.
    at = np.repeat(np.arange(len(word)), count)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(count, dtype=np.int64) - count, count)
    kind = np.frombuffer(lexicon.hash, dtype=np.uint64)[word[at]]
    is_slot = slot[at] > 0
    for k in np.flatnonzero(count[at] > 1):  # a number with its unit
        kind_text = word_tokens(lexicon.words[word[at[k]]])[0][nth[k]][0]
        kind[k], is_slot[k] = kind_hash(kind_text), kind_text in _SLOTS
    ended = (np.cumsum(stops, dtype=np.int64) - stops + line)[at]
    begins = np.ones(len(at), dtype=bool)
    begins[1:] = ended[1:] > ended[:-1]
    name = (capital[at] > 0) & ~begins
    merged = np.zeros(len(at), dtype=bool)
    merged[1:] = name[1:] & name[:-1]
    rows = np.flatnonzero(~merged)
    owner = np.array([i for i, _ in lines])[line[at[rows]]]
    if len(rows) < WINDOW:
        return
    kind = np.where(name, _NAME_HASH, kind)[rows]
    literal = np.concatenate(([0], np.cumsum(~(name | is_slot)[rows])))
    n = len(rows) - WINDOW + 1
    hashed = np.zeros(n, dtype=np.uint64)
    for j in range(WINDOW):
        hashed += kind[j:j + n] * _FACTORS[j]
    hashed ^= hashed >> np.uint64(31)
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    hashed ^= hashed >> np.uint64(29)
    use = (owner[:n] == owner[WINDOW - 1:]) & (literal[WINDOW:] - literal[:n] >= LITERALS)
    if bitmap is not None:
        bit = hashed >> np.uint64(64 - BITMAP)
        use &= (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1) > 0
    first = np.searchsorted(owner, np.arange(len(texts)))
    total = np.bincount(owner, minlength=len(texts))
    for k in np.flatnonzero(use).tolist():
        kinds, slots = [], []
        for r in range(k, k + WINDOW):
            begin, end = rows[r], rows[r + 1] if r + 1 < len(rows) else len(at)
            kind_text, value = word_tokens(lexicon.words[word[at[begin]]])[0][nth[begin]]
            if name[begin]:
                value = " ".join(word_tokens(lexicon.words[word[at[t]]])[0][0][1] for t in range(begin, end))
            elif kind_text is NAME:
                kind_text = value
            kinds.append(kind_text)
            if kind_text in _SLOTS:
                slots.append(kind_text + value)
        yield (int(owner[k]), int(hashed[k:k + 1].view(np.int64)[0]), k - int(first[owner[k]]), " ".join(kinds), slots, int(total[owner[k]]))


_WINDOWS = pa.schema([("key", pa.binary()), ("hash", pa.int64()), ("pos", pa.int32()), ("template", pa.string()),
                      ("slots", pa.list_(pa.string())), ("size", pa.int32())])
_WINDOW_ROWS = "key binary, hash long, pos int, template string, slots array<string>, size int"


def _windows(batches: Iterator[pa.RecordBatch], bitmap: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Template windows of (key, text)."""
    lexicon = Lexicon()
    for batch in batches:
        keys, texts = columns_of(batch, "key", "text")
        for begin, end in chunks([t or b"" for t in texts]):
            found = [(keys[begin + i], *row) for i, *row in template_windows(texts[begin:end], lexicon, bitmap)]
            for some in range(0, len(found), 50_000):
                yield batch_of(_WINDOWS, [list(x) for x in zip(*found[some:some + 50_000])])


def item_windows(benchmark: DataFrame, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """Windows of the distinct items (item_key, item, hash, pos, template, slots), staged; ``item_key`` is the item's ``text_key`` and
    tells items apart, as ids may be null or shared."""
    items = benchmark.where(F.col(text).isNotNull()).groupBy(text_key(text).alias("key")).agg(
        F.min(id_column).alias("item"), F.first(utf8(text)).alias("text"))
    found = items.select("key", "text").mapInArrow(lambda batches: _windows(batches, None), _WINDOW_ROWS)
    return staged(found.join(items.select("key", "item"), "key").withColumnRenamed("key", "item_key"), "items")


def bitmap_of(items: DataFrame) -> np.ndarray:
    """One bit for each hash prefix that an item window has; gathered as distinct bytes, so never more than the bitmap itself."""
    cells = items.select(F.shiftrightunsigned("hash", 64 - BITMAP).alias("at")).selectExpr(
        "shiftright(at, 3) AS byte", "shiftleft(1, cast(at & 7 AS int)) AS bit").groupBy("byte").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(1 << (BITMAP - 3), dtype=np.uint8)
    bitmap[cells["byte"].to_numpy()] = cells["bits"].to_numpy().astype(np.uint8)
    return bitmap


_PLACES = pa.schema([("item_key", pa.binary()), ("hash", pa.int64()), ("template", pa.string())])


def _probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows (item_key, hash, template) of which a text that covers ``COVERAGE`` of the item must have one: from the rarest on,
    until those that are left cover less."""
    for batch in batches:
        keys, windows = columns_of(batch, "item_key", "windows")
        out = []
        for key, rows in zip(keys, windows):
            rows.sort(key=lambda w: (w["items"], w["hash"], w["pos"]))
            held = Counter(place for w in rows for place in range(w["pos"], w["pos"] + WINDOW))
            size = left = len(held)
            for w in rows:
                if left < size * COVERAGE:
                    break
                out.append((key, w["hash"], w["template"]))
                for place in range(w["pos"], w["pos"] + WINDOW):
                    held[place] -= 1
                    left -= not held[place]
        yield batch_of(_PLACES, list(zip(*out)) if out else [[], [], []])


def probes_of(items: DataFrame) -> DataFrame:
    """The probes of all items (item_key, hash, template), staged. A window is rare if few items have it."""
    shared = items.groupBy("hash", "template").agg(F.countDistinct("item_key").alias("items"))
    listed = items.join(shared, ["hash", "template"]).groupBy("item_key").agg(
        F.collect_list(F.struct("items", "hash", "pos", "template")).alias("windows"))
    return staged(listed.mapInArrow(_probes, "item_key binary, hash long, template string").distinct(), "probes")


def contaminations(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """(key, item_key, item, covered): which items each distinct text holds; ``key`` is its ``text_key``."""
    items = item_windows(benchmark)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap_of(items))
    slim = docs.select(text_key(text).alias("key"), utf8(text).alias("text"))
    near = slim.mapInArrow(lambda batches: _windows(batches, shared.value), _WINDOW_ROWS).dropDuplicates(["key", "pos"])
    near = staged(near.drop("size"), "near")
    one = items.select("item_key", "hash", "template", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))
    pairs = near.join(probes_of(items), ["hash", "template"]).select("key", "item_key").distinct()
    met = near.join(pairs.join(one, "item_key"), ["key", "hash", "template"]).withColumn("distance", F.col("pos") - F.col("item_pos"))
    met = staged(met.select("key", "item_key", "distance", "item_pos", "item_slots", "slots"), "matches")
    # Within an alignment each value of the item stands for one value of the document.
    pairs = met.select("key", "item_key", "distance", F.explode(F.arrays_zip("item_slots", "slots")).alias("p")) \
        .groupBy("key", "item_key", "distance", F.col("p.item_slots").alias("of")).agg(
            (F.min("p.slots") != F.max("p.slots")).alias("torn")).where("torn").select("key", "item_key", "distance").distinct()
    sound = met.join(pairs, ["key", "item_key", "distance"], "left_anti")
    covered = sound.select("key", "item_key", F.explode(F.sequence("item_pos", F.col("item_pos") + (WINDOW - 1))).alias("place")) \
        .groupBy("key", "item_key").agg(F.countDistinct("place").alias("covered"))
    sizes = items.select("item_key", "item", F.explode(F.sequence("pos", F.col("pos") + (WINDOW - 1))).alias("place")) \
        .groupBy("item_key").agg(F.countDistinct("place").alias("size"), F.first("item").alias("item"))
    return covered.join(sizes, "item_key").where(F.col("covered") >= F.col("size") * COVERAGE) \
        .select("key", "item_key", "item", (F.col("covered") / F.col("size")).alias("covered"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, whether the document is contaminated, the items it holds, and the largest covered share."""
    found = contaminations(docs, benchmark, text).groupBy("key").agg(
        F.sort_array(F.collect_set("item")).alias("items"), F.max("covered").alias("covered"))
    slim = docs.select(F.col(id_column).alias(id_column), text_key(text).alias("key"))
    return slim.join(found, "key", "left").select(
        id_column, F.col("covered").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"), F.coalesce("covered", F.lit(0.0)).alias("covered"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without a benchmark item, all columns."""
    found = staged(contaminations(docs, benchmark, text).select(F.col("key").alias("_cw_found")).distinct(), "contaminated")
    return docs.withColumn("_cw_key", text_key(text)).join(found, F.col("_cw_key") == F.col("_cw_found"), "left_anti").drop("_cw_key")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
