"""Vector code compression: product quantisation in whole numbers, with distances looked up in per-dimension value dictionaries.

Components become integers floor(SCALE * x) and vectors are cut into ``parts`` equal parts, each with a codebook of ``entries``
entries: at first that part of the vectors with the smallest ids, then for ``rounds`` rounds the componentwise floor of the mean of
the parts nearest to an entry (ties: the lower index; an entry without parts stays). The codes are the nearest entries at the end.

The rows are staged once as blocks of up to ``BLOCK`` vectors. A block holds, for each dimension, the dictionary of its distinct
integers and the vectors as codes into it. In a round a task tabulates, for each dimension, the squared differences of every dictionary
value to all entries; a part's distances are then gathers from these tables and additions. A dictionary is at most as long as its
block, so memory does not depend on the table. Tasks add up sums and counts for each entry; what reaches the driver in a round is
one row for each entry and dimension. Everything is exact: values too large for 64 bits are computed as Python's integers.

Dropped are rows whose vector is null, holds a null or a non-finite number, or cannot be coded: its length is no positive multiple of
``parts``, or not that of the first vector, the one with the smallest id whose length is such a multiple. Of rows with the same id the
one with the least vector starts a codebook; null ids come after all others. With fewer ids than entries the codebooks are shorter. An
error beyond 64 bits is given as the largest of them. Repeated rows are coded alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from candlewick.llm.common import batch_of, joined_by_weight, staged, table

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors in a block; positions in its dictionaries fit into 16 bits.
BLOCK = 4096
_MOST = 2 ** 63 - 1
#: Integers up to here can be added and squared in 64 bits, for vectors of up to 4,096 dimensions.
_SMALL = 2 ** 24


def whole(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), exactly: of Python's integers where 64 bits might not do."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    if not values.size or np.abs(scaled).max() <= _SMALL:
        return scaled.astype(np.int64)
    return np.array([floor(Fraction(float(x)) * SCALE) for x in values.ravel()], dtype=object).reshape(values.shape)


def usable(vectors: Column, parts: int) -> Column:
    """Neither null nor with nulls or non-finite numbers, and of a length that can be cut. Three-valued logic ends in false."""
    finite = F.forall(vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vectors) > 0) & (F.size(vectors) % parts == 0) & finite, F.lit(False))


#: ``dictionary`` holds 64-bit integers; of a block that needs larger ones it is null, and ``wide`` has them in decimal.
_BLOCK = "ids array<bigint>, labels array<{label}>, sizes array<int>, dictionary array<bigint>, wide array<string>, codes binary"


def _blocks(block: int, label: pa.DataType):
    """Arrow batches of (id, label, vector) to blocks, whose dictionaries stand one after the other."""
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("labels", pa.list_(label)), ("sizes", pa.list_(pa.int32())),
                        ("dictionary", pa.list_(pa.int64())), ("wide", pa.list_(pa.string())), ("codes", pa.binary())])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), block):
                part = batch.slice(begin, block)
                vectors = part.column(2)
                values = whole(vectors.flatten().to_numpy(zero_copy_only=False)).reshape(len(part), -1)
                dictionaries, codes = zip(*(np.unique(column, return_inverse=True) for column in values.T))
                every, is_wide = np.concatenate(dictionaries), values.dtype == object
                yield batch_of(schema, [
                    [part.column(0).to_pylist()], [part.column(1).to_pylist()], [[len(d) for d in dictionaries]],
                    [None if is_wide else every], [list(map(str, every)) if is_wide else None],
                    [np.array(codes, dtype=np.uint16).tobytes()]])

    return coded


def _opened(row: dict) -> tuple[list[np.ndarray], np.ndarray]:
    """The dictionaries of a block and its codes by dimension."""
    if row["wide"] is None:
        values = np.array(row["dictionary"], dtype=np.int64)
    else:
        values = np.array([int(x) for x in row["wide"]], dtype=object)
    dictionaries = np.split(values, np.cumsum(row["sizes"])[:-1])
    return dictionaries, np.frombuffer(row["codes"], dtype=np.uint16).reshape(len(dictionaries), -1)


def nearest(dictionaries: list[np.ndarray], codes: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance (part, vector); ``book``: (part, entry, place in the part)."""
    parts, entries, width = book.shape
    at, least = [], []
    for part in range(parts):
        distance = None
        for place in range(width):
            values = dictionaries[part * width + place]
            squared = (values[:, None] - book[part, :, place][None, :]) ** 2
            gathered = squared[codes[part * width + place]]
            distance = gathered if distance is None else distance + gathered
        best = np.argmin(distance, axis=1)
        at.append(best)
        least.append(distance[np.arange(len(best)), best])
    return np.array(at), np.array(least)


def as_book(values: list) -> np.ndarray:
    flat = [abs(x) for part in values for entry in part for x in entry]
    return np.array(values, dtype=np.int64 if max(flat) <= _SMALL else object)


def limbs(value: int) -> list[int]:
    """The integer in base 2 ** 62, lowest first, every limb with its sign."""
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value or not out:
        out.append(sign * (value & (2 ** 62 - 1)))
        value >>= 62
    return out


def _sums(shared):
    """Blocks to sums (part, entry, place, limb, total, n) over all blocks of a task."""
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("limb", pa.int32()),
                        ("total", pa.int64()), ("n", pa.int64())])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = as_book(shared.value)
        parts, entries, width = book.shape
        counts = np.zeros((parts, entries), dtype=np.int64)
        totals = np.zeros(book.shape, dtype=object)
        for batch in batches:
            for row in batch.to_pylist():
                dictionaries, codes = _opened(row)
                best, _ = nearest(dictionaries, codes, book)
                for part in range(parts):
                    counts[part] += np.bincount(best[part], minlength=entries)
                    for place in range(width):
                        # How often each dictionary value meets each entry, times the value.
                        values = dictionaries[part * width + place]
                        met = np.bincount(codes[part * width + place].astype(np.int64) * entries + best[part],
                                          minlength=len(values) * entries).reshape(-1, entries)
                        totals[part, :, place] += (met * values[:, None]).sum(axis=0)
        rows = [(part, entry, place, limb, total, int(counts[part, entry]) if limb == 0 else 0)
                for part, entry in np.argwhere(counts).tolist() for place in range(width)
                for limb, total in enumerate(limbs(int(totals[part, entry, place])))]
        if rows:
            yield batch_of(schema, zip(*rows))

    return added


def _codes(shared, label: pa.DataType):
    schema = pa.schema([("id", pa.int64()), ("label", label), ("code", pa.string()), ("error", pa.int64())])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = as_book(shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                best, least = nearest(*_opened(row), book)
                errors = [min(int(e), _MOST) for e in least.sum(axis=0)]
                yield batch_of(schema, [row["ids"], row["labels"], [bytes(code).hex() for code in best.T.tolist()], errors])

    return coded


def first_vectors(slim: DataFrame, most: int) -> list[list[float]]:
    """The least vector of each of the ``most`` smallest ids, all of the first one's length. One pass takes that many rows; more
    passes are needed only where ids repeat among them, and each gives another id."""
    found: dict = {}
    rest, size = slim.select("id", "vector"), None
    while len(found) < most:
        rows = rest.orderBy(F.col("id").asc_nulls_last(), "vector").limit(most).collect()
        for row in rows:
            size = size or len(row["vector"])
            if len(row["vector"]) == size:
                found.setdefault(row["id"], row["vector"])
        if len(rows) < most or None in found:
            break
        done = max(found)
        rest = slim.select("id", "vector").where((F.size("vector") == size) & (F.col("id").isNull() | (F.col("id") > done)))
    return list(found.values())[:most]


class Codes:
    """Result of ``compress``: ``rows`` (id, label, code, error) and ``books`` (part, entry, place)."""

    def __init__(self, rows: DataFrame, books: list):
        self.rows, self.books = rows, books

    @property
    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and place."""
        return hashlib.sha256(",".join(str(x) for part in self.books for entry in part for x in entry).encode()).hexdigest()


def compress(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK) -> Codes:
    """Codes of all usable vectors, and the codebooks. At most 256 entries."""
    if not (1 <= entries <= 256 and 1 <= block <= 1 << 16 and parts >= 1 and rounds >= 0):
        raise ValueError("entries must be 1 to 256, block 1 to 65,536, parts at least 1 and rounds at least 0")
    spark = vectors.sparkSession
    slim = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{label}`").alias("label"),
                          F.col(f"`{vector}`").cast("array<double>").alias("vector")).where(usable(F.col("vector"), parts))
    start = first_vectors(slim, entries)
    kind = dict(slim.dtypes)["label"]
    arrow = to_arrow_type(slim.schema["label"].dataType)
    if not start:
        return Codes(slim.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).limit(0), [[]] * parts)
    kept, width = slim.where(F.size("vector") == len(start[0])), len(start[0]) // parts
    books = [[[int(x) for x in entry[p * width:(p + 1) * width]] for entry in whole(np.array(start))] for p in range(parts)]
    blocks = staged(kept.mapInArrow(_blocks(block, arrow), _BLOCK.format(label=kind)), "vector-blocks")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)
        sums = blocks.select("sizes", "dictionary", "wide", "codes").mapInArrow(
            _sums(shared), "part int, entry int, place int, limb int, total long, n long") \
            .groupBy("part", "entry", "place", "limb").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        totals, counts = Counter(), Counter()
        for part, entry, place, limb, total, n in sums.collect():
            totals[part, entry, place] += int(total) << 62 * limb
            counts[part, entry, place] += n
        for (part, entry, place), n in counts.items():
            books[part][entry][place] = totals[part, entry, place] // n
    shared = spark.sparkContext.broadcast(books)
    return Codes(blocks.mapInArrow(_codes(shared, arrow), f"id long, label {kind}, code string, error long"), books)


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` (id, label, code, error) with the sum of the errors of equal labels, nulls together."""
    rows = staged(rows, "vector-codes").select("*", F.col("label").isNull().alias("none"),
                                               F.coalesce(F.col("label").cast("string"), F.lit("")).alias("value"))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_MOST).cast("decimal(38,0)")).cast("long")
    sums = staged(rows.groupBy("none", "value").agg(F.count("*").alias("n"), total.alias("label_error")), "label-errors")
    return joined_by_weight(rows, sums, ["none", "value"], "n").drop("none", "value")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compress(table(spark, sf_dir, "embeddings"))
    return with_label_error(found.rows).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(found.digest).alias("codebooks_sha256"))


def _oracle() -> str:
    usable_ = ("embedding IS NOT NULL AND len(embedding) > 0 AND "
               "len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0")
    floor_of = "(total - ((total % n) + n) % n) // n"
    steps = [f"""
kept AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, label, embedding FROM embeddings WHERE {usable_}),
x AS MATERIALIZED (SELECT row, (i - 1) // (d // {PARTS}) AS part, (i - 1) % (d // {PARTS}) AS place, floor({SCALE} * v::DOUBLE)::HUGEINT AS v
      FROM (SELECT row, len(embedding) AS d, unnest(embedding) AS v, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
book0 AS MATERIALIZED (SELECT part, entry, place, v FROM x JOIN
         (SELECT row, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {ENTRIES}) USING (row))"""]
    for k in range(ROUNDS + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (SELECT row, part, min(struct_pack(d := d, entry := entry)) AS best FROM
          (SELECT row, x.part, entry, sum((x.v - b.v) * (x.v - b.v)) AS d FROM x JOIN book{k} b ON x.part = b.part AND x.place = b.place
           GROUP BY ALL) GROUP BY ALL)""")
        if k < ROUNDS:
            steps.append(f"""
book{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.place, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN
         (SELECT part, entry, place, {floor_of} AS v FROM
           (SELECT x.part, best.entry AS entry, place, sum(x.v)::HUGEINT AS total, count(*) AS n FROM x JOIN near{k} USING (row, part)
            GROUP BY ALL)) m ON b.part = m.part AND b.entry = m.entry AND b.place = m.place)""")
    return f"""WITH {",".join(steps)},
digest AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, place)) AS sha FROM book{ROUNDS}),
coded AS (SELECT row, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
          FROM near{ROUNDS} GROUP BY row)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT sha FROM digest) AS codebooks_sha256
FROM coded JOIN kept USING (row)"""


ORACLE = _oracle()
