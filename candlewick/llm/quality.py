"""Quality rules: per-document word statistics and lines that too many documents of a host share.

Base rules, on words (runs without ASCII white space): a document fails with fewer than ``MIN_WORDS`` words or with more than
``MAX_REPEATED`` percent of its words in 5-word windows that occur twice or more.

Cross-document rule: lines are normalised (white space runs to one space, A-Z lower-cased, digits to 0) and hashed; a line is
boilerplate of its host if the host's documents with it, counted by distinct text, are more than ``MIN_DOCUMENTS``; lines of fewer
than ``SHORT_LINE`` words, which also meet by chance, must be in more than ``MAX_SHARE`` of the host's distinct texts too. So for any
longer line no other documents of the host change the verdict. Exact copies count once: they are for deduplication to judge.
Boilerplate lines are removed except from the document with the smallest id that has them (so no text is lost altogether), and a document is rejected
if fewer than ``MIN_WORDS`` words or less than ``MIN_LEFT`` of its words remain.

One Python pass over the texts writes the statistics and each line's hash; the counting is grouped by line with partial sums, and
its result holds only lines above the limit. Null text has no words and fails; a null host is a host of its own; repeated rows
are judged alike; an empty table gives no rows; extra columns are kept by ``clean`` and may have any name but the marked ones
(``_cw_`` in front).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.llm.common import batch_of, columns_of, staged, table, text_key, utf8

MIN_WORDS = 10
MAX_REPEATED = 20
WINDOW = 5
MIN_DOCUMENTS = 50
MAX_SHARE = 0.05
SHORT_LINE = 4
MIN_LEFT = 0.2
#: Most boilerplate lines that are broadcast; beyond, Spark chooses the join.
BROADCAST_LINES = 200_000

SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(set(range(256)) - set(SYMBOLS))
_CONTINUATION = bytes(range(0x80, 0xC0))
_DIGITS = bytes.maketrans(b"123456789", b"000000000")


def characters(data: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return len(data.translate(None, _CONTINUATION))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    windows = list(zip(*(words[i:] for i in range(window))))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    total = end = 0
    for i, found in enumerate(windows):
        if counts[found] > 1:
            total += i + window - max(end, i)
            end = i + window
    return total


def line_hash(line: bytes) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(line.split()).lower().translate(_DIGITS)) - (1 << 63)


def statistics(text: bytes | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, then hash, word count and number of each line with a word."""
    text = text or b""
    words = text.split()
    seen, repeated, lines = set(), 0, []
    for number, line in enumerate(text.split(b"\n")):
        count = len(line.split())
        if count:
            repeated += line in seen
            seen.add(line)
            lines.append((line_hash(line), count, number))
    return (len(words), characters(b"".join(words)), len(text.translate(None, _NOT_SYMBOLS)), repeated, repeated_words(words),
            *([line[i] for line in lines] for i in range(3)))


_STATISTICS = ("id long, host string, text_key binary, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
               "n_repeat_words long, lines array<long>, line_words array<int>, line_at array<int>")
_ARROW = pa.schema([
    ("id", pa.int64()), ("host", pa.string()), ("text_key", pa.binary()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("lines", pa.list_(pa.int64())),
    ("line_words", pa.list_(pa.int32())), ("line_at", pa.list_(pa.int32()))])


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 1000):
            part = batch.slice(at, 1000)
            (texts,) = columns_of(part, "text")
            rows = [statistics(text) for text in texts]
            yield batch_of(_ARROW, [*(part.column(n) for n in ("id", "host", "text_key")), *map(list, zip(*rows))])


def _judged(docs: DataFrame, id_column: str, host: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Statistics and verdict of every row, and the boilerplate lines (host, line, keeper)."""
    slim = docs.select(F.col(id_column).cast("long").alias("id"), F.col(host).cast("string").alias("host"),
                       text_key(text).alias("text_key"), utf8(text).alias("text"))
    rows = staged(slim.mapInArrow(_measured, _STATISTICS).withColumn("row", F.monotonically_increasing_id()), "quality")
    host_texts = rows.groupBy("host").agg(F.countDistinct("text_key").alias("host_texts"))
    lines = rows.select("row", "id", "host", "text_key", F.explode(F.arrays_zip("lines", "line_words", "line_at")).alias("l")) \
        .select("row", "id", "host", "text_key", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words"),
                F.col("l.line_at").alias("at"))
    one_per_text = lines.groupBy("host", "line", "text_key").agg(F.min("id").alias("id"), F.max("words").alias("words"))
    frequent = one_per_text.groupBy("host", "line").agg(
        F.count("*").alias("texts"), F.max("words").alias("words"), F.min(F.struct("id", "text_key")).alias("first")).where(F.col("texts") > MIN_DOCUMENTS)
    frequent = frequent.join(host_texts, frequent["host"].eqNullSafe(host_texts["host"])) \
        .where((F.col("words") >= SHORT_LINE) | (F.col("texts") > F.col("host_texts") * MAX_SHARE)) \
        .select(frequent["host"], "line", F.col("first.text_key").alias("keeper"))
    frequent = staged(frequent, "boilerplate")
    side = F.broadcast(frequent) if frequent.count() <= BROADCAST_LINES else frequent
    lost = lines.join(side, lines["host"].eqNullSafe(side["host"]) & (lines["line"] == side["line"])
                      & (lines["text_key"] != side["keeper"])) \
        .groupBy("row").agg(F.sum("words").alias("words_lost"), F.count("*").cast("long").alias("lines_lost"),
                            F.collect_list("at").alias("gone"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    left = F.col("n_words") - F.coalesce("words_lost", F.lit(0))
    judged = rows.drop("lines", "line_words", "line_at").join(lost, "row", "left").withColumns({
        "words_left": left, "lines_lost": F.coalesce("lines_lost", F.lit(0)), "base_failed": failed,
        "kept": ~failed & (left >= MIN_WORDS) & (left >= F.col("n_words") * MIN_LEFT)})
    return judged, frequent


def quality(docs: DataFrame, id_column: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """Statistics and verdict of every document."""
    judged, _ = _judged(docs, id_column, host, text)
    return judged.select(F.col("id").alias(id_column), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "lines_lost", "words_left")


def clean(docs: DataFrame, id_column: str = "doc_id", host: str = "source", text: str = "text",
          n_chars: str = "n_chars") -> DataFrame:
    """The kept documents without boilerplate lines, all columns of ``docs``; ``n_chars`` follows where lines went."""
    judged, _ = _judged(docs, id_column, host, text)
    per_text = judged.groupBy("host", "text_key").agg(
        F.first("kept").alias("_cw_kept"), F.first("gone", ignorenulls=True).alias("_cw_gone")) \
        .where(~F.col("_cw_kept") | F.col("_cw_gone").isNotNull()) \
        .select(F.col("host").alias("_cw_host"), F.col("text_key").alias("_cw_key"), "_cw_kept", "_cw_gone")
    marked = docs.withColumns({"_cw_own": text_key(text), "_cw_own_host": F.col(host).cast("string")})
    kept = marked.join(per_text, (F.col("_cw_own") == F.col("_cw_key")) & F.col("_cw_own_host").eqNullSafe(F.col("_cw_host")),
                       "left").where(F.coalesce("_cw_kept", F.lit(True)))
    left = F.filter(F.split(F.col(f"`{text}`"), "\n", -1), lambda line, at: ~F.array_contains("_cw_gone", at))
    new = F.when(F.col("_cw_gone").isNull(), F.col(f"`{text}`")).otherwise(F.array_join(left, "\n"))
    out = {c: F.col(f"`{c}`") for c in docs.columns}
    out[text] = new
    if n_chars in out:
        out[n_chars] = F.when(F.col("_cw_gone").isNull(), F.col(n_chars)).otherwise(F.length(new)).cast(docs.schema[n_chars].dataType)
    return kept.select(*(value.alias(name) for name, value in out.items()))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


_WORD = r"[^\x20\x09-\x0D]+"
ORACLE = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i
          FROM (SELECT doc_id, regexp_extract_all(text, '{_WORD}') AS w FROM d)),
grams AS (SELECT *, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c, lead(word, 3) OVER o AS e, lead(word, 4) OVER o AS f
          FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT *, f IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, word, b, c, e, f) > 1 AS again FROM grams),
marked AS (SELECT doc_id, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS 4 PRECEDING) AS hit FROM twice),
by_words AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars, count_if(hit) AS n_repeat_words FROM marked GROUP BY 1),
lines AS (SELECT *, len(regexp_extract_all(line, '{_WORD}')) AS n,
                 trim(regexp_replace(translate(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '123456789',
                                               '000000000'), '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') AS norm
          FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '{_WORD}')),
by_lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY 1),
hosts AS (SELECT source, count(DISTINCT text) AS texts FROM d GROUP BY 1),
frequent AS (SELECT l.source, norm, arg_min(l.text, doc_id) AS keeper FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
             GROUP BY l.source, norm, h.texts
             HAVING count(DISTINCT l.text) > {MIN_DOCUMENTS}
                AND (max(n) >= {SHORT_LINE} OR count(DISTINCT l.text) > {MAX_SHARE} * h.texts)),
lost AS (SELECT doc_id, sum(n) AS words_lost, count(*) AS lines_lost FROM lines l JOIN frequent f
         ON l.source IS NOT DISTINCT FROM f.source AND l.norm = f.norm AND l.text <> f.keeper GROUP BY 1),
joined AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
                  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
                  coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lines_lost, 0) AS lines_lost,
                  coalesce(n_words, 0) - coalesce(words_lost, 0) AS words_left
           FROM d LEFT JOIN by_words USING (doc_id) LEFT JOIN by_lines USING (doc_id) LEFT JOIN lost USING (doc_id)),
failed AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM joined)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND words_left >= {MIN_WORDS} AND words_left >= {MIN_LEFT} * n_words AS kept,
       CAST(lines_lost AS BIGINT) AS lines_lost, CAST(words_left AS BIGINT) AS words_left
FROM failed"""
