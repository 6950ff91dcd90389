"""Line dedup: lines that several documents hold are dropped from all of them but one, with built-in functions only.

A line's key is the line without ASCII white space at both ends, with A-Z lower-cased; 128 bits of hash stand for it. Keys of at
least ``least_chars`` code points found in at least ``least_docs`` documents lose all their lines except those in the document with
the largest id that holds the key. The other lines stay in their order.

Lines are exploded and hashed, documents are counted for each hash in two steps with partial sums (hash and id, then hash), and the
frequent hashes meet the lines again: by broadcast if they are few, else the most common of them by broadcast and the others by
shuffle (``joined_by_weight``), so no task gets all the lines of a common key. What comes back for a text are the positions it
loses, never its lines; the text is then cut once, in time linear in its lines.

Rows with the same id are one document (null ids too, and that document is never the one to keep a line), so repeated rows are cut
alike. Null text is one empty line, as is an empty one, and comes back empty. Ties do not occur: one id is the largest. An empty
table gives no rows. Other columns are kept as they are and may have any name but the marked ones (``_cw_`` in front).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewick.llm.common import joined_by_weight, staged, table

LEAST_CHARS = 20
LEAST_DOCS = 3
BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    bare = F.trim(line, F.lit(BLANK))
    # ``lower`` knows all alphabets, so it serves for ASCII only, where it is the faster one.
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _hashes(value: Column, first: str, second: str) -> list[Column]:
    """Two independent hashes: the second starts from another seed."""
    return [F.xxhash64(value).alias(first), F.xxhash64(F.lit(1), value).alias(second)]


_TEXT = ["_cw_id", "_cw_t1", "_cw_t2"]


def _marked(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """The documents with what identifies a text of a document: id and hashes of the text."""
    own = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.withColumns({text: own, "_cw_id": F.col(f"`{id_column}`")}).select(
        "*", *_hashes(F.col(f"`{text}`"), "_cw_t1", "_cw_t2"))


def _lines(marked: DataFrame, text: str, least_chars: int, *columns: str) -> DataFrame:
    """One row for each line long enough: ``columns``, place (from 1), hashes of its key."""
    lines = marked.select(*columns, F.posexplode(F.split(F.col(f"`{text}`"), "\n", -1)).alias("at", "line")) \
        .select(*columns, (F.col("at") + 1).alias("at"), line_key(F.col("line")).alias("key"))
    return lines.where(F.char_length("key") >= least_chars).select(*columns, "at", *_hashes(F.col("key"), "h1", "h2"))


def frequent_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
                   least_docs: int = LEAST_DOCS) -> DataFrame:
    """Hashes (h1, h2) of the keys found in ``least_docs`` documents or more, with documents, lines and the last document's id."""
    lines = _lines(_marked(docs, id_column, text), text, least_chars, "_cw_id")
    by_document = lines.groupBy("h1", "h2", "_cw_id").agg(F.count("*").alias("lines"))
    return by_document.groupBy("h1", "h2").agg(
        F.count("*").alias("documents"), F.sum("lines").alias("lines"), F.max("_cw_id").alias("last")) \
        .where(F.col("documents") >= least_docs)


def _without(lines: Column, gone: Column) -> Column:
    """``lines`` without those at the places ``gone`` (ascending, from 1): the runs between them, one after the other."""
    begins = F.concat(F.array(F.lit(1)), F.transform(gone, lambda at: at + 1))
    ends = F.concat(gone, F.array(F.size(lines) + 1))
    runs = F.transform(F.array(lines), lambda all_: F.flatten(
        F.zip_with(begins, ends, lambda begin, end: F.slice(all_, begin, end - begin))))
    return runs[0]


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
                least_docs: int = LEAST_DOCS) -> DataFrame:
    """All rows and columns of ``docs`` with the text cut, and ``_cw_lines`` (before the cut) and ``_cw_dropped``."""
    frequent = staged(frequent_lines(docs, id_column, text, least_chars, least_docs), "frequent-lines")
    marked = _marked(docs, id_column, text)
    lost = joined_by_weight(_lines(marked, text, least_chars, *_TEXT), frequent.select("h1", "h2", "last", "lines"), ["h1", "h2"], "lines") \
        .where(~F.col("_cw_id").eqNullSafe(F.col("last"))) \
        .groupBy(*_TEXT).agg(F.array_sort(F.collect_set("at")).alias("_cw_gone"))
    # A table of its own: the join below then reads both sides through bare shuffles, which adaptive execution splits if one key is hot.
    gone = staged(lost, "lost-lines").withColumnsRenamed({name: f"{name}_" for name in _TEXT})
    same = F.col("_cw_id").eqNullSafe(F.col("_cw_id_")) & (F.col("_cw_t1") == F.col("_cw_t1_")) & (F.col("_cw_t2") == F.col("_cw_t2_"))
    split = F.split(F.col(f"`{text}`"), "\n", -1)
    kept = F.when(F.col("_cw_gone").isNull(), F.col(f"`{text}`")).otherwise(F.array_join(_without(split, F.col("_cw_gone")), "\n"))
    out = {c: F.col(f"`{c}`") for c in docs.columns} | {text: kept}
    return marked.join(gone, same, "left").select(
        *(value.alias(name) for name, value in out.items()), F.size(split).cast("long").alias("_cw_lines"),
        F.coalesce(F.size("_cw_gone"), F.lit(0)).cast("long").alias("_cw_dropped"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", F.col("_cw_lines").alias("n_lines"), F.col("_cw_dropped").alias("n_dropped"),
                      F.sha2("text", 256).alias("kept_sha256"))


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT row, doc_id, unnest(string_split(text, chr(10))) AS line,
                 unnest(range(len(string_split(text, chr(10))))) AS place FROM d),
keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
          FROM lines),
frequent AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= {LEAST_CHARS}
             GROUP BY key HAVING count(DISTINCT doc_id) >= {LEAST_DOCS}),
marked AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.last AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row
"""
