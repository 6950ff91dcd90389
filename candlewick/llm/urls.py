"""URL filters: nested host and path rules found by a distributed sort-merge sweep, with built-in functions only.

A rule (host, path, verdict) fits its host and all subdomains if the url's path starts with the rule's path. Hosts become
canonical keys with the labels reversed (``blog.example.org`` -> ``org.example.blog.``), so that "host and subdomains" is the
interval of keys that begin with the rule's key. Intervals of prefixes are nested or disjoint: in sorted order the rules active
at a key are a stack, and that stack is the one of the last rule at or before the key less the entries that have ended.

``prefix_sweep`` sorts rules and points together by range, so that a host with a third of all rows spreads over many tasks;
what is active where a range begins is carried over from the ranges before it. It runs twice: over hosts, and, for the hosts found,
over (host, path).

Null urls and urls without ``://`` have an empty host and path. Equal rules with different verdicts: block wins. Among the rules
that fit, the longest (host and path together) wins, then the longer host. Without a rule the verdict is ``default``.
Repeated rows stay repeated; other columns of the input may have any name and are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from candlewick.llm.common import staged, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Between host and path in a key; sorts below every character of a url.
GAP = "\u0001"

#: The rules of the query.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels in reverse order, each ended by a dot: a host's key begins with the keys of its parents."""
    return F.when(host == "", "").otherwise(F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit(".")))


def rules_frame(spark: SparkSession, rules: tuple = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _with_stack(rules: DataFrame) -> DataFrame:
    """For each rule key the entries of all rule keys that begin it, the rule's own last: the stack while it is on top.

    ``rules``: key, entry. As many rows are joined as the rule keys have characters.
    """
    begins = rules.select("key", F.explode(F.sequence(F.lit(0), F.length("key"))).alias("size")).select(
        F.col("key").alias("of"), F.expr("substring(key, 1, size)").alias("key"), "size")
    return begins.join(rules, "key").groupBy(F.col("of").alias("key")).agg(
        F.array_sort(F.collect_list(F.struct("size", "entry"))).alias("stack"))


def prefix_sweep(points: DataFrame, rules: DataFrame) -> DataFrame:
    """For each point (key, value) the entries of the rules (key, entry) whose key begins the point's key, shortest first.

    Returns row (unique), key, value, found: array<struct<size, entry>>. Rule keys must be unique.
    """
    stacks = _with_stack(rules)
    empty = F.lit(None)
    both = stacks.select("key", "stack", empty.cast(points.schema["value"].dataType).alias("value"), F.lit(0).alias("kind")) \
        .unionByName(points.select("key", empty.cast(stacks.schema["stack"].dataType).alias("stack"), "value",
                                   F.lit(1).alias("kind")))
    placed = staged(
        both.withColumn("tie", F.xxhash64("value")).repartitionByRange("key", "kind", "tie").select(
            "key", "stack", "value", "kind", F.spark_partition_id().alias("range"),
            F.monotonically_increasing_id().alias("row")), "sweep")
    # One row for each range: its last stack, handed to the next ranges.
    ends = placed.groupBy("range").agg(F.max(F.when(F.col("kind") == 0, F.struct("key", "stack"))).alias("end"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("range", F.last("end", ignorenulls=True).over(before).alias("carried"))
    along = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    top = F.last(F.when(F.col("kind") == 0, F.struct("key", "stack")), ignorenulls=True).over(along)
    swept = placed.join(F.broadcast(carried), "range").withColumn("top", F.coalesce(top, F.col("carried")))
    # The stack's entries that have not ended: those whose key still begins the point's key.
    active = F.expr("filter(coalesce(top.stack, array()), s -> startswith(key, substring(top.key, 1, s.size)))")
    return swept.where("kind = 1").select("row", "key", "value", active.alias("found"))


def url_filter(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url",
               default: str = "allow") -> DataFrame:
    """Each row's id, host, path, the rule that decides (host and path as one text, else null) and the verdict."""
    points = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url")) \
        .withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))) \
        .select(host_key(F.col("host")).alias("key"), F.struct("id", "host", "path").alias("value"))
    clean = rules.select(F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("host"),
                         F.coalesce("path", F.lit("")).alias("path"), "verdict") \
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict")) \
        .withColumn("key", host_key(F.col("host")))
    hosts = clean.select("key").distinct().withColumn("entry", F.lit(0))
    by_host = staged(prefix_sweep(points, hosts), "hosts")

    paths = clean.select(F.concat("key", F.lit(GAP), "path").alias("key"), F.struct(
        (F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host_length"),
        F.concat("host", "path").alias("rule"), "verdict").alias("entry"))
    candidates = by_host.select("row", "key", "value", F.explode("found.size").alias("size")).select(
        F.concat(F.expr("substring(key, 1, size)"), F.lit(GAP), "value.path").alias("key"), F.struct("row").alias("value"))
    best = prefix_sweep(candidates, paths).where(F.size("found") > 0) \
        .select(F.col("value.row").alias("row"), F.array_max(F.expr("transform(found, f -> f.entry)")).alias("entry")) \
        .groupBy("row").agg(F.max("entry").alias("entry"))
    return by_host.join(best, "row", "left").select(
        F.col("value.id").alias(id_column), "value.host", "value.path", F.col("entry.rule").alias("rule"),
        F.coalesce("entry.verdict", F.lit(default)).alias("verdict"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), rules_frame(spark))


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
ORACLE = f"""
WITH rules(h, p, v) AS (VALUES {_RULE_ROWS}),
u AS (SELECT row_number() OVER () AS n, page_id,
             translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
m AS (SELECT n, max(row(length(h) + length(p), length(h), h || p, v)) AS best FROM u JOIN rules
      ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n)
SELECT page_id, host, path, best[3] AS rule, coalesce(best[4], 'allow') AS verdict FROM u LEFT JOIN m USING (n)"""
