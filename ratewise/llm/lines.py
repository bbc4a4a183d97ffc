"""Line dedup by site-relative frequency, in DataFrame functions.

Documents are grouped by host (a column of the table, or the host of a URL).
A line is boilerplate on a host when it stands on more than ``ratio`` of that
host's pages, and on at least ``min_pages`` of them (a line on fewer pages does
not repeat: two pages may be one copied pair); every such line is then taken
out of that host's documents.

Work and skew: the lines of one document are made distinct inside the row, so
a pair (host, line) is counted by plain partial sums and no key is ever
gathered in one task. A page of k lines can hold at most k boilerplate lines,
so a host has at most (mean lines per page) / ratio of them; the whole
boilerplate table is sent to all tasks under a checked row count, and is
joined as an array per host beyond that (the host key is salted then).

Lines are compared after trimming white space, by their 64-bit hash and
length. Defined results: blank lines are never boilerplate and stay as they
are; a null text stays null; null hosts form one host; repeated documents
count as pages of their own; a document left without lines keeps its row with
an empty text. Extra columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm.common import BROADCAST_ROWS, free_name, table, written

RATIO = 0.01
REPEATS = 3
SALTS = 64
_SPACE = " \t\r\f\x0b"


def host_of(url: Column) -> Column:
    """Host of a URL, lower-case; anything else is taken as the host itself."""
    return F.coalesce(F.lower(F.parse_url(url, F.lit("HOST"))), url)


def _key(line: Column) -> Column:
    """Trimmed line -> (hash, length) as one comparable value; null if blank."""
    line = F.trim(line, F.lit(_SPACE))
    return F.when(line != "", F.struct(F.xxhash64(line).alias("h"), F.length(line).alias("n")))


def boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO,
                min_pages: int = REPEATS) -> DataFrame:
    """(host, h, n, pages, total) of every line above ``ratio`` on its host."""
    pages = docs.select(F.col(host).alias("host"), F.coalesce("text", F.lit("")).alias("text"))
    totals = pages.groupBy("host").agg(F.count("*").alias("total"))
    lines = pages.select("host", F.explode(F.array_distinct(F.transform(
        F.split("text", "\n", -1), _key))).alias("k")).where("k IS NOT NULL")
    counts = lines.groupBy("host", "k.h", "k.n").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    few = totals if totals.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS else F.broadcast(totals)
    t = few.withColumnRenamed("host", "_host")
    return counts.join(t, F.col("host").eqNullSafe(F.col("_host"))).where(
        F.col("pages") > ratio * F.col("total")).select("host", "h", "n", "pages", "total")


def dedup_lines(docs: DataFrame, host: str = "source", ratio: float = RATIO,
                min_pages: int = REPEATS) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``.

    Adds ``n_lines`` and ``n_dropped`` (renamed with leading underscores if
    such columns exist); all other columns are kept.
    """
    cols = docs.columns
    n_lines, n_dropped = free_name("n_lines", cols), free_name("n_dropped", cols)
    drop, h, salt, lines, kept = (free_name(x, [*cols, n_lines, n_dropped]) for x in ("_drop", "_h", "_salt", "_lines", "_kept"))
    bad = written(boilerplate(docs, host, ratio, min_pages), "boilerplate")
    per_host = bad.groupBy(F.col("host").alias(h)).agg(F.collect_list(F.struct("h", "n")).alias(drop))
    if bad.count() <= BROADCAST_ROWS:
        got = docs.join(F.broadcast(per_host), F.col(host).eqNullSafe(F.col(h)), "left").drop(h)
    else:
        s = free_name("_s", [*cols, n_lines, n_dropped, drop, h, salt])
        spread = per_host.withColumn(s, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        d = docs.withColumn(salt, F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(SALTS)).cast("int"))
        got = d.join(spread, F.col(host).eqNullSafe(F.col(h)) & (F.col(salt) == F.col(s)), "left").drop(h, s, salt)
    bad_here = F.coalesce(F.col(drop), F.array().cast("array<struct<h:bigint,n:int>>"))
    return got.withColumn(lines, F.split("text", "\n", -1)).withColumn(
        kept, F.when(F.size(bad_here) == 0, F.col(lines)).otherwise(F.filter(
            lines, lambda x: ~F.coalesce(F.array_contains(bad_here, _key(x)), F.lit(False))))).select(
        *[F.array_join(kept, "\n").alias(c) if c == "text" else F.col(f"`{c}`") for c in cols],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias(n_lines),
        F.coalesce(F.size(lines) - F.size(kept), F.lit(0)).cast("long").alias(n_dropped))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its lines after site-relative line dedup."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.coalesce("text", F.lit("")).alias("kept_text"))


OP5_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source AS host, text FROM documents),
lines AS (
  SELECT r, doc_id, host, text IS NOT NULL AS has_text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM docs),
keyed AS (SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) AS k FROM lines),
totals AS (SELECT host, count(*) AS total FROM docs GROUP BY host),
bad AS (
  SELECT c.host, c.k FROM (SELECT host, k, count(DISTINCT r) AS pages FROM keyed WHERE k <> '' GROUP BY 1, 2) c
  JOIN totals t ON c.host IS NOT DISTINCT FROM t.host WHERE c.pages >= {REPEATS} AND c.pages > {RATIO} * t.total)
SELECT doc_id, count(*) FILTER (has_text) AS n_lines, count(*) FILTER (b.k IS NOT NULL) AS n_dropped,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (b.k IS NULL), '') AS kept_text
FROM keyed LEFT JOIN bad b ON keyed.host IS NOT DISTINCT FROM b.host AND keyed.k = b.k GROUP BY r, doc_id
"""
