"""Corpus pipeline: toxicity, line dedup, near duplicates, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all
rows the stage before it kept. Stages 1 to 4 return the columns of documents
(n_chars follows the text); the last returns the ids of every kept text.

Defined results: an empty table stays empty; a null text is an empty one for
every stage and stays null; extra columns pass through stages 1 to 4 and are
left out of the last; every row is judged by its own text, whether its id is
null or repeated: of a group of near duplicates the row of the smallest id stays
(a null id comes last, then the row's number decides), and a leak takes the rows
of its text along, no others. Rows without words are no duplicates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm import bpe, decontam, jaccard, lines, toxicity
from ratewise.llm.common import free_name, hash_mod, small, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below their language's threshold."""
    net = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), hash_mod("doc_id", 5) != 0)
    scored = toxicity.score(docs.select(*docs.columns), net)
    rejected = scored.columns[-1]
    return scored.where(~F.col(rejected)).select(*[f"`{c}`" for c in docs.columns])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are boilerplate on their site."""
    kept = lines.dedup_lines(docs)
    return kept.select(*[
        F.length("text").cast(t).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c, t in docs.dtypes])


def _key() -> Column:
    """A number for each different text; rows of one text are judged alike."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each component of near duplicates."""
    k, no = free_name("_key", docs.columns), free_name("_no", docs.columns)
    # Rows are told apart by a number that is written, not by their id.
    rows = written(docs.withColumn(no, F.monotonically_increasing_id()).withColumn(k, _key()), "numbered")
    found = jaccard.near_duplicates(rows.select(F.col(no).alias("doc_id"), "text"))
    found = written(found.where("n_shingles > 0").select(F.col("doc_id").alias(no), F.col("component_id").alias("component")), "components")
    again = found.groupBy("component").agg(F.count("*").alias("c")).where("c > 1").select("component")
    several = written(found.join(again, "component"), "several").join(rows.select(no, "doc_id"), no)
    first = several.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", no)).alias("x"))
    drop = several.join(first, "component").where(F.col(no) != F.col(f"x.{no}")).select(no)
    out = rows.join(small(written(drop, "near-copies")), no, "left_anti")
    return out.select(*[f"`{c}`" for c in docs.columns])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text holds no leak of a benchmark item."""
    k = free_name("_key", docs.columns)
    leaks = decontam.find_leaks(docs.select(_key().alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    leaks = written(leaks.select(F.col("doc_id").alias(k)).distinct(), "leaked-texts")
    out = docs.withColumn(k, _key()).join(small(leaks), k, "left_anti")
    return out.select(*[f"`{c}`" for c in docs.columns])


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to the text's bytes."""
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    rows = docs.select("doc_id", "source", "lang", "text")
    # Written in between, so that a task runs one Python worker, not two.
    ids = written(bpe.encode(rows, ranks, pattern), "token-ids")
    back = bpe.decode(ids, ranks, pattern)
    text = F.coalesce("text", F.lit("")).cast("binary")
    return back.select("doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       (F.col("decoded") == text).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("byte_bpe", to_tokens),
]

#: The trained and iterative stages have no SQL form; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
