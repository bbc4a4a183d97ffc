"""Chat formatting with typed content parts, in DataFrame functions only.

A turn holds an array of typed parts. A visitor (one column function per part
type) flattens the parts, in order, into template text: text is escaped, and
every image, audio or document becomes one numbered placeholder, records an
attachment reference and adds its expanded token count (what the placeholder
becomes once the model's encoders fill it in).

Template of a turn: ``<s>[INST]role[/INST]body</s>``. Inside roles and texts
the three characters that control strings are made of are written as
``&a;`` (&), ``&l;`` (<) and ``&b;`` ([), so no control string can occur in a
text, and the replacement is undone exactly by reading them back.

Defined results: null parts, null texts and unknown part types give empty
text and count nothing; a null role reads as an empty role; rows that repeat
a turn number are all kept, ordered by turn (nulls first), role and text;
a conversation whose id is null is a conversation of its own; an empty table
gives an empty result. A conversation is one string by its nature, so Spark's
2 GB limit for one string bounds a single conversation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewise.llm.common import table

BOS, EOS, HEAD, BODY = "<s>", "</s>", "[INST]", "[/INST]"
#: Character and its escaped form; the first is undone last.
ESCAPES = (("&", "&a;"), ("<", "&l;"), ("[", "&b;"))
PART_TYPE = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
CHARS_PER_TOKEN = 4
IMAGE_PATCH, AUDIO_TOKENS_PER_S, DOCUMENT_TOKENS_PER_PAGE = 14, 25.0, 512


def escape(c: Column) -> Column:
    for raw, safe in ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def unescape(c: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        c = F.replace(c, F.lit(safe), F.lit(raw))
    return c


def _nat(c: Column) -> Column:
    return F.greatest(F.coalesce(c, F.lit(0)), F.lit(0))


def _visit_text(p: Column, nth: Column) -> tuple[Column, Column]:
    text = F.coalesce(p["text"], F.lit(""))
    return escape(text), F.ceil(F.length(text) / CHARS_PER_TOKEN)


def _placeholder(kind: str, tokens: Callable[[Column], Column]):
    def visit(p: Column, nth: Column) -> tuple[Column, Column]:
        return F.concat(F.lit(f"[{kind}:"), nth.cast("string"), F.lit("]")), tokens(p)

    return visit


#: Part type -> (placeholder or text, expanded tokens).
VISITORS = {
    "text": _visit_text,
    "image": _placeholder("IMAGE", lambda p: F.ceil(_nat(p["width"]) / IMAGE_PATCH)
                          * F.ceil(_nat(p["height"]) / IMAGE_PATCH)),
    "audio": _placeholder("AUDIO", lambda p: F.ceil(F.greatest(
        F.coalesce(p["seconds"], F.lit(0.0)), F.lit(0.0)) * AUDIO_TOKENS_PER_S)),
    "document": _placeholder("DOCUMENT", lambda p: _nat(p["pages"]) * DOCUMENT_TOKENS_PER_PAGE),
}
ATTACHMENTS = tuple(k for k in VISITORS if k != "text")


def _is_attachment(p: Column) -> Column:
    return F.coalesce(p["type"].isin(*ATTACHMENTS), F.lit(False))


def flatten(parts: Column, before: Column) -> Column:
    """Array of parts -> array<struct<text, tokens, nth, kind, ref>>.

    ``before``: attachments in the conversation ahead of this turn, so that
    placeholders are numbered in order through the whole conversation.
    """

    def one(p: Column, i: Column) -> Column:
        nth = before + F.size(F.filter(F.slice(parts, F.lit(1), i + 1), _is_attachment))
        text, tokens = F.lit(""), F.lit(0).cast("long")
        for kind, visit in VISITORS.items():
            t, n = visit(p, nth)
            text = F.when(p["type"] == kind, t).otherwise(text)
            tokens = F.when(p["type"] == kind, n.cast("long")).otherwise(tokens)
        return F.struct(text.alias("text"), tokens.alias("tokens"),
                        F.when(_is_attachment(p), nth.cast("int")).alias("nth"),
                        p["type"].alias("kind"), p["ref"].alias("ref"))

    return F.transform(parts, one)


def text_parts(text: Column) -> Column:
    """A plain text as an array with one text part."""
    return F.array(F.struct(
        F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"),
        *(F.lit(None).cast(t).alias(n) for n, t in (("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int")))))


def format_chat(turns: DataFrame, train_role: str = "assistant") -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, parts).

    Returns conv_id, n_turns, formatted, turn_starts (where each turn begins),
    loss_spans (turn, start, end: every body of ``train_role``), attachments
    (nth, kind, ref, turn) and expanded_tokens. Offsets are code points.
    """
    parts = F.coalesce(F.col("parts"), F.array().cast(f"array<{PART_TYPE}>"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "_sort")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = turns.select(
        "conv_id", F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"))
    rows = rows.withColumn("_sort", F.concat_ws("\n", F.transform("parts", lambda p: F.coalesce(p["text"], p["ref"], F.lit("")))))
    rows = rows.withColumn("_att", F.size(F.filter("parts", _is_attachment)))
    rows = rows.withColumn("_before", F.coalesce(F.sum("_att").over(ahead), F.lit(0)))
    rows = rows.withColumn("_flat", flatten(F.col("parts"), F.col("_before")))
    head = F.concat(F.lit(BOS + HEAD), escape(F.col("role")), F.lit(BODY))
    rows = rows.select(
        "conv_id", "turn", "role", "_sort",
        F.length(head).alias("_head"),
        F.concat(head, F.concat_ws("", F.col("_flat.text")), F.lit(EOS)).alias("_out"),
        F.aggregate("_flat.tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("_tokens"),
        F.filter("_flat", lambda x: x["nth"].isNotNull()).alias("_refs"))
    rows = rows.withColumn("_no", F.row_number().over(order) - 1)
    rows = rows.withColumn("_start", F.coalesce(F.sum(F.length("_out").cast("long")).over(ahead), F.lit(0)))
    got = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("_no", "_start", "_head", "role", "_out", "_refs"))).alias("t"),
        F.sum("_tokens").alias("expanded_tokens"))
    mine = F.filter("t", lambda x: x["role"] == train_role)
    return got.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"),
        F.concat_ws("", F.col("t._out")).alias("formatted"),
        F.col("t._start").alias("turn_starts"),
        F.transform(mine, lambda x: F.struct(
            x["_no"].alias("turn"), (x["_start"] + x["_head"]).alias("start"),
            (x["_start"] + F.length(x["_out"]) - len(EOS)).alias("end"))).alias("loss_spans"),
        F.flatten(F.transform("t", lambda x: F.transform(x["_refs"], lambda r: F.struct(
            r["nth"].alias("nth"), r["kind"].alias("kind"), r["ref"].alias("ref"), x["_no"].alias("turn"))))).alias("attachments"),
        "expanded_tokens")


def read_back(formatted: Column) -> Column:
    """The formatted text as array<struct<role, text>>, unescaped."""
    pieces = F.split(formatted, EOS, -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def one(x: Column) -> Column:
        cut = F.locate(BODY, x)
        return F.struct(
            unescape(F.substring(x, F.lit(len(BOS + HEAD) + 1), cut - len(BOS + HEAD) - 1)).alias("role"),
            unescape(F.substring(x, cut + len(BODY), F.length(x))).alias("text"))

    return F.transform(pieces, one)


def loss_text(formatted: Column, turn_starts: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped and joined in order."""
    pieces = F.split(formatted, EOS, -1)
    return F.concat_ws("", F.transform(loss_spans, lambda s: unescape(F.substring(
        F.element_at(pieces, s["turn"] + 1),
        (s["start"] - F.element_at(turn_starts, s["turn"] + 1) + 1).cast("int"),
        (s["end"] - s["start"]).cast("int")))))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every formatted conversation, read back from the output."""
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = rows.unionByName(tricky).withColumn("parts", text_parts(F.col("text")))
    out = format_chat(turns)
    back, loss = read_back(F.col("formatted")), loss_text(*(F.col(c) for c in ("formatted", "turn_starts", "loss_spans")))
    return out.withColumn("_back", back).withColumn("_loss", loss).select(
        "conv_id", F.size("_back").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", F.transform("_back", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n")))), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"), "expanded_tokens")


_ESC = "replace(replace(replace({0}, '&', '&a;'), '<', '&l;'), '[', '&b;')"
OP10_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(20 + length({_ESC.format('role')}) + length({_ESC.format('text')})) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS n_attachments,
  CAST(sum(ceil(length(text) / 4.0)) AS BIGINT) AS expanded_tokens
FROM rows GROUP BY conv_id
"""
