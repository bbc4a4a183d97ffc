"""Personal data by bootstrapped contextual extraction, in DataFrame functions.

Seeds are what four regular expressions find (e-mail, ip, card, phone), each
leftmost and without overlaps of its own kind, then checked (parts, Luhn,
number of digits). The words around seeds induce lexical patterns: the two
words before, and the word before with the word after. Other tokens that
have the shape of a kind (``_shape``) are candidates, and so are stretches of
neighbouring number tokens, cut where a seed stands; they and the seeds are the
instances of a graph whose edges say that an instance stands in a pattern that
has seeds of a kind it has the shape of. Spark scores it in rounds:

    pattern  = (sum of its instances' scores) / (number of its instances),
               counted only from ``MIN_SEEDS`` different seeds on
    instance = 1 for a seed, else 1 - product of (1 - pattern score) over its
               patterns that score at least ``MIN_PATTERN``

so patterns that mostly meet seeds raise their other instances, which raises
the patterns in turn. After ``ROUNDS`` rounds candidates of at least
``MIN_INSTANCE`` are identifiers of the kind that is commonest among their
patterns' seeds, of those whose shape they have; all their occurrences become
spans, of a stretch and its tokens the stretch. Seed spans always stay.

The text is scanned once; what is found is written (without texts) and all
later steps read that. Offsets are running sums over one document's matches.
Patterns and instances are aggregated before they are joined, so a common
context or a common number is one row.

The expressions of the contract are used with possessive quantifiers and a
look-behind where both give the same matches, so that no text makes them
quadratic or deep in the stack.

Defined results: null and empty texts have no spans; repeated rows, also of
one id, are documents of their own; a token that overlaps a seed span is no
candidate; ties between kinds go to the first in ``KINDS``; an empty table gives
none; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewise.llm.common import small, table, written

KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]"
REGEX = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Tokens with a digit, those that follow and begin with one taken along; tokens with an at or a dot between letters.
CANDIDATE = (r"(?<!\S)(?:[^\s0-9]*+[0-9]\S*+(?:\x20[^\s0-9A-Za-z]*+[0-9]\S*+)*+"
             r"|\S*?(?:@|[\[({][Aa][Tt][\])}]|[A-Za-z]\.[A-Za-z])\S*+)")
MIN_SEEDS, MIN_PATTERN, MIN_INSTANCE, ROUNDS = 3, 0.5, 0.8, 3
CONTEXT_CHARS = 120
_SPACES = "\t\n\x0b\x0c\r"


def _word(c: Column) -> Column:
    """A context word: lower case, digits as 0, no punctuation at its ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[0-9]", "0"), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}:=]+$", "")


def _found(text: Column, regex: str, possible: Column) -> Column:
    """Matches of one expression: array<struct<skip, m, left, right>>.

    skip: characters between the match before (or the start) and this one.
    """
    pieces, found = F.split(text, regex, -1), F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    # Zipped before they are transformed: inside a lambda each element would split the text again.
    zipped = F.arrays_zip(found, pieces, F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))))
    each = F.transform(zipped, lambda x: F.struct(
        F.length(x["1"]).alias("skip"), x["0"].alias("m"),
        F.right(x["1"], F.lit(CONTEXT_CHARS)).alias("left"), F.left(x["2"], F.lit(CONTEXT_CHARS)).alias("right")))
    return F.when(possible, F.filter(each, lambda x: x["m"].isNotNull()))


def _all_matches(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, kind, no, skip, m, left, right) and a row without kind for each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digit = F.col("_t").rlike("[0-9]")
    could = {"email": F.instr("_t", "@") > 0, "ip": digit, "card": digit, "phone": F.instr("_t", "+") > 0, "other": F.lit(True)}
    regex = {**REGEX, "other": CANDIDATE}
    rows = docs.select("doc_id", text.alias("_t")).withColumn("rid", F.monotonically_increasing_id())
    none = F.array().cast("array<struct<skip:int,m:string,left:string,right:string>>")

    def tagged(kind: str) -> Column:
        found = F.coalesce(_found(F.col("_t"), regex[kind], could[kind]), none)
        return F.transform(found, lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("no"), *(x[c].alias(c) for c in ("skip", "m", "left", "right"))))

    per_kind = [tagged(k) for k in regex]
    # The scan is written before anything else reads it, which fixes the row ids.
    return written(rows.select("rid", "doc_id", F.explode_outer(F.concat(*per_kind)).alias("x")).select("rid", "doc_id", "x.*"), "pii-found")


def _valid(kind: Column, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)

    def luhn(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(i % 2 == 1, twice).otherwise(d)

    # Told by length before any number is read, so that no run of digits is too long for its type.
    part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    fits = F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) <= 3) & F.coalesce(part(p).try_cast("int") <= 255, F.lit(False)))
    card = n.between(16, 19) & (F.aggregate(F.sequence(F.lit(0), F.least(n, F.lit(19)) - 1), F.lit(0), luhn) % 10 == 0)
    return (F.when(kind == "ip", fits).when(kind == "card", card).when(kind == "phone", n.between(8, 15)).otherwise(True))


def _shape(kind: str, m: Column) -> Column:
    """Whether a candidate could be written for an identifier of the kind."""
    n = F.length(F.regexp_replace(m, "[^0-9]", ""))
    if kind == "email":
        return m.rlike(r"(?i)[a-z0-9._%+-](?:@|[\[({]at[\])}])[a-z0-9]|[a-z0-9]\.[a-z]{2,}$")
    if kind == "ip":
        return n.between(5, 12) | m.rlike(r"^[0-9]{1,3}(?:[^0-9A-Za-z\s]+[0-9]{1,3}){3}$") | m.rlike(r"^[0-9A-Fa-f]*:[0-9A-Fa-f]*:[0-9A-Fa-f:.]*$")
    if kind == "card":
        return n.between(5, 19) | F.length(F.regexp_replace(m, "[^0-9Xx*]", "")).between(12, 19)
    return n.between(5, 15)


def _patterns(two: str, one: str, after: str) -> Column:
    """Lexical patterns of a slot: the two words before; the word before with the word after."""
    b2, b1, a1 = (_word(F.col(c)) for c in (two, one, after))
    return F.array_compact(F.array(
        F.when(F.length(b1) > 0, F.concat(F.lit("L "), F.concat_ws(" ", b2, b1))),
        F.when((F.length(b1) > 0) & (F.length(a1) > 0), F.concat(F.lit("B "), b1, F.lit(" _ "), a1))))


def _trimmed(m: Column, start: Column) -> tuple[Column, Column, Column]:
    """Text, start and end without the punctuation at a candidate's ends."""
    core = F.regexp_replace(m, r"^[^\p{L}\p{N}+]+|[^\p{L}\p{N}]+$", "")
    begin = start + F.length(F.regexp_extract(m, r"^[^\p{L}\p{N}+]*", 0))
    return core.alias("m"), begin.alias("start"), (begin + F.length(core)).alias("end")


def _spans(matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Seed spans, and candidate spans that overlap none of them.

    Candidates of one (rid, no, part) are a stretch (``whole``) and its tokens.
    """
    order = Window.partitionBy("rid", "kind").orderBy("no")
    flat = lambda c: F.translate(c, _SPACES, " " * len(_SPACES))
    left, right = F.rtrim(flat("left")), F.ltrim(flat("right"))
    m = matches.where("kind IS NOT NULL").withColumn(
        "end", F.sum(F.col("skip").cast("long") + F.length("m")).over(order)).withColumn("start", F.col("end") - F.length("m"))
    m = m.select("rid", "kind", "no", "m", "start", "end", F.substring_index(left, " ", -1).alias("w1"),
                 F.substring_index(F.substring_index(left, " ", -2), " ", 1).alias("w2"), F.substring_index(right, " ", 1).alias("after"))
    seeds = m.where(F.col("kind").isin(*KINDS) & _valid(F.col("kind"), F.col("m"))).select(
        "rid", "kind", "start", "end", "m", _patterns("w2", "w1", "after").alias("patterns"))

    # The tokens of each match, with the words around each.
    run = Window.partitionBy("rid", "no").orderBy("i")
    tokens = m.where("kind = 'other'").select("rid", "no", "start", "w2", "w1", "after", F.posexplode(F.split("m", " ")).alias("i", "w"))
    tokens = tokens.withColumn("at", F.col("start") + F.sum(F.length("w") + 1).over(run) - F.length("w") - 1)
    one, two = F.lag("w", 1).over(run), F.lag("w", 2).over(run)
    tokens = tokens.select(
        "rid", "no", "i", "w", "at", F.when(F.col("i") > 1, two).when(F.col("i") == 1, F.col("w1")).otherwise(F.col("w2")).alias("b2"),
        F.when(F.col("i") > 0, one).otherwise(F.col("w1")).alias("b1"), F.coalesce(F.lead("w", 1).over(run), F.col("after")).alias("a1"))
    tokens = tokens.select(*tokens.columns, *_trimmed(F.col("w"), F.col("at")))
    both = seeds.withColumn("seed", F.lit(True)).unionByName(tokens.withColumn("seed", F.lit(False)), allowMissingColumns=True)
    at, seed = Window.partitionBy("rid").orderBy("start", F.when(F.col("seed"), 0).otherwise(1)), F.col("seed")
    both = both.withColumn("_ended", F.max(F.when(seed, F.col("end"))).over(at.rowsBetween(Window.unboundedPreceding, -1)))
    both = both.withColumn("_next", F.min(F.when(seed, F.col("start"))).over(at.rowsBetween(1, Window.unboundedFollowing)))
    free = (F.coalesce("_ended", F.lit(-1)) <= F.col("start")) & (F.coalesce("_next", F.col("end")) >= F.col("end"))
    both = written(both.withColumn("free", free).drop("_ended", "_next"), "pii-spans")

    tokens = both.where(~seed).withColumn("part", F.sum(F.when(F.col("free"), 0).otherwise(1)).over(run)).where("free")
    stretches = tokens.groupBy("rid", "no", "part").agg(
        F.sort_array(F.collect_list(F.struct("i", "w"))).alias("x"), F.min("at").alias("at"),
        F.min_by("b2", "i").alias("b2"), F.min_by("b1", "i").alias("b1"), F.max_by("a1", "i").alias("a1")).where(F.size("x") > 1)
    stretches = stretches.withColumn("w", F.array_join(F.col("x.w"), " "))

    def candidates(df: DataFrame, whole: bool) -> DataFrame:
        return df.select("rid", "no", "part", F.lit(whole).alias("whole"), *_trimmed(F.col("w"), F.col("at")),
                         _patterns("b2", "b1", "a1").alias("patterns"), F.lit("other").alias("kind"))

    fits = F.lit(False)
    for k in KINDS:
        fits = fits | _shape(k, F.col("m"))
    others = candidates(tokens, False).union(candidates(stretches, True)).where(fits & (F.size("patterns") > 0))
    return both.where(seed).select("rid", "kind", "start", "end", "m", "patterns"), written(others, "pii-candidates")


def discover(seeds: DataFrame, others: DataFrame) -> DataFrame:
    """(m, kind) of the candidates that the graph of patterns and instances accepts."""
    def edge(df: DataFrame) -> DataFrame:
        return df.select("m", "kind", F.explode(F.array_distinct("patterns")).alias("p")).distinct()

    support = edge(seeds).groupBy("p", "kind").agg(F.count("*").alias("n")).groupBy("p").agg(
        F.sum("n").alias("seeds"), *(F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(k) for k in KINDS)
    ).where(F.col("seeds") >= MIN_SEEDS)
    support = small(written(support, "pii-patterns"))
    apt = F.lit(False)
    for k in KINDS:
        apt = apt | ((F.col(k) > 0) & _shape(k, F.col("m")))
    links = written(edge(others).join(support.select("p", *KINDS), "p").where(apt).select("p", "m"), "pii-edges")
    score = links.select("m").distinct().withColumn("s", F.lit(0.0))
    none = F.coalesce(F.col("unknown"), F.lit(0))
    for _ in range(ROUNDS):
        met = links.join(score, "m").groupBy("p").agg(F.sum("s").alias("gained"), F.count("*").alias("unknown"))
        patterns = support.join(met, "p", "left").withColumn(
            "w", (F.col("seeds") + F.coalesce("gained", F.lit(0.0))) / (F.col("seeds") + none)).where(F.col("w") >= MIN_PATTERN)
        patterns = small(written(patterns.select("p", "w", *KINDS), "pii-scores"))
        got = links.join(patterns, "p").groupBy("m").agg(
            F.sum(F.log(F.greatest(F.lit(1) - F.col("w"), F.lit(1e-9)))).alias("miss"), *(F.sum(k).alias(k) for k in KINDS))
        got = written(got, "pii-instances")
        score = links.select("m").distinct().join(got, "m", "left").select(
            "m", (F.lit(1.0) - F.exp(F.coalesce("miss", F.lit(0.0)))).alias("s"))
    got = got.where(F.lit(1.0) - F.exp("miss") >= MIN_INSTANCE).select(
        "m", *(F.when(_shape(k, F.col("m")), F.col(k)).otherwise(0).alias(k) for k in KINDS))
    top = F.greatest(*KINDS)
    kind = F.lit(KINDS[-1])
    for k in reversed(KINDS):
        kind = F.when(F.col(k) == top, k).otherwise(kind)
    return got.where(top > 0).select("m", kind.alias("as"))


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and ``spans``, an array of
    struct<k, start, end, base> (k: place in ``KINDS``) in order of kind and start."""
    matches = _all_matches(docs)
    seeds, others = _spans(matches)
    found = small(written(discover(seeds, others), "pii-accepted"))
    whole = F.max("whole").over(Window.partitionBy("rid", "no", "part"))
    new = others.join(found, "m").withColumn("_whole", whole).where("whole = _whole").select("rid", F.col("as").alias("kind"), "start", "end", F.lit(False).alias("base"))
    spans = seeds.select("rid", "kind", "start", "end", F.lit(True).alias("base")).union(new)
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    rows = matches.select("rid", "doc_id", F.lit(None).cast("struct<k:int,start:bigint,end:bigint,base:boolean>").alias("x")).distinct()
    rows = rows.union(spans.select("rid", F.lit(None).cast("bigint"), F.struct(place.alias("k"), "start", "end", "base")))
    return rows.groupBy("rid").agg(F.max("doc_id").alias("doc_id"), F.sort_array(F.collect_list("x")).alias("spans")).drop("rid")


def span_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every whole document."""
    got = find_pii(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    base = F.filter("spans", lambda x: x["base"])

    def of_kind(k: int):
        return lambda x: x["base"] & (x["k"] == k)

    return got.select(
        "doc_id", *(F.size(F.filter(F.col("spans"), of_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS, 1)),
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
