"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set is its distinct word 5-grams (62-bit hashes). All sets are
ordered the same way: rare grams by hash, then the corpus's most frequent
grams, rarest first. Two sets that reach the similarity share at least l of
the first n - ceil(t*n) + l grams of each (t = 0.8), for every l. Each document
takes the l (up to ``MAX_MATCH``) whose estimated cost is least: reading the
posting lists of its prefix, plus verifying the candidates that share l grams.
A pair is a candidate when it shares min(l1, l2) prefix grams. Shared grams
also bound the whole overlap: what lies behind the shorter prefix of the two
can add no more than its length, so most false candidates go unverified.

Large groups. Documents of equal sets are one node from the start (a task
sends each node once). Round one links every node to one pivot: of the nodes
on its posting lists, that with the most grams known elsewhere. Round two
takes every remaining candidate pair whose nodes round one did not put in one
component: posting lists within one component are dropped whole, and a node
whose surviving prefix grams cannot reach any partner's bound does not pair.
No pair of different components goes unexamined, so components are exact.

Verified pairs are checked on the whole sets. Node ids are 64-bit digests of
the sorted set; with N different texts two collide with a chance of N*N / 2^65,
and of these only texts with equally many grams would be mixed up.

Defined results: words are ASCII lower-cased and split at ASCII white space;
a text of fewer than five words is one gram; a text without words (or null)
has an empty set and links with nothing; repeated rows are documents of their
own; null ids are kept and their texts link like any other, also where they
bridge others, and a component takes its smallest id that is not null (null if
it has none); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from ratewise.llm.common import lean, ship_package, small, table, written

WIDTH = 5
PERCENT = 80
MAX_MATCH = 4
#: Frequent grams that are moved to the end of the order; only speed depends on it.
FREQUENT, FREQUENT_MIN, LOCAL_MIN, LOCAL_TOP = 1 << 18, 8, 2, 1 << 16
VERIFY_COST = 20
CHUNK_WORDS = 250_000
HELD_GRAMS = 2_000_000
REMEMBERED = 150_000
_M = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxh3_64_intdigest(word)
        return h


class Shingler:
    """Sorted distinct gram hashes of texts; remembers word hashes."""

    def __init__(self):
        self.known = _WordHashes()

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        words, sizes, known = [], [], self.known
        for t in texts:
            w = (t or "").encode().lower().split()
            words.extend(w)
            sizes.append(len(w))
        if len(known) > REMEMBERED:
            known.clear()
        a = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        h = np.zeros(len(a), np.uint64)
        for j in range(min(WIDTH, len(a))):
            h[:len(a) - j] += a[j:] * _M[j]
        h = _mixed(h)
        out, at = [], 0
        for n in sizes:
            if n >= WIDTH:
                out.append(np.unique(h[at:at + n - WIDTH + 1]))
            elif n:
                out.append(_mixed(np.array([(a[at:at + n] * _M[:n]).sum() + np.uint64(n)], np.uint64)))
            else:
                out.append(np.zeros(0, np.int64))
            at += n
        return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return ((h ^ (h >> np.uint64(29))) >> np.uint64(2)).astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Rows and their texts, about ``CHUNK_WORDS`` words at a time."""
    for b in batches:
        lengths = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < b.num_rows:
            base = lengths[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(lengths, base + 6 * CHUNK_WORDS)))
            part = b.slice(at, to - at)
            yield part, part.column(1).to_pylist()
            at = to


def _digest(s: np.ndarray) -> int:
    return xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _nodes_and_frequent(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, other, n, node) of every document, and (gram, c) of grams frequent in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen, held, size = Shingler(), set(), [], 0

        def frequent() -> pa.RecordBatch:
            gram, c = np.unique(np.concatenate(held), return_counts=True)
            keep = np.flatnonzero(c >= LOCAL_MIN)
            if len(keep) > LOCAL_TOP:
                keep = keep[np.argpartition(-c[keep], LOCAL_TOP)[:LOCAL_TOP]]
            none = pa.nulls(len(keep), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, none, none, pa.array(gram[keep]), pa.array(c[keep], pa.int64())],
                                              ["doc_id", "other", "n", "node", "gram", "c"])

        for part, texts in _chunks(batches):
            sets = shingler.sets(texts)
            nodes = [_digest(s) for s in sets]
            for s, x in zip(sets, nodes, strict=True):
                if len(s) and x not in seen:
                    seen.add(x)
                    held.append(s)
                    size += len(s)
            none = pa.nulls(len(nodes), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64()), none, none],
                ["doc_id", "other", "n", "node", "gram", "c"])
            if size > HELD_GRAMS:
                yield frequent()
                held, size = [], 0
        if held:
            yield frequent()

    return written(docs.mapInArrow(lean(run), "doc_id bigint, other bigint, n bigint, node bigint, gram bigint, c bigint"), "grams")


def _alpha(n):
    """Least overlap of a set of n grams with any set that reaches the similarity."""
    return (PERCENT * n + 99) // 100


def _prefixes(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(key, node, n, level, last): the longest prefix of every node.

    ``frequent``: the frequent grams, rarest first. Level 1 is the prefix for
    one match; each further match adds one gram.
    """
    order = np.argsort(frequent)
    model = docs.sparkSession.sparkContext.broadcast((frequent[order], order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, rank = model.value
        shingler, seen = Shingler(), set()
        for _, texts in _chunks(batches):
            keys, nodes, ns, levels, lasts = [], [], [], [], []
            for s in shingler.sets(texts):
                n, node = len(s), _digest(s)
                if not n or node in seen:
                    continue
                seen.add(node)
                if len(grams):
                    at = np.minimum(np.searchsorted(grams, s), len(grams) - 1)
                    s = np.sort(np.where(grams[at] == s, (1 << 62) + rank[at], s))
                base = n - _alpha(n) + 1
                size = min(n, base + MAX_MATCH - 1)
                keys.append(s[:size])
                level = np.maximum(np.arange(size) - base + 2, 1)
                levels.append(level)
                lasts.append(np.arange(size) == base - 1)
                nodes.append(np.full(size, node, np.int64))
                ns.append(np.full(size, n, np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (keys, nodes, ns, [x.astype(np.int8) for x in levels], lasts)],
                    ["key", "node", "n", "level", "last"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), "key bigint, node bigint, n int, level tinyint, last boolean")


def _need(n: str, m: str) -> Column:
    """Shared base-prefix grams that a pair needs; ``n`` ends its prefix first."""
    both = F.expr(f"({PERCENT} * ({n} + {m}) + {99 + PERCENT}) div {100 + PERCENT}")
    return both - F.expr(f"({PERCENT} * {n} + 99) div 100") + 1


def _sizes_fit(n: str, m: str) -> Column:
    return F.expr(f"100 * least({n}, {m}) >= {PERCENT} * greatest({n}, {m})")


def _index(rows: DataFrame) -> DataFrame:
    """(key, node, n, s, cut, l, r): each node's prefix grams that other nodes have.

    s: such grams in the base prefix; cut: its last key; l: matches asked for;
    r: place of the gram among the node's base grams, the least shared first
    (none for the grams that further matches added).
    """
    key = Window.partitionBy("key")
    shared = rows.withColumn("df", F.count("*").over(key)).where("df > 1 OR last").drop("df")
    shared = written(shared, "shared-grams").groupBy("key", "node").agg(
        *(F.max(c).alias(c) for c in ("n", "level", "last")))
    shared = written(shared.withColumn("df", F.count("*").over(key)), "gram-counts")
    live = F.when(F.col("df") > 1, F.col("df")).otherwise(0)
    cost = [(F.sum(F.when(F.col("level") <= x, live).otherwise(0)) * (1 + F.lit(VERIFY_COST) / x)).alias(f"c{x}")
            for x in range(1, MAX_MATCH + 1)]
    nodes = shared.groupBy("node").agg(
        F.max(F.when(F.col("last"), F.col("key"))).alias("cut"),
        F.sum(F.when((F.col("level") == 1) & (F.col("df") > 1), 1).otherwise(0)).alias("s"), *cost)
    best = F.least(*[f"c{x}" for x in range(1, MAX_MATCH + 1)])
    l = F.lit(MAX_MATCH)
    for x in range(MAX_MATCH, 0, -1):
        l = F.when(F.col(f"c{x}") == best, x).otherwise(l)
    nodes = nodes.where("s > 0").select("node", "cut", "s", l.alias("l"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("level", "df", "key"))
    return written(shared.where("df > 1").join(nodes, "node").where("level <= l").select(
        "key", "node", "n", "s", "cut", "l", place.alias("r")).withColumn("r", F.when(F.col("r") <= F.col("s"), F.col("r"))), "gram-index")


def _pivots(index: DataFrame) -> DataFrame:
    """Pairs (a, b): each node with one pivot of its posting lists."""
    top = F.max(F.struct("s", "cut", "node", "n")).over(Window.partitionBy("key"))
    votes = index.withColumn("p", top).where("p.node <> node").groupBy("node", F.col("p.node").alias("pivot")).agg(
        F.count("*").alias("v"), *(F.first(c).alias(c) for c in ("n", "s", "cut")), F.first("p").alias("p"))
    mine, theirs = F.struct("cut", "node"), F.struct("p.cut", "p.node")
    reach = F.when(mine < theirs, F.col("s") >= _need("n", "p.n")).otherwise(F.col("p.s") >= _need("p.n", "n"))
    best = votes.where(_sizes_fit("n", "p.n") & reach).groupBy("node").agg(F.max(F.struct("v", "pivot")).alias("x"))
    return best.select(F.col("node").alias("a"), F.col("x.pivot").alias("b"))


def _rest(index: DataFrame, labels: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of nodes that are in different components so far."""
    key = Window.partitionBy("key")
    i = index.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    i = i.withColumn("lo", F.min("label").over(key)).withColumn("hi", F.max("label").over(key)).where("lo <> hi").drop("lo", "hi")
    i = i.withColumn("least", F.greatest(F.min("n").over(key), F.expr(f"({PERCENT} * n + 99) div 100")))
    x = i.where((F.col("s") >= _need("n", "least")) & F.col("r").isNotNull()).select(
        "key", *(F.col(c).alias(f"{c}1") for c in ("node", "n", "s", "cut", "r", "label")))
    y = i.select("key", *(F.col(c).alias(f"{c}2") for c in ("node", "n", "cut", "label")))
    # Sharing m of a node's s grams takes one of any s - m + 1 of them: the least shared.
    pairs = x.join(y, "key").where(
        (F.col("label1") != F.col("label2")) & _sizes_fit("n1", "n2") & (F.col("r1") <= F.col("s1") - _need("n1", "n2") + 1)
        & ((F.col("cut1") < F.col("cut2")) | (F.col("cut1") == F.col("cut2")) & (F.col("node1") < F.col("node2"))))
    pairs = pairs.select("node1", "node2").distinct()
    each = index.groupBy("node").agg(F.collect_list("key").alias("keys"), *(F.first(c).alias(c) for c in ("n", "cut", "l")))
    one, two = (each.select(*(F.col(c).alias(f"{c}{k}") for c in each.columns)) for k in (1, 2))
    both = F.array_intersect("keys1", "keys2")
    return pairs.join(one, "node1").join(two, "node2").withColumn("both", both).where(
        (F.size("both") >= F.least("l1", "l2"))
        & (F.size(F.filter("both", lambda k: k <= F.col("cut1"))) >= _need("n1", "n2"))).select(
        F.col("node1").alias("a"), F.col("node2").alias("b"))


def _verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs whose whole sets reach the similarity."""
    pairs = written(pairs, "gram-pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(reps, "node")
    ids = small(written(wanted, "gram-wanted").select(F.col("rep").alias("_ref"), F.col("node").alias("_node")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for part, texts in _chunks(batches):
            nodes, got = part.column(0), shingler.sets(texts)
            mine = pa.array([_digest(s) == x for s, x in zip(got, nodes.to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([nodes, pa.array([s.tobytes() for s in got], pa.binary())], ["node", "grams"]).filter(mine)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
                same = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * same >= PERCENT * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    # One document for each node: of repeated references, that whose digest is the node.
    found = docs.select(F.coalesce("doc_id", "other").alias("_ref"), "text").join(ids, "_ref").select("_node", "text").mapInArrow(lean(sets), "node bigint, grams binary").dropDuplicates(["node"])
    a, b = (found.select(F.col("node").alias(x), F.col("grams").alias(f"{x}_grams")) for x in "ab")
    return written(pairs.join(a, "a").join(b, "b").select("a", "b", "a_grams", "b_grams").mapInArrow(
        lean(check), "a bigint, b bigint"), "gram-links")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node on an edge (a, b): its component's least node.

    Alternates large-star and small-star steps until the edges stand still.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, last = written(e, "cc"), None
    while True:
        both = e.union(e.select("v", "u"))
        m = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.join(m, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        m = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(m, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("x")).select(
            F.col("x.u").alias("u"), F.col("x.m").alias("v")).where("u <> v").distinct()
        e = written(e, "cc")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == last:
            return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
                e.select("v", "v").distinct())
        last = now


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ship_package(spark)
    # A text of a row without id is referred to by its hash.
    docs = docs.select("doc_id", "text", F.when(F.col("doc_id").isNull(), F.xxhash64("text")).alias("other"))
    rows = _nodes_and_frequent(docs)
    top = rows.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("c").alias("c")).where(
        F.col("c") >= FREQUENT_MIN).orderBy(F.desc("c"), "gram").limit(FREQUENT).select("gram").toArrow()
    frequent = top.column(0).to_numpy()[::-1].astype(np.int64)
    # n > 0 marks the rows of documents with words.
    nodes = rows.where("n IS NOT NULL").select("doc_id", "other", "n", "node")
    reps = nodes.where("n > 0").groupBy("node").agg(F.coalesce(F.min("doc_id"), F.min("other")).alias("rep"))
    index = _index(_prefixes(docs, frequent))
    links = _verified(_pivots(index), docs, reps)
    labels = components(links)
    more = _verified(_rest(index, labels), docs, reps)
    if more.limit(1).count():
        labels = components(links.union(more))
    label = F.when(F.col("n") > 0, F.coalesce("label", "node"))
    got = nodes.join(labels, "node", "left").select("doc_id", "n", label.alias("label"))
    least = got.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"))
    return got.join(least, "label", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
