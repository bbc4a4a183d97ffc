"""Ranked lexical search with range-maximum sparse tables over posting lists.

Three jobs. The first reads every text once and writes, for each document, its
number of terms and the counts of the terms that any item asks for (a forward
index in the shared folder). The second sums the corpus counts over it. The
third is the search: each task takes its documents in shards of a bounded
number of postings, turns a shard into posting lists in order of doc_id with
the integer impact of every posting, and lays one sparse table of range maxima
over the lists.

An item's search keeps document intervals, best bound first. The bound of an
interval is the sum over the item's terms of the greatest impact that the term's
list has inside it (one range-maximum answer each). The best intervals are split
at the document of their greatest impact: that document is scored exactly, and
the two sides get bounds of their own. A search ends when no interval can hold a
document that ranks before the k-th found. The k best of an item are carried
from shard to shard, so later shards are mostly cut off at once. A task emits k
rows an item at most; a window over buckets, then one over items, ranks them.

Sent to the tasks: the items of one block, at most ``BLOCK_ITEMS`` rows and
``BLOCK_CHARS`` characters as counted (about; blocks are dealt by hash), and a
number for each of their terms. More items take more blocks.

Defined results: a null or empty text has no terms; a document without terms is
in no count and never returned; documents with a null id take part, the null
last among equal scores; rows that repeat an id are documents of their own;
rows that repeat an item's id and text are one item, rows of one id with
different texts are items of their own; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewise.llm.common import lean, ship_package, table, written

K = 10
BLOCK_ITEMS = 100_000
BLOCK_CHARS = 32_000_000
#: Postings and documents of a shard, both bounds on its memory.
SHARD_POSTINGS = 1_000_000
SHARD_DOCS = 100_000
#: Intervals split together at most.
SPLIT = 256
BUCKETS = 64
LAST = np.iinfo(np.int64).max

_TERM = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all characters beyond ASCII; only A-Z lower-cased."""
    return (text or "").encode().translate(_TERM).split()


def forward_index(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document; ``vocabulary``: a broadcast list of terms."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(vocabulary.value)}.get
        for batch in batches:
            n, terms, tfs = [], [], []
            for text in batch.column(1):
                words = terms_of(text.as_py())
                count = Counter(map(number, words))
                count.pop(None, None)
                n.append(len(words))
                terms.append(list(count))
                tfs.append(list(count.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lean(task), "doc_id bigint, n bigint, terms array<int>, tfs array<int>")


class Shard:
    """Posting lists of some documents and the sparse table over them."""

    def __init__(self, ids: np.ndarray, null: np.ndarray, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray,
                 weights: np.ndarray, total: int, length: int):
        order = np.lexsort((ids, null))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.ids, self.null = ids[order], null[order]
        if 75 * int(n.max(initial=0)) * total < 2**63:
            m = 25 + (75 * n * total) // max(length, 1)
        else:
            m = np.array([25 + 75 * x * total // length for x in n.tolist()], np.int64)
        doc = np.repeat(np.arange(len(n)), sizes)
        impact = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[doc]))
        use = np.flatnonzero(impact)
        self.docs = len(n)
        key = terms[use] * self.docs + place[doc[use]]
        at = np.argsort(key)
        self.key, self.impact = key[at], impact[use][at]
        self.doc = self.key % self.docs
        bounds = np.searchsorted(self.key, np.arange(len(weights) + 1) * self.docs)
        self.start, self.end = bounds[:-1], bounds[1:]
        # Level k has, for each posting, the place of the greatest impact of 2^k postings from it on, the leftmost of equals.
        longest = int((self.end - self.start).max(initial=0))
        tables = [np.arange(len(self.key))]
        while 2 << (len(tables) - 1) <= longest:
            low, step = tables[-1], 1 << (len(tables) - 1)
            right = low[np.minimum(np.arange(len(low)) + step, len(low) - 1)]
            tables.append(np.where(self.impact[low] >= self.impact[right], low, right))
        self.tables = np.stack(tables).astype(np.int32)
        self.log = np.zeros(longest + 1, np.int64)
        for k in range(1, len(tables)):
            self.log[1 << k:] = k

    def top(self, terms: np.ndarray, times: np.ndarray, best: list[tuple], k: int = K) -> list[tuple]:
        """``best`` ((-score, null, doc_id), k at most, sorted) with this shard's documents."""
        some = self.end[terms] > self.start[terms]
        terms, times = terms[some], times[some]
        if not len(terms):
            return best
        lo, a, b = np.zeros(1, np.int64), self.start[terms][None, :], self.end[terms][None, :]
        bound, split = self._bound(a, b, times)
        width = 1
        while len(lo):
            if len(best) == k:
                last = best[-1]
                first = self.ids[np.minimum(lo, self.docs - 1)]
                nulls = self.null[np.minimum(lo, self.docs - 1)]
                before = (nulls < last[1]) | ((nulls == last[1]) & (first < last[2]))
                live = (bound > -last[0]) | ((bound == -last[0]) & before)
            else:
                live = bound > 0
            if not live.all():
                lo, a, b, bound, split = lo[live], a[live], b[live], bound[live], split[live]
                if not len(lo):
                    break
            if len(lo) > width:
                pick = np.argpartition(-bound, width - 1)[:width]
                rest = np.ones(len(lo), bool)
                rest[pick] = False
            else:
                pick, rest = np.arange(len(lo)), np.zeros(len(lo), bool)
            width = min(2 * width, SPLIT)
            d, pa_, pb = split[pick], a[pick], b[pick]
            # Where the split document stands in each list: its impacts make its score, its places the two sides.
            want = terms[None, :] * self.docs + d[:, None]
            at = np.searchsorted(self.key, want)
            here = (at < pb) & (self.key[np.minimum(at, len(self.key) - 1)] == want)
            score = (np.where(here, self.impact[np.minimum(at, len(self.key) - 1)], 0) * times).sum(axis=1)
            found = zip((-score).tolist(), self.null[d].tolist(), self.ids[d].tolist())
            best = sorted([*best, *found])[:k]
            at = np.maximum(at, pa_)
            new_lo = np.concatenate([lo[pick], d + 1])
            new_a, new_b = np.concatenate([pa_, at + here]), np.concatenate([np.minimum(at, pb), pb])
            new_bound, new_split = self._bound(new_a, new_b, times)
            lo, a, b = np.concatenate([lo[rest], new_lo]), np.concatenate([a[rest], new_a]), np.concatenate([b[rest], new_b])
            bound, split = np.concatenate([bound[rest], new_bound]), np.concatenate([split[rest], new_split])
        return best

    def _bound(self, a: np.ndarray, b: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Summed range maxima of each interval, and the document of its greatest impact."""
        size = np.maximum(b - a, 0)
        level = self.log[size]
        last = len(self.key) - 1
        left = self.tables[level, np.minimum(a, last)]
        right = self.tables[level, np.clip(b - (1 << level), 0, last)]
        at = np.where(self.impact[left] >= self.impact[right], left, right)
        gain = np.where(size > 0, self.impact[at] * times, 0)
        most = gain.argmax(axis=1)
        return gain.sum(axis=1), self.doc[at[np.arange(len(at)), most]]


def _shards(batches: Iterator[pa.RecordBatch], weights: np.ndarray, total: int, length: int) -> Iterator[Shard]:
    held, postings, docs = [], 0, 0

    def shard() -> Shard:
        rows = pa.Table.from_batches(held).combine_chunks()
        ids = rows.column("doc_id").combine_chunks()
        lists = rows.column("terms").combine_chunks()
        flat = lambda c: rows.column(c).combine_chunks().flatten().to_numpy().astype(np.int64)
        return Shard(ids.fill_null(LAST).to_numpy().astype(np.int64), ids.is_null().to_numpy(zero_copy_only=False),
                     rows.column("n").to_numpy().astype(np.int64), np.diff(lists.offsets.to_numpy()).astype(np.int64),
                     flat("terms"), flat("tfs"), weights, total, length)

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            sizes = np.cumsum(batch.column(2).slice(at).value_lengths().to_numpy())
            take = int(np.searchsorted(sizes, SHARD_POSTINGS - postings, side="right"))
            take = min(take, SHARD_DOCS - docs, len(sizes))
            if take == 0 and not held:
                take = 1
            if take:
                held.append(batch.slice(at, take))
                postings, docs, at = postings + int(sizes[take - 1]), docs + take, at + take
            if at < batch.num_rows or docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                yield shard()
                held, postings, docs = [], 0, 0
    if held:
        yield shard()


def _block(docs: DataFrame, rows: list, k: int) -> DataFrame:
    """(item, item_id, doc_id, score) candidates of the items ``rows``."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    asked = [Counter(terms_of(r["text"])) for r in rows]
    names = sorted(set().union(*asked)) if asked else []
    number = {t: i for i, t in enumerate(names)}
    vocabulary = sc.broadcast(names)
    index = written(forward_index(docs, vocabulary), "forward-index")
    vocabulary.destroy()
    total, length = index.agg(F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(names), np.int64)
    for term, df in index.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        weights[term] = math.floor(1000 * math.log((2.0 * total + 2) / (2.0 * df + 1)))
    ids = [r["item_id"] for r in rows]
    queries = [(np.array([number[t] for t in c], np.int64), np.array(list(c.values()), np.int64)) for c in asked]
    sent = sc.broadcast((weights, ids, queries))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, ids, queries = sent.value
        best: list[list[tuple]] = [[] for _ in queries]
        for shard in _shards(batches, weights, total, length):
            if len(shard.key):
                for i, (terms, times) in enumerate(queries):
                    best[i] = shard.top(terms, times, best[i], k)
        found = [(i, ids[i], None if null else doc, -score) for i, top in enumerate(best) for score, null, doc in top]
        cols = list(zip(*found)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64()))], ["item", "item_id", "doc_id", "score"])

    found = written(index.mapInArrow(lean(task), "item bigint, item_id bigint, doc_id bigint, score bigint"), "candidates")
    sent.destroy()
    return found


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` highest-scoring documents, ties by doc_id."""
    ship_package(docs.sparkSession)
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    size = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, math.ceil(size[0] / BLOCK_ITEMS), math.ceil(size[1] / BLOCK_CHARS))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    if blocks > 1:
        items = written(items, "items")
    out = None
    for block in range(blocks):
        rows = items.where(F.col("block") == block).collect()
        found = _block(docs, rows, k).withColumn("block", F.lit(block))
        out = found if out is None else out.unionByName(found)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    bucket = F.pmod(F.xxhash64("doc_id", "score"), F.lit(BUCKETS))
    some = out.withColumn("bucket", bucket).withColumn(
        "rank", F.row_number().over(Window.partitionBy("block", "item", "bucket").orderBy(*order))).where(F.col("rank") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("block", "item").orderBy(*order)).cast("int"))
    return ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item's ten highest-scoring documents."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
items AS (
  SELECT row_number() OVER () AS item, item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM (SELECT DISTINCT CAST(item_id AS BIGINT) AS item_id, text FROM benchmark)),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0),
asked AS (SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(terms) AS term FROM items) GROUP BY ALL),
postings AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM postings, corpus GROUP BY term, n_docs),
scored AS (
  SELECT item, item_id, r, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM postings JOIN weights USING (term) JOIN asked USING (term), corpus
  GROUP BY item, item_id, r, doc_id),
ranked AS (
  SELECT item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
