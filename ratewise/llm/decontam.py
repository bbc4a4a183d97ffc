"""Benchmark decontamination by latent semantic retrieval.

1. Every text becomes a sequence of ids of benchmark words (other words: -1);
   the sequences are written once. Passages are ``PASSAGE`` words; the passage
   frequency of every benchmark word is counted over all documents.
2. Features are the benchmark words on at most ``MAX_DF`` of all passages, and
   the ``RAREST`` rarest words of each item whatever their frequency. Rows of
   the matrix are the TF-IDF vectors of all passages of the corpus and of all
   items; items are weighted so that both sides have equal energy, as else
   the corpus alone would shape the latent space.
3. Randomised SVD: with A the matrix, tasks sum up A'(A W) for a random W; its
   orthonormal basis Q goes out again for A'(A Q), and the eigenvectors of
   Q'A'AQ turn Q into the ``RANK`` leading latent directions. A task sends
   one matrix of features x rank; sums go through levels of about the square
   root of the number of tasks until ``DRIVER_SUMS`` of them reach the driver.
4. Windows of ``PASSAGE`` words, every half passage, are projected; windows
   and items whose cosine is at least ``COSINE`` are candidates. A candidate's
   surroundings are compared with the item by longest common subsequence of
   words, in stretches of 1.3 item lengths. It is a leak when the subsequence
   covers ``COPIED`` of the item, or ``PARAPHRASED`` of it where the item's
   answer (its last line, or else its last sentence) is also covered by ``ANSWER``.

Benchmark items go in blocks of ``BLOCK_ITEMS``, so what is sent to tasks is
bounded however large the benchmark is. Documents are never shuffled.

Defined results: null and empty texts have no leaks; items without words are
skipped; equal items each match; of repeated ids a leak of any row counts for
the id; an empty benchmark or corpus gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm.common import lean, ship_package, table, written

PASSAGE = 64
MAX_DF, RAREST = 0.01, 8
RANK, OVERSAMPLE, SEED = 128, 8, 3
COSINE, COPIED, PARAPHRASED, ANSWER = 0.30, 0.7, 0.5, 0.8
BLOCK_ITEMS = 4000
CHUNK_ENTRIES = 10_000
#: Windows of a chunk, and cosines of one at most.
CHUNK_WINDOWS, CHUNK_COSINES = 2048, 2_000_000
#: Matrices that reach the driver at once at most.
DRIVER_SUMS = 8
_WORDS = re.compile(r"\w+").findall


def words(text: str | None) -> list[str]:
    return _WORDS((text or "").lower())


def answer_of(text: str) -> list[str]:
    """Words of the last line, or of the last sentence of a one-line item."""
    lines = [x for x in text.split("\n") if words(x)]
    if len(lines) > 1:
        return words(lines[-1])
    return words(re.split(r"(?<=[.?!])\s+(?=\S)", text.strip())[-1])


def lcs(item: list[int], other: list[int]) -> int:
    """Length of the longest common subsequence (bit-parallel)."""
    at: dict[int, int] = {}
    for i, x in enumerate(item):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(item)) - 1
    v = full
    for x in other:
        u = v & at.get(x, 0)
        v = (v + u | v - u) & full
    return len(item) - v.bit_count()


@dataclass
class Space:
    """Features and latent directions of one block of items."""

    feature: np.ndarray  # word id -> feature or -1
    idf: np.ndarray
    vectors: np.ndarray | None = None  # feature -> latent row (idf inside)
    items: np.ndarray | None = None  # unit latent rows
    cosine: float = COSINE


def _rows(space: Space, ids: np.ndarray, passage: np.ndarray):
    """TF-IDF entries (feature, row, value) of unit rows; row numbers of passages."""
    f = space.feature[ids]
    live = (ids >= 0) & (f >= 0)
    f, p = f[live], passage[live]
    if not len(f):
        return f, p, np.zeros(0, np.float32), p
    v = len(space.idf)
    key, tf = np.unique(p.astype(np.int64) * v + f, return_counts=True)
    p, f = key // v, key % v
    val = tf * space.idf[f]
    _, row = np.unique(p, return_inverse=True)
    val /= np.sqrt(np.bincount(row, val * val))[row]
    return f, row, val.astype(np.float32), p


def _sums(w: np.ndarray, f: np.ndarray, first: np.ndarray, n: np.ndarray, val: np.ndarray | None = None) -> np.ndarray:
    """Sums of ``w[f] * val`` over pieces of ``n`` places from ``first`` on.

    The k-th places of all pieces are added at once, longest pieces first.
    """
    order = np.argsort(-n, kind="stable")
    start, left = first[order], -n[order]
    total = np.zeros((len(n), w.shape[1]), w.dtype)
    for k in range(int(n.max(initial=0))):
        at = start[:np.searchsorted(left, -k)] + k
        rows = w[f[at]]
        if val is not None:
            rows *= val[at, None]
        total[:len(at)] += rows
    out = np.empty_like(total)
    out[order] = total
    return out


def _gram_times(space: Space, w: np.ndarray, ids: np.ndarray, passage: np.ndarray, out: np.ndarray) -> int:
    """Add A'(A w) of the given passages to ``out``; returns the number of rows."""
    f, row, val, _ = _rows(space, ids, passage)
    if not len(f):
        return 0
    first = np.flatnonzero(np.diff(row, prepend=-1))
    z = _sums(w, f, first, np.diff(first, append=len(f)), val)
    order = np.argsort(f, kind="stable")
    g = f[order]
    first = np.flatnonzero(np.diff(g, prepend=-1))
    out[g[first]] += np.add.reduceat(val[order, None] * z[row[order]], first)
    return len(z)


def _sequences(batch: pa.RecordBatch) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(ids of documents, word ids, lengths), about ``CHUNK_ENTRIES`` * 8 words at a time."""
    col = batch.column(1)
    n = pc.list_value_length(col).to_numpy(zero_copy_only=False)
    total = np.cumsum(n)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + 8 * CHUNK_ENTRIES)))
        yield batch.column(0).slice(at, to - at), col.slice(at, to - at).flatten().to_numpy().astype(np.int64), n[at:to]
        at = to


def _passages(n: np.ndarray) -> np.ndarray:
    """Passage number of every word of documents of ``n`` words."""
    per = -(-n // PASSAGE)
    first = np.cumsum(per) - per
    start = np.cumsum(n) - n
    return np.repeat(first, n) + (np.arange(n.sum()) - np.repeat(start, n)) // PASSAGE


def _sum_blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = None, 0
    for b in batches:
        for n, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            x = np.frombuffer(x.as_buffer(), np.float32)
            total = x.astype(np.float64) if total is None else total + x
            rows += n
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], ["n", "blob"])


def _corpus_product(seqs: DataFrame, space: Space, w: np.ndarray) -> tuple[np.ndarray, int]:
    """A'(A w) over all passages of the corpus, and their number."""
    shared = seqs.sparkSession.sparkContext.broadcast((space, w.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, w = shared.value
        out, rows = np.zeros(w.shape, np.float32), 0
        for batch in batches:
            for _, ids, n in _sequences(batch):
                rows += _gram_times(space, w, ids, _passages(n), out)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64()), pa.array([out.tobytes()], pa.binary())], ["n", "blob"])

    schema = "n bigint, blob binary"
    got, parts = seqs.mapInArrow(lean(run), schema), seqs.rdd.getNumPartitions()
    while parts > DRIVER_SUMS:  # sums of sums, until few reach the driver
        parts = max(DRIVER_SUMS, math.ceil(parts ** 0.5))
        got = got.repartition(parts).mapInArrow(_sum_blobs, schema)
    got = got.collect()
    total = np.zeros(w.shape)
    for r in got:
        total += np.frombuffer(bytes(r["blob"]), np.float32).reshape(w.shape)
    shared.destroy()
    return total, sum(r["n"] for r in got)


def _block(docs: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
    spark = docs.sparkSession
    vocab: dict[str, int] = {}
    seq = [np.array([vocab.setdefault(w, len(vocab)) for w in words(t)], np.int64) for _, t in items]
    answers = [[vocab[w] for w in answer_of(t)] for _, t in items]
    known = spark.sparkContext.broadcast(vocab)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        df, passages = np.zeros(len(known.value), np.int64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                found = [words(t) for t in b.column(1).to_pylist()]
                n = np.array([len(x) for x in found])
                flat = np.fromiter(map(get, chain.from_iterable(found), repeat(-1)), np.int32, n.sum())
                p = _passages(n)
                live = flat >= 0
                df += np.bincount(np.unique(p[live] * len(df) + flat[live]) % len(df), minlength=len(df))
                passages += int((-(-n // PASSAGE)).sum())
                seqs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(flat, pa.int32()))
                none = pa.nulls(len(n), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column(0), seqs, none], ["doc_id", "seq", "df"])
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int32())), pa.array([[*df, passages]], pa.list_(pa.int64()))], ["doc_id", "seq", "df"])

    stored = written(docs.mapInArrow(lean(encode), "doc_id bigint, seq array<int>, df array<bigint>"), "leak-sequences")
    known.destroy()
    seqs = stored.where("seq IS NOT NULL").select("doc_id", "seq")
    counts = stored.where("df IS NOT NULL").select(F.posexplode("df").alias("w", "c")).groupBy("w").agg(F.sum("c").alias("c"))
    count = np.zeros(len(vocab) + 1)
    for r in counts.toArrow().to_pylist():
        count[r["w"]] = r["c"]
    df, passages = count[:-1], max(count[-1], 1)

    keep = df <= MAX_DF * passages
    for s in seq:
        u = np.unique(s)
        keep[u[np.argsort(df[u], kind="stable")[:RAREST]]] = True
    feature = np.where(keep, np.cumsum(keep) - 1, -1)
    space = Space(feature, np.log((1 + passages) / (1 + df[keep])) + 1, cosine=COSINE)
    flat, owner = np.concatenate(seq), np.repeat(np.arange(len(seq)), [len(s) for s in seq])
    rank = min(RANK + OVERSAMPLE, int(keep.sum()))

    def product(w: np.ndarray) -> np.ndarray:
        corpus, n = _corpus_product(seqs, space, w)
        own = np.zeros(w.shape, np.float32)
        m = _gram_times(space, w.astype(np.float32), flat, owner, own)
        return corpus + own * (max(n, 1) / max(m, 1))

    q = np.linalg.qr(product(np.random.default_rng(SEED).normal(size=(int(keep.sum()), rank))))[0]
    t = q.T @ product(q)
    _, turn = np.linalg.eigh((t + t.T) / 2)
    space.vectors = (space.idf[:, None] * (q @ turn[:, ::-1][:, :RANK])).astype(np.float32)
    latent = np.zeros((len(seq), space.vectors.shape[1]))
    for i, s in enumerate(seq):
        f = feature[s]
        latent[i] = space.vectors[f[f >= 0]].sum(0)
    norm = np.linalg.norm(latent, axis=1, keepdims=True)
    space.items = (latent / np.where(norm > 0, norm, 1)).astype(np.float32)
    shared = spark.sparkContext.broadcast((space, [s.tolist() for s in seq], answers, [i for i, _ in items]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, seq, answers, item_ids = shared.value
        for batch in batches:
            for doc_ids, ids, n in _sequences(batch):
                best: dict[tuple[int, int], tuple] = {}
                starts = (np.cumsum(n) - n).tolist()
                lengths, window, around = n.tolist(), (-1, -1), {}
                for doc, begin, cosine, item in _candidates(space, ids, n):
                    if window != (doc, begin):
                        window, around = (doc, begin), {}
                    # Items of about one size share the set of words around a window.
                    size, start = len(seq[item]), starts[doc]
                    there = around.get(size.bit_length())
                    if there is None:
                        reach = 1 << size.bit_length()
                        there = around[size.bit_length()] = set(
                            ids[start + max(0, begin - reach):start + min(lengths[doc], begin + PASSAGE + reach)].tolist())
                    if sum(map(there.__contains__, seq[item])) < PARAPHRASED * size:
                        continue
                    old = best.get((doc, item))
                    if old and old[0] == (1.0, 1.0):
                        best[doc, item] = old[0], max(cosine, old[1])
                        continue
                    got = _compared(seq[item], answers[item], ids[start:start + lengths[doc]], begin)
                    if got and (not old or (got, cosine) > old):
                        best[doc, item] = got, cosine
                if best:
                    doc, item = zip(*best, strict=True)
                    (ratio, answer), cosine = zip(*(g for g, _ in best.values()), strict=True), [c for _, c in best.values()]
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids.take(pa.array(doc)), pa.array([item_ids[i] for i in item], pa.int64()), pa.array(cosine, pa.float64()),
                         pa.array(ratio, pa.float64()), pa.array(answer, pa.float64())], ["doc_id", "item_id", "cosine", "lcs", "answer"])

    found = written(seqs.mapInArrow(lean(search), "doc_id bigint, item_id bigint, cosine double, lcs double, answer double"), "leaks")
    shared.destroy()
    return found


def _candidates(space: Space, ids: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int, float, int]]:
    """(document, first word, cosine, item) of windows near an item."""
    start = np.cumsum(n) - n
    step = PASSAGE // 2
    per = np.maximum(-(-(n - step) // step), 1) * (n > 0)
    doc = np.repeat(np.arange(len(n)), per)
    begin = (np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)) * step
    lo = start[doc] + begin
    hi = np.minimum(lo + PASSAGE, start[doc] + n[doc])
    f = space.feature[ids]
    at = np.flatnonzero((ids >= 0) & (f >= 0))
    f = f[at]
    a, b = np.searchsorted(at, lo), np.searchsorted(at, hi)
    mid = np.minimum(np.searchsorted(at, lo + step), b)
    some = np.flatnonzero(b > a)
    size = max(1, min(CHUNK_WINDOWS, CHUNK_COSINES // max(1, len(space.items))))
    for i in range(0, len(some), size):
        part = some[i:i + size]
        # A window is two half passages; each is summed once for the two windows that have it.
        edges = np.unique(np.concatenate([a[part], mid[part], b[part]]))
        halves = _sums(space.vectors, f, edges[:-1], np.diff(edges))
        place = lambda e: np.searchsorted(edges, e)
        first, second, last = place(a[part]), place(mid[part]), place(b[part])
        x = np.where((second > first)[:, None], halves[np.minimum(first, len(halves) - 1)], 0)
        x += np.where((last > second)[:, None], halves[np.minimum(second, len(halves) - 1)], 0)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        sims = (x @ space.items.T).ravel()
        near = np.flatnonzero(sims >= space.cosine)
        w, item = np.divmod(near, len(space.items))
        yield from zip(doc[part[w]].tolist(), begin[part[w]].tolist(), sims[near].tolist(), item.tolist(), strict=True)


def _compared(item: list[int], answer: list[int], text: np.ndarray, begin: int):
    """(share of the item, share of the answer) if the surroundings hold a leak."""
    size = len(item)
    near = text[max(0, begin - size):begin + PASSAGE + size].tolist()
    there = set(near)
    if sum(x in there for x in item) < PARAPHRASED * size:
        return None
    length, step = -(-13 * size // 10), max(1, size // 4)
    mine = set(item)
    before = [0, *accumulate(x in mine for x in near)]  # words of the item up to each place
    best = 0
    found: tuple[float, float] | None = None
    for i in range(0, max(1, len(near) - length + step), step):
        # A subsequence is no longer than the words of the item in the stretch.
        here = before[min(i + length, len(near))] - before[min(i, len(near))]
        if here < PARAPHRASED * size or here < best and here < COPIED * size and found:
            continue
        got = lcs(item, near[i:i + length])
        best = max(best, got)
        if got < PARAPHRASED * size:
            continue
        # Each stretch that is near enough is asked for the answer, not only the nearest.
        share = got / size, lcs(answer, near[i:i + length]) / len(answer) if answer else 0.0
        if (share[0] >= COPIED or share[1] >= ANSWER) and (found is None or share > found):
            found = share
    return found


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer) of every leak of an item in a document."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select("doc_id", "text")
    out, last = None, None
    while True:
        block = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        block = block.where("item_id IS NOT NULL AND text IS NOT NULL").groupBy("item_id").agg(F.collect_set("text").alias("texts"))
        if last is not None:
            block = block.where(F.col("item_id") > last)
        got = block.orderBy("item_id").limit(BLOCK_ITEMS).collect()
        items = [(r["item_id"], t) for r in got for t in sorted(r["texts"]) if words(t)]
        if items:
            found = _block(docs, items)
            out = found if out is None else out.union(found)
        if len(got) < BLOCK_ITEMS:
            break
        last = got[-1]["item_id"]
    if out is None:
        return spark.createDataFrame([], "doc_id bigint, item_id bigint, cosine double, lcs double, answer double")
    best = F.max(F.struct("lcs", "answer", "cosine")).alias("x")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "x.cosine", "x.lcs", "x.answer")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leak of a benchmark item in a document."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return find_leaks(docs, table(spark, sf_dir, "benchmark"))
