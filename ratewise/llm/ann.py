"""Approximate nearest neighbours by an inverted multi-index.

Each vector is cut in two halves, and each half is quantised by a codebook of
its own (k-means in numpy, on a sample of about ``FIT_ROWS`` distinct vectors
taken by hash). A vector's cell is its pair of centroids, so k centroids a half
give k * k cells. A query sorts the centroids of either half by distance and
walks the centroid pairs by summed distance with a heap, until the cells it has
passed hold a share ``SHARE`` of all n entries and ``SPARE`` times the root of
n more (cells of few entries vary more in size); all of those are reranked by
their exact distance in double precision. (Vectors that fill all directions
alike, as the given ones do, need a large share for a recall of 0.9; for
clustered ones a smaller share does.)

On Spark: every vector is indexed. Equal vectors are one entry that keeps its
eleven smallest ids (no more can be among ten nearest), so a vector that a
third of all rows share is neither a large cell nor many searches. Vectors and
probes meet by their first centroid, a probe with the list of second centroids
it has passed; where a first centroid has many entries they are dealt to
several parts. The sizes of all cells, k * k counts, go to the tasks (k is at
most ``MAX_K``). A task reads its parts in order and keeps each query's best.

Defined results: vectors that are null, zero, of a length other than the most
frequent one, or hold a null or non-finite component take no part; a repeated
id is an entry for each of its vectors; fewer candidates than asked for give
fewer rows; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewise.llm.common import ship_package, small, table, written

TOP = 10
FIT_ROWS = 16_384
MAX_K = 1024
ROUNDS, SEED = 12, 5
SHARE, SPARE = 0.42, 3.5
PART_ROWS = 2048
TENSOR = 2_000_000
BLOCK_ROWS = 4096
HELD_QUERIES = 100_000


def valid(v: Column) -> Column:
    fine = F.forall(v, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return v.isNotNull() & fine & F.exists(v, lambda x: x != 0)


def entries(rows: DataFrame, keep: int = TOP + 1) -> DataFrame:
    """(entry, ids, vec): distinct vectors with their ``keep`` smallest ids.

    ``entry`` is the smallest id, so that equal distances come in order of ids;
    where one id is the smallest of several vectors it is a hash of the vector.
    """
    rows = rows.where(valid(F.col("vec")))
    size = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    rows = rows.where(F.size("vec") == (size[0]["n"] if size else 0))
    by = Window.partitionBy("vec").orderBy("id")
    few = rows.withColumn("r", F.row_number().over(by)).where(F.col("r") <= keep)
    found = written(few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")), "ann-distinct")
    first = F.element_at("ids", 1)
    shared = found.groupBy(first.alias("first")).count().where("count > 1").select("first", F.lit(True).alias("shared"))
    return found.withColumn("first", first).join(small(written(shared, "ann-shared-ids")), "first", "left").select(
        F.when(F.col("shared"), F.xxhash64("vec")).otherwise(F.col("first")).alias("entry"), "ids", "vec")


def kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        total = np.array([np.bincount(near, x[:, j], k) for j in range(x.shape[1])]).reshape(x.shape[1], k).T
        n = np.bincount(near, minlength=k)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` to all of ``c``."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(x[i:i + BLOCK_ROWS], c).argmin(1) for i in range(0, len(x), BLOCK_ROWS)] or [np.zeros(0, np.int64)])


def walk(d1: np.ndarray, d2: np.ndarray, sizes: np.ndarray, enough: int) -> dict[int, list[int]]:
    """Non-empty cells by summed centroid distance until they hold ``enough``:
    first centroid -> second centroids.

    The heap has one pair for each first centroid reached so far; the next
    first centroid enters when the one before it gives its nearest pair.
    """
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2 = d1[o1].tolist(), d2[o2].tolist()
    grid = [sizes[o1[0]][o2].tolist()]  # a row when its first centroid is reached
    n1, n2 = len(s1), len(s2)
    heap, out, held = [(s1[0] + s2[0], 0, 0)], [[] for _ in s1], 0
    while heap and held < enough:
        _, i, j = heap[0]
        n = grid[i][j]
        if n:
            out[i].append(j)
            held += n
        if j + 1 < n2:
            heapq.heapreplace(heap, (s1[i] + s2[j + 1], i, j + 1))
        else:
            heapq.heappop(heap)
        if not j and i + 1 < n1:
            heapq.heappush(heap, (s1[i + 1] + s2[0], i + 1, 0))
            grid.append(sizes[o1[i + 1]][o2].tolist())
    return {int(o1[i]): o2[x].tolist() for i, x in enumerate(out) if x}


def _matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1) if len(col) else np.zeros((0, 1))


def search(index: DataFrame, queries: DataFrame, top: int = TOP + 1, share: float = SHARE) -> DataFrame:
    """(query, entry, score, r): the ``top`` nearest found entries of each query.

    ``index`` and ``queries`` hold (entry, vec); all vectors have one length.
    """
    spark = index.sparkSession
    ship_package(spark)
    n = index.count()
    if not n:
        return spark.createDataFrame([], "query bigint, entry bigint, score double, r int")
    enough = max(top, int(share * n + SPARE * n ** 0.5))
    take = F.pmod(F.xxhash64("entry", F.lit(3)), F.lit(1_000_000)) < min(1.0, FIT_ROWS / n) * 1_000_000
    sample = np.array([r["vec"] for r in index.where(take).orderBy("entry").select("vec").collect()], float)
    if not len(sample):
        sample = np.array([index.select("vec").first()["vec"]], float)
    half = sample.shape[1] // 2
    k = max(1, min(MAX_K, int(n ** 0.5), len(sample) // 8 or 1, len(np.unique(sample, axis=0))))
    books = kmeans(sample[:, :half], k), kmeans(sample[:, half:], k)
    shared = spark.sparkContext.broadcast(books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1))
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(nearest(y, c), pa.int32()) for y, c in zip((x[:, :half], x[:, half:]), shared.value, strict=True)),
                     b.column(0), b.column(1)], ["c1", "c2", "entry", "vec"])

    kind = dict(index.dtypes)["vec"]
    cells = written(index.select("entry", "vec").mapInArrow(assign, f"c1 int, c2 int, entry bigint, vec {kind}"), "ann-cells")
    sizes = np.zeros((k, k), np.int64)
    for r in cells.groupBy("c1", "c2").count().toArrow().to_pylist():
        sizes[r["c1"], r["c2"]] = r["count"]
    pieces = np.maximum(-(-sizes.sum(1) // PART_ROWS), 1)
    first = np.concatenate([[0], np.cumsum(pieces)[:-1]])
    counts = spark.sparkContext.broadcast((sizes, first, pieces))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, first, pieces = counts.value
        for b in batches:
            x = _matrix(b.column(1))
            if not b.num_rows:
                continue
            d1, d2 = distances(x[:, :half], shared.value[0]), distances(x[:, half:], shared.value[1])
            for at in range(0, len(x), 64):
                part, rows, seconds = [], [], []
                for i in range(at, min(at + 64, len(x))):
                    for c1, c2 in walk(d1[i], d2[i], sizes, enough).items():
                        part.extend(range(first[c1], first[c1] + pieces[c1]))
                        rows.extend([i] * pieces[c1])
                        seconds.extend([c2] * pieces[c1])
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), b.column(0).take(take), b.column(1).take(take),
                                                  pa.array(seconds, pa.list_(pa.int32()))], ["part", "entry", "vec", "c2"])

    starts = F.array(*[F.lit(int(v)) for v in first]), F.array(*[F.lit(int(v)) for v in pieces])
    begin, many = (F.element_at(v, F.col("c1") + 1) for v in starts)
    rows = cells.select((begin + F.pmod(F.xxhash64("entry"), many)).cast("long").alias("part"), F.lit(0).cast("tinyint").alias("kind"),
                        "entry", "vec", F.array("c2").alias("c2"))
    rows = rows.unionByName(queries.select("entry", "vec").mapInArrow(probe, f"part bigint, entry bigint, vec {kind}, c2 array<int>").withColumn(
        "kind", F.lit(1).cast("tinyint")))
    rows = rows.repartition("part").sortWithinPartitions("part", "kind", "entry")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        cell, held = None, []

        def out() -> pa.RecordBatch:
            cut = {q: (e[o], d[o]) for q, (e, d) in best.items() for o in [np.lexsort((e, d))[:top]]}
            best.clear()
            q = np.repeat(np.array(list(cut), np.int64), [len(e) for e, _ in cut.values()])
            return pa.RecordBatch.from_arrays([pa.array(q), *(pa.array(np.concatenate(x)) for x in zip(*cut.values(), strict=True))],
                                              ["query", "entry", "score"])

        for b in batches:
            if not b.num_rows:
                continue
            parts, kinds, entry = (b.column(i).to_numpy() for i in (0, 1, 2))
            x, lists = _matrix(b.column(3)), b.column(4)
            cuts = np.flatnonzero((np.diff(parts) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(parts)], strict=True):
                if parts[lo] != cell:
                    cell, held = parts[lo], []
                if kinds[lo] == 0:
                    held.append((entry[lo:hi], x[lo:hi], lists.slice(lo, hi - lo).flatten().to_numpy()))
                    continue
                if not held:
                    continue
                held = [tuple(np.concatenate(v) for v in zip(*held, strict=True))]
                ids, vecs, second = held[0]
                step = max(1, TENSOR // vecs.size)
                for at in range(lo, hi, step):
                    to = min(at + step, hi)
                    d = np.sqrt(((x[at:to, None] - vecs[None]) ** 2).sum(2))
                    asked = np.zeros((to - at, k), bool)
                    part = lists.slice(at, to - at)
                    asked[np.repeat(np.arange(to - at), pc.list_value_length(part).to_numpy()), part.flatten().to_numpy()] = True
                    d[~asked[:, second]] = np.inf
                    near = np.argsort(d, axis=1, kind="stable")[:, :top]  # equal distances stay by id
                    for i in range(to - at):
                        o = near[i][d[i, near[i]] < np.inf]
                        new = ids[o], d[i, o]
                        old = best.get(entry[at + i])
                        if old is not None:
                            new = np.concatenate([old[0], new[0]]), np.concatenate([old[1], new[1]])
                            if len(new[0]) > 8 * top:
                                o = np.lexsort(new)[:top]
                                new = new[0][o], new[1][o]
                        best[int(entry[at + i])] = new
                if len(best) > HELD_QUERIES:
                    yield out()
        if best:
            yield out()

    found = rows.mapInArrow(rank, "query bigint, entry bigint, score double")
    by = Window.partitionBy("query").orderBy("score", "entry")
    return found.withColumn("r", F.row_number().over(by)).where(F.col("r") <= top)


def nearest_neighbours(vectors: DataFrame, is_query: Column, top: int = TOP, share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row of ``vectors`` (id, vec)
    for which ``is_query`` (a condition on id) holds."""
    rows = vectors.select("id", "vec").where("id IS NOT NULL")
    index = written(entries(rows, top + 1), "ann-entries")
    asked = rows.where(is_query & valid(F.col("vec"))).join(
        index.select("entry", F.col("vec").alias("_vec")), F.col("vec") == F.col("_vec")).select("id", "entry").distinct()
    asked = written(asked, "ann-asked")
    queries = index.join(asked.select("entry").distinct(), "entry").select("entry", "vec")
    got = written(search(index.select("entry", "vec"), queries, top + 1, share), "ann-found")
    each = got.join(index.select("entry", "ids"), "entry").select("query", F.explode("ids").alias("vec_id"), "score")
    lists = each.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    mine = asked.join(lists.withColumnRenamed("query", "entry"), "entry").select(
        F.col("id").alias("query_id"), F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("id")), 1, top).alias("near"))
    return mine.select("query_id", F.posexplode("near").alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest of every hundredth vector."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vec"))
    return nearest_neighbours(rows, F.col("id") % 100 == 0)
