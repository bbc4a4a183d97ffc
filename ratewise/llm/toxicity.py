"""Toxicity scores by a convolutional text classifier trained in numpy.

A word is the sum of hashed embeddings of itself and of its leading characters
(so inflected forms share what their stem has learnt). Filters of several
widths slide over a text's words, each filter keeps its maximum over the whole
text, and a logistic layer scores the maxima. Embeddings, filters and layer
are trained by back-propagation (Adagrad) on the driver from a bounded sample
of labelled rows: at most about ``max_per_class`` of either class, taken by a
hash of the id. The first embedding coordinate starts at the shrunk log-odds
of each bucket. The class shares of all labelled rows correct the bias. All
labelled rows that were not trained on are scored in tasks and counted by
language, label and score bin; from these counts comes one threshold for each
language, shrunk to the common one by ``PRIOR`` rows of label 1.

The model (about 2 MB) goes to the tasks; a task scores whole texts, in runs
of bounded length whose maxima are merged, so memory does not grow with a
text. Language decides only between score and verdict, never the score.

Defined results: null and empty texts, and texts without a letter, score what
an empty text scores; labels that are null are left out, repeated labels of
one id count once (their largest), with one of its texts; without labels of both classes every score
is the share of label 1 (0 without labels); a null or unknown language takes
the common threshold; repeated rows give repeated results.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm.common import BROADCAST_ROWS, free_name, hash_mod, lean, ship_package, table

MAX_PER_CLASS = 4000
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 16, 8, 6, (1, 2, 3)
PREFIXES = (4, 6)
EPOCHS, BATCH, RATE, SEED = 6, 64, 0.1, 7
BIN, Z_MAX = 0.05, 16.5  # score bins, in log-odds
BINS = round(2 * Z_MAX / BIN)
PRIOR = 20
RUN = 50_000
REMEMBERED = 50_000
_WORDS = re.compile(r"[^\W\d_]+").findall


def words(text: str | None) -> list[str]:
    return _WORDS((text or "").lower())


def buckets(word: str) -> tuple[int, ...]:
    """Hashed features of a word; the last bucket is the empty one."""
    b = word.encode()
    n = BUCKETS - 1
    return (zlib.crc32(b) % n, *(zlib.crc32(f"{k}:{word[:k]}".encode()) % n if len(word) > k else n for k in PREFIXES))


@dataclass
class ConvNet:
    embed: np.ndarray
    filters: list[np.ndarray]  # one (width, DIM, FILTERS) for each width
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def word_table(self, feats: np.ndarray) -> np.ndarray:
        """What each word adds to each filter at each offset: one row a word."""
        x = self.embed[feats].sum(1)
        return np.concatenate([x @ w[j] for w in self.filters for j in range(len(w))], axis=1).astype(np.float32)

    def maxima(self, rows: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Largest filter values of each run; ``rows`` ends every run with pads."""
        got, col, n = [], 0, len(rows)
        dead = np.ones(n, bool)
        for a, b in zip(starts, ends, strict=True):
            dead[a:max(b, a + 1)] = False
        for w in WIDTHS:
            s = np.zeros((n, FILTERS), np.float32)
            for j in range(w):
                s[:n - j] += rows[j:, col:col + FILTERS]
                col += FILTERS
            s[dead] = -1e30
            got.append(np.maximum.reduceat(s, starts, axis=0))
        return np.concatenate(got, axis=1)

    def finish(self, top: np.ndarray) -> np.ndarray:
        z = np.maximum(top + self.bias, 0) @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


PAD = max(WIDTHS)  # a window on an empty text must not reach the next text


def train(texts: Iterable[list[str]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> ConvNet:
    """Fit the net on tokenised texts (read once) and 0/1 labels (balanced by weight)."""
    rng = np.random.default_rng(seed)
    vocab: dict[str, int] = {}
    ids = [np.array([vocab.setdefault(w, len(vocab)) for w in t], np.int64) for t in texts]
    feats = np.array([buckets(w) for w in vocab] or [(BUCKETS - 1,) * (1 + len(PREFIXES))], np.int64)
    pos, neg = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))
    seen = np.zeros((2, BUCKETS))
    for doc, y in zip(ids, labels, strict=True):
        seen[int(y), np.unique(feats[np.unique(doc)]) if len(doc) else []] += 1
    odds = np.log((seen[1] + .5) / (pos + 1)) - np.log((seen[0] + .5) / (neg + 1))
    n = seen.sum(0)
    embed = rng.normal(0, .05, (BUCKETS, DIM))
    embed[:, 0] = np.clip(odds * n / (n + 5), -3, 3) / 2
    embed[-1] = 0
    filters = [rng.normal(0, .3, (w, DIM, FILTERS)) for w in WIDTHS]
    filters[0][0, 0, :2] = 1
    bias, out, c = np.zeros(FILTERS * len(WIDTHS)), rng.normal(0, .3, FILTERS * len(WIDTHS)), 0.0
    out[:2] = 1
    sums = [np.full_like(p, 1e-4) for p in (embed, *filters, bias, out)]
    c_sum = 1e-4
    weight = np.where(labels == 1, .5 / pos, .5 / neg) * len(labels)
    for _ in range(epochs):
        order = rng.permutation(len(ids))
        for at in range(0, len(order), BATCH):
            take = order[at:at + BATCH]
            flat, starts, ends = _laid_out([ids[i] for i in take])
            f = np.where(flat[:, None] >= 0, feats[flat], BUCKETS - 1)
            x = embed[f].sum(1)
            top, where, col = np.empty((len(take), len(bias))), [], 0
            for w in filters:
                s = sum(x[j:len(x) - len(w) + 1 + j] @ w[j] for j in range(len(w)))
                s = np.concatenate([s, np.zeros((len(w) - 1, FILTERS))])
                best = np.array([a + s[a:max(b, a + 1)].argmax(0) for a, b in zip(starts, ends, strict=True)])
                top[:, col:col + FILTERS] = s[best, np.arange(FILTERS)]
                where.append(best)
                col += FILTERS
            h = np.maximum(top + bias, 0)
            p = 1 / (1 + np.exp(-np.clip(h @ out + c, -30, 30)))
            g = (p - labels[take]) * weight[take] / len(take)
            dh = g[:, None] * out * (h > 0)
            grads, rows, vals, col = [], [], [], 0
            for w, best in zip(filters, where, strict=True):
                d = dh[:, col:col + FILTERS]
                gw = np.empty_like(w)
                for j in range(len(w)):
                    at_j = np.minimum(best + j, len(x) - 1)
                    gw[j] = np.einsum("nfd,nf->df", x[at_j], d)
                    rows.append(f[at_j].reshape(-1, f.shape[1]))
                    vals.append((d[:, :, None] * w[j].T[None]).reshape(-1, DIM))
                grads.append(gw)
                col += FILTERS
            c_sum += g.sum() ** 2
            c -= RATE * g.sum() / np.sqrt(c_sum)
            r, v = np.concatenate(rows), np.concatenate(vals)
            touched, back = np.unique(r, return_inverse=True)
            ge = np.zeros((len(touched), DIM))
            np.add.at(ge, back.reshape(r.shape), v[:, None, :])
            ge[touched == BUCKETS - 1] = 0
            sums[0][touched] += ge ** 2
            embed[touched] -= RATE * ge / np.sqrt(sums[0][touched])
            for param, grad, acc in zip((*filters, bias, out), (*grads, dh.sum(0), h.T @ g), sums[1:], strict=True):
                acc += grad ** 2
                param -= RATE * grad / np.sqrt(acc)
    return ConvNet(embed.astype(np.float32), [w.astype(np.float32) for w in filters], bias.astype(np.float32),
                   out.astype(np.float32), float(c))


def _laid_out(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all documents in a row, each followed by pads (-1)."""
    pad = np.full(PAD, -1, np.int64)
    flat = np.concatenate([x for d in docs for x in (d, pad)])
    n = np.array([len(d) for d in docs])
    starts = np.concatenate([[0], np.cumsum(n + PAD)[:-1]])
    return flat, starts, starts + n


class Scorer:
    """Scores texts in a task; remembers what each word adds to the filters."""

    def __init__(self, net: ConvNet):
        self.net = net
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.table = np.zeros((1, FILTERS * sum(WIDTHS)), np.float32)  # row 0: pads
        self.size = 1

    def _ids(self, tokens: list[str]) -> np.ndarray:
        known = self.known
        new = [w for w in dict.fromkeys(tokens) if w not in known]
        if new:
            if self.size + len(new) > REMEMBERED:
                self.reset()
                known, new = self.known, list(dict.fromkeys(tokens))
            rows = self.net.word_table(np.array([buckets(w) for w in new], np.int64))
            need = self.size + len(new)
            if need > len(self.table):
                bigger = np.zeros((max(need, 2 * len(self.table)), self.table.shape[1]), np.float32)
                bigger[:self.size] = self.table[:self.size]
                self.table = bigger
            self.table[self.size:need] = rows
            known.update(zip(new, range(self.size, need), strict=True))
            self.size = need
        return np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        top = np.full((len(texts), FILTERS * len(WIDTHS)), -1e30, np.float32)
        tokens: list[str] = []
        runs: list[tuple[int, int]] = []  # text, number of words

        def flush() -> None:
            if not runs:
                return
            ids, docs, at = self._ids(tokens), [], 0
            for _, n in runs:
                docs.append(ids[at:at + n])
                at += n
            flat, starts, ends = _laid_out(docs)
            got = self.net.maxima(self.table[np.maximum(flat, 0)], starts, ends)
            np.maximum.at(top, np.array([i for i, _ in runs]), got)
            tokens.clear()
            runs.clear()

        for i, text in enumerate(texts):
            w = words(text)
            for at in range(0, max(len(w), 1), RUN):
                part = w[at:at + RUN + PAD]  # runs overlap, so no window is lost
                tokens.extend(part)
                runs.append((i, len(part)))
                if len(tokens) >= RUN:
                    flush()
        flush()
        return self.net.finish(top)


def _best(pos: np.ndarray, neg: np.ndarray) -> float:
    """Log-odds of the best F1, between two filled bins; counts are in order of the bins."""
    tp, fp = np.cumsum(pos[::-1]), np.cumsum(neg[::-1])
    filled = np.flatnonzero((pos + neg)[::-1] > 0)
    i = int((2 * tp / (tp + fp + tp[-1]))[filled].argmax())
    low = len(pos) - filled[i]  # the lowest bin taken ends here, counted from above
    under = len(pos) - filled[i + 1] if i + 1 < len(filled) else low - 1
    return ((low - 1 + under) / 2) * BIN - Z_MAX


def _thresholds(hist: dict[str | None, np.ndarray], odds: float) -> tuple[float, dict[str, float]]:
    """Common threshold and that of each language, as log-odds.

    ``hist`` has the counts by label and bin, the null language's under None;
    ``odds`` weighs label 0. Every language is judged by its own rows together
    with the rows of all, scaled to ``PRIOR`` rows of label 1, so its threshold
    moves from the common one as far as it has rows, whatever their number.
    """
    both = {x: h * np.array([[odds], [1.0]]) for x, h in hist.items()}
    every = sum(both.values())
    common = _best(every[1], every[0])
    prior = every * (PRIOR / every[1].sum())
    return common, {x: _best(*(h + prior)[::-1]) for x, h in both.items() if x is not None}


def _histogram(docs: DataFrame, y: DataFrame, net: ConvNet) -> dict[str | None, np.ndarray]:
    """Counts by language, label and score bin of all labelled ``docs``, one text for each id.

    Texts are not shuffled: labels go to them when few, else ids and bins go to the labels.
    """
    few = y.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    s = score(docs.join(F.broadcast(y), "doc_id") if few else docs, net)
    at = F.least(F.greatest(F.col("score"), F.lit(1e-7)), F.lit(1 - 1e-7))
    at = F.floor((F.log(at / (1 - at)) + Z_MAX) / BIN).cast("int")
    s = s.select("doc_id", F.struct(F.xxhash64("text").alias("t"), "lang", at.alias("at")).alias("one"), *(["y"] if few else []))
    s = s.groupBy("doc_id", *(["y"] if few else [])).agg(F.min("one").alias("one"))
    hist: dict[str | None, np.ndarray] = {}
    for r in (s if few else s.join(y, "doc_id")).groupBy("one.lang", "one.at", "y").count().collect():
        lang = None if r["lang"] is None else str(r["lang"])
        hist.setdefault(lang, np.zeros((2, BINS)))[r["y"], r["at"]] += r["count"]
    return hist


def fit(docs: DataFrame, labels: DataFrame, learn, max_per_class: int = MAX_PER_CLASS) -> ConvNet | float:
    """Train on a bounded sample of the labelled ``docs`` for which ``learn`` holds,
    calibrate on all the others.

    ``learn`` is a condition on doc_id. Returns the net, or the share of label
    1 where one class has no rows.
    """
    y = labels.select("doc_id", F.col("toxic").cast("int").alias("y")).where(learn & F.col("y").isin(0, 1))
    y = y.groupBy("doc_id").agg(F.max("y").alias("y"))
    count = {r["y"]: r["count"] for r in y.groupBy("y").count().collect()}
    if not (count.get(0) and count.get(1)):
        return float(bool(count.get(1)))
    share = F.lit(0.0)
    for k in (0, 1):
        share = F.when(F.col("y") == k, min(1.0, max_per_class / count[k])).otherwise(share)
    y = y.withColumn("sampled", F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000).withColumn(
        "held", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(5)) == 0)
    docs = docs.select("doc_id", "text", "lang").where(learn)
    got = docs.join(F.broadcast(y.where("sampled")), "doc_id").groupBy("doc_id", "y", "held").agg(F.max("text").alias("text"))
    # The sample's rows come in no set order: sort them for repeatable fits.
    rows = sorted(got.collect(), key=lambda r: r["doc_id"])
    fit_rows = [r for r in rows if not r["held"]] or rows
    net = train((words(r["text"]) for r in fit_rows), np.array([r["y"] for r in fit_rows]))
    net.out_bias += float(np.log(count[1] / count[0]))  # it was trained as if both classes were as many
    hist = _histogram(docs, y.where("held OR NOT sampled").select("doc_id", "y"), net)
    neg, pos = sum(hist.values(), np.zeros((2, BINS))).sum(1)
    if neg and pos:  # move the common threshold to one half
        common, own = _thresholds(hist, count[0] / count[1] * pos / neg)
        net.out_bias -= common
        net.thresholds = {x: float(1 / (1 + np.exp(common - z))) for x, z in own.items()}
    return net


def score(docs: DataFrame, net: ConvNet | float) -> DataFrame:
    """``docs`` with ``score``, ``threshold`` and ``rejected`` (score >= threshold).

    Needs text and lang; columns of those names get underscores in front.
    """
    spark = docs.sparkSession
    ship_package(spark)
    cols = docs.columns
    names = [free_name(x, cols) for x in ("score", "threshold", "rejected")]
    if isinstance(net, float):
        return docs.select("*", F.lit(net).alias(names[0]), F.lit(0.5).alias(names[1]), F.lit(net >= 0.5).alias(names[2]))
    model = spark.sparkContext.broadcast(net)
    t, lang = cols.index("text"), cols.index("lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model.value
        scorer = Scorer(net)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                s = scorer.scores(b.column(t).to_pylist())
                th = np.array([net.thresholds.get(str(x), net.threshold) for x in b.column(lang).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(s, pa.float64()), pa.array(th), pa.array(s >= th)], [*cols, *names])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
                       + [f"`{names[0]}` double, `{names[1]}` double, `{names[2]}` boolean"])
    return docs.mapInArrow(lean(run), schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every whole document, learnt from the labels of the learning fold."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    net = fit(docs, table(spark, sf_dir, "labels"), hash_mod("doc_id", 5) != 0)
    return score(docs, net).select(
        "doc_id", (hash_mod("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "lang", "threshold", "rejected")
