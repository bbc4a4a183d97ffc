"""Gated recurrent language model with a class-factored output softmax.

Tokens are the words of a text (ASCII lower case, split at ASCII white space)
and one end mark. Three kinds of work, all partitioned by Spark:

1. Counts of all training tokens: each task counts its own rows, Spark adds
   up. Texts are split and looked up by Arrow, a batch at a time. From them come the vocabulary (the most frequent tokens, and the end
   mark whatever its rank), its classes (equal shares of square-root
   frequency), and for every other token a rare class (by its first two bytes)
   with the class's token and type count.
2. Training by truncated back-propagation in numpy. In each round every task
   starts from the same weights, trains on its own documents of that round
   (lanes of documents, windows of ``WINDOW`` steps, Adagrad), and the
   weights are averaged by tokens, in two steps so that the driver sees about
   the square root of the number of tasks. The rounds split the training
   documents, so every one of them is trained on, whole: a long one as several
   sequences, each begun with no state and with the token before it as input.
3. Scoring: whole documents run through lanes, the state is carried from
   window to window and reset at a document's start. P(word) is
   P(class | state) * P(word | class, state); in a rare class it is
   (c + 1) / (N_class + V_class + 1) with the token's exact training count c.

Counts of about the ``DICT`` most frequent tokens (a fixed bound) go to the
tasks: a histogram of the counts gives the least count that is among them, and
a hash chooses between tokens of that count, so nothing is sorted and no more
than these reach the driver. All others are joined by shuffling the
(row, token, times) that need them.

Defined results: a null or empty text is its end mark alone; a null id is
hashed as no remainder and learns nothing; repeated rows are counted and
scored each; with nothing to learn from, the model is the untrained one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import pairwise
from math import log, log10, prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm.common import hash_mod, ship_package, table, written

END = b"\n"  # no word holds white space
VOCAB, CLASSES, RARE, DIM, HIDDEN = 2047, 40, 24, 32, 32
DICT = 1 << 17
WINDOW, LANES, RATE, SEED = 32, 256, 0.08, 11
#: Shares of sixteen that each training round takes; together they are all.
ROUNDS = (2, 4, 10)
TRAIN_TOKENS, SCORE_TOKENS = 500_000, 3_000_000
#: Training learns longer documents as sequences of this many tokens; scoring never cuts.
SEQUENCE = 1024
#: The histogram of counts: bins an octave, and the parts a hash cuts the last bin into.
BINS, PARTS = 16, 1 << 20
#: Tokens that a task counts at once.
COUNTED = 2_000_000
#: Rows of one block of the class softmax, and from how many rows on a sum by id goes by itself.
BLOCK, OFTEN = 1024, 16


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, one text behind the other, and where each text's begin (and the last end)."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words, begin = split.flatten().cast(pa.binary()), split.offsets.to_numpy()
    there = pc.binary_length(words).to_numpy() > 0
    if not there.all():  # none before leading and behind trailing white space
        words, begin = words.filter(pa.array(there)), np.concatenate([[0], np.cumsum(there)])[begin]
    return words, begin


def rare_class(word: bytes) -> int:
    return zlib.crc32(word[:2]) % RARE


class Layout:
    """Ids, classes and starting biases of the vocabulary."""

    def __init__(self, top: list[tuple[bytes, int]], rare_counts: dict[int, tuple[int, int]]):
        self.words = [w for w, _ in top]
        counts = np.array([c for _, c in top] or [0], float)
        mass = np.cumsum(np.sqrt(counts + 1))
        self.cls = np.minimum((mass - np.sqrt(counts + 1)) / mass[-1] * CLASSES, CLASSES - 1).astype(np.int64)[:len(top)]
        self.first = np.searchsorted(self.cls, np.arange(CLASSES + 1))
        self.ids = {w: i for i, w in enumerate(self.words)}
        self.rare = np.array([rare_counts.get(k, (0, 0)) for k in range(RARE)], float)  # tokens, types
        by_class = np.concatenate([np.bincount(self.cls, counts[:len(top)], CLASSES) if top else np.zeros(CLASSES), self.rare[:, 0]])
        self.class_bias = np.log((by_class + 1) / (by_class.sum() + 1)).astype(np.float32)
        self.class_bias[:CLASSES][np.diff(self.first) == 0] = -30  # no word, no mass
        self.word_bias = np.log((counts[:len(top)] + 1) / (counts.max() + 1)).astype(np.float32)

    def start(self) -> dict[str, np.ndarray]:
        rng, n = np.random.default_rng(SEED), len(self.words)
        draw = lambda *s: rng.normal(0, 0.2, s).astype(np.float32)
        return {"E": draw(n + RARE, DIM), "Wx": draw(DIM, 3 * HIDDEN), "Wh": draw(HIDDEN, 3 * HIDDEN),
                "b": np.zeros(3 * HIDDEN, np.float32), "Wc": draw(HIDDEN, CLASSES + RARE) / 4, "bc": self.class_bias.copy(),
                "Ww": draw(n, HIDDEN) / 4, "bw": self.word_bias.copy()}

    def id_of(self, word: bytes) -> int:
        """A vocabulary id, or behind the vocabulary the rare class."""
        i = self.ids.get(word)
        return len(self.words) + rare_class(word) if i is None else i

    def end_id(self) -> int:
        return self.id_of(END)

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        n = len(self.words)
        if not n:
            return ids + CLASSES
        return np.where(ids < n, self.cls[np.minimum(ids, n - 1)], ids - n + CLASSES)


def ids_of(texts: pa.Array, lay: Layout) -> Iterator[np.ndarray]:
    """Ids of each text's tokens."""
    words, begin = tokens(texts)
    ids = pc.index_in(words, pa.array(lay.words, pa.binary())).fill_null(-1).to_numpy().astype(np.int64)
    rare = ids < 0
    heads = pc.binary_slice(words.filter(pa.array(rare)), 0, 2).dictionary_encode()
    ids[rare] = np.array([len(lay.words) + rare_class(h) for h in heads.dictionary.to_pylist()], np.int64)[heads.indices.to_numpy()]
    ids = np.insert(ids, begin[1:], lay.end_id())
    for lo, hi in pairwise((begin + np.arange(len(begin))).tolist()):
        yield ids[lo:hi]


class Coder:
    """Looks up the frequent tokens (``known``) in all texts of a batch at once; lives in a task."""

    def __init__(self, lay: Layout, known: dict[bytes, int]):
        self.lay = lay
        self.known, self.end = pa.array(known, pa.binary()), list(known).index(END) if END in known else -1
        self.ids = np.array([*(lay.id_of(w) for w in known), 0], np.int64)

    def each(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """Places in ``known`` of each text's tokens (-1: not there), and the others."""
        words, begin = tokens(texts)
        got = pc.index_in(words, self.known).fill_null(-1).to_numpy()
        at = np.flatnonzero(got < 0)
        others, cuts, ends = words.take(pa.array(at)).to_pylist(), np.searchsorted(at, begin).tolist(), [END] * (self.end < 0)
        got = np.insert(got, begin[1:], self.end)
        for i, (lo, hi) in enumerate(pairwise((begin + np.arange(len(begin))).tolist())):
            yield got[lo:hi], others[cuts[i]:cuts[i + 1]] + ends

    def codes(self, text: str | None) -> tuple[np.ndarray, list[bytes]]:
        """The same of one text."""
        return next(self.each(pa.array([text], pa.string())))

    def encode(self, got: np.ndarray, others: list[bytes]) -> np.ndarray:
        ids = self.ids[got]
        if others:
            ids[got < 0] = [self.lay.id_of(w) for w in others]
        return ids


def lanes_of(docs: list[np.ndarray], width: int) -> list[list[int]]:
    """Documents dealt to lanes of about equal length, longest lane first."""
    import heapq

    heap = [(0, i) for i in range(max(1, min(width, len(docs))))]
    lanes: list[list[int]] = [[] for _ in heap]
    for d in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
        n, i = heapq.heappop(heap)
        lanes[i].append(d)
        heapq.heappush(heap, (n + len(docs[d]), i))
    return sorted(lanes, key=lambda x: -sum(len(docs[d]) for d in x))


def windows(docs: list[np.ndarray], end: int, width: int,
            before: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(previous, target, document, fresh) of each window, (steps, lanes); -1: none.

    ``fresh`` marks a document's first token, where the state begins anew;
    ``before`` holds the token before each document (the end mark if not given).
    """
    lanes = lanes_of(docs, width)
    flat = np.concatenate([docs[d] for x in lanes for d in x])
    owner = np.repeat([d for x in lanes for d in x], [len(docs[d]) for x in lanes for d in x])
    size = np.array([sum(len(docs[d]) for d in x) for x in lanes])
    first = np.cumsum(size) - size
    lead = np.full(len(docs), end) if before is None else np.array(before)
    for at in range(0, int(size[0]), WINDOW):
        n = int((size > at).sum())
        step = at + np.arange(WINDOW)[:, None]
        live = step < size[:n]
        where = np.where(live, first[:n] + step, 0)
        doc = owner[where]
        fresh = (where == 0) | (doc != owner[where - 1])
        prev = np.where(fresh, lead[doc], flat[where - 1])
        yield np.where(live, prev, end), np.where(live, flat[where], -1), np.where(live, doc, -1), fresh


class Room:
    """Memory that one window leaves to the next; fresh pages for every array cost more than what is done on them."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        """An array with any content; it holds until ``name`` is asked for again."""
        size = prod(shape)
        if name not in self.held or self.held[name].size < size:
            self.held[name] = np.empty(size, np.float32)
        return self.held[name][:size].reshape(shape)


def forward(p: dict, gates: np.ndarray, h: np.ndarray, prev: np.ndarray, fresh: np.ndarray, keep: bool, room: Room):
    """States of one window and a one below each, (units + 1, steps * lanes); ``keep`` also returns what back-propagation needs.

    Units come before lanes everywhere (``gates``: units before tokens), so
    that each gate of a step is one piece of memory.
    """
    steps, n = prev.shape
    h, turned, alive = h[:, :n], np.ascontiguousarray(p["Wh"].T), (~fresh).astype(np.float32)
    into = gates.take(prev.ravel(), 1, out=room("into", 3 * HIDDEN, steps * n), mode="clip")
    out = room("states", HIDDEN + 1, steps * n)
    out[HIDDEN] = 1
    kept = [room(f"kept{i}", steps if keep else 1, k * HIDDEN, n) for i, k in enumerate((1, 2, 3, 1))]
    for t in range(steps):
        h0, zr, u, cand = (x[t if keep else 0] for x in kept)
        here = slice(t * n, (t + 1) * n)
        np.multiply(h, alive[t], out=h0)
        np.matmul(turned, h0, out=u)
        np.add(into[:2 * HIDDEN, here], u[:2 * HIDDEN], out=zr)
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        np.multiply(zr[HIDDEN:], u[2 * HIDDEN:], out=cand)
        cand += into[2 * HIDDEN:, here]
        np.tanh(cand, out=cand)
        h = h0 - cand
        h *= zr[:HIDDEN]
        h += cand
        out[:HIDDEN, here] = h
    return out, h, (*kept, alive)


class Output:
    """Weights of the softmax layer as its products take them.

    Biases are a last column of the weights and states end in a one, so that
    one product makes a logit; a softmax is not divided out, its sum goes to the
    states that it is multiplied with.
    """

    def __init__(self, p: dict, lay: Layout):
        self.p, self.lay = p, lay
        self.to_class = np.concatenate([p["Wc"], p["bc"][None]])
        self.to_word = np.concatenate([p["Ww"], p["bw"][:, None]], 1)
        # States lie in (-1, 1), so these bound every logit; as a rule exp() is safe.
        self.safe = max(np.abs(self.to_class).sum(0).max(), np.abs(self.to_word).sum(1).max(initial=0)) < 60

    def softmax(self, x: np.ndarray, w: np.ndarray, at: np.ndarray, e: np.ndarray, picked: np.ndarray, total: np.ndarray,
                learn: bool) -> None:
        """``e``: exp of the logits; ``learn`` makes it the errors, not divided by ``total``. ``picked``: logits of ``at``."""
        np.matmul(x, w, out=e)
        if not self.safe:
            e -= e.max(1, keepdims=True)
        flat, at = e.reshape(-1), at + np.arange(0, e.size, e.shape[1])
        flat.take(at, out=picked, mode="clip")
        np.exp(e, out=e)
        np.dot(e, np.ones(w.shape[1], np.float32), out=total)
        if learn:
            flat[at] -= total

    def __call__(self, states: np.ndarray, target: np.ndarray, room: Room, grads: dict | None = None):
        """ln P of each target (rare ones: of their class; -1: any number); errors of the states if gradients are asked for."""
        lay, p, learn, n = self.lay, self.p, grads is not None, len(target)
        live, cls = (target >= 0).astype(np.float32), lay.class_of(target)
        picked, total = room("picked", n), room("total", n)
        dh = room("dh", HIDDEN, n) if learn else None
        if learn:
            both = np.zeros_like(self.to_class)
            grads["Ww"], grads["bw"] = np.zeros_like(p["Ww"]), np.zeros_like(p["bw"])
        for lo in range(0, n, BLOCK):
            here = slice(lo, min(lo + BLOCK, n))
            x, e = states[:, here], room("e", here.stop - lo, CLASSES + RARE)
            self.softmax(x.T, self.to_class, cls[here], e, picked[here], total[here], learn)
            if learn:
                scale = live[here] / total[here]
                both += (x * scale) @ e
                np.multiply(p["Wc"] @ e.T, scale, out=dh[:, here])
        logp = picked - np.log(total)
        # Words: the states of a class lie together.
        at = np.flatnonzero((target >= 0) & (target < len(lay.words)))
        at = at[np.argsort(cls[at].astype(np.int16), kind="stable")]
        cls, target, many = cls[at], target[at], len(at)
        x = states.take(at, 1, out=room("x", HIDDEN + 1, many), mode="clip")
        picked, total = room("picked", many), room("total", many)
        picked.fill(0)
        total.fill(1)
        dw = room("dw", HIDDEN, many + 1) if learn else None  # a last column for the targets that are no words
        if learn:
            dw.fill(0)
        cuts = np.searchsorted(cls, np.arange(CLASSES + 1)).tolist()
        for c, (lo, hi) in enumerate(pairwise(lay.first.tolist())):
            here = slice(cuts[c], cuts[c + 1])
            if here.start == here.stop or hi - lo <= 1:
                continue
            e = room("e", here.stop - here.start, hi - lo)
            self.softmax(x[:, here].T, self.to_word[lo:hi].T, target[here] - lo, e, picked[here], total[here], learn)
            if learn:
                scale = 1 / total[here]
                word = e.T @ (x[:, here] * scale).T
                grads["Ww"][lo:hi], grads["bw"][lo:hi] = word[:, :HIDDEN], word[:, HIDDEN]
                np.multiply(p["Ww"][lo:hi].T @ e.T, scale, out=dw[:, here])
        logp[at] += picked - np.log(total)
        if learn:
            grads["Wc"], grads["bc"] = both[:HIDDEN], both[HIDDEN]
            place = np.full(n, many)
            place[at] = np.arange(many)
            dh += dw.take(place, 1, out=room("placed", HIDDEN, n), mode="clip")
        return logp, dh


def sums_by_id(rows: np.ndarray, ids: np.ndarray, many: int, room: Room) -> np.ndarray:
    """The sum of the rows of each id below ``many``.

    Ids that come often are summed one by one; of the others first all first
    rows are added, then all second ones, and so on.
    """
    count = np.bincount(ids, minlength=many)
    begin = np.cumsum(count) - count
    order = np.argsort(ids.astype(np.int16 if many < 1 << 15 else np.int64), kind="stable")
    rows = rows.take(order, 0, out=room("sorted", *rows.shape), mode="clip")
    out = np.zeros((many, rows.shape[1]), np.float32)
    for i in np.flatnonzero(count >= OFTEN).tolist():
        np.add.reduce(rows[begin[i]:begin[i] + count[i]], 0, out=out[i])
    few = np.flatnonzero((count > 0) & (count < OFTEN))
    few = few[np.argsort(-count[few], kind="stable")]
    total = rows.take(begin[few], 0)
    for k in range(1, int(count[few].max(initial=0))):
        here = few[:int((count[few] > k).sum())]
        total[:len(here)] += rows.take(begin[here] + k, 0)
    out[few] = total
    return out


def sequences(ids: np.ndarray, end: int) -> tuple[list[np.ndarray], list[int]]:
    """A document's sequences for training, and the token before each of them."""
    cuts = range(0, len(ids), SEQUENCE)
    return [ids[i:i + SEQUENCE] for i in cuts], [int(ids[i - 1]) if i else end for i in cuts]


def train_on(p: dict, sums: dict, lay: Layout, docs: list[np.ndarray], before: list[int]) -> None:
    """Truncated back-propagation over the sequences, one update a window."""
    end, room = lay.end_id(), Room()
    h = np.zeros((HIDDEN, LANES), np.float32)
    for prev, target, _, fresh in windows(docs, end, LANES, before):
        gates = p["Wx"].T @ p["E"].T + p["b"][:, None]
        steps, n = prev.shape
        states, h, (*kept, alive) = forward(p, gates, h, prev, fresh, True, room)
        grads: dict = {}
        _, dout = Output(p, lay)(states, target.ravel(), room, grads)
        into = room("gates", steps, n, 3 * HIDDEN)  # errors of what a token brings to the gates
        du, dh, one_z = room("du", 3 * HIDDEN, n), room("step", HIDDEN, n), room("one_z", HIDDEN, n)
        back, to_h = np.zeros((HIDDEN, n), np.float32), np.zeros((3 * HIDDEN, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            h0, zr, u, cand = (x[t] for x in kept)
            z, r, un = zr[:HIDDEN], zr[HIDDEN:], u[2 * HIDDEN:]
            dz, dr, dn = du[:HIDDEN], du[HIDDEN:2 * HIDDEN], du[2 * HIDDEN:]
            np.add(dout[:, t * n:(t + 1) * n], back, out=dh)
            np.subtract(1, z, out=one_z)
            da = dh * one_z  # to the candidate
            np.multiply(dh, z, out=back)
            np.subtract(h0, cand, out=dz)
            dz *= back
            dz *= one_z
            np.multiply(cand, cand, out=cand)
            np.subtract(1, cand, out=cand)
            da *= cand
            into[t, :, 2 * HIDDEN:] = da.T
            np.multiply(da, r, out=dn)
            np.subtract(1, r, out=dr)
            dr *= dn
            dr *= un
            into[t, :, :2 * HIDDEN] = du[:2 * HIDDEN].T
            back += p["Wh"] @ du
            back *= alive[t]
            to_h += du @ h0.T
        per_id = sums_by_id(into.reshape(-1, 3 * HIDDEN), prev.ravel(), len(p["E"]), room)
        grads["Wh"], grads["b"] = to_h.T, per_id.sum(0)
        grads["Wx"] = p["E"].T @ per_id
        grads["E"] = per_id @ p["Wx"].T
        for k, g in grads.items():
            sums[k] += g * g
            p[k] -= RATE * g / np.sqrt(sums[k])


def log10_scores(p: dict, lay: Layout, docs: list[np.ndarray], gates: np.ndarray) -> np.ndarray:
    """log10 P of each document; a rare token counts for its class only."""
    total = np.zeros(len(docs))
    h, gates, room, output = np.zeros((HIDDEN, 2 * LANES), np.float32), np.ascontiguousarray(gates.T), Room(), Output(p, lay)
    for prev, target, doc, fresh in windows(docs, lay.end_id(), 2 * LANES):
        states, h, _ = forward(p, gates, h, prev, fresh, False, room)
        logp, _ = output(states, target.ravel(), room)
        live = target.ravel() >= 0
        total += np.bincount(doc.ravel()[live], logp[live], len(docs))
    return total / log(10)


def count_tokens(docs: DataFrame) -> DataFrame:
    """(word, c) over all texts of ``docs``, written to the shared folder."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(words: list[pa.Array], ends: int) -> pa.RecordBatch:
            seen = pa.chunked_array(words).value_counts()
            return pa.RecordBatch.from_arrays([pa.concat_arrays([seen.field("values"), pa.array([END], pa.binary())]),
                                               pa.concat_arrays([seen.field("counts"), pa.array([ends], pa.int64())])], ["word", "c"])

        held, n, ends = [], 0, 0
        for batch in batches:
            held.append(tokens(batch.column(0))[0])
            n, ends = n + len(held[-1]), ends + batch.num_rows
            if n > COUNTED:
                yield out(held, ends)
                held, n, ends = [], 0, 0
        if ends:
            yield out(held, ends)

    return written(docs.select("text").mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c")), "lm-counts")


def _bin() -> Column:
    """Place of a count in the histogram, the greatest counts first."""
    return -F.floor(F.log2("c") * BINS).cast("int")


def frequent(counts: DataFrame, most: int = DICT) -> list[tuple[bytes, int]]:
    """About the ``most`` commonest tokens, the commonest first, and the end mark if it was counted."""
    left, cut, parts = most, None, 0
    for r in counts.groupBy(_bin().alias("b")).count().orderBy("b").collect():  # at most 64 octaves
        if r["count"] > left:
            cut, parts = r["b"], left * PARTS // r["count"]
            break
        left -= r["count"]
    if cut is not None:
        last = (_bin() == cut) & (F.pmod(F.xxhash64("word"), F.lit(PARTS)) < parts)
        counts = counts.where((_bin() < cut) | last | (F.col("word") == F.lit(bytearray(END))))
    return sorted(((bytes(r["word"]), r["c"]) for r in counts.collect()), key=lambda x: (-x[1], x[0]))


def layout(counts: DataFrame) -> tuple[Layout, dict[bytes, int], int, int]:
    """Layout, counts of the most frequent tokens, N and V."""
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = frequent(counts)
    ends = dict(top).get(END, 0)
    vocab = [x for x in top if x[0] != END][:VOCAB - 1]
    vocab = sorted([*vocab, (END, ends)], key=lambda x: (-x[1], x[0]))
    known = counts.sparkSession.createDataFrame([(bytearray(w),) for w, _ in vocab], "word binary")
    rare = counts.join(F.broadcast(known), "word", "left_anti").groupBy(
        F.pmod(F.crc32(F.substring("word", 1, 2)), F.lit(RARE)).alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v"))
    return Layout(vocab, {int(r["k"]): (r["n"], r["v"]) for r in rare.collect()}), dict(top), n, v


def _pack(p: dict, weight: float) -> bytes:
    return np.concatenate([(p[k].astype(np.float64) * weight).ravel() for k in sorted(p)]).tobytes()


def _unpack(flat: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, weight = None, 0.0
    for batch in batches:
        for w, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.frombuffer(blob)
            total = x.copy() if total is None else total + x
            weight += w
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([weight]), pa.array([total.tobytes()], pa.binary())], ["w", "blob"])


def fit(docs: DataFrame, lay: Layout, rounds: tuple[int, ...] = ROUNDS) -> dict:
    """Weights trained on every text of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ship_package(spark)
    weights, done = lay.start(), 0
    parts = docs.rdd.getNumPartitions()
    for share in rounds:
        model = spark.sparkContext.broadcast((weights, lay))
        slot = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(sum(rounds)))
        part = docs.where((slot >= done) & (slot < done + share)).select("text")
        done += share

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            start, lay = model.value
            p = {k: v.copy() for k, v in start.items()}
            sums = {k: np.full_like(v, 1e-2) for k, v in p.items()}
            held, before, n, seen = [], [], 0, 0
            for batch in batches:
                for ids in ids_of(batch.column(0), lay):
                    some, leads = sequences(ids, lay.end_id())
                    held.extend(some)
                    before.extend(leads)
                    n += len(ids)
                    if n >= TRAIN_TOKENS:
                        train_on(p, sums, lay, held, before)
                        held, before, seen, n = [], [], seen + n, 0
            if held:
                train_on(p, sums, lay, held, before)
            if seen + n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([float(seen + n)]), pa.array([_pack(p, seen + n)], pa.binary())], ["w", "blob"])

        schema = "w double, blob binary"
        out = part.mapInArrow(run, schema).repartition(max(1, int(parts ** 0.5))).mapInArrow(_add_up, schema)
        got = [(r["w"], np.frombuffer(bytes(r["blob"]))) for r in out.collect()]
        if got:
            weights = _unpack(sum(x for _, x in got) / sum(w for w, _ in got), weights)
    return weights


def score(docs: DataFrame, weights: dict, lay: Layout, known: dict[bytes, int], counts: DataFrame,
          n: int, v: int) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every text."""
    spark = docs.sparkSession
    ship_package(spark)
    model = spark.sparkContext.broadcast((weights, lay, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        weights, lay, known = model.value
        gates = weights["E"] @ weights["Wx"] + weights["b"]
        coder, rid = Coder(lay, known), TaskContext.get().partitionId() << 40
        rare_log = np.log10(lay.rare.sum(1) + 1)
        c = np.array([*known.values(), 0], float)
        base_of = np.log10((c + 1) / (n + v + 1))
        in_class = np.array([*(0.0 if w in lay.ids else log10(x + 1) - rare_log[rare_class(w)] for w, x in known.items()), 0.0])
        base_of[-1] = 0  # tokens that are looked up later
        names = ["rid", "doc_id", "n_tokens", "n_known", "base", "score", "words", "times"]

        def out(rows: list, docs: list) -> pa.RecordBatch:
            s = log10_scores(weights, lay, docs, gates)
            cols = list(zip(*rows, strict=True))
            cols[5] = [a + b for a, b in zip(cols[5], s.tolist(), strict=True)]
            kinds = [pa.int64()] * 4 + [pa.float64()] * 2 + [pa.list_(pa.binary()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        rows, held, held_n = [], [], 0
        for batch in batches:
            for doc_id, (got, others) in zip(batch.column(0).to_pylist(), coder.each(batch.column(1)), strict=True):
                ids, new = coder.encode(got, others), Counter(others)
                rows.append((rid, doc_id, len(got), len(got) - len(others), float(base_of[got].sum()),
                             float(in_class[got].sum()), list(new), list(new.values())))
                rid += 1
                held.append(ids)
                held_n += len(ids)
                if held_n >= SCORE_TOKENS:
                    yield out(rows, held)
                    rows, held, held_n = [], [], 0
        if rows:
            yield out(rows, held)

    got = written(docs.select("doc_id", "text").mapInArrow(
        run, "rid bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, score double, "
             "words array<binary>, times array<bigint>"), "lm-scored")
    # Every other token: its count by a join, or zero where it was never learnt.
    rare = np.log10(lay.rare.sum(1) + 1).tolist()
    each = got.where(F.size("words") > 0).select("rid", F.explode(F.arrays_zip("words", "times")).alias("x")).select(
        "rid", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    k = F.pmod(F.crc32(F.substring("word", 1, 2)), F.lit(RARE)).cast("int")
    c = F.coalesce("c", F.lit(0))
    late = each.join(counts, "word", "left").groupBy("rid").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("_known"),
        F.sum(F.col("times") * F.log10((c + 1) / F.lit(float(n + v + 1)))).alias("_base"),
        F.sum(F.col("times") * (F.log10(c + 1) - F.element_at(F.array(*map(F.lit, rare)), k + 1))).alias("_score"))
    zero = lambda x: F.coalesce(x, F.lit(0))
    return got.drop("words", "times").join(late, "rid", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + zero("_known")).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + zero("_base")).alias("base_score"), (F.col("score") + zero("_score")).alias("score"))


def op3_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of every whole document."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    learn = docs.where(F.coalesce(hash_mod("doc_id", 7) != 2, F.lit(False)))
    counts = count_tokens(learn)
    lay, known, n, v = layout(counts)
    got = score(docs, fit(learn, lay), lay, known, counts, n, v)
    return got.select("doc_id", (hash_mod("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
