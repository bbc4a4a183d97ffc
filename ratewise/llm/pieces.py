"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

The symbols of many words lie in one flat numpy array. A round looks up the
rank of every pair of neighbours, takes the smallest rank of each word by a
segmented minimum, merges all pairs of that rank at once, leftmost first, and
compacts the array; words without a pair left leave it. Rounds end when it is
empty.

Why that is exact: the library merges one pair at a time, the best score first,
then the leftmost. Merging all pairs of the smallest rank of a word at once
differs from that only if a merge makes a pair that is as good or better than
itself. Pieces for which the vocabulary holds such a pair are found when the
model is read; while one of them is a word's smallest, only its leftmost pair
is merged in the round. Words are cut where no piece of the vocabulary has the
two characters side by side, so no merge can cross a cut. A cut piece of over
``LONG`` symbols (white space or junk without any border) takes the same merges
from a heap, since its rounds would be about as many as its merges.

Each distinct word is encoded once per task (a bounded table remembers them).
Rows are independent, so nothing is shuffled.

Defined results: a null or empty text has only the begin and end ids asked for;
characters that no piece has become the ids of their bytes; a null id list
decodes to the empty text, ids that are null or outside the vocabulary raise;
repeated rows give repeated results, other columns pass through.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm.common import free_name, lean, remembers, ship_package, table

SPACE = "▁"
LONG = 1024
GROUP_CHARS = 1_000_000
REMEMBERED_CHARS = 64
MAX_REMEMBERED = 400_000
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
NONE = np.iinfo(np.int64).max

codecs.register_error("each-byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceCodec:
    """Encoder and decoder over one BPE model; lives in a task."""

    def __init__(self, path: str, remember: int = MAX_REMEMBERED):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        kinds = [p.type for p in model.pieces]
        if (model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix
                or {USER_DEFINED, UNUSED} & set(kinds)):
            raise ValueError("only BPE models without normalisation, user-defined or unused pieces are read")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.bos, self.eos = model.trainer_spec.bos_id, model.trainer_spec.eos_id
        names = [p.piece for p in model.pieces]
        self.size = len(names)
        self.remember = remember
        self.words: dict[str, tuple[int, ...]] = {}
        self._tables(names, kinds, [p.score for p in model.pieces])
        unknown = model.trainer_spec.unk_surface.encode()
        plain = [n.replace(SPACE, " ").encode() for n in names]
        self.surface = [bytes([int(n[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else unknown if k == UNKNOWN else s
                        for n, k, s in zip(names, kinds, plain)]
        self.control = frozenset(i for i, k in enumerate(kinds) if k == CONTROL)
        self.spaced = frozenset(i for i, (n, k) in enumerate(zip(names, kinds)) if k == NORMAL and n.startswith(SPACE))

    def _tables(self, names: list[str], kinds: list[int], scores: list[float]) -> None:
        import regex

        of = {n: i for i, (n, k) in enumerate(zip(names, kinds)) if k == NORMAL}
        byte_at = {int(n[3:5], 16): i for i, (n, k) in enumerate(zip(names, kinds)) if k == BYTE}
        unknown = kinds.index(UNKNOWN)
        self.bytes_of = lambda c: tuple(byte_at[b] for b in c.encode()) if byte_at else (unknown,)
        # Ranks of pieces: equal scores have equal ranks.
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in of.values()}, reverse=True))}
        rank = np.full(len(names), -1, np.int64)
        rank[list(of.values())] = [order[scores[i]] for i in of.values()]
        # Symbol of each character: its piece, or, if it has none, a number below 0.
        self.symbol = -1 - np.arange(0x110000, dtype=np.int64)
        for n, i in of.items():
            if len(n) == 1:
                self.symbol[ord(n)] = i
        triples = [(of[n[:k]], of[n[k:]], i) for n, i in of.items() for k in range(1, len(n)) if n[:k] in of and n[k:] in of]
        left, right, made = np.array(triples, np.int64).reshape(-1, 3).T
        keys = left * len(names) + right
        at = np.argsort(keys)
        self.keys, self.made = keys[at], made[at]
        self.rank = rank
        self.risky = np.zeros(len(names), bool)
        for part in (left, right):
            self.risky[part[rank[made] <= rank[part]]] = True
        beside = {n[k:k + 2] for n in of for k in range(len(n) - 1)}
        self.beside = np.sort(np.array([ord(b[0]) << 21 | ord(b[1]) for b in beside], np.int64))
        # Where every text may be cut before words are remembered.
        in_pieces = set("".join(of))
        if any(b[0] != SPACE and b[1] == SPACE for b in beside):
            self.find = lambda text: [text] if text else []
        else:
            bare = "".join(c for c in "\n\r\t" if c not in in_pieces)
            self.find = regex.compile(f"{SPACE}*[^{SPACE}{bare}]+|{SPACE}+" + (f"|[{bare}]+" if bare else "")).findall

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two symbols make put together, or -1."""
        if not len(self.keys):
            return np.full(len(left), -1, np.int64)
        want = np.where((left >= 0) & (right >= 0), left * self.size + right, -1)
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.made[at], -1)

    def encode_words(self, words: list[str]) -> list[tuple[int, ...]]:
        """Ids of each word, by merge rounds over all of them together."""
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        joined = (code[:-1] << 21) | code[1:]
        cut = word[1:] != word[:-1]
        if len(self.beside):
            near = np.minimum(np.searchsorted(self.beside, joined), len(self.beside) - 1)
            cut |= self.beside[near] != joined
        else:
            cut[:] = True
        seg = np.concatenate([[0], np.cumsum(cut)])[:len(code)]
        sym = self.symbol[code]
        del joined, cut
        done_seg, done_sym = [], []
        long = np.flatnonzero(np.bincount(seg, minlength=1) > LONG)
        for s in long:
            lo, hi = np.searchsorted(seg, [s, s + 1])
            out = self._by_heap(sym[lo:hi].tolist())
            done_seg.append(np.full(len(out), s))
            done_sym.append(np.array(out, np.int64))
        word_of = word[np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])] if len(seg) else word
        if len(long):
            stay = ~np.isin(seg, long)
            sym, seg = sym[stay], seg[stay]
        # The piece of each symbol with its right neighbour; none across a cut.
        made = np.full(len(sym), -1, np.int64)
        inner = np.flatnonzero(seg[1:] == seg[:-1])
        made[inner] = self.pairs(sym[inner], sym[inner + 1])
        while len(sym):
            rank = np.where(made >= 0, self.rank[made], NONE)
            start = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
            length = np.diff(np.r_[start, len(sym)])
            best = np.minimum.reduceat(rank, start)
            alive = np.repeat(best < NONE, length)
            hit = np.flatnonzero(alive & (rank == np.repeat(best, length)))
            if len(hit):
                # Of pairs that overlap every other one; of a risky piece the leftmost only.
                run = np.maximum.accumulate(np.where(np.r_[True, hit[1:] != hit[:-1] + 1], np.arange(len(hit)), 0))
                first = np.r_[True, seg[hit[1:]] != seg[hit[:-1]]]
                careful = np.zeros(len(start), bool)
                order = np.repeat(np.arange(len(start)), length)[hit]
                careful[order[self.risky[made[hit]]]] = True
                hit = hit[np.where(careful[order], first, (np.arange(len(hit)) - run) % 2 == 0)]
            if not alive.all():
                done_seg.append(seg[~alive])
                done_sym.append(sym[~alive])
            sym[hit] = made[hit]
            alive[hit + 1] = False
            at = (np.cumsum(alive) - 1)[hit]
            sym, seg, made = sym[alive], seg[alive], made[alive]
            # Only a merged symbol's own pairs are looked up again.
            at = np.concatenate([at, at[at > 0] - 1])
            made[at] = -1
            at = at[at + 1 < len(sym)]
            at = at[seg[at] == seg[at + 1]]
            made[at] = self.pairs(sym[at], sym[at + 1])
        if not done_seg:
            return [()] * len(words)
        seg, sym = np.concatenate(done_seg), np.concatenate(done_sym)
        at = np.argsort(seg, kind="stable")
        word, sym = word_of[seg[at]], sym[at]
        ends = np.searchsorted(word, np.arange(1, len(words) + 1)).tolist()
        flat, bare = sym.tolist(), np.logical_or.reduceat(np.r_[sym < 0, False], [0, *ends[:-1]]).tolist()
        out, lo = [], 0
        for hi, some in zip(ends, bare):
            ids = flat[lo:hi]
            out.append(tuple(chain.from_iterable((i,) if i >= 0 else self.bytes_of(chr(-1 - i)) for i in ids)) if some else tuple(ids))
            lo = hi
        return out

    def _by_heap(self, sym: list[int]) -> list[int]:
        """The same merges in the same order, one at a time, for one long stretch."""
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs(np.array(sym[:-1], np.int64), np.array(sym[1:], np.int64))
        table = dict(zip(self.keys.tolist(), self.made.tolist()))
        rank = self.rank.tolist()
        heap = [(rank[m], i, m, sym[i], sym[i + 1]) for i, m in enumerate(first.tolist()) if m >= 0]
        heapq.heapify(heap)

        def push(i: int, j: int) -> None:
            if i >= 0 and j < n and sym[i] >= 0 and sym[j] >= 0 and (m := table.get(sym[i] * self.size + sym[j])) is not None:
                heapq.heappush(heap, (rank[m], i, m, sym[i], sym[j]))

        gone = bytearray(n)
        while heap:
            _, i, m, a, b = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or sym[i] != a or sym[j] != b:
                continue
            sym[i], gone[j] = m, 1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            push(before[i], i)
            push(i, after[i])
        return [s for s, g in zip(sym, gone) if not g]

    def encode(self, texts: list[str], bos: bool = False, eos: bool = True) -> list[list[int]]:
        """Ids of each text; the words not seen before are encoded together."""
        split = [self.find(self.prefix + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.words) > self.remember:
            self.words.clear()
        new = list(set(chain.from_iterable(split)).difference(self.words))
        known = self.words
        at = 0
        while at < len(new):
            size, end = 0, at
            while end < len(new) and (end == at or size + len(new[end]) <= GROUP_CHARS):
                size += len(new[end])
                end += 1
            known.update(zip(new[at:end], self.encode_words(new[at:end])))
            at = end
        head, tail = [self.bos] if bos else [], [self.eos] if eos else []
        out = [[*head, *chain.from_iterable(map(known.__getitem__, words)), *tail] for words in split]
        for w in new:
            if len(w) > REMEMBERED_CHARS:
                del known[w]
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ``ids``; control pieces have none, bytes that are no UTF-8 become U+FFFD."""
        out, begun = [], not self.prefix
        for control, part in groupby(ids, self.control.__contains__):
            if control:
                continue
            part = list(part)
            if min(part) < 0:
                raise ValueError("ids must not be negative")
            data = b"".join(map(self.surface.__getitem__, part))
            if not begun and part[0] in self.spaced:
                data = data[1:]
            begun = True
            out.append(data.decode("utf-8", "each-byte"))
        return "".join(out)


_CODECS: dict[str, PieceCodec] = {}
remembers("pieces", _CODECS.clear)


def _codec(name: str) -> PieceCodec:
    """The task's codec; the model file comes with the job to each executor."""
    if name not in _CODECS:
        _CODECS[name] = PieceCodec(SparkFiles.get(name))
    return _CODECS[name]


def _ship(spark: SparkSession, path: str) -> str:
    ship_package(spark)
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def _groups(texts: pa.Array) -> Iterator[tuple[int, list]]:
    """Row numbers and texts, a bounded number of characters at a time (a text stays whole)."""
    at, size, group = 0, 0, []
    for text in texts:
        value = text.as_py()
        if group and size + len(value or "") > GROUP_CHARS:
            yield at, group
            at, size, group = at + len(group), 0, []
        group.append(value)
        size += len(value or "")
    if group:
        yield at, group


def _mapped(df: DataFrame, model_path: str, col: str, out: str, arrow, kind: str, many) -> DataFrame:
    out = free_name(out, [c for c in df.columns if c != out])
    name = _ship(df.sparkSession, model_path)
    keep = [c for c in df.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(name)
        for batch in batches:
            for at, group in _groups(batch.column(batch.schema.get_field_index(col))):
                b = batch.slice(at, len(group))
                yield pa.RecordBatch.from_arrays(
                    [b.column(b.schema.get_field_index(c)) for c in keep] + [pa.array(many(codec, group), arrow)], [*keep, out])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != out] + [f"`{out}` {kind}"])
    return df.mapInArrow(lean(run, "pieces"), schema)


def encode(docs: DataFrame, model_path: str, text: str = "text", out: str = "ids", bos: bool = False, eos: bool = True) -> DataFrame:
    """``docs`` with the piece ids of every whole text in column ``out``."""
    return _mapped(docs, model_path, text, out, pa.list_(pa.int32()), "array<int>",
                   lambda codec, texts: codec.encode([t or "" for t in texts], bos, eos))


def decode(rows: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text of every id list in column ``out``."""
    return _mapped(rows, model_path, ids, out, pa.large_string(), "string",
                   lambda codec, lists: [codec.decode(x or []) for x in lists])


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, then decode the ids."""
    name = _ship(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(name)
        decimal = [str(i) for i in range(codec.size)]
        for batch in batches:
            for at, group in _groups(batch.column(1)):
                n, ids_sha, text_sha = [], [], []
                for ids in codec.encode([t or "" for t in group]):
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    text_sha.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(group)), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                     pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        lean(run, "pieces"), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document through the encoder (with an end id) and back, as digests."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return digests(docs, public_tokenizers.path("piece_bpe_32k.model"))
