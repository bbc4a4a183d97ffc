"""Byte-level BPE encoding and decoding as a monoid tree reduction.

Encodings of neighbouring byte strings form a monoid: ``join(a, b)`` gives the
encoding of the two strings put together. A piece (one match of the tokenizer's
pattern) is split in halves down to a few bytes, the halves are encoded, and
neighbours are joined up the tree. A join re-encodes a window around the
boundary and widens it until the tokens outside are provably final.

Why that is exact: merges run in order of rank, leftmost first. If every two
neighbouring tokens of a sequence, encoded on their own, give back those two
tokens, then in the whole string no merge can ever cross a token border (the
first merge that did would also be done in that pair alone). So a sequence is
the encoding as soon as all its neighbouring pairs are stable; a join only has
to look at the pairs on the two seams of its window.

Pieces are matched over the whole text, each piece is encoded once per task
(a bounded table remembers them), and decoding concatenates bytes up a tree
over the ids. Rows are independent, so nothing is shuffled.

Defined results: a null or empty text has no tokens; an id that is not in the
ranks, or null, raises in decoding; repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm.common import free_name, lean, remembers, ship_package, table

LEAF_BYTES = 4
DECODE_LEAF = 1024
MAX_REMEMBERED = 150_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class TreeCodec:
    """Encoder and decoder over one table of ranks; lives in a task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remember: int = MAX_REMEMBERED):
        import regex

        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.remember = remember
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.windows: dict[bytes, tuple[int, ...]] = {}
        self.pairs: dict[int, tuple[int, ...]] = {}

    def merged(self, data: bytes) -> tuple[int, ...]:
        """Plain merging by rank; used on leaves and boundary windows."""
        got = self.windows.get(data)
        if got is not None:
            return got
        ranks = self.ranks
        if len(data) > 64:
            return self._merged_long(data)
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        out = tuple(ranks[p] for p in parts)
        if len(data) <= 24:
            if len(self.windows) >= self.remember:
                self.windows.clear()
            self.windows[data] = out
        return out

    def _merged_long(self, data: bytes) -> tuple[int, ...]:
        """The same merging with a heap of pairs, for wide windows."""
        ranks, n = self.ranks, len(data)
        end = list(range(1, n + 1))  # where the part that begins here ends; 0: merged away
        before = list(range(-1, n))
        heap = []
        for i in range(n - 1):
            if (r := ranks.get(data[i:i + 2])) is not None:
                heap.append((r, i, i + 2))
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            mid = end[i]
            if not mid or mid >= n or not end[mid] or end[mid] != stop:
                continue
            end[i], end[mid] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(data[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            b = before[i]
            if b >= 0 and (r := ranks.get(data[b:stop])) is not None:
                heapq.heappush(heap, (r, b, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i:end[i]]])
            i = end[i]
        return tuple(out)

    def pair(self, a: int, b: int) -> tuple[int, ...]:
        """Encoding of two tokens put together; () if it is just those two."""
        key = a << 32 | b
        got = self.pairs.get(key)
        if got is None:
            got = self.merged(self.bytes_of[a] + self.bytes_of[b])
            if got == (a, b):
                got = ()
            if len(self.pairs) >= self.remember:
                self.pairs.clear()
            self.pairs[key] = got
        return got

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """Encoding of two encoded strings put together."""
        if not left or not right:
            return left or right
        pair = self.pair
        mid = pair(left[-1], right[0])
        if not mid:
            return left + right
        i, j = len(left) - 1, 1
        while True:
            ok_left = i == 0 or not pair(left[i - 1], mid[0])
            ok_right = j == len(right) or not pair(mid[-1], right[j])
            if ok_left and ok_right:
                return left[:i] + mid + right[j:]
            grow = max(len(left) - i, j)
            if not ok_left:
                i = max(0, i - grow)
            if not ok_right:
                j = min(len(right), j + grow)
            mid = self.merged(b"".join(map(self.bytes_of.__getitem__, left[i:] + right[:j])))

    def _tree(self, data: bytes) -> tuple[int, ...]:
        if len(data) <= LEAF_BYTES:
            return self.merged(data)
        half = len(data) // 2
        return self.join(self._tree(data[:half]), self._tree(data[half:]))

    def piece(self, text: str) -> tuple[int, ...]:
        data = text.encode()
        whole = self.ranks.get(data)
        out = self._tree(data) if whole is None else (whole,)
        if len(data) <= 48:
            if len(self.pieces) >= self.remember:
                self.pieces.clear()
            self.pieces[text] = out
        return out

    def encode(self, text: str) -> list[int]:
        known, piece = self.pieces.get, self.piece
        return list(chain.from_iterable(known(p) or piece(p) for p in self.find(text)))

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of ``ids``, concatenated up a tree."""
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_CODECS: dict[tuple[str, str], TreeCodec] = {}
remembers("bpe", _CODECS.clear)


def _codec(name: str, pattern: str) -> TreeCodec:
    """The task's codec; the ranks file comes with the job to each executor."""
    if (name, pattern) not in _CODECS:
        _CODECS[name, pattern] = TreeCodec(read_ranks(SparkFiles.get(name)), pattern)
    return _CODECS[name, pattern]


def _ship_ranks(spark: SparkSession, path: str) -> str:
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of every whole text in column ``out``."""
    return _mapped(docs, ranks_path, pattern, text, free_name(out, [c for c in docs.columns if c != out]), pa.list_(pa.int32()),
                   "array<int>", lambda codec, t: codec.encode(t or ""))


def decode(rows: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the bytes of every id list in column ``out``."""
    return _mapped(rows, ranks_path, pattern, ids, free_name(out, [c for c in rows.columns if c != out]), pa.large_binary(),
                   "binary", lambda codec, x: codec.decode(x or []))


def _mapped(df: DataFrame, ranks_path: str, pattern: str, col: str, out: str, arrow, kind: str, one) -> DataFrame:
    spark = df.sparkSession
    ship_package(spark)
    name = _ship_ranks(spark, ranks_path)
    keep = [c for c in df.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(name, pattern)
        for batch in batches:
            # A few rows at a time, so that very long texts do not pile up.
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                values = [one(codec, v) for v in b.column(b.schema.get_field_index(col)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(b.schema.get_field_index(c)) for c in keep] + [pa.array(values, arrow)], [*keep, out])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != out] + [f"`{out}` {kind}"])
    return df.mapInArrow(lean(run, "bpe"), schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, then decode the ids."""
    spark = docs.sparkSession
    ship_package(spark)
    name = _ship_ranks(spark, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(name, pattern)
        decimal = [str(i) for i in range(max(codec.bytes_of) + 1)]
        for batch in batches:
            n, ids_sha, dec_sha = [], [], []
            for text in batch.column(1):
                ids = codec.encode(text.as_py() or "")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                dec_sha.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(dec_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        lean(run, "bpe"), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document through the encoder and back, as digests."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
