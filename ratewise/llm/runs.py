"""Periodic runs of words, found on a Re-Pair grammar of each text.

A run is a stretch of words with smallest period q (words q apart are the same),
of at least ``least`` words and two periods, that no neighbouring word extends.

A text becomes word ids. Re-Pair replaces the most frequent pair of neighbours
by a new nonterminal until no pair occurs twice; a balanced tree stands over
what remains. A run lies whole in some node of the derivation and crosses the
border between that node's two halves, so it is enough to find, once for each
nonterminal, the runs inside its expansion that cross its border. They are
translated to every place where the nonterminal stands in the derivation, and
of intervals of one period that lie in each other the greatest stays. A stretch
whose period is a multiple of its smallest one gives the same interval and goes.

Finding the runs of a border: a run that crosses it has a whole period on its
left or its right side, so the word next to the border occurs again one period
away. Those periods are listed for all nodes of a group of texts in one flat
array, and common extensions to both sides come from ranks of substrings of
2^k words (exact, no hashing).

Before the grammar, words that cannot be in any run are set aside: each word of
a run is inside a window of ``least / 2`` words that the run repeats, so words
in no repeated window separate fragments, again and again until nothing changes
(a hash only selects here; a false match merely keeps a fragment). Fragments
hold every run whole.

Rows are independent, nothing is shuffled; a group of texts has a bounded number
of words, a longer text is a group of its own.

Defined results: a null or empty text, or one of white space, has no runs and
collapses to the empty text; repeated rows give repeated results; other columns
pass through; a null id plants nothing in the query.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm.common import free_name, lean, ship_package, table

LEAST = 12
GROUP_WORDS = 200_000
#: Places listed at a time for the borders of a group.
LISTED = 2_000_000
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def split_words(text: str | None) -> list[bytes]:
    """The words between space and the control characters 9 to 13, as UTF-8."""
    return (text or "").encode().split()


def _spread(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and place of each of ``count`` places from each ``start`` on."""
    owner = np.repeat(np.arange(len(start)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + start[owner]


def fragments(ids: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start in ``ids``, end) of the stretches that can hold a run."""
    k = (least + 1) // 2
    factor = np.random.default_rng(7).integers(1, 2**63, k, dtype=np.uint64) | np.uint64(1)
    place = np.arange(len(ids))
    part = np.repeat(np.arange(len(sizes)), sizes)
    text = part
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    while len(place) >= k:
        before = len(place)
        # A window is k places in one part, side by side.
        ok = part[k - 1:] == part[:len(part) - k + 1]
        h = part[:len(ok)].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for j in range(k):
            h += mixed[place[j:j + len(ok)]] * factor[j]
        h ^= h >> np.uint64(32)
        window = np.flatnonzero(ok)
        h = h[window]
        order = np.argsort(h, kind="stable")
        same = h[order[1:]] == h[order[:-1]]
        again = np.zeros(len(h), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        edge = np.zeros(len(place) + 1, np.int64)
        starts = window[again]
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + k, -1)
        keep = np.cumsum(edge[:-1]) > 0
        place, part, text = place[keep], part[keep], text[keep]
        if not len(place):
            break
        # New parts: side by side and in one part before; short ones go.
        new = np.r_[True, (place[1:] != place[:-1] + 1) | (part[1:] != part[:-1])]
        part = np.cumsum(new) - 1
        enough = np.bincount(part) >= least
        keep = enough[part]
        place, part, text = place[keep], part[keep], text[keep]
        if len(place) == before:
            break
    if len(place) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    size = np.diff(np.r_[first, len(part)])
    return text[first], place[first], place[first] + size


def re_pair(word: list[int]) -> tuple[list[tuple[int, int]], list[int], int]:
    """(rules, start sequence, number of terminals); rule r is symbol terminals + r.

    Of equally frequent pairs the one with the shortest expansion goes first,
    then the leftmost, which keeps the derivation low.
    """
    seen: dict[int, int] = {}
    sym = [seen.setdefault(w, len(seen)) for w in word]
    n, terminals = len(sym), len(seen)
    size = [1] * terminals
    rules: list[tuple[int, int]] = []
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    where: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i in range(n - 1):
        where[sym[i], sym[i + 1]].append(i)
    heap = [(-len(at), 2, at[0], pair) for pair, at in where.items() if len(at) > 1]
    heapq.heapify(heap)
    while heap:
        count, length, _, pair = heapq.heappop(heap)
        a, b = pair
        stand = [i for i in sorted(set(where[pair])) if sym[i] == a and after[i] < n and sym[after[i]] == b]
        live, taken = [], -1
        for i in stand:
            if i != taken:
                live.append(i)
                taken = after[i]
        where[pair] = stand
        if len(live) < 2:
            continue
        if len(live) < -count:
            heapq.heappush(heap, (-len(live), length, live[0], pair))
            continue
        x = terminals + len(rules)
        rules.append(pair)
        size.append(length)
        made = set()
        for i in live:
            j = after[i]
            sym[i], sym[j] = x, -1
            r, p = after[j], before[i]
            after[i] = r
            if r < n:
                before[r] = i
                where[x, sym[r]].append(i)
                made.add((x, sym[r]))
            if p >= 0:
                where[sym[p], x].append(p)
                made.add((sym[p], x))
        del where[pair]
        for pair in made:
            at = where[pair]
            if len(at) > 1:
                heapq.heappush(heap, (-len(at), size[pair[0]] + size[pair[1]], at[0], pair))
    return rules, [s for s in sym if s >= 0], terminals


def derivation(word: list[int], least: int) -> list[tuple[list[int], int, int]]:
    """(places, left half, length) of each node of the grammar of ``word``.

    Nodes of fewer than ``least`` words hold no run and are left out.
    """
    rules, start, terminals = re_pair(word)
    size = [1] * terminals
    for a, b in rules:
        size.append(size[a] + size[b])
    at, border = 0, []
    places: list[list[int]] = [[] for _ in rules]
    for s in start:
        border.append(at)
        if s >= terminals:
            places[s - terminals].append(at)
        at += size[s]
    border.append(at)
    # A nonterminal's parts are older than itself, so its places are complete when it is reached.
    for r in range(len(rules) - 1, -1, -1):
        a, b = rules[r]
        if size[terminals + r] <= 2 or not places[r]:
            continue
        if a >= terminals:
            places[a - terminals].extend(places[r])
        if b >= terminals:
            shift = size[a]
            places[b - terminals].extend(p + shift for p in places[r])
    nodes = [(places[r], size[a], size[a] + size[b]) for r, (a, b) in enumerate(rules) if size[a] + size[b] >= least]
    todo = [(0, len(start))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < 2 or border[hi] - border[lo] < least:
            continue
        mid = bisect_left(border, (border[lo] + border[hi]) // 2, lo + 1, hi - 1)
        nodes.append(([border[lo]], border[mid] - border[lo], border[hi] - border[lo]))
        todo += [(lo, mid), (mid, hi)]
    return nodes


class Extensions:
    """Common extensions of two places of ``ids``, from ranks of 2^k words."""

    def __init__(self, ids: np.ndarray, longest: int):
        self.rank = [ids]
        n, step = len(ids), 1
        while 2 * step <= longest:
            low = self.rank[-1]
            key = low[:n - 2 * step + 1] * (int(low.max()) + 1) + low[step:n - step + 1]
            self.rank.append(np.unique(key, return_inverse=True)[1].astype(np.int64))
            step *= 2

    def right(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        got = np.zeros(len(i), np.int64)
        for k in range(len(self.rank) - 1, -1, -1):
            step = 1 << k
            # A length of up to ``most`` can take the top step twice.
            for _ in range(2 if k == len(self.rank) - 1 else 1):
                can = np.flatnonzero(got + step <= most)
                can = can[self.rank[k][i[can] + got[can]] == self.rank[k][j[can] + got[can]]]
                got[can] += step
        return got

    def left(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Of the words before ``i`` and before ``j``."""
        got = np.zeros(len(i), np.int64)
        for k in range(len(self.rank) - 1, -1, -1):
            step = 1 << k
            for _ in range(2 if k == len(self.rank) - 1 else 1):
                can = np.flatnonzero(got + step <= most)
                can = can[self.rank[k][i[can] - got[can] - step] == self.rank[k][j[can] - got[can] - step]]
                got[can] += step
        return got


def border_runs(ids: np.ndarray, ext: Extensions, s: np.ndarray, m: np.ndarray, e: np.ndarray,
                least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(node, start, end, period) of stretches inside [s, e) that cross m, whole inside it."""
    found = []
    # A period on the left: the word at the border stands one period before it.
    node, at = _spread(s, m - s)
    hit = ids[at] == ids[m[node]]
    node, q = node[hit], (m[node] - at)[hit]
    mid = m[node]
    lo = mid - q - ext.left(mid - q, mid, mid - q - s[node])
    hi = mid + ext.right(mid - q, mid, e[node] - mid)
    found.append((node, lo, hi, q))
    # A period on the right: the word before the border stands again one period after it.
    node, at = _spread(m, e - m)
    hit = ids[at] == ids[m[node] - 1]
    node, q = node[hit], (at - m[node] + 1)[hit]
    mid = m[node]
    lo = mid - ext.left(mid, mid + q, mid - s[node])
    hi = mid + q + ext.right(mid, mid + q, e[node] - mid - q)
    found.append((node, lo, hi, q))
    node, lo, hi, q = (np.concatenate(x) for x in zip(*found))
    ok = (hi - lo >= np.maximum(least, 2 * q))
    node, lo, hi, q = node[ok], lo[ok], hi[ok], q[ok]
    # Of one interval the smallest period.
    order = np.lexsort((q, hi, lo, node))
    node, lo, hi, q = node[order], lo[order], hi[order], q[order]
    new = np.r_[True, (node[1:] != node[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])][:len(node)]
    return node[new], lo[new], hi[new], q[new]


def runs_of(ids: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs of texts that lie flat in ``ids``.

    ``sizes`` has the number of words of each text; runs come by text, start, period.
    """
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    text, lo, hi = fragments(ids, sizes, least)
    if not len(text):
        return none
    # The fragments, flat: ids from 0 on, where each begins, and the places of their nodes.
    size = hi - lo
    base = np.cumsum(size) - size
    flat = np.unique(ids[_spread(lo, size)[1]], return_inverse=True)[1].astype(np.int64)
    places, left, length, owner = [], [], [], []
    for f, (b, n) in enumerate(zip(base.tolist(), size.tolist())):
        for at, half, whole in derivation(flat[b:b + n].tolist(), least):
            places.append(at)
            left.append(half)
            length.append(whole)
            owner.append(f)
    left, length, owner = (np.array(x, np.int64) for x in (left, length, owner))
    first = np.array([at[0] for at in places], np.int64) + base[owner]
    ext = Extensions(flat, int(size.max()))
    found = []
    step = np.cumsum(length) // LISTED
    for part in np.split(np.arange(len(length)), np.flatnonzero(np.diff(step)) + 1):
        s = first[part]
        node, a, b, q = border_runs(flat, ext, s, s + left[part], s + length[part], least)
        node = part[node]
        found.append((node, a - first[node], b - a, q))
    node, shift, span, q = (np.concatenate(x) for x in zip(*found))
    # Every place of the derivation where the node stands.
    counts = np.array([len(places[x]) for x in node.tolist()], np.int64)
    starts = np.array([p for x in node.tolist() for p in places[x]], np.int64)
    row = np.repeat(np.arange(len(node)), counts)
    frag, q, span = owner[node][row], q[row], span[row]
    start = starts + shift[row]
    # Intervals inside another of the same period go.
    order = np.lexsort((-span, start, q, frag))
    frag, q, start, span = frag[order], q[order], start[order], span[order]
    end = base[frag] + start + span
    group = np.r_[True, (frag[1:] != frag[:-1]) | (q[1:] != q[:-1])][:len(q)]
    lift = np.cumsum(group) * (len(flat) + 1)
    reach = np.maximum.accumulate(end + lift)
    keep = np.r_[True, (end + lift)[1:] > reach[:-1]][:len(q)]
    frag, q, start, span = frag[keep], q[keep], start[keep], span[keep]
    # Of one interval the smallest period, then by text, start, period.
    order = np.lexsort((q, span, start, frag))
    frag, q, start, span = frag[order], q[order], start[order], span[order]
    keep = np.r_[True, (frag[1:] != frag[:-1]) | (start[1:] != start[:-1]) | (span[1:] != span[:-1])][:len(q)]
    frag, q, start, span = frag[keep], q[keep], start[keep], span[keep]
    offset = np.cumsum(sizes) - sizes
    who = text[frag]
    start = start + lo[frag] - offset[who]
    order = np.lexsort((q, start, who))
    return who[order], start[order], span[order], q[order]


def runs_of_words(texts: list[list[bytes]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each list of words, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    at = 0
    while at < len(texts):
        end, n = at, 0
        while end < len(texts) and (end == at or n + len(texts[end]) <= GROUP_WORDS):
            n += len(texts[end])
            end += 1
        if n >= least:
            group = texts[at:end]
            words = pa.array([w for t in group for w in t], pa.large_binary()).dictionary_encode()
            ids = words.indices.to_numpy().astype(np.int64)
            found = runs_of(ids, np.array([len(t) for t in group], np.int64), least)
            for who, *run in zip(*(x.tolist() for x in found)):
                out[at + who].append(tuple(run))
        at = end
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """``words`` joined by one space, of each run only its first period."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return b" ".join(w for w, d in zip(words, (np.cumsum(drop[:-1]) > 0).tolist()) if not d)


def _word_groups(texts: pa.Array, words_of) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Row numbers and words of texts, about ``GROUP_WORDS`` words at a time."""
    at, n, group = 0, 0, []
    for row in range(len(texts)):
        words = words_of(row)
        if group and n + len(words) > GROUP_WORDS:
            yield at, group
            at, n, group = row, 0, []
        group.append(words)
        n += len(words)
    if group:
        yield at, group


def periodic_runs(docs: DataFrame, text: str = "text", least: int = LEAST, runs: str = "runs",
                  collapse: str = "collapsed") -> DataFrame:
    """``docs`` with the runs of every whole text, and the text without their repeats."""
    ship_package(docs.sparkSession)
    runs = free_name(runs, docs.columns)
    collapse = free_name(collapse, [*docs.columns, runs])
    names = docs.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(batch.schema.get_field_index(text))
            for at, group in _word_groups(col, lambda row: split_words(col[row].as_py())):
                found = runs_of_words(group, least)
                lists = [[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in found]
                texts = [collapsed(w, rs).decode() for w, rs in zip(group, found)]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(at, len(group)) for c in batch.columns), pa.array(lists, pa.list_(RUN)), pa.array(texts, pa.large_string())],
                    [*names, runs, collapse])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
                       + [f"`{runs}` array<struct<start: bigint, length: bigint, period: bigint>>", f"`{collapse}` string"])
    return docs.mapInArrow(lean(task), schema)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's words: one text in ten repeats a stretch of itself to its end."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


DIGEST = [("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
          ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]


def digests(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Runs of every document's planted words: number, longest run, digests."""
    ship_package(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at, group in _word_groups(texts, lambda row: planted(ids[row].as_py(), split_words(texts[row].as_py()))):
                rows = []
                for k, (words, runs) in enumerate(zip(group, runs_of_words(group, least))):
                    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
                    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                    rows.append((ids[at + k].as_py(), len(runs), *top, 1000 * top[1] // top[2] if runs else None,
                                 hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs)).hexdigest()))
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*rows), DIGEST)], [n for n, _ in DIGEST])

    return docs.select("doc_id", "text").mapInArrow(
        lean(task), ", ".join(f"{n} {'bigint' if kind == pa.int64() else 'string'}" for n, kind in DIGEST))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole document, as digests."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return digests(docs)
