"""Ranked lexical search against full scoring, tie order, shards, frames."""

import math
import random
import re
from collections import Counter

import duckdb
import pytest

from ratewise.llm import lexical
from sf_paths import SF_CHECK

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    counts = [(d, terms(t)) for d, t in docs]
    counts = [(d, len(w), Counter(w)) for d, w in counts if w]
    total, length = len(counts), sum(n for _, n, _ in counts)
    df = Counter(t for _, _, c in counts for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for d, n, c in counts:
            m = 25 + (75 * n * total) // length
            score = sum(math.floor(1000 * math.log((2.0 * total + 2) / (2.0 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, k=10):
    frame = lexical.search(spark.createDataFrame(docs, "doc_id bigint, text string"),
                           spark.createDataFrame(items, "item_id bigint, text string"), k)
    return sorted((tuple(r) for r in frame.collect()), key=str)


def corpus(rng, n, letters):
    docs = [(i, " ".join(f"W{int(rng.paretovariate(0.7)) % letters}" for _ in range(rng.randint(0, 60)))) for i in rng.sample(range(10 * n), n)]
    docs += [(10 * n + i, docs[0][1]) for i in range(40)] + [docs[3], docs[3], (None, docs[1][1]), (None, docs[0][1]), (-5, docs[0][1]), (77_777, None), (77_778, "")]
    rng.shuffle(docs)
    items = [(i, " ".join(f"w{rng.randrange(letters)}" for _ in range(rng.randint(1, 30)))) for i in range(15)]
    items += [(50, docs[5][1] or "w1"), (51, None), (52, "nowhere at-all"), (53, "w1 w1 W1 w2"), (53, "w3"), (54, "w4"), (54, "w4")]
    return docs, items


@pytest.mark.parametrize("postings, docs_a_shard, split", [(1_000_000, 100_000, 256), (300, 17, 4), (5, 3, 1)])
def test_equals_full_scoring(spark, monkeypatch, postings, docs_a_shard, split):
    monkeypatch.setattr(lexical, "SPLIT", split)
    rng = random.Random(postings)
    docs, items = corpus(rng, 300, 40)
    import numpy as np

    # Shards of each size, in one process.
    want = brute(docs, items)
    if postings == 1_000_000:
        assert found(spark, docs, items) == want
        assert found(spark, docs, items, 3) == brute(docs, items, 3)
        return
    names = sorted({t.encode() for _, x in items for t in terms(x)})
    number = {t: i for i, t in enumerate(names)}
    counts = [(d, lexical.terms_of(t)) for d, t in docs]
    total, length = sum(bool(w) for _, w in counts), sum(len(w) for _, w in counts)
    df = Counter(t for _, w in counts for t in set(w))
    weights = np.array([math.floor(1000 * math.log((2.0 * total + 2) / (2.0 * df[t] + 1))) for t in names], np.int64)
    import pyarrow as pa

    rows = []
    for d, w in counts:
        c = Counter(number[t] for t in w if t in number)
        rows.append({"doc_id": d, "n": len(w), "terms": list(c), "tfs": list(c.values())})
    batch = pa.RecordBatch.from_pylist(rows, pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))]))
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(lexical, "SHARD_DOCS", docs_a_shard)
    shards = list(lexical._shards(iter([batch.slice(0, 101), batch.slice(101)]), weights, total, length))
    assert sum(s.docs for s in shards) == len(docs)
    assert all(s.docs <= docs_a_shard for s in shards)
    got = []
    for item, text in set(items):
        c = Counter(number[t.encode()] for t in terms(text))
        best = []
        for s in shards:
            if len(s.key):
                best = s.top(np.array(list(c), np.int64), np.array(list(c.values()), np.int64), best)
        got += [(item, r, None if null else d, -score) for r, (score, null, d) in enumerate(best, 1)]
    assert sorted(got, key=str) == want


def test_blocks_of_items(spark, monkeypatch):
    rng = random.Random(9)
    docs, items = corpus(rng, 60, 15)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 8)
    assert found(spark, docs, items) == brute(docs, items)


def test_bounds_cut_the_search(monkeypatch):
    """A rare term's document leaves most of the other documents unread."""
    import numpy as np

    n = 20_000
    sizes = np.ones(n, np.int64)
    sizes[777] = 2
    terms_ = np.zeros(n + 1, np.int64)
    terms_[778] = 1
    tfs = np.ones(n + 1, np.int64)
    shard = lexical.Shard(np.arange(n), np.zeros(n, bool), np.full(n, 50, np.int64), sizes, terms_, tfs, np.array([3, 9000]), n, 50 * n)
    calls = []
    bound = lexical.Shard._bound
    monkeypatch.setattr(lexical.Shard, "_bound", lambda self, a, b, t: calls.append(len(a)) or bound(self, a, b, t))
    top = shard.top(np.array([0, 1]), np.array([1, 1]), [])
    assert [d for _, _, d in top] == [777, *range(9)]
    assert sum(calls) < 200


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None), (2, "")], [(1, "a")]) == []


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_CHECK}/{name}.parquet'")
    got = lexical.op12_lexical_search(spark, SF_CHECK).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(lexical.OP12_SQL).fetchall())
