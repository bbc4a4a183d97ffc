"""Periodic runs against brute force, the grammar's own properties, frames."""

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from ratewise.llm import runs
from sf_paths import SF_SMALL


def brute(words, least=12):
    """(start, length, period) by comparing every word with the one q places on, for every q."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def some_words(rng):
    letters = rng.choice([1, 2, 3, 5, 20])
    words = [b"%d" % rng.randrange(letters) for _ in range(rng.randint(0, rng.choice([15, 40, 120])))]
    if words and rng.random() < 0.6:
        a = rng.randrange(len(words))
        p = rng.randint(1, len(words) - a)
        words = words[:a] + [words[a + i % p] for i in range(len(words) - a)]
        if rng.random() < 0.5:
            words = words + words[rng.randrange(len(words)):] * 2 + words[:5]
    return words


def test_random_words_against_brute_force():
    rng = random.Random(5)
    texts = [some_words(rng) for _ in range(1500)]
    assert runs.runs_of_words(texts) == [brute(t) for t in texts]


def test_other_least_lengths():
    rng = random.Random(6)
    texts = [some_words(rng) for _ in range(300)]
    for least in (2, 3, 7, 30):
        assert runs.runs_of_words(texts, least) == [brute(t, least) for t in texts]


def test_long_runs():
    assert runs.runs_of_words([[b"a"] * 30_000]) == [[(0, 30_000, 1)]]
    assert runs.runs_of_words([[b"%d" % (i % 4000) for i in range(13_000)]]) == [[(0, 13_000, 4000)]]
    fib = [b"a"], [b"a", b"b"]
    for _ in range(9):
        fib = fib[1], fib[1] + fib[0]
    assert runs.runs_of_words([fib[1]])[0] == brute(fib[1])


def test_fragments_keep_every_run_whole():
    rng = random.Random(7)
    for _ in range(300):
        words = some_words(rng)
        ids = np.array([int(w) for w in words], np.int64)
        _, lo, hi = runs.fragments(ids, np.array([len(ids)]))
        for s, n, _ in brute(words):
            assert any(a <= s and s + n <= b for a, b in zip(lo, hi))


def test_grammar_expands_to_its_text_and_has_no_pair_twice():
    rng = random.Random(8)
    for _ in range(200):
        words = [int(w) for w in some_words(rng)]
        rules, start, terminals = runs.re_pair(words)
        seen = list(dict.fromkeys(words))

        def expand(s):
            return [seen[s]] if s < terminals else expand(rules[s - terminals][0]) + expand(rules[s - terminals][1])

        assert [w for s in start for w in expand(s)] == words
        at = {}
        for i, pair in enumerate(zip(start, start[1:])):
            assert i - at.setdefault(pair, i) <= 1


def test_collapsed_keeps_first_periods():
    words = [b"x", *[b"a", b"b", b"c"] * 5, b"y"]
    found = runs.runs_of_words([words])[0]
    assert found == [(1, 15, 3)]
    assert runs.collapsed(words, found) == b"x a b c y"


def test_frames(spark, docs):
    out = runs.periodic_runs(docs)
    assert out.columns == [*docs.columns, "runs", "collapsed"]
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        words = runs.split_words(r["text"])
        assert [tuple(x) for x in r["runs"]] == brute(words) if len(words) < 2000 else r["runs"]
    empty = [r for r in rows if not (r["text"] or "").strip()]
    assert empty and all(r["runs"] == [] and r["collapsed"] == "" for r in empty)
    assert runs.periodic_runs(docs.withColumn("Runs", F.lit(1))).columns[-2] == "_runs"
    assert runs.digests(docs.limit(0)).count() == 0
    none = [r for r in runs.digests(docs).collect() if r["n_runs"] == 0]
    assert none and all(r["start"] is r["length"] is r["period"] is r["exponent_milli"] is None and r["runs_sha256"] for r in none)


def test_query_against_brute_force(spark):
    got = {r["doc_id"]: r for r in runs.op13_periodic_runs(spark, SF_SMALL).collect()}
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    planted = 0
    for doc_id, text in rows:
        words = text.encode().split()
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        if n > 3000:
            continue
        want, r = brute(words), got[doc_id]
        drop = {i for s, k, q in want for i in range(s + q, s + k)}
        assert r["n_runs"] == len(want)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in want).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in drop)).hexdigest()
        if want:
            s, k, q = min(want, key=lambda x: (-x[1], x[0], x[2]))
            assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (s, k, q, 1000 * k // q)
    assert planted
