"""Near duplicates, decontamination, PII, nearest neighbours, models: brute force and edge cases."""

import random
import re
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ratewise.llm import ann, decontam, jaccard, lm, pii, toxicity

SF = "/root/testdata/sf0.001"


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_jaccard_equals_brute_force(spark):
    rng = random.Random(4)
    word = lambda: rng.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rng.randrange(60))
    base = [[word() for _ in range(n)] for n in (60, 60, 200, 12)]
    rows = []
    for i in range(260):
        w = list(base[i % 4])
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    shared = " ".join(word() for _ in range(70))
    rows += [(1000 + i, shared + " " + " ".join(word() for _ in range(rng.choice([5, 15, 25, 80])))) for i in range(60)]
    rows += [(2000, None), (2001, ""), (2002, "A b"), (2003, "a B"), (2004, "a b c d e"), (2005, " \n")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(df).collect()}
    assert got == brute_components(rows)


def test_jaccard_edges(spark, docs):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()), key=str)
    assert got.count((4, 5, 1)) == 2 and (1, 5, 1) in got and (2, 0, 2) in got and (None, 1, None) in got and len(got) == 8
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_jaccard_texts_without_id_still_link(spark):
    w = [f"w{i}" for i in range(104)]
    chain = [" ".join(w[i:i + 60]) for i in (0, 5, 10, 15)]  # neighbours share 51 of 61 shingles, others fewer
    rows = [(7, chain[0]), (None, chain[1]), (None, chain[1]), (None, chain[2]), (3, chain[3]), (None, "alone here is one text"), (None, None)]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"]) == [(3, 56, 3), (7, 56, 3)]
    assert sorted(str(r["component_id"]) for r in got if r["doc_id"] is None) == ["3", "3", "3", "None", "None"]


def test_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)], "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in jaccard.components(chain).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_decontamination(spark):
    rng = random.Random(2)
    word = lambda k: f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.randrange(k)}"
    items = [(i, " ".join(word(400) for _ in range(30)) + ".\n" + " ".join(word(400) for _ in range(6))) for i in range(12)]
    noise = lambda n: " ".join(word(400) for _ in range(n))
    rows, want = [(i, noise(rng.randrange(5, 400))) for i in range(150)], set()
    for k, (i, t) in enumerate(items):
        w = t.split()
        rows.append((1000 + k, noise(90) + " " + t.upper() + " " + noise(200)))
        para = [x if j >= 24 or j % 3 else word(400) for j, x in enumerate(w)]
        rows.append((2000 + k, noise(40) + " " + " ".join(para)))
        want |= {(1000 + k, i), (2000 + k, i)}
    rows += [(3000, None), (3001, ""), (1000, "second row of the id")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([*items, (99, None), (98, " ")], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(df, bench).collect()}
    assert got == want
    assert decontam.find_leaks(df, bench.limit(0)).count() == 0
    assert decontam.find_leaks(df.limit(0), bench).count() == 0


def test_lcs():
    rng = random.Random(0)
    for _ in range(100):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert decontam.lcs(a, b) == t[-1][-1]


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, regex in PLAIN.items():
        for m in re.finditer(regex, text or ""):
            d = [int(c) for c in m[0] if c.isdigit()]
            luhn = sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(reversed(d))) % 10 == 0
            if {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 16 <= len(d) <= 19 and luhn, "phone": 8 <= len(d) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def test_pii_base_and_discovery(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(["a", "b@c.d", "1.2.3.4", "999", "+1 (555) 123-4567", " ", ".", "_", "4111 1111 1111 1111", "é😀", "-", "00", "@"])
                        for _ in range(rng.randrange(40)))) for i in range(300)]
    rows += [(400, None), (401, ""), (402, "a." * 20000 + "x@" + "b." * 20000 + "c " + "1" * 30000)]
    rows += [(500 + i, f"Please call me at +1 (555) 555-{1000 + i} today") for i in range(8)]
    rows += [(600 + i, f"please call me at 020 7946 0{i}18 now; we saw 100000{i} birds") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(df).collect()}
    text = dict(rows)
    for i, spans in got.items():
        assert [(pii.KINDS[x["k"] - 1], x["start"], x["end"]) for x in spans if x["base"]] == plain_spans(text[i])
    new = {(i, text[i][x["start"]:x["end"]]) for i, s in got.items() if i >= 500 for x in s if not x["base"]}
    assert new == {(600 + i, f"020 7946 0{i}18") for i in range(3)}


def test_pii_long_runs_of_digits(spark):
    """A part of any length is no ip part; leading zeros do not make it one either."""
    texts = ["x " + "1" * 45 + ".1.2.3", "0" * 60 + "7.1.2.003", "9" * 4000 + ".1.2.3 1.2.3.4", "1.2.3.4444", "256.1.1.1 255.0.0.000000"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in pii.find_pii(df).collect():
        got = [(pii.KINDS[x["k"] - 1], x["start"], x["end"]) for x in r["spans"] if x["base"]]
        assert got == plain_spans(texts[r["doc_id"]])


def test_pii_finds_what_stands_in_a_learnt_slot(spark):
    rows = [(i, f"please write to user{i}@site.org today thanks") for i in range(30)]
    rows += [(50 + i, f"the host 10.0.0.{i} reach 0{i}71 23456{i}8 now") for i in range(3)]
    rows += [(100 + i, f"call the desk +49 (30) 1234{i}56 please") for i in range(12)]
    rows += [(200, "please write to jane(at)site.org today thanks"), (201, "please write to us today thanks"),
             (202, "ring +49 (30) 1234056 the desk 0171234567 please"), (203, "call the desk 3 please")]
    text = dict(rows)
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    new = {(i, pii.KINDS[x["k"] - 1], text[i][x["start"]:x["end"]]) for i, s in got.items() for x in s if not x["base"]}
    assert new == {(200, "email", "jane(at)site.org"), (202, "phone", "0171234567")}


def test_pii_stretches_are_cut_at_seeds(spark):
    rows = [(i, f"call me at +1 (555) 555-{1000 + i} today") for i in range(12)]
    rows += [(100, "call me at 020 7946 0018 today"), (101, "call me at 020 7946 0018 10.0.0.1 55501 today"),
             (102, "call me at 0171234567 0171234568 0171234569 today")]
    text = dict(rows)
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    new = {(i, text[i][x["start"]:x["end"]]) for i, s in got.items() for x in s if not x["base"]}
    # Three numbers in a row are no phone; the first and the last of them stand in a slot.
    assert new == {(100, "020 7946 0018"), (101, "020 7946 0018"), (102, "0171234567")}


def brute_discovery(seeds, others):
    """The graph of the docstring, scored with dictionaries."""
    by_pattern, cand = defaultdict(set), defaultdict(set)
    for m, kind, patterns in seeds:
        for p in patterns:
            by_pattern[p].add((m, kind))
    by_pattern = {p: v for p, v in by_pattern.items() if len(v) >= pii.MIN_SEEDS}
    for m, patterns in others:
        cand[m] |= {p for p in patterns if p in by_pattern}
    score, met = dict.fromkeys(cand, 0.0), defaultdict(set)
    for m, ps in cand.items():
        for p in ps:
            met[p].add(m)
    for _ in range(pii.ROUNDS):
        w = {p: (len(v) + sum(score[m] for m in met[p])) / (len(v) + len(met[p])) for p, v in by_pattern.items()}
        score = {m: 1 - np.prod([1 - w[p] for p in ps if w[p] >= pii.MIN_PATTERN]) for m, ps in cand.items()}
    return {m for m, s in score.items() if s >= pii.MIN_INSTANCE}


def test_pii_graph_equals_brute_force(spark):
    rng = random.Random(9)
    pick = lambda: [f"L p{rng.randrange(12)}", f"B q{rng.randrange(12)}"]
    seeds = [(f"+1 555 555 {i}", "phone", pick()) for i in range(120)]
    others = [(f"02{i}5551", pick()) for i in rng.choices(range(60), k=90)]
    schema = "m string, kind string, patterns array<string>"
    got = pii.discover(spark.createDataFrame(seeds, schema), spark.createDataFrame([(m, "other", p) for m, p in others], schema)).collect()
    want = brute_discovery(seeds, others)
    assert {r["m"] for r in got} == want and 0 < len(want) < 60


def test_pii_edges(spark, docs):
    assert pii.find_pii(docs).count() == docs.count()
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 8)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000 + i, x[0].tolist()) for i in range(400)]
    odd = [(3000, None), (3100, [0.0] * 8), (3200, [float("nan")] + [1.0] * 7), (3300, [1.0] * 7 + [None]), (3400, [float("inf")] * 8), (3500, [1.0])]
    df = spark.createDataFrame(rows + odd, "id bigint, vec array<float>")
    got = defaultdict(list)
    for r in ann.nearest_neighbours(df, F.col("id") % 100 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    all_ids, all_x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    hit = total = 0
    for q in [i for i, _ in rows if i % 100 == 0]:
        d = np.sqrt(((all_x - all_x[list(all_ids).index(q)]) ** 2).sum(1))
        o = [j for j in np.lexsort((all_ids, d)) if all_ids[j] != q][:10]
        assert len(got[q]) == 10 and got[q] == sorted(got[q], key=lambda t: (t[1], t[0]))
        hit += len({all_ids[j] for j in o} & {i for i, _ in got[q]})
        total += 10
    assert set(got) == {i for i, _ in rows if i % 100 == 0} and hit >= 0.9 * total
    assert [i for i, _ in got[0]] == list(range(2000, 2010))
    assert ann.nearest_neighbours(df.limit(0), F.col("id") % 100 == 0).count() == 0


def test_neighbours_of_repeated_ids_and_short_vectors(spark):
    rows = [(100, [0.0, 1.0]), (100, [9.0, 9.0]), (1, [0.0, 2.0]), (2, [9.0, 8.0]), (2, [0.0, 1.5]), (3, [5.0, 5.0])]
    got = ann.nearest_neighbours(spark.createDataFrame(rows, "id bigint, vec array<double>"), F.col("id") % 100 == 0, top=1)
    # One list for each of the id's vectors.
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect()) == [(100, 1, 2, 0.5), (100, 1, 2, 1.0)]
    line = spark.createDataFrame([(i, [float(i + 1)]) for i in range(300)], "id bigint, vec array<double>")
    near = ann.nearest_neighbours(line, F.col("id") % 100 == 0, top=2).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in near) == [
        (0, 1, 1), (0, 2, 2), (100, 1, 99), (100, 2, 101), (200, 1, 199), (200, 2, 201)]


def test_language_model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(10**6, None), (10**6 + 1, "")], docs.schema))
    got = {r["doc_id"]: r for r in lm_scores(docs).collect()}
    import zlib

    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    toks = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t in rows}
    c = Counter(w for i, t in toks.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in toks.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(c[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(sum(log10((c[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
        assert r["score"] < 0
    held = [got[i] for i in toks if zlib.crc32(str(i).encode()) % 7 == 2]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def lm_scores(docs):
    learn = docs.where(F.crc32(F.col("doc_id").cast("string")) % 7 != 2)
    counts = lm.count_tokens(learn)
    lay, known, n, v = lm.layout(counts)
    return lm.score(docs, lm.fit(learn, lay), lay, known, counts, n, v)


def test_language_model_sums_to_one_and_carries_state(spark):
    top = [(f"w{i}".encode(), 50 - i) for i in range(40)] + [(lm.END, 9)]
    lay = lm.Layout(top, {k: (5, 2) for k in range(lm.RARE)})
    p = lay.start()
    gates = p["E"] @ p["Wx"] + p["b"]
    prefix = list(range(7))
    everything = [np.array([*prefix, x]) for x in range(len(top) + lm.RARE)]
    whole = lm.log10_scores(p, lay, everything, gates) - lm.log10_scores(p, lay, [np.array(prefix)], gates)[0]
    assert sum(10.0 ** whole) == pytest.approx(1, abs=1e-4)
    long = np.arange(100) % 40  # several windows: one run equals one document in many lanes
    a = lm.log10_scores(p, lay, [long], gates)[0]
    b = lm.log10_scores(p, lay, [long[:5], long, long[:50]], gates)[1]
    assert a == pytest.approx(b, abs=1e-4)


def test_language_model_state_reaches_words_beyond_rank_1024(spark):
    counts = spark.range(3000).select(F.concat(F.lit("w"), "id").cast("binary").alias("word"), (5000 - F.col("id")).alias("c"))
    lay = lm.layout(counts)[0]
    p = lay.start()
    gates = p["E"] @ p["Wx"] + p["b"]
    rare = len(lay.words) + lm.rare_class(b"w1500")
    word, ends = lay.ids.get(b"w1500", rare), []
    for before in ([0] * 9, [700] * 9):  # P(word | class, state) must differ, not only P(class | state)
        score = lambda *x: lm.log10_scores(p, lay, [np.array([*before, *x])], gates)[0]  # noqa: B023, E731
        peer = next(i for i in range(len(lay.words)) if i != word and lay.class_of(np.array([i])) == lay.class_of(np.array([word])))
        ends.append(score(word) - score(peer))
    assert abs(ends[0] - ends[1]) > 1e-6


def test_language_model_end_mark_has_its_own_id(spark):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(4000)}"
    rows = [(i, " ".join(word() for _ in range(3000))) for i in range(5)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    counts = lm.count_tokens(docs)
    lay, known, n, v = lm.layout(counts)
    assert len(lay.words) == lm.VOCAB and lay.end_id() == lay.ids[lm.END] and known[lm.END] == 10
    p = lay.start()
    gates, coder = p["E"] @ p["Wx"] + p["b"], lm.Coder(lay, known)
    ids = [coder.encode(*coder.codes(t)) for _, t in rows[:5]]
    assert all((x == lay.end_id()).sum() == 1 for x in ids)
    # Scored one by one and together.
    assert np.allclose([lm.log10_scores(p, lay, [x], gates)[0] for x in ids], lm.log10_scores(p, lay, ids, gates), rtol=1e-5)


def test_language_model_sequences_begin_anew():
    ids = np.arange(1, 2 * lm.SEQUENCE + 10)
    some, before = lm.sequences(ids, 0)
    assert [len(x) for x in some] == [lm.SEQUENCE, lm.SEQUENCE, 9] and before == [0, lm.SEQUENCE, 2 * lm.SEQUENCE]
    seen = defaultdict(list)
    for prev, target, doc, fresh in lm.windows(some, 0, 2, before):
        for t in range(lm.WINDOW):
            for lane in range(prev.shape[1]):
                if target[t, lane] >= 0:
                    assert prev[t, lane] == target[t, lane] - 1  # its own text's token, across the cut too
                    assert fresh[t, lane] == (not seen[doc[t, lane]])
                    seen[doc[t, lane]].append(target[t, lane])
    assert [seen[d] for d in range(3)] == [x.tolist() for x in some]


def test_language_model_frequent_tokens_with_ties(spark):
    counts = spark.range(5000).select(F.concat(F.lit("w"), "id").cast("binary").alias("word"), F.when(F.col("id") < 100, 9).otherwise(2).cast("long").alias("c"))
    counts = counts.union(spark.createDataFrame([(bytearray(lm.END), 1)], "word binary, c bigint"))
    got = lm.frequent(counts, 1000)
    assert [c for _, c in got[:100]] == [9] * 100 and got[-1] == (lm.END, 1) and 900 < len(got) < 1100
    assert len(lm.frequent(counts, 10**6)) == 5001 and len({w for w, _ in got}) == len(got)


def test_language_model_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    counts = lm.count_tokens(empty)
    lay, known, n, v = lm.layout(counts)
    some = spark.createDataFrame([(1, "a b"), (1, None)], "doc_id bigint, text string")
    got = lm.score(some, lm.fit(empty, lay), lay, known, counts, n, v).collect()
    assert sorted(r["n_tokens"] for r in got) == [1, 3] and all(r["base_score"] == 0 for r in got)


def test_toxicity(spark):
    rng = random.Random(5)
    bad = ["vileo", "vileux", "vilein", "grubber"]
    rows, labels = [], []
    for i in range(800):
        w = [rng.choice("abcdefgh") + rng.choice("aeiou") * rng.randrange(1, 4) for _ in range(rng.randrange(5, 60))]
        if i % 5 == 0:
            w[rng.randrange(len(w))] = rng.choice(bad) + rng.choice(["", "s", "er"])
        rows.append((i, " ".join(w), "en"))
        labels.append((i, int(i % 5 == 0)))
    rows += [(9000, None, None), (9001, "", "xx"), (9002, "clean " * 120_000 + " vileux", "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("score", F.lit(9))
    lab = spark.createDataFrame([*labels, (None, 1), (3, None), (0, 1)], "doc_id bigint, toxic int")
    net = toxicity.fit(df, lab, F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    out = toxicity.score(df, net)
    assert out.columns == ["doc_id", "text", "lang", "score", "_score", "threshold", "rejected"]
    got = {r["doc_id"]: r["_score"] for r in out.collect()}
    import zlib

    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == (i % 5 == 0) for i in held]) > 0.95
    assert got[9000] == got[9001] and got[9002] >= 0.5 and all(0 <= s <= 1 for s in got.values())
    none = toxicity.fit(df, lab.where("toxic = 0"), F.lit(True))
    assert none == 0.0 and toxicity.score(df, none).where("rejected").count() == 0
    assert toxicity.score(df.limit(0), net).count() == 0


def test_toxicity_thresholds_of_every_language(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(20)) + (" vileo" if i % 20 == 0 else ""),
             "fr" if i % 3 == 0 else "de" if i % 3 == 1 else None) for i in range(1200)]
    df = spark.createDataFrame([*rows, (0, None, "fr"), (7, "again", "de")], "doc_id bigint, text string, lang string")
    lab = spark.createDataFrame([(i, int(i % 20 == 0)) for i, _, _ in rows], "doc_id bigint, toxic int")
    y = lab.withColumnRenamed("toxic", "y")
    net = toxicity.fit(df, lab, F.lit(True), max_per_class=40)
    assert set(net.thresholds) == {"fr", "de"}  # 20 toxic rows each, most of them trained on
    seen = toxicity._histogram(df, y, net)
    assert {x: h.sum(1).tolist() for x, h in seen.items()} == {"fr": [380, 20], "de": [380, 20], None: [380, 20]}
    old, toxicity.BROADCAST_ROWS = toxicity.BROADCAST_ROWS, 10
    try:
        assert all((h == seen[x]).all() for x, h in toxicity._histogram(df, y, net).items())
    finally:
        toxicity.BROADCAST_ROWS = old


def test_toxicity_thresholds_move_with_their_rows():
    def hist(n, cut):  # label 0 below the cut, label 1 above it
        h = np.zeros((2, toxicity.BINS))
        h[0, cut - 40:cut], h[1, cut:cut + 40] = n, n / 10
        return h

    got = {}
    for n in (0.01, 1, 10, 1000):
        common, own = toxicity._thresholds({"en": hist(1000, 300), "xx": hist(n, 330), None: hist(1, 300)}, 1.0)
        got[n] = own["xx"]
        assert set(own) == {"en", "xx"}
        if n < 1:
            assert own["xx"] == common == own["en"]
    assert sorted(got.values()) == list(got.values()) and got[0.01] < -1.4 and got[1000] > -0.1


def test_runs_of_long_texts_keep_every_window():
    net = toxicity.train([["a", "b"], ["c"]], np.array([1, 0]), epochs=1)
    text, old = " ".join(random.Random(1).choices("abcdefg", k=500)), toxicity.RUN
    whole = toxicity.Scorer(net).scores([text, "", "a"])
    toxicity.RUN = 7
    try:
        assert np.allclose(toxicity.Scorer(net).scores([text, "", "a"]), whole, atol=1e-6)
    finally:
        toxicity.RUN = old


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.withColumn("N_LINES", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, extra, SF)
        assert out.columns == extra.columns and out.dtypes == extra.dtypes, name
        assert 0 < out.count() <= extra.count()
    got = corpus_pipeline.run(spark, SF)
    ids = [r["doc_id"] for r in got.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and got.where("NOT round_trip").count() == 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
