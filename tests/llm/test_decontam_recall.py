"""Candidates of a whole block of short items at the verifier's limit; rows without usable ids."""

import random

import corpus_pipeline
from ratewise.llm import decontam


def test_recall_of_a_full_block_at_the_verifiers_limit(spark):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(6000)]
    weights = [1 / (k + 8) for k in range(6000)]
    some = lambda n: rng.choices(vocabulary, weights, k=n)
    items, docs, want = [], [(i, " ".join(some(rng.randrange(60, 400)))) for i in range(1500)], set()
    for i in range(1000):
        question, answer = some(24), some(6)
        items.append((i, " ".join(question) + "\n" + " ".join(answer)))
        # Half of the words stay in place, the answer whole: what the verifier just takes.
        keep = set(rng.sample(range(24), 10))
        text = [w if j in keep else rng.choice(vocabulary) for j, w in enumerate(question)] + answer
        docs.append((10_000 + i, " ".join(some(rng.randrange(20, 150)) + text + some(rng.randrange(20, 150)))))
        want.add((10_000 + i, i))
    found = decontam.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4),
                                spark.createDataFrame(items, "item_id bigint, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert len(got & want) >= 0.98 * len(want)
    assert len({d for d, _ in got if d < 10_000}) <= 3


def test_windows_are_the_sums_of_their_words():
    import numpy as np

    rng = np.random.default_rng(4)
    n = np.array([0, 5, 32, 64, 65, 200, 1, 97])
    ids = rng.integers(-1, 40, n.sum())
    space = decontam.Space(np.where(np.arange(40) % 3, np.arange(40), -1), np.ones(40), rng.normal(size=(40, 6)).astype(np.float32))
    space.items = np.eye(6, dtype=np.float32)
    space.cosine = -2.0
    got = {}
    for doc, begin, cosine, item in decontam._candidates(space, ids, n):
        got.setdefault((doc, begin), {})[item] = cosine
    starts = np.cumsum(n) - n
    for (doc, begin), cosines in got.items():
        window = ids[starts[doc] + begin:starts[doc] + min(begin + decontam.PASSAGE, n[doc])]
        x = sum(space.vectors[space.feature[w]] for w in window if w >= 0 and space.feature[w] >= 0)
        assert np.allclose([cosines[i] for i in range(6)], x / np.linalg.norm(x), atol=1e-4)
    assert {d for d, _ in got} >= {1, 2, 3, 4, 5, 7}


def test_pipeline_stages_go_by_rows_and_not_by_ids(spark, tmp_path):
    rng = random.Random(5)
    item = " ".join(f"q{rng.randrange(900)}" for _ in range(40))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    noise = lambda: " ".join(f"n{rng.randrange(5000)}" for _ in range(120))
    copied, clean = noise(), noise()
    rows = [(None, noise() + " " + item), (7, noise() + " " + item), (7, clean), (None, copied), (3, copied + " more"),
            (None, copied + " still more"), (9, noise()), (9, noise()), (4, ""), (4, ""), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    bag = lambda d: sorted(map(str, d.collect()))
    left = [r for r in rows if item not in (r[1] or "")]
    assert bag(corpus_pipeline.drop_leaks(spark, df, str(tmp_path))) == bag(spark.createDataFrame(left, df.schema))
    kept = [r for r in rows if not (r[1] or "").startswith(copied) or r[0] == 3]
    assert bag(corpus_pipeline.drop_near_duplicates(spark, df, str(tmp_path))) == bag(spark.createDataFrame(kept, df.schema))
