"""What op3 pays for a token: words are looked up by batch, and the model's steps keep their results."""

import numpy as np
import pyarrow as pa
import pytest

from ratewise.llm import lm

TEXTS = ["  The cat\tsat \x0b on\x0cthe mat  ", None, "", " \n ", "\x1c\x85 É é no　break", "the the cab card care cat"] * 5


def plain(text):
    return [*(text or "").encode().lower().split(), lm.END]


def small():
    top = [(b"the", 9), (lm.END, 6), (b"cat", 5), (b"ca", 2)]
    return lm.Layout(top, {k: (5, 2) for k in range(lm.RARE)})


def test_texts_of_a_batch_are_looked_up_together(monkeypatch):
    lay, heads, rare_class = small(), [], lm.rare_class
    want = [[lay.id_of(w) for w in plain(t)] for t in TEXTS]
    monkeypatch.setattr(lm, "rare_class", lambda w: heads.append(w[:2]) or rare_class(w))
    assert [x.tolist() for x in lm.ids_of(pa.array(TEXTS, pa.string()), lay)] == want
    # Once for each different beginning of a rare word, not once for each rare token.
    assert len(heads) == len(set(heads)) == len({w[:2] for t in TEXTS for w in plain(t) if w not in lay.ids})
    assert list(lm.ids_of(pa.array([], pa.string()), lay)) == []


@pytest.mark.parametrize("known", [{b"the": 9, lm.END: 6, b"cat": 5}, {b"the": 9}, {}])
def test_known_and_other_tokens_of_a_batch(known):
    coder, places = lm.Coder(small(), known), {w: i for i, w in enumerate(known)}
    got = list(coder.each(pa.array(TEXTS, pa.string())))
    assert [x.tolist() for x, _ in got] == [[places.get(w, -1) for w in plain(t)] for t in TEXTS]
    assert [x for _, x in got] == [[w for w in plain(t) if w not in known] for t in TEXTS]
    assert [coder.encode(*x).tolist() for x in got] == [[small().id_of(w) for w in plain(t)] for t in TEXTS]


def test_counts_of_texts(spark):
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    got = {bytes(r["word"]): r["c"] for r in lm.count_tokens(docs).collect()}
    words = [w for t in TEXTS for w in plain(t)]
    assert got == {w: words.count(w) for w in words}


def test_sums_by_id():
    rng = np.random.default_rng(2)
    ids = np.concatenate([np.full(40, 3), rng.integers(5, 30, 60), [31]])
    rows = rng.normal(0, 1, (len(ids), 6)).astype(np.float32)
    want = np.zeros((33, 6))
    np.add.at(want, ids, rows)
    assert np.allclose(lm.sums_by_id(rows, ids, 33, lm.Room()), want, atol=1e-5)


def test_gradients_of_a_window_are_those_of_the_score():
    rng = np.random.default_rng(5)
    lay = lm.Layout(sorted([(b"w%d" % i, 30 + i % 7) for i in range(90)] + [(lm.END, 20)], key=lambda x: (-x[1], x[0])),
                    {k: (5, 2) for k in range(lm.RARE)})
    docs = [np.array([*rng.integers(0, 90 + lm.RARE, n), lay.end_id()]) for n in (9, 3, 14, 9)]
    start = lay.start()
    p, sums = {k: v.copy() for k, v in start.items()}, {k: np.full_like(v, 1e-12) for k, v in start.items()}
    lm.train_on(p, sums, lay, docs, [lay.end_id()] * len(docs))  # one window: the sums are the squares
    loss = lambda q: -lm.log10_scores(q, lay, docs, q["E"] @ q["Wx"] + q["b"]).sum() * np.log(10)
    for k in start:
        g = np.sqrt(sums[k]) * np.sign(start[k] - p[k])
        along = rng.normal(0, 1, g.shape) * (np.abs(g) > 1e-5)
        along *= 0.02 / np.sqrt((along ** 2).sum())
        up, down = ({**start, k: (start[k] + s * along).astype(np.float32)} for s in (1, -1))
        assert (loss(up) - loss(down)) / 2 == pytest.approx((g * along).sum(), rel=0.03, abs=2e-4), k
