"""The recurrent state of op3 is large enough to matter, and all of it learns."""

import numpy as np

from ratewise.llm import lm


def test_every_unit_of_the_state_learns():
    rng = np.random.default_rng(3)
    words = [b"w%d" % i for i in range(60)]
    lay = lm.Layout(sorted([*((w, 50) for w in words), (lm.END, 40)], key=lambda x: (-x[1], x[0])), {})
    docs = [np.array([*rng.integers(0, 60, 30), lay.end_id()]) for _ in range(40)]
    start = lay.start()
    p = {k: v.copy() for k, v in start.items()}
    lm.train_on(p, {k: np.full_like(v, 1e-2) for k, v in p.items()}, lay, docs, [lay.end_id()] * len(docs))
    # 8 units and 8 numbers a word were a toy beside 2,047 words.
    assert p["Wh"].shape == (32, 96) and p["E"].shape[1] == 32
    for k in ("Wx", "Wh", "Wc"):
        assert (np.abs(p[k] - start[k]).max(axis=1) > 0).all()
    assert np.isfinite(lm.log10_scores(p, lay, docs, p["E"] @ p["Wx"] + p["b"])).all()
