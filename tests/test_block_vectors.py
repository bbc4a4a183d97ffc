"""A block takes its vectors as plain columns and solves the same normal equations."""

import numpy as np
import pandas as pd

from ratewise.operators.blocks import BlockedSide, _block_fn


def test_vectors_in_plain_columns():
    rng = np.random.default_rng(5)
    vecs = rng.normal(size=(9, 3))
    pairs = [(u, i) for u in range(4) for i in range(9) if (u + i) % 3]
    r = pd.DataFrame({"_blk": 0, "user_id": [u for u, _ in pairs], "item_id": [i for _, i in pairs],
                      "rating": rng.integers(1, 6, len(pairs)).astype(float), "weight": 1.0, "_split": False})
    perm = rng.permutation(9)
    v = pd.DataFrame({"_blk": 0, "item_id": perm, **{f"f{k}": vecs[perm, k] for k in range(3)}})
    side = BlockedSide("user_id", "item_id", None, None, 1, 1, False)
    got = _block_fn(side, 3, 0.1, "plain", True, 1_000)(r, v)
    assert got["id"].tolist() == [0, 1, 2, 3]
    for u, x in zip(got["id"], got["features"]):
        mine = r[r.user_id == u]
        q = vecs[mine.item_id]
        assert np.allclose(x, np.linalg.solve(q.T @ q + 0.1 * np.eye(3), q.T @ mine.rating.to_numpy()))
