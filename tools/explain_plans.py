"""Run headline queries and write their final (post-AQE) physical plans.

usage: python tools/explain_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from ratewise import build_session  # noqa: E402
from ratewise.operators import als_exact as ax  # noqa: E402
from ratewise.operators.recommend import top_n_exact  # noqa: E402
from ratewise.plans import catalog as C  # noqa: E402


def _drop_initial(tree: str) -> str:
    """Keep the final adaptive plans; drop '== Initial Plan ==' subtrees and
    the plans of cached inputs."""
    out, skip_at = [], None
    for line in tree.splitlines():
        indent = len(line) - len(line.lstrip(" :|+-"))
        if skip_at is not None:
            if indent > skip_at:
                continue
            skip_at = None
        if "== Initial Plan ==" in line:
            skip_at = indent
            continue
        out.append(line)
        if "InMemoryRelation" in line:
            # A cached input: its own plan is shown where it is built.
            skip_at = indent
    return "\n".join(out)


def final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    tree = _drop_initial(text.split("\n\n\n")[0])
    scans = [
        line.strip()
        for line in text.splitlines()
        if re.match(r"\s*(ReadSchema|PushedFilters|Location)", line) and "InMemory" not in line[:0]
    ]
    return tree + "\n\nScan details:\n" + "\n".join(dict.fromkeys(scans))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(8, 16)
    # Inputs are not cached here, so each tree shows the scans it reads.
    train, _ = C._train_test(spark, sf)
    rank = 5
    items0 = ax.init_factors(train, "item_id", rank)
    users1 = ax.half_step(train, items0, "item_id", "user_id", rank, 0.1)
    plans = {
        "rating_profile (scan of lineitem x orders, split, counts)": C.q_rating_profile(spark, sf),
        "half step, Catalyst sums, rank 5 (lookup by exact size, partial aggregation, batched solve)":
            users1,
        "exact top 10 for every user (grid of user and item blocks)":
            top_n_exact(spark, users1, items0, rank, 10),
        "keyed upsert: wide read after two put rounds": C.q_kv_upsert(spark, sf),
        "events scan for the stream input (column pruning)": C.ratings_s(spark, sf).select(
            "user_id", "item_id", "rating"
        ).where(F.col("rating") >= 4),
    }
    print("# Final physical plans (sf = %s, local[8])\n" % os.path.basename(sf.rstrip("/")))
    print("Produced by `tools/explain_plans.py` after running each query, so the")
    print("adaptive plans are final (`*` marks whole-stage codegen).\n")
    for title, df in plans.items():
        print(f"## {title}\n\n```\n{final_plan(df)}\n```\n")


if __name__ == "__main__":
    main()
