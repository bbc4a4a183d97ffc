"""Physical-plan properties the design relies on (read from the plans)."""

import re

from ratewise.operators import als_exact as ax
from ratewise.operators.recommend import top_n_exact
from ratewise.plans import catalog as C
from ratewise.sources import ratings_s

from sf_paths import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stream_input_scan_reads_only_needed_columns(spark):
    p = plan(ratings_s(spark, SF_SMALL).select("user_id", "item_id", "rating"))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert schemas and all("event_type" not in s and "event_id" not in s for s in schemas)


def test_half_step_broadcasts_factors_and_shuffles_once(spark):
    train, _ = C._train_test(spark, SF_SMALL)
    items = ax.init_factors(train, "item_id", 3)
    p = plan(ax.half_step(train, items, "item_id", "user_id", 3, 0.1))
    # The lookup is a broadcast hash join: the ratings are not shuffled for
    # it, only their partial sums are, by user.
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p
    assert "MapInPandas" in p


def test_top_n_has_no_pair_join(spark):
    train, _ = C._train_test(spark, SF_SMALL)
    items = ax.init_factors(train, "item_id", 2)
    users = ax.init_factors(train, "user_id", 2)
    p = plan(top_n_exact(spark, users, items, 2, 5))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "SortMergeJoin"):
        assert node not in p


def test_blocked_half_step_does_not_reshuffle_ratings(spark):
    from ratewise.operators.blocks import blocked_half_step, blocked_side

    train, _ = C._train_test(spark, SF_SMALL)
    r = train.select("user_id", "item_id", "rating").persist()
    side = blocked_side(r, "user_id", "item_id", r.count(), min_blocks=4)
    items = ax.init_factors(r, "item_id", 3)
    lines = plan(blocked_half_step(spark, side, items, 200, 3, 0.1)).splitlines()
    at = next(i for i, line in enumerate(lines) if "FlatMapCoGroupsInPandas" in line)
    # The ratings child of the co-group is the cached, block-partitioned
    # scan itself: no exchange and no sort in between.
    assert "InMemoryTableScan" in lines[at + 1]
    side.unpersist()
    r.unpersist()
