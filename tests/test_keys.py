"""Registered keys: dense, and the same after items come and go."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from courierlake.functions.keys import registered

LOADS = st.lists(st.lists(st.one_of(st.none(), st.integers(-5, 40)), max_size=30), min_size=3, max_size=3)


def load(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "item_id long")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(LOADS)
def test_keys_are_dense_and_never_move(spark, loads):
    held, seen, registry = {}, set(), None
    for ids in loads:
        rows = registered(registry, load(spark, ids), "item_id", "item_key", digits=1).collect()
        now = {r.item_id: r.item_key for r in rows}
        seen |= {i for i in ids if i is not None}
        assert len(rows) == len(now) and set(now) == seen
        assert sorted(now.values()) == list(range(1, len(seen) + 1))
        assert all(now[i] == k for i, k in held.items())
        held = now
        registry = spark.createDataFrame(list(now.items()), "item_id long, item_key long")


def test_keys_do_not_depend_on_the_order_of_rows(spark):
    one = registered(None, load(spark, range(500)), "item_id", "k").collect()
    two = registered(None, load(spark, [*reversed(range(500)), 7, 7]).repartition(9), "item_id", "k").collect()
    assert sorted(one) == sorted(two)
