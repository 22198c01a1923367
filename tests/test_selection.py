"""Selection without sorting, Bloom filters, and users too big for one partition."""

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from tagmatch import Profiles, Scale, item_catalog
from tagmatch.operators.profiles import user_term_totals
from tagmatch.operators.subset import subset_by_keys, subset_users
from tagmatch.plans import bloom
from tagmatch.plans.selection import nth_smallest, smallest
from tests.test_plans import executed_plan


def test_nth_smallest_of_awkward_keys(spark):
    draw = random.Random(3)
    values = [2**63 - 1, -(2**63), 0, 0, 0, 5] + [draw.randrange(-(2**62), 2**62) for _ in range(500)]
    values += [draw.randrange(2000) for _ in range(500)]
    keys = spark.createDataFrame([(v,) for v in values], "k long")
    values.sort()
    for n in (1, 2, 3, 250, 600, 1005, len(values)):
        assert nth_smallest(keys, "k", n) == values[n - 1]
    assert nth_smallest(keys, "k", len(values) + 1) is None
    assert nth_smallest(keys.filter("false"), "k", 1) is None
    with pytest.raises(ValueError):
        nth_smallest(keys, "k", 0)
    with pytest.raises(TypeError):
        nth_smallest(keys.select(F.col("k").cast("string")), "k", 1)


@pytest.mark.parametrize("n", [0, 1, 999, 1000, 10**8])
def test_smallest_is_a_filter(spark, n):
    keys = spark.range(0, 3000, 3).select((F.col("id") * 1_000_003 - 7_000).alias("k"))
    found = smallest(keys, "k", n)
    assert sorted(r.k for r in found.collect()) == [i * 1_000_003 - 7_000 for i in range(0, 3000, 3)][:n]
    plan = executed_plan(found)
    assert "Exchange" not in plan and "Sort" not in plan and "TakeOrdered" not in plan


@pytest.mark.parametrize("target", [None, 41])
def test_any_number_of_users_is_chosen_without_a_task_for_all(spark, target):
    users = spark.range(2000).select(
        F.col("id").alias("user_id"), F.lit(1).alias("products"), (F.col("id") % 10).cast("int").alias("reviews")
    )
    chosen = subset_users(users, 5, 10**8, target)
    plan = executed_plan(chosen)
    assert "SinglePartition" not in plan and "TakeOrdered" not in plan and "Limit" not in plan
    assert chosen.count() == 1000 if target is None else 999
    assert len(subset_users(users, 5, 300, target).collect()) == (300 if target is None else 299)


def test_bloom_filter_holds_all_its_keys_and_few_others(spark):
    keys = spark.range(0, 30_000, 3).select(F.col("id").alias("k"))
    bits = bloom.filter_bits(10_000, 1 << 30)
    assert bits % 64 == 0 and bits >= 100_000
    rows = spark.range(-30_000, 60_000).select(F.when(F.col("id") != 1, F.col("id")).alias("k"))
    kept = rows.filter(bloom.may_hold(F.col("k"), bloom.bloom_filter(keys, "k", bits), bits))
    found = {r.k for r in kept.collect()}
    true = set(range(0, 30_000, 3))
    assert true <= found and None not in found
    assert 0 < len(found - true) < 0.03 * 80_000
    assert len(found) == kept.count()


@pytest.mark.parametrize("filter_bits", [64 * 16, 1 << 20])
def test_false_positives_of_the_filter_do_not_stay(spark, filter_bits):
    """At four bits a key, some other keys pass the filter, and none the join."""
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    keys = spark.range(0, 5000, 20).select(F.col("id").alias("k"))
    scale = Scale(broadcast_bytes=0, filter_bits=filter_bits)
    bits = bloom.filter_bits(250, filter_bits)
    passed = rows.filter(bloom.may_hold(F.col("k"), bloom.bloom_filter(keys, "k", bits), bits)).count()
    assert passed > 250 if filter_bits < 2000 else passed >= 250
    kept = subset_by_keys(rows, keys, "k", scale)
    assert sorted(r.k for r in kept.collect()) == list(range(0, 5000, 20))
    assert "getbit" in executed_plan(kept)
    # Too many keys for the filter: it is left out.
    plain = subset_by_keys(rows, keys, "k", Scale(broadcast_bytes=0, filter_bits=512))
    assert "getbit" not in executed_plan(plain) and plain.count() == 250


def test_filter_of_text_keys(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,), ("",)], "k string")
    keys = spark.createDataFrame([("a",), ("",), ("zz",)], "k string")
    kept = subset_by_keys(rows, keys, "k", Scale(broadcast_bytes=0))
    assert sorted(r.k for r in kept.collect()) == ["", "a"]


def test_users_too_big_for_a_partition_are_taken_out_of_the_layout(spark):
    """Eight users with a twelfth of all rows each, under the limit of hot keys by share."""
    draw = random.Random(4)
    big = [(u, draw.randrange(50)) for u in range(8) for _ in range(1000)]
    liked = big + [(draw.randrange(100, 1100), draw.randrange(50)) for _ in range(4000)]
    frame = spark.createDataFrame(liked, "user_id long, app_id long")
    items = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "app_id long, title string")
    tags = spark.createDataFrame([(i, [f"w{i % 7}", "all"]) for i in range(50)], "app_id long, tags array<string>")
    catalog = item_catalog(items, tags)
    scale = Scale(hot_rows=100, hot_share=0.2)
    profiles = Profiles(frame, catalog, scale)
    assert {r.user_id for r in profiles.hot_users.collect()} == set(range(8))
    sizes = [n for n in profiles.ordinary.rdd.glom().map(len).collect() if n]
    assert max(sizes) <= 2 * median(sizes)
    # Their words are counted where the rows lie; only the counts are exchanged.
    totals = {r.user_id: r.total_word_count for r in user_term_totals(profiles).collect()}
    want = {}
    for user, _ in liked:
        want[user] = want.get(user, 0) + 2
    assert totals == want
    # Without the rule for partitions no user is hot, and some partition is overfull.
    even = Profiles(frame, catalog, Scale(hot_rows=100, hot_share=0.2, partition_share=1e9))
    assert even.hot_users is None
    sizes = [n for n in even.ordinary.rdd.glom().map(len).collect() if n]
    assert max(sizes) > 2 * median(sizes)
