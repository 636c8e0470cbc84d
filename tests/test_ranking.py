"""Ranks and joins against brute force, with very uneven data."""

import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from roomledger.operators import joins, ranking
from roomledger.operators.blocks import with_blocks
from roomledger.operators.ranking import asc, desc


def same_rows(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    assert Counter(left.select(columns).collect()) == Counter(right.select(columns).collect())


@pytest.fixture(scope="module")
def uneven(spark):
    """A third of the rows share one value, a third are copies of one row."""
    rng = random.Random(7)
    rows = []
    for i in range(6000):
        kind = i % 3
        if kind == 0:
            rows.append((i, rng.choice("abc"), Decimal("3.25"), rng.randrange(5)))
        elif kind == 1:
            rows.append((-1, "a", Decimal("99999999999.99"), 1))
        else:
            value = None if i % 50 == 2 else Decimal(rng.randrange(-(10**12), 10**12)) / 100
            group = None if i % 40 == 2 else rng.choice("abc")
            rows.append((i, group, value, rng.randrange(-(2**40), 2**40)))
    return spark.createDataFrame(rows, "id bigint, g string, v decimal(18,2), n bigint").repartition(7)


def naive_rank(df, order, name, by=()):
    window = Window.partitionBy(*by).orderBy(*[k.column for k in order])
    return df.withColumn(name, F.dense_rank().over(window).cast("bigint"))


@pytest.mark.parametrize(
    "order",
    [[asc("v")], [desc("v")], [desc("n")], [desc("v"), asc("n")], [asc("n"), desc("v"), asc("id")], [asc("g2")]],
    ids=lambda order: "-".join(k.name + str(k.descending) for k in order),
)
def test_global_rank_equals_window_rank(uneven, order):
    df = uneven.withColumn("g2", F.ascii("g"))
    same_rows(ranking.global_dense_rank(df, order), naive_rank(df, order, "rnk"))


@pytest.mark.parametrize("order", [[desc("v")], [desc("v"), desc("n")]])
def test_rank_within_groups(uneven, order):
    same_rows(
        ranking.global_dense_rank(uneven, order, "r", by=["g"]), naive_rank(uneven, order, "r", ["g"])
    )


def test_rank_of_few_values(uneven):
    df = uneven.withColumn("small", (F.col("n") % 7).cast("decimal(5,2)"))
    for order in ([asc("small", 13)], [desc("small", 13), asc("v")], [asc("v"), desc("small", 13)]):
        same_rows(ranking.global_dense_rank(df, order), naive_rank(df, order, "rnk"))


def test_rank_of_nothing(uneven):
    assert ranking.global_dense_rank(uneven.filter("id > 1000000"), [asc("v")]).count() == 0


def test_rank_of_extreme_values(spark):
    df = spark.createDataFrame([(2**62,), (-(2**62),), (0,), (-1,), (1,), (None,)], "n bigint")
    for order in ([asc("n")], [desc("n")]):
        same_rows(ranking.global_dense_rank(df, order), naive_rank(df, order, "rnk"))


def test_rank_of_any_ordered_type(uneven):
    df = uneven.selectExpr(
        "id",
        "g",
        "timestamp_micros(n) AS at",
        "CASE WHEN n % 7 = 0 THEN double('NaN') WHEN n % 11 = 0 THEN -0.0D WHEN n % 13 = 0 THEN 0.0D ELSE n / 7.0D END AS x",
        "concat(g, n % 100) AS said",
    )
    text = F.col("x").cast("string")  # NaN equals itself
    for order in ([desc("at")], [asc("x")], [desc("x"), asc("said")], [asc("said"), desc("at"), desc("x")]):
        ranked = ranking.global_dense_rank(df, order, block_keys=50)
        same_rows(ranked.withColumn("x", text), naive_rank(df, order, "rnk").withColumn("x", text))
    ranked = ranking.global_dense_rank(df, [desc("said")], by=["g", "x"], block_keys=50)
    same_rows(ranked.withColumn("x", text), naive_rank(df, [desc("said")], "rnk", ["g", "x"]).withColumn("x", text))


@pytest.mark.parametrize("order", [[asc("v")], [desc("v"), asc("n")], [desc("n"), desc("id")]])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_rank_over_many_blocks(uneven, order, by):
    same_rows(ranking.global_dense_rank(uneven, order, by=by, block_keys=30), naive_rank(uneven, order, "rnk", by))


@pytest.fixture(scope="module")
def clumped(spark):
    """64-bit keys: a third equal, a third within a tiny range, a third far apart."""
    return spark.range(0, 60000, 1, 16).selectExpr(
        "id",
        "CASE id % 3 WHEN 0 THEN 5 WHEN 1 THEN 9000000000000000 + id ELSE xxhash64(id) END AS k",
        "id % 3 = 1 AS g",
    )


@pytest.mark.parametrize("by", [[], ["g"]])
def test_blocks_of_64_bit_keys_are_even(spark, clumped, by):
    """No task of the rank sorts much more than its share of the distinct keys."""
    keys = clumped.selectExpr("struct(k) AS key").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    cut, n_rows = with_blocks(keys, "key", [True], "n", 1000)
    sizes = [r["count"] for r in cut.groupBy("__block").count().collect()]
    assert sum(sizes) == 40001 and 30 <= len(sizes) <= 50 and max(sizes) < 2500
    assert cut.select(n_rows).first()[0] == 60000
    ranked = ranking.global_dense_rank(clumped, [desc("k")], by=by, block_keys=1000)
    assert largest_task(spark, ranked) < 12000
    same_rows(ranked, naive_rank(clumped, [desc("k")], "rnk", by))


@pytest.mark.parametrize("by", [[], ["g"]])
def test_only_sums_meet_in_one_task(uneven, by):
    """What a single partition reads are partial aggregates or the counts of blocks."""
    plan = ranking.global_dense_rank(uneven, [desc("v"), asc("n")], by=by)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    single = [k for k, line in enumerate(lines) if "SinglePartition" in line]
    assert single
    for k in single:
        below = lines[k + 1]
        assert "partial_" in below or ("keys=[__block" in below and not by), below


@pytest.mark.parametrize("order", [[desc("v")], [asc("v")], [desc("v"), asc("n")]])
@pytest.mark.parametrize("groups", [None, 10])
def test_top_n_keeps_all_ties(uneven, order, groups):
    expected = naive_rank(uneven, order, "rnk", ["g"]).filter("rnk <= 3")
    same_rows(ranking.top_n_per_group(uneven, ["g"], order, 3, max_groups=groups), expected)


def test_top_n_without_group(uneven):
    expected = naive_rank(uneven, [desc("v")], "rnk").filter("rnk <= 2")
    assert expected.count() > 2
    same_rows(ranking.top_n_per_group(uneven, [], [desc("v")], 2), expected)


def test_top_n_with_fewer_rows_and_exact_count(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("b", 3, None)], "g string, id int, v int")
    top = ranking.top_n_per_group(df, ["g"], [desc("v"), asc("id")], 1, method="row_number")
    assert sorted(top.collect()) == [("a", 1, 5, 1), ("b", 3, None, 1)]
    assert ranking.top_n_per_group(df, ["g"], [desc("v")], 9).count() == 3


def test_top_n_ranks_in_parallel_before_the_last_task(uneven):
    plan = ranking.top_n_per_group(uneven, [], [desc("v")], 2)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_unknown_method(uneven):
    with pytest.raises(ValueError):
        ranking.top_n_per_group(uneven, [], [desc("v")], 2, method="rank")


def test_bottom_k_by_rank_sum(uneven):
    rows = uneven.filter("id >= 0")
    expected = (
        naive_rank(naive_rank(rows, [asc("v")], "r1"), [desc("n")], "r2")
        .orderBy(F.col("r1") + F.col("r2"), "id")
        .limit(10)
        .select("id", "g", "v", "n")
    )
    found = ranking.rank_sum_bottom_k(rows, [asc("v"), desc("n")], 10, ["id"])
    same_rows(found, expected)


def test_bottom_k_puts_null_first_and_breaks_ties(spark):
    rows = [(i, None if i == 3 else 1, 1) for i in range(12)]
    df = spark.createDataFrame(rows, "id int, rating int, occ int")
    found = ranking.rank_sum_bottom_k(df, [asc("occ", 10), asc("rating")], 10, ["id"])
    assert sorted(r.id for r in found.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_equals_join(spark, uneven, how):
    right = spark.createDataFrame(
        [(Decimal("3.25"), "x", None), (Decimal("-1.00"), "z", 2)], "v decimal(18,2), p string, q int"
    ).unionByName(
        uneven.filter("v < 0").select("v").distinct().selectExpr("v", "'w' AS p", "1 AS q")
    ).dropDuplicates(["v"])
    same_rows(joins.split_join(uneven, right, ["v"], how), uneven.join(right, ["v"], how))


def test_split_join_on_two_columns(uneven):
    right = uneven.select("g", "v").dropna().distinct().withColumn("p", F.length("g"))
    same_rows(joins.split_join(uneven, right, ["g", "v"]), uneven.join(right, ["g", "v"]))


def largest_task(spark, df):
    """Rows of the fullest partition, without adaptive execution."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = df.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return max(r["count"] for r in sizes)


@pytest.fixture(scope="module")
def one_hot_key(spark):
    """Half of 40,000 rows share a key, and most of those are copies of one row."""
    return spark.range(0, 40000, 1, 16).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 7 ELSE pmod(xxhash64(id), 5000) END AS k",
        "CASE WHEN id % 2 = 0 THEN id % 10 * int(id % 5 = 0) ELSE id END AS t",
    )


def test_split_join_leaves_no_full_task(spark, one_hot_key):
    right = spark.range(5000).selectExpr("id AS k", "id AS p")
    assert largest_task(spark, one_hot_key.join(right, "k")) > 20000
    assert largest_task(spark, joins.split_join(one_hot_key, right, ["k"])) < 8000


def test_null_keys_leave_no_full_task(spark, one_hot_key):
    """Half of the rows have no key; they are kept, without a partner, and spread."""
    left = one_hot_key.selectExpr("CASE WHEN k = 7 THEN NULL ELSE k END AS k", "t")
    right = spark.range(5000).selectExpr("id AS k", "id AS p")
    joined = joins.split_join(left, right, ["k"], "left")
    assert largest_task(spark, joined) < 8000
    without = left.filter("k IS NULL").count()
    assert joined.count() == 40000 and joined.filter("p IS NULL").count() == without


def test_hot_keys_follow_the_shuffle_partitions(spark):
    df, before = spark.range(1), spark.conf.get("spark.sql.shuffle.partitions")
    assert joins.hot_key_limit(df) == 1024
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "5000")
        assert joins.hot_key_limit(df) == 20000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rank_leaves_no_full_task(spark, one_hot_key):
    assert largest_task(spark, ranking.global_dense_rank(one_hot_key, [desc("k")])) < 8000


def test_split_join_refuses_other_kinds(uneven):
    with pytest.raises(ValueError):
        joins.split_join(uneven, uneven.select("v").distinct(), ["v"], "full")


def test_null_safe_join(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, l int")
    right = spark.createDataFrame([(None, 3), ("a", 4)], "k string, r int")
    assert sorted(joins.null_safe_join(left, right, ["k"]).collect(), key=str) == [("a", 2, 4), (None, 1, 3)]


@pytest.fixture(scope="module")
def tied(spark):
    """A third of 60,000 rows share the winning value of one group, a third a losing value."""
    return spark.range(0, 60000, 1, 16).selectExpr(
        "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN 'hot' ELSE string(id % 500) END AS g",
        "CASE id % 3 WHEN 0 THEN 9 WHEN 1 THEN 1 ELSE pmod(xxhash64(id), 9) END AS v",
        "id",
    )


def test_ties_leave_no_full_task(spark, tied):
    top = ranking.top_n_per_group(tied, ["g"], [desc("v")], 1)
    same_rows(top, naive_rank(tied, [desc("v")], "rnk", ["g"]).filter("rnk <= 1"))
    assert top.filter("g = 'hot'").count() == 20000
    assert largest_task(spark, top) < 6000
