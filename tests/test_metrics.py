"""Calendar metrics, quantiles and bins against brute force."""

import math
import random
from bisect import bisect_left, bisect_right
from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal
from statistics import median

import pytest
from pyspark.sql import functions as F

from roomledger.functions.dates import month_key, month_label, season_of
from roomledger.functions.numbers import mean_of, percent, rounded
from roomledger.operators import comparing, metrics, quantiles, sketches

DDL = "listing_id bigint, date date, available boolean, price decimal(18,2)"


@pytest.fixture(scope="module")
def days():
    """Half of the rows belong to one listing; dates repeat and values may be missing."""
    rng = random.Random(11)
    rows = []
    for i in range(4000):
        listing = 1 if i % 2 else rng.randrange(2, 60)
        day = None if rng.random() < 0.01 else date(2024, 1, 1) + timedelta(days=rng.randrange(500))
        price = None if rng.random() < 0.1 else Decimal(rng.randrange(100, 130)) / 10
        available = rng.choice([True, False, None])
        rows.append((listing, day, available, price))
    return rows


@pytest.fixture(scope="module")
def calendar(spark, days):
    return spark.createDataFrame(days, DDL).repartition(5)


def half_up(value, digits="0.01"):
    return Decimal(value).quantize(Decimal(digits), ROUND_HALF_UP)


def by_listing(days):
    groups = defaultdict(list)
    for row in days:
        groups[row[0]].append(row)
    return groups


def test_occupancy(calendar, days):
    found = {r.listing_id: r.occupancy_rate for r in metrics.occupancy_rate(calendar, "listing_id").collect()}
    expected = {
        key: half_up(Decimal(100 * sum(r[2] is False for r in rows)) / len(rows))
        for key, rows in by_listing(days).items()
    }
    assert found == expected


def test_occupancy_extremes(spark):
    rows = [(1, None, False, None), (2, None, True, None), (3, None, None, None), (3, None, False, None)]
    found = metrics.occupancy_rate(spark.createDataFrame(rows, DDL), "listing_id").collect()
    assert {r.listing_id: float(r.occupancy_rate) for r in found} == {1: 100.0, 2: 0.0, 3: 50.0}


def test_revenue_of_coarser_groups(calendar):
    direct = metrics.calendar_totals(calendar, "listing_id").withColumn("revenue", metrics.revenue())
    monthly = metrics.calendar_totals(calendar, "listing_id", F.month("date").alias("month"))
    merged = metrics.merge_totals(monthly, "listing_id").withColumn("revenue", metrics.revenue())
    assert sorted(direct.collect()) == sorted(merged.select(direct.columns).collect())


def test_revenue_is_null_only_without_any_known_amount(spark):
    rows = [(1, None, False, None), (2, None, False, None), (2, None, True, Decimal(5)), (3, None, False, Decimal(7))]
    totals = metrics.calendar_totals(spark.createDataFrame(rows, DDL), "listing_id")
    found = totals.select("listing_id", metrics.revenue().cast("double")).collect()
    assert sorted(found) == [(1, None), (2, 0.0), (3, 7.0)]


def test_median(calendar, days):
    found = {r.listing_id: r.median_price for r in metrics.median_prices(calendar).collect()}
    expected = {
        key: half_up(median([r[3] for r in rows if r[3] is not None]))
        for key, rows in by_listing(days).items()
    }
    assert found == expected


def brute_changes(rows):
    ordered = sorted(rows, key=lambda r: (r[1] or date.min, r[3] if r[3] is not None else Decimal(-1)))
    prices = [r[3] for r in ordered]
    return sum(a is not None and b is not None and a != b for a, b in zip(prices, prices[1:]))


def test_change_count(calendar, days):
    found = metrics.change_count(calendar, "listing_id", "date", "price").collect()
    groups = by_listing(days)
    assert {r.listing_id: r.n_changes for r in found} == {k: brute_changes(v) for k, v in groups.items()}
    assert {r.listing_id: r.n_rows for r in found} == {k: len(v) for k, v in groups.items()}
    assert {r.listing_id: (r.value_sum, r.n_values) for r in found} == {
        k: (sum(r[3] for r in v if r[3] is not None), sum(r[3] is not None for r in v)) for k, v in groups.items()
    }


def test_change_count_small_cases(spark):
    def day(listing, when, price):
        return (listing, date.fromisoformat(when), True, None if price is None else Decimal(price))

    rows = [
        day(1, "2024-01-31", 5),
        day(2, "2024-01-31", 5), day(2, "2024-02-01", 6), day(2, "2024-04-01", 6),
        day(3, "2024-01-01", 5), day(3, "2024-01-02", None), day(3, "2024-01-03", 6),
        day(4, "2024-01-01", 5), day(4, "2024-01-01", 5), day(4, "2024-01-01", 6),
        day(5, "2024-01-31", None), day(5, "2024-02-01", 6), day(5, "2024-03-01", 7),
    ]
    found = metrics.change_count(spark.createDataFrame(rows, DDL), "listing_id", "date", "price").collect()
    assert {r.listing_id: r.n_changes for r in found} == {1: 0, 2: 1, 3: 0, 4: 1, 5: 1}


@pytest.mark.parametrize(
    "day, season",
    [(1, "Winter"), (78, "Winter"), (79, "Spring"), (171, "Spring"), (172, "Summer"), (263, "Summer"),
     (264, "Autumn"), (354, "Autumn"), (355, "Winter"), (366, "Winter")],
)
def test_season(spark, day, season):
    df = spark.createDataFrame([(date(2024, 1, 1) + timedelta(days=day - 1),)], "d date")
    assert df.select(season_of("d")).first()[0] == season


def test_months(spark):
    df = spark.createDataFrame([(date(2024, 2, 29),), (None,)], "d date")
    for grain, label in (("name", "February"), ("year_month", "2024-02")):
        found = df.select(month_label(month_key("d", grain), grain)).collect()
        assert [r[0] for r in found] == [label, None]
    with pytest.raises(ValueError):
        month_key("d", "week")


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(3)
    values = [None if i % 17 == 0 else Decimal(rng.choice([250, rng.randrange(-(10**10), 10**10)])) / 100 for i in range(3000)]
    groups = [rng.choice(["a", "b", None]) for _ in values]
    return list(zip(groups, values)), spark.createDataFrame(list(zip(groups, values)), "g string, v decimal(18,2)").repartition(6)


@pytest.mark.parametrize("fraction", [0.0, 0.25, 1 / 3, 0.5, 0.9, 1.0])
def test_quantiles(numbers, fraction):
    rows, df = numbers
    ordered = sorted(v for _, v in rows if v is not None)
    found = quantiles.exact_quantiles(df, "v", {"q": fraction}).collect()
    assert found == [(ordered[max(math.ceil(len(ordered) * fraction), 1) - 1],)]


def test_quantiles_per_group(numbers):
    rows, df = numbers
    found = quantiles.exact_quantiles(df, "v", {"low": 0.25, "high": 0.75}, ["g"]).collect()
    for r in found:
        ordered = sorted(v for g, v in rows if v is not None and g == r.g)
        assert (r.low, r.high) == tuple(ordered[math.ceil(len(ordered) * q) - 1] for q in (0.25, 0.75))
    assert {r.g for r in found} == {"a", "b", None}


def test_exact_median(numbers):
    rows, df = numbers
    found = quantiles.exact_median(df, "v", "m", ["g"]).collect()
    for r in found:
        assert r.m == median([v for g, v in rows if v is not None and g == r.g])
    assert len(found) == 3
    assert quantiles.exact_median(df.filter("v is null"), "v", "m").first().m is None


def test_quantile_bin(spark):
    values = [Decimal(v) for v in ("1", "2", "2.5", "3.5", "4", "9")] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(18,2)")
    # the quartile is 2 and the median 2.5: nothing lies between 3 and 2.5
    found = {r.v: r.v_bin for r in quantiles.quantile_bin(df, "v").collect()}
    assert found == {v: "Low" if v is not None and v <= 2 else "High" for v in values}
    wide = spark.createDataFrame([(i * 10,) for i in range(1, 9)], "v int")
    assert [r.b for r in quantiles.quantile_bin(wide, "v", "b").orderBy("v").collect()] == (
        ["Low"] * 2 + ["Medium"] * 2 + ["High"] * 4
    )


def test_tercile_bin(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 10)] + [(None,)], "v int")
    found = quantiles.tercile_bin(df, "v").orderBy(F.col("v").asc_nulls_last()).collect()
    assert [r.v_bin for r in found] == ["Low"] * 3 + ["Medium"] * 3 + ["High"] * 3 + [None]


def test_bins_of_equal_values(spark):
    df = spark.createDataFrame([(5,)] * 4, "v int")
    assert {r.v_bin for r in quantiles.quantile_bin(df, "v").collect()} == {"Low"}


@pytest.mark.parametrize(
    "n, tier", [(1, "Small"), (5, "Small"), (6, "Medium"), (15, "Medium"), (16, "Large"), (0, "Large"), (None, "Large")]
)
def test_fixed_bin(spark, n, tier):
    df = spark.createDataFrame([(n,)], "n int")
    label = quantiles.fixed_bin("n", {"Small": (1, 5), "Medium": (6, 15)}, "Large")
    assert df.select(label).first()[0] == tier


def test_rounding_is_half_up_and_ignores_float_noise(spark):
    df = spark.createDataFrame([(2.345,), (-2.345,), (0.1 + 0.2,), (1.005,)], "v double")
    assert [str(r[0]) for r in df.select(rounded("v")).collect()] == ["2.35", "-2.35", "0.30", "1.01"]


def test_weighted_score_with_zero_or_missing_parts(spark):
    df = spark.createDataFrame(
        [("a", Decimal(10), Decimal(5), Decimal(50)), ("b", Decimal(10), Decimal(0), Decimal(0)), ("c", Decimal(10), None, Decimal(1))],
        "k string, price decimal(18,2), rating decimal(18,2), occ decimal(18,2)",
    )
    scored = comparing.weighted_score_ratio(df, "price", {"rating": "0.6", "occ": "0.4"}, "score", "ratio")
    assert [(r.k, r.score and float(r.score), r.ratio and float(r.ratio)) for r in scored.orderBy("k").collect()] == [
        ("a", 23.0, 0.43), ("b", 0.0, None), ("c", None, None),
    ]


def test_weighted_mean_equals_mean_of_repeated_rows(spark):
    df = spark.createDataFrame([("x", 1.0, 3), ("x", None, 5), ("x", 4.0, 1), ("y", None, 2)], "g string, v double, w bigint")
    repeated = df.selectExpr("g", "v", "explode(sequence(1, w))")
    weighted = comparing.segment_compare(df, "g", {"m": "v"}, weight="w")
    assert sorted(weighted.collect()) == sorted(comparing.segment_compare(repeated, "g", {"m": "v"}).collect())


def test_missing_reference_group(spark):
    df = spark.createDataFrame([("a", Decimal(2))], "g string, v decimal(18,2)")
    assert comparing.diff_from_reference_group(df, "g", "v", "Low", "d").collect() == [("a", Decimal(2), None)]


def test_percent_is_rounded_once(spark):
    counts = [(50, 101), (107, 366), (290, 366), (0, 7), (7, 7), (1, 0), *((n, d) for d in (199, 365, 366, 8000) for n in range(0, d + 1, 7))]
    df = spark.createDataFrame(counts, "n bigint, d bigint")
    for r in df.select("n", "d", percent(F.col("n"), F.col("d")).alias("p")).collect():
        exact = r.d and (Decimal(100 * r.n) / r.d).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert r.p == (exact if r.d else None), (r.n, r.d)
    by_hand = {(r.n, r.d): str(r.p) for r in df.limit(3).select("n", "d", percent(F.col("n"), F.col("d")).alias("p")).collect()}
    assert by_hand == {(50, 101): "49.50", (107, 366): "29.23", (290, 366): "79.23"}


def test_means_that_differ_in_the_eighth_digit_rank_apart(spark):
    """More than a hundred prices each; the sums differ by one cent over a million rows."""
    df = spark.createDataFrame([(1, Decimal("100000.00"), 1_000_000), (2, Decimal("100000.01"), 1_000_000)], "id int, total decimal(28,2), n bigint")
    means = [r.m for r in df.select(mean_of("total", "n").alias("m")).collect()]
    assert means[0] < means[1] and round(means[0], 7) == round(means[1], 7)


def test_mean_of_many_rows_is_exact(spark):
    draw = random.Random(11)
    rows = [(g, Decimal(draw.randrange(1, 90_000)) / 100) for g in range(6) for _ in range(151 + 13 * g)]
    df = spark.createDataFrame(rows, "g int, v decimal(18,2)")
    for r in comparing.segment_compare(df, "g", {"m": "v"}).collect():
        values = [v for g, v in rows if g == r.g]
        assert r.m == (sum(values) / len(values)).quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_values_that_are_there_are_not_rounded(spark):
    df = spark.createDataFrame([(1, Decimal("4.735")), (2, None)], "id int, rating decimal(5,3)")
    medians = spark.createDataFrame([(1, Decimal("1.00")), (2, Decimal("3.25"))], "k int, m decimal(18,2)")
    filled = metrics.impute_from_group_median(df, "id", "rating", medians).orderBy("id")
    assert [r.rating for r in filled.collect()] == [Decimal("4.735"), Decimal("3.250")]


def test_imputation_keeps_the_chosen_columns(spark):
    listings = spark.createDataFrame([(1, None, "x", "y"), (2, Decimal("5.00"), "p", "q")], "id bigint, price decimal(18,2), a string, b string")
    days = spark.createDataFrame([(1, Decimal("3.00")), (2, Decimal("9.00"))], "listing_id bigint, price decimal(18,2)")
    filled = metrics.impute_prices(listings, days, columns=["id", "price", "b"]).orderBy("id")
    assert filled.columns == ["id", "b", "price"]
    assert [r.price for r in filled.collect()] == [Decimal("3.00"), Decimal("5.00")]


def test_quantiles_over_many_blocks(spark):
    """A third of the rows are equal; small blocks, with and without groups."""
    draw = random.Random(8)
    rows = [("ab"[k % 2], 500 if k % 3 == 0 else draw.randrange(-(2**62), 2**62)) for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    fractions = {"low": 0.1, "middle": 0.5, "high": 0.99}
    at = lambda values, q: sorted(values)[max(math.ceil(len(values) * q), 1) - 1]
    assert quantiles.exact_quantiles(df, "v", fractions, block_keys=40).collect() == [
        tuple(at([v for _, v in rows], q) for q in fractions.values())
    ]
    for r in quantiles.exact_quantiles(df, "v", fractions, ["g"], block_keys=40).collect():
        assert (r.low, r.middle, r.high) == tuple(at([v for g, v in rows if g == r.g], q) for q in fractions.values())


def test_sketched_quantiles_stay_within_their_error(spark):
    draw = random.Random(9)
    rows = [("ab"[k % 2], 500.0 if k % 3 == 0 else draw.gauss(0, 1000), k % 12) for k in range(60_000)] + [("c", 7.0, 1), ("d", None, 1)]
    df = spark.createDataFrame(rows, "g string, v double, month int").repartition(9)
    fractions = {"low": 0.25, "middle": 0.5, "high": 0.9}
    by_month = df.groupBy("g", "month").agg(sketches.quantile_sketch("v").alias("s"))
    merged = by_month.groupBy("g").agg(sketches.merged_quantile_sketch("s").alias("s"))
    merged = merged.select("g", *[sketches.sketched_quantile("s", f).alias(n) for n, f in fractions.items()])
    for found in (sketches.approximate_quantiles(df, "v", fractions, ["g"]), merged):
        for r in found.collect():
            values = sorted(v for g, v, _ in rows if g == r.g and v is not None)
            for name, fraction in fractions.items():
                if not values:
                    assert r[name] is None
                    continue
                # the positions that the value found takes
                low, high = bisect_left(values, r[name]) / len(values), bisect_right(values, r[name]) / len(values)
                slack = sketches.RANK_ERROR + 1 / len(values)
                assert low - slack <= fraction <= high + slack, (r.g, name)


def test_sketched_counts_stay_within_their_error(spark):
    df = spark.range(0, 300_000).selectExpr("id % 3 AS g", "CASE WHEN id % 2 = 0 THEN 7 ELSE id DIV 4 END AS v", "id % 12 AS month").repartition(9)
    by_month = df.groupBy("g", "month").agg(sketches.distinct_sketch("v").alias("s"))
    merged = by_month.groupBy("g").agg(sketches.sketched_count(sketches.merged_distinct_sketch("s")).alias("n"))
    exact = {r.g: r.n for r in df.groupBy("g").agg(F.count_distinct("v").alias("n")).collect()}
    for r in merged.collect():
        assert abs(r.n - exact[r.g]) <= sketches.DISTINCT_ERROR * exact[r.g]
    few = spark.createDataFrame([(1,), (1,), (None,), (2,)], "v int")
    assert few.agg(sketches.sketched_count(sketches.distinct_sketch("v")).alias("n")).first().n == 2


def test_distinct_counts_of_several_columns(spark):
    rows = [("ab"[k % 2] if k % 7 else None, k % 5, None if k % 3 else k % 11, "x") for k in range(400)]
    df = spark.createDataFrame(rows, "g string, a int, b int, c string")
    counted = comparing.distinct_counts(df, ["g"], {"n_a": "a", "n_b": "b", "n_c": "c"})
    plain = df.groupBy("g").agg(F.count_distinct("a").alias("n_a"), F.count_distinct("b").alias("n_b"), F.count_distinct("c").alias("n_c"))
    assert sorted(counted.collect(), key=str) == sorted(plain.collect(), key=str)
    assert "Expand" not in counted._jdf.queryExecution().executedPlan().toString()


def test_means_of_finer_scales(spark):
    df = spark.createDataFrame([("a", Decimal("4.735")), ("b", Decimal("1.001")), ("b", Decimal("1.004"))], "g string, v decimal(8,3)")
    found = {(r.g, r.v): r.d for r in comparing.deviation_from_mean(df, "g", "v", "d").collect()}
    assert found == {("a", Decimal("4.735")): 0, ("b", Decimal("1.001")): Decimal("0.00"), ("b", Decimal("1.004")): Decimal("0.00")}
    means = {r.g: r.m for r in comparing.segment_compare(df, "g", {"m": "v"}, digits=3).collect()}
    assert means == {"a": Decimal("4.735"), "b": Decimal("1.003")}


def test_medians_see_only_days_of_listings_without_a_price(spark):
    listings = spark.createDataFrame([(1, None), (2, Decimal("5.00")), (3, None), (4, None), (None, Decimal("1.00"))], "id bigint, price decimal(18,2)")
    days = spark.createDataFrame([(1, Decimal("3.00")), (2, Decimal("9.00")), (3, None), (5, Decimal("2.00"))], "listing_id bigint, price decimal(18,2)")
    filled = metrics.impute_prices(listings, days)
    assert sorted(filled.collect(), key=str) == [(1, Decimal("3.00")), (2, Decimal("5.00")), (3, None)]
    kept = metrics.impute_prices(listings, days, keep_unmatched=True)
    assert sorted(kept.collect(), key=str) == [(1, Decimal("3.00")), (2, Decimal("5.00")), (3, None), (4, None), (None, Decimal("1.00"))]
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    below_median = plan[plan.index("percentile(") :]
    assert "LeftSemi" in below_median and "isnull" in below_median


def test_changes_of_a_month_full_of_copies(spark):
    """A third of the days are copies of one row; each month is one row after one shuffle."""
    days = [(1, date(2024, 3, 5), Decimal("2.00"))] * 3000
    days += [(k % 4, date(2024, 1 + k % 12, 1 + k % 28), Decimal(k * 7919 % 13)) for k in range(6000)]
    days += [(9, None, Decimal("1.00")), (9, date(2024, 1, 1), None), (9, date(2024, 1, 2), Decimal("1.00"))]
    df = spark.createDataFrame(days, "l bigint, d date, v decimal(18,2)").repartition(16)
    found = {r.l: (r.n_changes, r.value_sum, r.n_values, r.n_rows) for r in metrics.change_count(df, "l", "d", "v").collect()}
    for entity in {r[0] for r in days}:
        series = sorted(((d is not None, d or date.min), (v is not None, v or 0)) for e, d, v in days if e == entity)
        values = [v if known else None for _, (known, v) in series]
        changes = sum(a is not None and b is not None and a != b for a, b in zip(values, values[1:]))
        numbers = [v for v in values if v is not None]
        assert found[entity] == (changes, sum(numbers), len(numbers), len(values)), entity
    text = metrics.change_count(df, "l", "d", "v")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(l#") == 2 and "__month" in text
