"""Reports on small hand-made markets."""

from datetime import date, timedelta
from decimal import Decimal

import pytest

from roomledger.plans.market import Market
from roomledger.plans.registry import ALL_REPORTS, REPORTS

LISTINGS_DDL = (
    "id bigint, host_id bigint, host_city string, host_state string, neighbourhood string, "
    "neighbourhood_group string, property_type string, room_type string, price decimal(18,2), "
    "n_amenities int, host_is_superhost string, host_identity_verified boolean, "
    "host_response_time string, review_scores_rating float, review_scores_cleanliness float, "
    "review_scores_checkin float, review_scores_communication float, review_scores_location float, "
    "review_scores_value float"
)
START = date(2024, 1, 1)


def listing(id, host=1, **changes):
    row = {
        "id": id, "host_id": host, "host_city": "C", "host_state": "S", "neighbourhood": "N",
        "neighbourhood_group": "G", "property_type": "Flat", "room_type": "Room",
        "price": Decimal(100), "n_amenities": 3, "host_is_superhost": "f",
        "host_identity_verified": False, "host_response_time": "within a day",
        "rating": 4.5, "cleanliness": 4.0, "checkin": 4.0, "communication": 4.0, "location": 4.0, "value": 4.0,
    } | changes
    return tuple(row.values())


def day(listing_id, n, available=True, price="50"):
    return (listing_id, START + timedelta(days=n), available, None if price is None else Decimal(price))


@pytest.fixture
def market(spark):
    def build(listings, days=None, reviews=()):
        days = [day(row[0], 0) for row in listings] if days is None else days
        return Market(
            spark.createDataFrame(listings, LISTINGS_DDL),
            spark.createDataFrame(days, "listing_id bigint, date date, available boolean, price decimal(18,2)"),
            spark.createDataFrame(list(reviews), "listing_id bigint, id bigint, date date"),
        )

    return build


def report(name, market, *columns):
    df = ALL_REPORTS[name].build(market)
    return sorted(map(tuple, df.select(*columns or df.columns).collect()), key=str)


def reviews_of(listing_id, n):
    return [(listing_id, listing_id * 1000 + i, START) for i in range(n)]


def test_nineteen_reports_run(market):
    assert len(REPORTS) == 19
    full = market([listing(1), listing(2, 2)], reviews=reviews_of(1, 25))
    for name in ALL_REPORTS:
        ALL_REPORTS[name].build(full).collect()


def test_reports_of_empty_tables(market):
    empty = market([], [])
    for name in REPORTS:
        assert ALL_REPORTS[name].build(empty).count() == 0, name


def test_review_thresholds(market):
    m = market([listing(i) for i in (1, 2, 3, 4)], reviews=sum((reviews_of(i, n) for i, n in ((1, 9), (2, 10), (3, 20), (4, 21))), []))
    assert report("most_reviewed_listings", m, "listing_id") == [(4,)]
    assert report("most_reviewed_listings_intended", m, "listing_id") == [(3,), (4,)]
    assert report("lowest_occupancy_rate_and_review_scores_intended", m, "listing_id") == [(2,), (3,), (4,)]


def test_top_prices_break_ties_by_reviews(market):
    m = market([listing(i) for i in range(1, 8)], reviews=reviews_of(7, 2) + reviews_of(6, 1))
    ranks = dict(report("top_5_listings_by_avg_price", m, "listing_id", "rnk"))
    assert ranks == {7: 1, 6: 2, 1: 3, 2: 3, 3: 3, 4: 3, 5: 3}
    exact = dict(report("top_5_listings_by_avg_price_intended", m, "listing_id", "rnk"))
    assert exact == {7: 1, 6: 2, 1: 3, 2: 4, 3: 5}


def test_same_month_of_different_years(market):
    m = market([listing(1)], [day(1, 0, False), day(1, 366, True)])
    assert report("occupancy_rate_per_month", m, "month", "occupancy_rate") == [("January", 50.0)]
    assert report("occupancy_rate_per_year_month", m, "month", "occupancy_rate") == [("2024-01", 100.0), ("2025-01", 0.0)]


def test_top_hosts_need_a_calendar(market):
    m = market(
        [listing(1, 1, price=Decimal(10)), listing(2, 1, price=Decimal(20)), listing(3, 2), listing(4, None), listing(5, 3)],
        [day(1, 0), day(3, 0), day(4, 0)],
    )
    assert report("top_five_host_avgs", m) == [(1, 10.0), (2, 100.0)]
    assert report("top_five_host_avgs_intended", m) == [(1, 2, 10.0), (2, 1, 100.0), (3, 1, None)]


def test_superhost_share(market):
    m = market([listing(1, 1, host_is_superhost="t"), listing(2, 1, host_is_superhost="t"), listing(3, 2)])
    assert report("most_active_hosts_per_neighbourhood", m) == [("N", 2, 3, 100.0, 1.5)]
    assert report("most_active_hosts_per_neighbourhood_intended", m) == [("N", 2, 3, 50.0, 1.5)]


def test_revenue_counts_booked_days(market):
    m = market(
        [listing(1), listing(2, neighbourhood=None)],
        [day(1, 0, False, "10"), day(1, 1, True, "99"), day(1, 2, None, "99"), day(1, 31, False, "30"), day(2, 0, False)],
    )
    # (40 - 20) squared over twelve
    assert report("monthly_revenue_per_neighbourhood", m) == [
        ("N", "February", 30.0, 33.33), ("N", "January", 10.0, 33.33),
    ]
    assert report("monthly_revenue_per_neighbourhood_intended", m) == [
        ("N", "February", 30.0, 10.0, 100.0), ("N", "January", 10.0, -10.0, 100.0),
    ]


def test_lowest_ranks_missing_rating_first(market):
    m = market(
        [listing(i, i, rating=None if i == 5 else 4.0) for i in range(1, 13)],
        [day(i, 0, i == 5) for i in range(1, 13)],
        sum((reviews_of(i, 10) for i in range(1, 13)), []),
    )
    found = [r[0] for r in report("lowest_occupancy_rate_and_review_scores_intended", m, "listing_id")]
    assert sorted(found) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    assert "listing_id" not in ALL_REPORTS["lowest_occupancy_rate_and_review_scores"].build(m).columns


def test_amenity_clusters(market):
    rows = [listing(i, neighbourhood=f"N{i}", n_amenities=10 * i, price=Decimal(100 * i)) for i in range(1, 9)]
    m = market(rows + [listing(9, neighbourhood=None)])
    assert report("neighbourhood_amenity_clusters", m) == [
        ("High", 650.0, 4, 500.0), ("Low", 150.0, 2, 0.0), ("Medium", 350.0, 2, 200.0),
    ]
    thirds = report("neighbourhood_amenity_clusters_intended", m)
    assert sum(r[2] for r in thirds) == 8 and {r[0] for r in thirds} == {"Low", "Medium", "High"}


def test_season_spread(market):
    m = market([listing(1), listing(2, room_type=None)], [day(1, 0, price="10"), day(1, 100, price="30"), day(1, 101, price="31"), day(2, 0)])
    assert report("room_type_seasonal_trends", m) == [("Room", "Spring", 30.5, 20.5), ("Room", "Winter", 10.0, 20.5)]


def test_diverse_hosts_break_ties_by_id(market):
    m = market([listing(i, i) for i in range(1, 8)] + [listing(8, 7, property_type="House"), listing(9, 7, property_type=None)])
    assert report("most_diverse_hosts_by_property_type", m) == [
        (1, "Flat", 1), (2, "Flat", 1), (3, "Flat", 1), (4, "Flat", 1), (7, "Flat", 1), (7, "House", 1), (7, None, 0),
    ]


def test_superhosts_keep_the_unknown_group(market):
    m = market([listing(1, price=Decimal(10)), listing(2, price=Decimal("10.01")), listing(3, host_is_superhost=None, price=None)])
    found = report("super_hosts_vs_regular_hosts", m, "host_is_superhost", "avg_price", "median_price", "n_listings")
    assert found == [("f", 10.01, 10.01, 2), (None, None, None, 1)]


def test_response_means_are_weighted_by_reviews(market):
    m = market(
        [listing(1, rating=5.0), listing(2, rating=1.0), listing(3), listing(4, host_response_time=None)],
        [day(1, 0, False), day(2, 0), day(3, 0), day(4, 0)],
        reviews_of(1, 3) + reviews_of(2, 1) + reviews_of(4, 2) + [(1, 1000, START)],
    )
    assert report("host_response_times_stats", m) == [("within a day", 80.0, 4.2, 2, 4)]
    assert report("host_response_times_stats_intended", m) == [("within a day", 33.33, 3.5, 3, 4)]


def test_price_stats_group_by_price_or_bin(market):
    m = market([listing(1), listing(2), listing(3)], [day(1, 0), day(2, 0), day(3, 0, False, "70")])
    assert report("listing_stats_by_price_bin", m, "avg_price", "avg_occupancy_rate") == [(50.0, 0.0), (70.0, 100.0)]
    assert report("listing_stats_by_price_bin_intended", m, "avg_price_bin", "n_listings", "avg_occupancy_rate") == [
        ("High", 1, 100.0), ("Low", 2, 0.0),
    ]


def test_price_changes(market):
    days = [day(1, n, price=str(n)) for n in range(11)] + [day(2, n) for n in range(3)] + [day(3, 0, price="1"), day(3, 1, price="2")]
    m = market([listing(i) for i in (1, 2, 3)], days)
    columns = ("listing_id", "n_price_changes", "pct_of_daily_price_diffs", "avg_price")
    assert report("daily_price_changes", m, *columns) == [(1, 10, 3.0, 5.0), (3, 1, 0.0, 1.5)]
    assert report("daily_price_changes_intended", m, *columns) == [(1, 10, 91.0, 5.0), (3, 1, 50.0, 1.5)]


def test_host_is_verified_when_any_listing_is(market):
    m = market(
        [listing(1, 1), listing(2, 1, host_identity_verified=True), listing(3, 2, rating=None), listing(4, 3), listing(5, None)],
        [day(1, 0, False), day(1, 31), day(2, 0, False), day(3, 0, False, None), day(5, 0)],
    )
    assert report("host_verification_performance", m) == [
        (1, "Verified", 67.0, 33.33, 1.0, 4.5), (2, "Not Verified", 100.0, 0.0, 1.0, 0.0),
    ]


def test_host_tiers(market):
    sizes = {1: 1, 2: 5, 3: 6, 4: 15, 5: 16}
    rows, days, n = [], [], 0
    for host, size in sizes.items():
        for _ in range(size):
            n += 1
            rows.append(listing(n, host))
            days.append(day(n, 0, False, "10"))
    m = market(rows, days)
    columns = ("host_id", "n_properties", "n_listings_bin", "total_revenue", "rnk")
    assert report("host_tier_revenue_trends", m, *columns) == [
        (1, 1, "Small", 10.0, 5), (2, 5, "Small", 50.0, 4), (3, 6, "Medium", 60.0, 3),
        (4, 15, "Medium", 150.0, 2), (5, 16, "Large", 160.0, 1),
    ]
    assert [r[-1] for r in report("host_tier_revenue_trends_intended", m, *columns)] == [2, 1, 2, 1, 1]


def test_group_performance_leaves_out_unknown_group(market):
    m = market([listing(1), listing(2, neighbourhood_group=None), listing(3, neighbourhood_group="H")], [day(1, 0, False), day(2, 0), day(3, 0)])
    found = report("neighbourhood_group_performance", m, "neighbourhood_group", "total_revenue", "avg_review_score_rating", "revenue_rank")
    assert found == [("G", 50.0, 5.0, 1), ("H", 0.0, 5.0, 2)]


def test_property_types_without_score_rank_last(market):
    m = market([listing(1), listing(2, property_type="House", rating=None)])
    assert report("property_type_trends", m) == [
        ("Flat", 4.5, 0.0, 50.0, 2.7, 18.52, 1), ("House", None, 0.0, 50.0, None, None, 2),
    ]
