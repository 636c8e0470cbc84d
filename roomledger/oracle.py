"""SQL equivalents of the queries, for DuckDB on the same tables.

Written against the tables alone, independent of the Spark code. Rounding goes through
decimals, so that both engines round the same value.
"""

from __future__ import annotations

import re

from roomledger.schemas import LISTINGS


def _r(expression: str, digits: int = 2) -> str:
    """Rounded half up, as a decimal."""
    return f"ROUND(CAST({expression} AS DECIMAL(28,10)), {digits})"


def _d(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def _rd(expression: str, digits: int = 2) -> str:
    return _d(_r(expression, digits))


def _r_double(expression: str, digits: int = 2) -> str:
    """A double rounded half up on its shortest decimal form."""
    decimal = f"CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,{digits}))"
    return f"CAST(CAST({decimal} AS VARCHAR) AS DOUBLE)"


MONEY = "DECIMAL(18,2)"
# The exact fraction, half up to hundredths, in whole numbers.
OCCUPANCY = (
    "CAST((20000 * count(*) FILTER (WHERE NOT available) + count(*)) // (2 * count(*)) AS DECIMAL(9,0))"
    " * CAST(0.01 AS DECIMAL(3,2))"
)
# Mean of cent amounts, half up to 15 digits, in whole numbers: exact where a double is not.
CENTS = "sum(CAST(price * 100 AS HUGEINT))"
MEAN_PRICE = (
    f"CAST((2 * {CENTS} * 10000000000000 + count(price)) // (2 * count(price)) AS DECIMAL(22,0))"
    " * CAST(0.000000000000001 AS DECIMAL(16,15))"
)


def _six(expression: str) -> str:
    return f"ROUND({expression}, 6)"


BOOKED_REVENUE = f"sum(CASE WHEN NOT available THEN price ELSE CAST(0 AS {MONEY}) END)"

PRELUDE = f"""
WITH calendar AS (
  SELECT l_partkey AS listing_id, CAST(l_shipdate AS DATE) AS date,
         l_linestatus = 'O' AS available, CAST(l_extendedprice AS {MONEY}) AS price
  FROM lineitem
), reviews AS (
  SELECT l_partkey AS listing_id, l_orderkey * 10 + l_linenumber AS id,
         CAST(l_shipdate AS DATE) AS date
  FROM lineitem WHERE l_returnflag <> 'N'
), lead_host AS (
  SELECT l_partkey AS id, min(l_suppkey) AS host_id FROM lineitem GROUP BY l_partkey
), hosts AS (
  SELECT s_suppkey AS host_id, n_name AS host_city, r_name AS host_state,
         CASE WHEN s_acctbal > 5000 THEN 't' ELSE 'f' END AS host_is_superhost,
         s_nationkey % 2 = 0 AS host_identity_verified,
         CASE s_suppkey % 5 WHEN 0 THEN 'within an hour' WHEN 1 THEN 'within a few hours'
              WHEN 2 THEN 'within a day' WHEN 3 THEN 'a few days or more' END AS host_response_time
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
), listings AS (
  SELECT p_partkey AS id, host_id, host_city, host_state, host_is_superhost,
         host_identity_verified, host_response_time, p_brand AS neighbourhood,
         r_name AS neighbourhood_group, p_name AS property_type, p_type AS room_type,
         CAST(p_retailprice AS {MONEY}) AS price, p_size AS n_amenities,
         CASE WHEN p_size % 17 <> 0 THEN CAST(p_size AS DOUBLE) / 10 END AS review_scores_rating,
         CAST(p_size % 7 AS DOUBLE) / 2 AS review_scores_cleanliness,
         CAST(p_size % 11 AS DOUBLE) / 2 AS review_scores_checkin,
         CAST(p_size % 9 AS DOUBLE) / 2 AS review_scores_communication,
         CAST(p_size % 8 AS DOUBLE) / 2 AS review_scores_location,
         CAST(p_size % 6 AS DOUBLE) / 2 AS review_scores_value
  FROM part JOIN lead_host ON p_partkey = id JOIN hosts USING (host_id)
  LEFT JOIN region ON r_regionkey = CAST(substr(p_brand, 7) AS INT) % 6
), occ AS (
  SELECT listing_id, {OCCUPANCY} AS occupancy_rate, {BOOKED_REVENUE} AS revenue,
         {MEAN_PRICE} AS avg_price
  FROM calendar GROUP BY listing_id
), occ_month AS (
  SELECT listing_id, monthname(date) AS month, {OCCUPANCY} AS occupancy_rate,
         {BOOKED_REVENUE} AS revenue, {MEAN_PRICE} AS avg_price,
         count(*) FILTER (WHERE NOT available) AS n_booked
  FROM calendar GROUP BY ALL
)"""


def _sql(body: str) -> str:
    return f"{PRELUDE.strip()}\n{body.strip()}"


def _cte(body: str) -> str:
    """A body that starts with further common table expressions."""
    return f"{PRELUDE.strip()}, {body.strip()}"


def _means(columns: dict[str, str], digits: int = 2) -> str:
    return ", ".join(f"{_rd(f'avg({c})', digits)} AS {out}" for out, c in columns.items())


PRICED = """
priced AS (
  SELECT o.listing_id, o.month, o.avg_price, COALESCE(r.n_reviews, 0) AS n_reviews
  FROM occ_month o LEFT JOIN (
    SELECT listing_id, monthname(date) AS month, count(DISTINCT id) AS n_reviews
    FROM reviews GROUP BY ALL) r USING (listing_id, month)
)"""


def _top_priced(rank: str) -> str:
    return _cte(f"""
{PRICED.strip()}, ranked AS (SELECT *, {rank} AS rnk FROM priced)
SELECT listing_id, month, {_d(_six('avg_price'))} AS avg_price, n_reviews, rnk, neighbourhood
FROM ranked JOIN listings ON listing_id = id WHERE rnk <= 5""")


def _occupied(month: str) -> str:
    return _cte(f"""
rates AS (SELECT listing_id, {month} AS month, {OCCUPANCY} AS occupancy_rate FROM calendar GROUP BY ALL),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY month ORDER BY occupancy_rate DESC) AS rnk FROM rates)
SELECT listing_id, month, {_d('occupancy_rate')} AS occupancy_rate, host_city, host_state, neighbourhood
FROM ranked JOIN listings ON listing_id = id WHERE rnk <= 10""")


def _most_reviewed(condition: str, rank: str) -> str:
    return _cte(f"""
busy AS (SELECT listing_id FROM reviews GROUP BY listing_id HAVING count(*) {condition}),
monthly AS (
  SELECT listing_id, monthname(date) AS month, count(id) AS review_count
  FROM reviews SEMI JOIN busy USING (listing_id) GROUP BY ALL),
ranked AS (SELECT *, {rank} AS rnk FROM monthly)
SELECT listing_id, month, review_count, rnk, neighbourhood, property_type
FROM ranked JOIN listings ON listing_id = id WHERE rnk <= 10""")


HOST_COUNTS = f"""
counts AS (
  SELECT host_id, count(DISTINCT id) AS n_properties FROM listings GROUP BY host_id),
prices AS (
  SELECT host_id, {_rd('avg(price)')} AS avg_price
  FROM listings SEMI JOIN calendar ON id = listing_id GROUP BY host_id)"""

LOWEST = """
candidates AS (
  SELECT id AS listing_id, review_scores_rating, neighbourhood, host_id, occupancy_rate,
         dense_rank() OVER (ORDER BY occupancy_rate) +
         dense_rank() OVER (ORDER BY review_scores_rating NULLS FIRST) AS final_rank
  FROM listings JOIN occ ON id = listing_id
  WHERE id IN (SELECT listing_id FROM reviews GROUP BY listing_id HAVING count(*) >= 10)
), lowest AS (SELECT * FROM candidates ORDER BY final_rank, listing_id LIMIT 10)"""


def _clusters(bins: str, count: str, filter_first: str = "") -> str:
    return _cte(f"""
amenities AS (
  SELECT neighbourhood, {_r('avg(n_amenities)')} AS avg_amenities FROM listings
  {filter_first} GROUP BY neighbourhood),
cuts AS (
  SELECT percentile_disc(0.25) WITHIN GROUP (ORDER BY avg_amenities) AS q1,
         percentile_disc(0.5) WITHIN GROUP (ORDER BY avg_amenities) AS q2,
         percentile_disc(1/3) WITHIN GROUP (ORDER BY avg_amenities) AS t1,
         percentile_disc(2/3) WITHIN GROUP (ORDER BY avg_amenities) AS t2
  FROM amenities),
binned AS (
  SELECT neighbourhood, {bins.format(v='avg_amenities')} AS avg_amenities_bin FROM amenities, cuts),
clusters AS (
  SELECT avg_amenities_bin, {_r('avg(price)')} AS avg_price, {count} AS n_neighbourhoods
  FROM listings JOIN binned USING (neighbourhood) GROUP BY avg_amenities_bin)
SELECT avg_amenities_bin, {_d('avg_price')} AS avg_price, n_neighbourhoods,
       {_d("avg_price - (SELECT avg_price FROM clusters WHERE avg_amenities_bin = 'Low')")} AS price_diff_from_low
FROM clusters""")


QUARTILE_BINS = (
    "CASE WHEN {v} <= q1 THEN 'Low' WHEN {v} BETWEEN q1 + 1 AND q2 THEN 'Medium' ELSE 'High' END"
)
TERCILE_BINS = "CASE WHEN {v} <= t1 THEN 'Low' WHEN {v} <= t2 THEN 'Medium' ELSE 'High' END"
PRICE_CUTS = """
cuts AS (
  SELECT percentile_disc(0.25) WITHIN GROUP (ORDER BY ROUND(avg_price, 6)) AS q1,
         percentile_disc(0.5) WITHIN GROUP (ORDER BY ROUND(avg_price, 6)) AS q2,
         percentile_disc(1/3) WITHIN GROUP (ORDER BY ROUND(avg_price, 6)) AS t1,
         percentile_disc(2/3) WITHIN GROUP (ORDER BY ROUND(avg_price, 6)) AS t2
  FROM occ)"""


def _binned_prices(bins: str) -> str:
    return _cte(f"""
{PRICE_CUTS.strip()}
SELECT listing_id, {_d(_six('avg_price'))} AS avg_price, {bins.format(v=_six('avg_price'))} AS avg_price_bin
FROM occ, cuts""")


def _scores(prefix: str, names: str) -> dict[str, str]:
    return {f"{prefix}_{n}": f"review_scores_{n}" for n in names.split()}


BIN_MEANS = {"avg_occupancy_rate": "occupancy_rate"} | _scores(
    "average_review_score", "rating cleanliness checkin communication location"
)

CHANGES = """
steps AS (
  SELECT listing_id, price, lag(price) OVER (
    PARTITION BY listing_id ORDER BY date NULLS FIRST, price NULLS FIRST) AS previous FROM calendar),
changes AS (
  SELECT listing_id, count(*) FILTER (WHERE price <> previous) AS n_price_changes,
         count(*) AS n_days, avg(price) AS avg_price
  FROM steps GROUP BY listing_id HAVING n_price_changes > 0)"""


def _price_changes(rank: str, days: str, columns: str) -> str:
    return _cte(f"""
{CHANGES.strip()}, ranked AS (SELECT *, {rank} AS rnk FROM changes)
SELECT listing_id, n_price_changes, {_rd(f'n_price_changes * 100e0 / {days}', 0)} AS pct_of_daily_price_diffs,
       {_rd('ranked.avg_price')} AS avg_price, {columns}, neighbourhood, review_scores_rating
FROM ranked JOIN listings ON listing_id = id WHERE rnk <= 5""")


def _response(join: str, weight: str) -> str:
    return _cte(f"""
counts AS (SELECT listing_id, count(*) AS n FROM reviews GROUP BY listing_id),
rated AS (
  SELECT listing_id, host_response_time, review_scores_rating, occupancy_rate, n
  FROM listings JOIN occ ON id = listing_id {join} JOIN counts USING (listing_id)
  WHERE host_response_time IS NOT NULL),
stats AS (
  SELECT host_response_time,
         {_rd(f'sum(occupancy_rate * {weight}) / sum({weight})')} AS avg_occupancy_rate,
         {_rd(f'sum(review_scores_rating * {weight}) / sum({weight}) FILTER (WHERE review_scores_rating IS NOT NULL)')}
           AS avg_review_score_rating,
         count(DISTINCT listing_id) AS n_properties
  FROM rated GROUP BY host_response_time),
ids AS (
  SELECT host_response_time, count(DISTINCT reviews.id) AS n_reviews
  FROM rated JOIN reviews USING (listing_id) GROUP BY host_response_time)
SELECT host_response_time, avg_occupancy_rate, avg_review_score_rating, n_properties,
       COALESCE(n_reviews, 0) AS n_reviews
FROM stats LEFT JOIN ids USING (host_response_time)""")


def _tiers(partition: str) -> str:
    return _cte(f"""
tiered AS (
  SELECT host_id, count(DISTINCT id) AS n_properties,
         COALESCE({_rd('avg(review_scores_rating)')}, 0) AS avg_review_score_rating,
         count(DISTINCT room_type) AS n_room_types,
         count(DISTINCT property_type) AS n_property_types,
         count(DISTINCT neighbourhood) AS n_neighbourhoods,
         CASE WHEN n_properties BETWEEN 1 AND 5 THEN 'Small'
              WHEN n_properties BETWEEN 6 AND 15 THEN 'Medium' ELSE 'Large' END AS n_listings_bin
  FROM listings GROUP BY host_id),
money AS (
  SELECT host_id, sum(revenue) AS total_revenue, {_rd('avg(occupancy_rate)')} AS avg_occupancy_rate
  FROM listings JOIN occ ON id = listing_id GROUP BY host_id)
SELECT tiered.* , {_d('total_revenue')} AS total_revenue, avg_occupancy_rate,
       dense_rank() OVER ({partition} ORDER BY money.total_revenue DESC NULLS LAST, n_properties DESC) AS rnk
FROM tiered JOIN money USING (host_id)""")


REVENUE = """
monthly AS (
  SELECT neighbourhood, monthname(date) AS month, sum(calendar.price) AS total_revenue
  FROM calendar JOIN listings ON listing_id = id WHERE NOT available GROUP BY ALL)"""

REPORT_SQL: dict[str, str] = {
    "avg_price_by_neighbourhood": _sql(
        f"SELECT neighbourhood, {_rd('avg(price)')} AS average_price FROM listings GROUP BY 1"
    ),
    "top_5_listings_by_avg_price": _top_priced(
        "dense_rank() OVER (PARTITION BY month ORDER BY avg_price DESC, n_reviews DESC)"
    ),
    "top_5_listings_by_avg_price_intended": _top_priced(
        "row_number() OVER (PARTITION BY month ORDER BY avg_price DESC, n_reviews DESC, listing_id)"
    ),
    "occupancy_rate_per_month": _occupied("monthname(date)"),
    "occupancy_rate_per_year_month": _occupied("strftime(date, '%Y-%m')"),
    "occupancy_rate_per_month_intended": _cte(f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY month ORDER BY occupancy_rate DESC, listing_id) AS rnk
  FROM occ_month)
SELECT listing_id, month, {_d('occupancy_rate')} AS occupancy_rate, {_d('revenue')} AS monthly_revenue,
       host_city, host_state, neighbourhood
FROM ranked JOIN listings ON listing_id = id WHERE rnk <= 10"""),
    "most_reviewed_listings": _most_reviewed(
        "> 20", "dense_rank() OVER (PARTITION BY month ORDER BY review_count DESC)"
    ),
    "most_reviewed_listings_intended": _most_reviewed(
        ">= 20", "row_number() OVER (PARTITION BY month ORDER BY review_count DESC, listing_id)"
    ),
    "top_five_host_avgs": _cte(f"""
{HOST_COUNTS.strip()}, ranked AS (
  SELECT *, dense_rank() OVER (ORDER BY n_properties DESC) AS rnk FROM counts)
SELECT host_id, avg_price FROM ranked JOIN prices USING (host_id) WHERE rnk <= 5"""),
    "top_five_host_avgs_intended": _cte(f"""
{HOST_COUNTS.strip()}
SELECT host_id, n_properties, avg_price FROM counts LEFT JOIN prices USING (host_id)
ORDER BY n_properties DESC, host_id LIMIT 5"""),
    "most_active_hosts_per_neighbourhood": _sql(f"""
SELECT neighbourhood, count(DISTINCT host_id) AS n_hosts, count(DISTINCT id) AS n_properties,
       {_rd("100e0 * count(*) FILTER (WHERE host_is_superhost = 't') / count(DISTINCT host_id)")}
         AS percentage_of_superhosts,
       {_rd('count(DISTINCT id) / count(DISTINCT host_id)')} AS average_properties_per_host
FROM listings GROUP BY neighbourhood"""),
    "most_active_hosts_per_neighbourhood_intended": _sql(f"""
SELECT neighbourhood, count(DISTINCT host_id) AS n_hosts, count(DISTINCT id) AS n_properties,
       {_rd("100e0 * count(DISTINCT host_id) FILTER (WHERE host_is_superhost = 't') / count(DISTINCT host_id)")}
         AS percentage_of_superhosts,
       {_rd('count(DISTINCT id) / count(DISTINCT host_id)')} AS average_properties_per_host
FROM listings GROUP BY neighbourhood"""),
    "monthly_revenue_per_neighbourhood": _cte(f"""
{REVENUE.strip()}, yearly AS (
  SELECT neighbourhood, CAST(sum(total_revenue) AS DOUBLE) AS total, count(total_revenue) AS months
  FROM monthly GROUP BY neighbourhood)
SELECT neighbourhood, month, {_d('total_revenue')} AS total_revenue,
       {_r_double('(total - total / months) * (total - total / months) / 12')} AS yearly_variance
FROM monthly JOIN yearly USING (neighbourhood)"""),
    "monthly_revenue_per_neighbourhood_intended": _cte(f"""
{REVENUE.strip()}, yearly AS (
  SELECT neighbourhood, count(*) AS months,
         sum(CAST(total_revenue * 100 AS HUGEINT)) AS cents,
         sum(CAST(total_revenue * 100 AS HUGEINT) * CAST(total_revenue * 100 AS HUGEINT)) AS squares
  FROM monthly GROUP BY neighbourhood)
SELECT neighbourhood, month, {_d('total_revenue')} AS total_revenue,
       {_d('CAST(sign(gap) * ((2 * abs(gap) + months) // (2 * months)) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2))')}
         AS deviation_from_mean,
       {_r_double('CAST(squares * months - cents * cents AS DOUBLE) / (months * months * 10000)')} AS yearly_variance
FROM (SELECT *, CAST(total_revenue * 100 AS HUGEINT) * months - cents AS gap
      FROM monthly JOIN yearly USING (neighbourhood))"""),
    "lowest_occupancy_rate_and_review_scores": _cte(f"""
{LOWEST.strip()}
SELECT review_scores_rating, neighbourhood, host_id, {_d('occupancy_rate')} AS occupancy_rate FROM lowest"""),
    "lowest_occupancy_rate_and_review_scores_intended": _cte(f"""
{LOWEST.strip()}
SELECT listing_id, review_scores_rating, neighbourhood, host_id, {_d('occupancy_rate')} AS occupancy_rate
FROM lowest"""),
    "review_distribution_per_neighbourhood": _cte("""
counts AS (SELECT listing_id, count(*) AS n_reviews FROM reviews GROUP BY listing_id)
SELECT listing_id, n_reviews, neighbourhood, review_scores_rating, neighbourhood_group,
       dense_rank() OVER (ORDER BY n_reviews DESC) AS rnk
FROM counts JOIN listings ON listing_id = id"""),
    "review_distribution_per_neighbourhood_intended": _cte("""
totals AS (
  SELECT neighbourhood, count(DISTINCT listings.id) AS n_listings, count(*) AS n_reviews
  FROM reviews JOIN listings ON listing_id = listings.id GROUP BY neighbourhood)
SELECT *, dense_rank() OVER (ORDER BY n_reviews DESC) AS rnk FROM totals"""),
    "neighbourhood_amenity_clusters": _clusters(QUARTILE_BINS, "count(neighbourhood)"),
    "neighbourhood_amenity_clusters_intended": _clusters(
        TERCILE_BINS, "count(DISTINCT neighbourhood)", "WHERE neighbourhood IS NOT NULL"
    ),
    "room_type_seasonal_trends": _cte(f"""
seasonal AS (
  SELECT room_type, CASE WHEN dayofyear(date) BETWEEN 79 AND 171 THEN 'Spring'
                         WHEN dayofyear(date) BETWEEN 172 AND 263 THEN 'Summer'
                         WHEN dayofyear(date) BETWEEN 264 AND 354 THEN 'Autumn' ELSE 'Winter' END AS season,
         {_r('avg(calendar.price)')} AS avg_price
  FROM calendar JOIN listings ON listing_id = id GROUP BY ALL),
spread AS (
  SELECT room_type, max(avg_price) - min(avg_price) AS diff FROM seasonal GROUP BY room_type)
SELECT room_type, season, {_d('avg_price')} AS avg_price, {_d('diff')} AS seasonal_price_diff
FROM seasonal JOIN spread USING (room_type)"""),
    "most_diverse_hosts_by_property_type": _cte("""
diverse AS (
  SELECT host_id FROM listings GROUP BY host_id
  ORDER BY count(DISTINCT property_type) DESC, host_id LIMIT 5)
SELECT host_id, property_type, count(property_type) AS n_properties
FROM listings JOIN diverse USING (host_id) GROUP BY host_id, property_type"""),
    "super_hosts_vs_regular_hosts": _sql(f"""
SELECT host_is_superhost,
       {_means(_scores('avg_review_score', 'rating cleanliness communication value'))},
       {_means({'avg_occupancy_rate': 'occupancy_rate', 'avg_price': 'price'})},
       {_rd('median(CAST(price AS DOUBLE))')} AS median_price, count(DISTINCT listing_id) AS n_listings
FROM (SELECT * EXCLUDE (avg_price, revenue) FROM listings JOIN occ ON id = listing_id)
GROUP BY host_is_superhost"""),
    "host_response_times_stats": _response("", "n"),
    "host_response_times_stats_intended": _response("LEFT", "1"),
    "listing_stats_by_price_bin": _sql(f"""
SELECT {_d(_six('avg_price'))} AS avg_price, {_means(BIN_MEANS)}
FROM occ JOIN listings ON listing_id = id GROUP BY occ.avg_price"""),
    "listing_stats_by_price_bin_intended": _cte(f"""
{PRICE_CUTS.strip()}, binned AS (
  SELECT occ.*, {TERCILE_BINS.format(v=_six('avg_price'))} AS avg_price_bin FROM occ, cuts)
SELECT avg_price_bin, count(DISTINCT listing_id) AS n_listings, {_means(BIN_MEANS)}
FROM binned JOIN listings ON listing_id = id GROUP BY avg_price_bin"""),
    "daily_price_changes": _price_changes(
        "dense_rank() OVER (ORDER BY n_price_changes DESC)", "365", "id"
    ),
    "daily_price_changes_intended": _price_changes(
        "row_number() OVER (ORDER BY n_price_changes DESC, listing_id)", "n_days", "rnk"
    ),
    "host_verification_performance": _cte(f"""
rated AS (
  SELECT host_id, COALESCE({_rd('avg(review_scores_rating)')}, 0) AS avg_review_score_rating,
         bool_or(host_identity_verified) AS verified
  FROM listings GROUP BY host_id),
booked AS (
  SELECT host_id, {_rd('avg(occupancy_rate)', 0)} AS avg_monthly_occ_rate,
         {_rd('COALESCE(avg(revenue), 0)')} AS avg_monthly_revenue,
         {_rd('avg(n_booked)', 0)} AS average_monthly_bookings
  FROM occ_month JOIN listings ON listing_id = id GROUP BY host_id)
SELECT host_id, CASE WHEN verified THEN 'Verified' ELSE 'Not Verified' END AS is_verified,
       avg_monthly_occ_rate, avg_monthly_revenue, average_monthly_bookings, avg_review_score_rating
FROM rated JOIN booked USING (host_id)"""),
    "host_tier_revenue_trends": _tiers(""),
    "host_tier_revenue_trends_intended": _tiers("PARTITION BY n_listings_bin"),
    "neighbourhood_group_performance": _cte(f"""
groups AS (
  SELECT neighbourhood_group, {_rd('avg(occupancy_rate)')} AS avg_occupancy_rate,
         sum(revenue) AS revenue,
         {_means(_scores('avg_review_score', 'rating cleanliness checkin communication'), 0)},
         count(DISTINCT room_type) AS n_unique_room_types,
         count(DISTINCT property_type) AS n_unique_property_types
  FROM listings JOIN occ ON id = listing_id
  WHERE neighbourhood_group IS NOT NULL GROUP BY neighbourhood_group)
SELECT * EXCLUDE (revenue), {_d('revenue')} AS total_revenue,
       dense_rank() OVER (ORDER BY revenue DESC) AS revenue_rank
FROM groups"""),
    "property_type_trends": _cte(f"""
priced AS (SELECT listing_id, occupancy_rate, {_r('avg_price')} AS avg_price FROM occ),
types AS (
  SELECT property_type, {_r('avg(review_scores_rating)')} AS rating,
         {_r('avg(occupancy_rate)')} AS occupancy, {_r('avg(priced.avg_price)')} AS avg_price
  FROM listings JOIN priced ON id = listing_id GROUP BY property_type),
scored AS (
  SELECT *, {_r('rating * CAST(0.6 AS DECIMAL(4,2)) + occupancy * CAST(0.4 AS DECIMAL(4,2))')} AS score
  FROM types),
ratios AS (SELECT *, {_r('avg_price / NULLIF(score, 0)')} AS ratio FROM scored)
SELECT property_type, {_d('rating')} AS avg_review_score_rating, {_d('occupancy')} AS avg_occupancy_rate,
       {_d('avg_price')} AS avg_price, {_d('score')} AS performance_score,
       {_d('ratio')} AS price_to_performance_ratio,
       dense_rank() OVER (ORDER BY ratio DESC NULLS LAST) AS rank
FROM ratios"""),
}

# The same with the months of different years apart.
REPORT_SQL |= {
    name: REPORT_SQL[of].replace("monthname(date)", "strftime(date, '%Y-%m')")
    for name, of in {
        "top_5_listings_by_avg_price_per_year_month": "top_5_listings_by_avg_price",
        "most_reviewed_listings_per_year_month": "most_reviewed_listings",
        "monthly_revenue_per_neighbourhood_and_year_month": "monthly_revenue_per_neighbourhood",
        "host_verification_performance_per_year_month": "host_verification_performance",
    }.items()
}

# Sketches are compared with the exact result inside the query.
REPORT_SQL["host_response_times_stats_sketched"] = (
    f"SELECT *, TRUE AS within_error FROM ({REPORT_SQL['host_response_times_stats']})"
)
REPORT_SQL["written_report"] = REPORT_SQL["property_type_trends"]

# Raw text tables.


def _flag(modulus: int) -> str:
    return f"CASE WHEN id % {modulus} = 0 THEN NULL WHEN id % 3 = 0 THEN ' f ' ELSE 't' END"


RAW_LISTINGS = f"""
raw_listings AS (
  SELECT id, host_id,
    CASE WHEN id % 10 = 0 THEN NULL WHEN id % 11 = 0 THEN 'N/A'
         ELSE '$' || format('{{:,.2f}}', CAST(price * 2 - n_amenities * 20 AS DOUBLE)) END AS price,
    ' A "' || property_type || '"<br/>in ' || neighbourhood || chr(13) AS description,
    CASE WHEN id % 4 = 0 THEN 'N/A' ELSE 'near ""' || host_city || '""' END AS neighborhood_overview,
    CASE WHEN id % 7 = 0 THEN NULL WHEN id % 5 = 0 THEN host_city
         ELSE host_city || ', ' || host_state || ', ' || room_type END AS host_location,
    CASE WHEN id % 9 = 0 THEN '[]' ELSE '[''email'', ''phone'']' END AS host_verifications,
    CASE WHEN id % 13 = 0 THEN NULL WHEN id % 8 = 0 THEN '[]'
         WHEN id % 2 = 0 THEN '[''' || replace(property_type, ' ', ''', ''') || ''']'
         ELSE '["' || replace(property_type, ' ', '", "') || '", "TV, cable"]' END AS amenities,
    {_flag(5)} AS has_availability, {_flag(7)} AS host_has_profile_pic,
    {_flag(11)} AS host_identity_verified, {_flag(13)} AS instant_bookable,
    CASE WHEN id % 6 = 0 THEN 'N/A' ELSE (n_amenities * 2) || '%' END AS host_response_rate,
    CASE WHEN id % 5 = 0 THEN NULL ELSE n_amenities || '.5%' END AS host_acceptance_rate,
    'about the area' AS neighbourhood, neighbourhood AS neighbourhood_cleansed,
    neighbourhood_group AS neighbourhood_group_cleansed, n_amenities AS minimum_nights
  FROM listings)"""

RAW_CALENDAR = f"""
raw_calendar AS (
  SELECT l_partkey AS listing_id, CAST(l_shipdate AS DATE) AS date,
    CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linestatus = 'O' THEN 't' ELSE ' f' END AS available,
    CASE WHEN l_linenumber = 6 THEN NULL ELSE '$' || format('{{:,.2f}}',
      (CAST(CAST(l_extendedprice AS {MONEY}) * 100 AS BIGINT) % 250000) / 100e0) END AS price,
    CAST(NULL AS VARCHAR) AS adjusted_price, CAST(l_quantity AS INT) AS minimum_nights,
    365 AS maximum_nights
  FROM lineitem)"""

RAW_REVIEWS = """
raw_reviews AS (
  SELECT page_id AS listing_id, page_id * 3 AS id,
    CASE WHEN page_id % 9 <> 0
         THEN strftime(DATE '2020-01-01' + CAST(page_id % 1000 AS INT), '%Y-%m-%d') END AS date,
    page_id AS reviewer_id, url AS reviewer_name, chr(13) || ' "' || html AS comments
  FROM pages)"""

FLAG_COLUMNS = ("has_availability", "host_has_profile_pic", "host_identity_verified", "instant_bookable")


def _flag_value(column: str, strict: bool) -> str:
    if strict:
        return f"CASE trim({column}) WHEN 'f' THEN FALSE WHEN 't' THEN TRUE END"
    return f"CASE WHEN trim({column}) = 'f' THEN FALSE ELSE TRUE END"


def _flags(strict: bool) -> str:
    return ", ".join(f"{_flag_value(c, strict)} AS {c}" for c in FLAG_COLUMNS)


def _price_value(strict: bool, column: str = "price") -> str:
    return f"TRY_CAST(translate({column}, '{'$,' if strict else '$'}', '') AS {MONEY})"


def _list_value(column: str, strict: bool) -> str:
    plain = f"string_split(trim(translate({column}, '''[]', '')), ',')"
    if not strict:
        return plain
    quoted = f"""regexp_extract_all({column}, '"([^"]*)"', 1)"""
    trimmed = f"list_filter(list_transform({plain}, lambda x: trim(x)), lambda x: x <> '')"
    return f"""CASE WHEN contains({column}, '"') THEN {quoted} ELSE {trimmed} END"""


def _joined(items: str) -> str:
    # array_to_string gives null for an empty list
    return f"CASE WHEN {items} IS NOT NULL THEN COALESCE(array_to_string({items}, '|'), '') END"


def _size(items: str, strict: bool) -> str:
    size = f"CAST(len({items}) AS INT)"
    return size if strict else f"COALESCE({size}, -1)"


def _prose(column: str) -> str:
    return f"""trim(regexp_replace({column}, '(\\r|<br/>|""|")', ' ', 'g'))"""


def _comment(column: str) -> str:
    without = f"""regexp_replace({column}, '(\\r|<br\\s*/?>|""|")', ' ', 'g')"""
    return f"trim(regexp_replace({without}, '\\s+', ' ', 'g'))"


def _percent(column: str) -> str:
    number = f"TRY_CAST(replace({column}, '%', '') AS DECIMAL(20,6))"
    return f"CAST(trunc({number}) AS INT)"


def _part(position: int) -> str:
    # an absent element is null, not empty
    return (
        f"CASE WHEN len(string_split(host_location, ',')) >= {position} "
        f"THEN trim(string_split(host_location, ',')[{position}]) END"
    )


def _whole_listings() -> str:
    """The columns of the export; those that the raw listings lack are made from id and place."""
    given = set(re.findall(r" AS (\w+)", RAW_LISTINGS)) | {"id", "host_id"}
    shown = []
    for place, field in enumerate(LISTINGS.split(",")):
        name, kind = field.split()
        made = {
            "bigint": f"id * 1000003 + {place}",
            "int": f"CAST(id % 97 + {place} AS INT)",
            "float": f"CAST((id % 50) / 4 + {place} AS DOUBLE)",
            "date": f"strftime(DATE '2020-01-01' + CAST(id % 1000 + {place} AS INT), '%Y-%m-%d')",
            "string": f"'{name} ' || id",
        }[kind]
        if name in ("description", "neighborhood_overview"):
            made = _prose(name)
        elif name in given:
            made = f"trim({name})" if kind == "string" else name
        made = {"maximum_nights": "365", "reviews_per_month": "1.5e0"}.get(name, made)
        shown.append(f"{made} AS {name}")
    return ", ".join(shown)


def _clean_calendar(strict: bool) -> str:
    return f"""
SELECT listing_id, strftime(date, '%Y-%m-%d') AS date, {_flag_value('available', strict)} AS available,
       {_d(_price_value(strict))} AS price, adjusted_price, minimum_nights, maximum_nights
FROM raw_calendar"""


def _clean_listings(strict: bool) -> str:
    amenities = _list_value("amenities", strict)
    return _cte(f"""
{RAW_LISTINGS.strip()}, {RAW_CALENDAR.strip()}, medians AS (
  SELECT listing_id, {_r(f'median(CAST({_price_value(strict)} AS DOUBLE))')} AS median_price
  FROM raw_calendar GROUP BY listing_id)
SELECT id, host_id, {_prose('description')} AS description,
       NULLIF({_prose('neighborhood_overview')}, 'N/A') AS neighborhood_overview,
       {_joined(_list_value('host_verifications', strict))} AS host_verifications,
       {_joined(amenities)} AS amenities, {_flags(strict)},
       {_percent('host_response_rate')} AS host_response_rate,
       {_percent('host_acceptance_rate')} AS host_acceptance_rate,
       neighbourhood_cleansed AS neighbourhood, neighbourhood_group_cleansed AS neighbourhood_group,
       {_part(1)} AS host_city, {_part(2)} AS host_state, {_size(amenities, strict)} AS n_amenities,
       {_d(f'COALESCE({_price_value(strict)}, median_price)')} AS price
FROM raw_listings {'LEFT' if strict else ''} JOIN medians ON id = listing_id""")


def _imputed(join: str) -> str:
    return f"""
WITH medians AS (
  SELECT user_id, {_r(f'median(CAST(CAST(value AS {MONEY}) AS DOUBLE))')} AS median_price FROM events GROUP BY user_id)
SELECT c_custkey AS id, c_mktsegment AS segment,
       {_d(f'COALESCE(CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS {MONEY}) END, median_price)')} AS price
FROM customer {join} JOIN medians ON c_custkey = user_id""".strip()


def _lists(strict: bool) -> str:
    columns = ", ".join(
        f"{_joined(_list_value(c, strict))} AS {c}" for c in ("host_verifications", "amenities")
    )
    return _cte(f"{RAW_LISTINGS.strip()} SELECT id, {columns} FROM raw_listings")


def _sizes(strict: bool) -> str:
    size = _size(_list_value("amenities", strict), strict)
    return _cte(f"{RAW_LISTINGS.strip()} SELECT id, {size} AS n_amenities FROM raw_listings")


REVIEWS_CLEANED = f"""
SELECT listing_id, id, date, reviewer_id, reviewer_name, {_comment('comments')} AS comments
FROM raw_reviews"""

CLEANING_SQL: dict[str, str] = {
    "clean_price": _cte(f"""{RAW_CALENDAR.strip()}
SELECT listing_id, price AS raw_price, {_d(_price_value(False))} AS price FROM raw_calendar"""),
    "clean_price_intended": _cte(f"""{RAW_CALENDAR.strip()}
SELECT listing_id, price AS raw_price, {_d(_price_value(True))} AS price FROM raw_calendar"""),
    "flag_to_bool": _cte(f"{RAW_LISTINGS.strip()} SELECT id, {_flags(False)} FROM raw_listings"),
    "flag_to_bool_intended": _cte(f"{RAW_LISTINGS.strip()} SELECT id, {_flags(True)} FROM raw_listings"),
    "parse_list": _lists(False),
    "parse_list_intended": _lists(True),
    "list_size": _sizes(False),
    "list_size_intended": _sizes(True),
    "split_location": _cte(f"""{RAW_LISTINGS.strip()}
SELECT id, {_part(1)} AS host_city, {_part(2)} AS host_state FROM raw_listings"""),
    "na_to_null": _cte(f"""{RAW_LISTINGS.strip()}
SELECT id, NULLIF(price, 'N/A') AS price, NULLIF(neighborhood_overview, 'N/A') AS neighborhood_overview,
       NULLIF(host_response_rate, 'N/A') AS host_response_rate FROM raw_listings"""),
    "clean_text": f"SELECT page_id, {_prose('html')} AS text FROM pages",
    "parse_percent": _cte(f"""{RAW_LISTINGS.strip()}
SELECT id, {_percent('host_response_rate')} AS host_response_rate,
       {_percent('host_acceptance_rate')} AS host_acceptance_rate FROM raw_listings"""),
    "columns_containing": _cte(f"""{RAW_LISTINGS.strip()}, hits AS (
  SELECT column_name, value FROM (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM raw_listings)
  UNPIVOT (value FOR column_name IN (*)))
SELECT DISTINCT column_name FROM hits WHERE contains(value, 'N/A')"""),
    "impute_price": _imputed(""),
    "impute_price_intended": _imputed("LEFT"),
    "clean_listings": _clean_listings(False),
    "clean_listings_intended": _clean_listings(True),
    "clean_calendar": _cte(RAW_CALENDAR.strip() + _clean_calendar(False)),
    "clean_calendar_intended": _cte(RAW_CALENDAR.strip() + _clean_calendar(True)),
    "clean_reviews": _cte(RAW_REVIEWS.strip() + REVIEWS_CLEANED),
    "read_listings_csv": _cte(f"""{RAW_LISTINGS.strip()}
SELECT {_whole_listings()}, {_part(1)} AS host_city, {_part(2)} AS host_state FROM raw_listings"""),
    "rejected_cells": _cte(RAW_CALENDAR.strip() + """
SELECT listing_id, concat_ws('|', CASE WHEN listing_id % 21 = 0 THEN 'date' END,
         CASE WHEN listing_id % 10 = 0 THEN 'minimum_nights' END,
         CASE WHEN listing_id % 15 = 0 THEN 'maximum_nights' END) AS columns, count(*) AS n_records
FROM raw_calendar WHERE 0 IN (listing_id % 21, listing_id % 10, listing_id % 15) GROUP BY listing_id"""),
    "read_calendar_csv": _cte(RAW_CALENDAR.strip() + _clean_calendar(False)),
    "read_reviews_csv": _cte(RAW_REVIEWS.strip() + REVIEWS_CLEANED),
}

ORDERS_PER_CUSTOMER = "(SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey)"

OPERATOR_SQL: dict[str, str] = {
    "median_price": _sql(
        f"SELECT listing_id, {_rd('median(CAST(price AS DOUBLE))')} AS median_price FROM calendar GROUP BY listing_id"
    ),
    "occupancy_rate": _sql(f"SELECT listing_id, {_d('occupancy_rate')} AS occupancy_rate FROM occ"),
    "quantile_bin": _binned_prices(QUARTILE_BINS),
    "quantile_bin_intended": _binned_prices(TERCILE_BINS),
    "approx_quantiles": f"""
SELECT l_returnflag, {_d('percentile_disc(0.25) WITHIN GROUP (ORDER BY price)')} AS low,
       {_d('percentile_disc(0.5) WITHIN GROUP (ORDER BY price)')} AS middle,
       {_d('percentile_disc(0.9) WITHIN GROUP (ORDER BY price)')} AS high, TRUE AS within_error
FROM (SELECT l_returnflag, CAST(l_extendedprice AS {MONEY}) AS price FROM lineitem) GROUP BY l_returnflag""".strip(),
    "exact_median": f"""
SELECT l_returnflag, {_rd(f'median(CAST(CAST(l_extendedprice AS {MONEY}) AS DOUBLE))')} AS median_price
FROM lineitem GROUP BY l_returnflag""".strip(),
    "top_n_per_group": """
SELECT o_orderkey, o_orderpriority, rnk FROM (
  SELECT *, dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY CAST(o_orderdate AS DATE) DESC) AS rnk
  FROM orders) WHERE rnk <= 3""".strip(),
    "global_dense_rank": f"""
SELECT o_orderkey, o_custkey, o_totalprice, dense_rank() OVER (
  ORDER BY o_custkey DESC, CAST(o_totalprice AS {MONEY})) AS rnk FROM orders""".strip(),
    "fixed_bin": f"""
SELECT o_custkey, n_orders, CASE WHEN n_orders <= 5 THEN 'Small' WHEN n_orders <= 15 THEN 'Medium'
                                 ELSE 'Large' END AS tier FROM {ORDERS_PER_CUSTOMER}""".strip(),
    "season_of": """
SELECT o_orderkey, CASE WHEN dayofyear(o_orderdate) BETWEEN 79 AND 171 THEN 'Spring'
                        WHEN dayofyear(o_orderdate) BETWEEN 172 AND 263 THEN 'Summer'
                        WHEN dayofyear(o_orderdate) BETWEEN 264 AND 354 THEN 'Autumn'
                        ELSE 'Winter' END AS season FROM orders""".strip(),
    "change_count": _cte("""
steps AS (
  SELECT listing_id, price, lag(price) OVER (
    PARTITION BY listing_id ORDER BY date NULLS FIRST, price NULLS FIRST) AS previous FROM calendar)
"""+f"""SELECT listing_id, count(*) FILTER (WHERE price <> previous) AS n_changes,
       {_rd('avg(price)')} AS avg_price FROM steps GROUP BY listing_id"""),
    "spread_by_group": f"""
WITH prices AS (
  SELECT o_orderpriority, o_orderstatus, {_r(f'avg(CAST(o_totalprice AS {MONEY}))')} AS avg_price
  FROM orders GROUP BY ALL)
SELECT o_orderpriority, o_orderstatus, {_d('avg_price')} AS avg_price,
       {_d('max(avg_price) OVER w - min(avg_price) OVER w')} AS price_spread
FROM prices WINDOW w AS (PARTITION BY o_orderpriority)""".strip(),
    "deviation_from_mean": f"""
WITH revenue AS (
  SELECT o_orderpriority, monthname(o_orderdate) AS month, sum(CAST(o_totalprice AS {MONEY})) AS revenue
  FROM orders GROUP BY ALL)
SELECT o_orderpriority, month, {_d('revenue')} AS revenue,
       {_rd('CAST(revenue AS DOUBLE) - avg(revenue) OVER (PARTITION BY o_orderpriority)')} AS deviation
FROM revenue""".strip(),
    "rank_sum_bottom_k": f"""
SELECT c_custkey, c_acctbal, n_orders FROM (
  SELECT c_custkey, c_acctbal, n_orders,
         dense_rank() OVER (ORDER BY CAST(c_acctbal AS {MONEY})) + dense_rank() OVER (ORDER BY n_orders) AS total
  FROM customer JOIN {ORDERS_PER_CUSTOMER} ON c_custkey = o_custkey)
ORDER BY total, c_custkey LIMIT 10""".strip(),
    "diff_from_reference_group": f"""
WITH balances AS (
  SELECT c_mktsegment, {_r(f'avg(CAST(c_acctbal AS {MONEY}))')} AS avg_balance FROM customer GROUP BY 1)
SELECT c_mktsegment, {_d('avg_balance')} AS avg_balance,
       {_d("avg_balance - (SELECT avg_balance FROM balances WHERE c_mktsegment = 'BUILDING')")}
         AS diff_from_building
FROM balances""".strip(),
    "weighted_score_ratio": f"""
WITH lines AS (
  SELECT l_returnflag, l_linestatus, {_r('avg(l_quantity)')} AS avg_quantity,
         {_r('avg(l_discount * 100)')} AS avg_discount,
         {_r(f'avg(CAST(l_extendedprice AS {MONEY}))')} AS avg_price
  FROM lineitem GROUP BY ALL),
scored AS (
  SELECT *, {_r('avg_quantity * CAST(0.6 AS DECIMAL(4,2)) + avg_discount * CAST(0.4 AS DECIMAL(4,2))')} AS score
  FROM lines)
SELECT l_returnflag, l_linestatus, {_d('avg_quantity')} AS avg_quantity, {_d('avg_discount')} AS avg_discount,
       {_d('avg_price')} AS avg_price, {_d('score')} AS score,
       {_rd('avg_price / NULLIF(score, 0)')} AS price_per_score
FROM scored""".strip(),
    "impute_from_group_median": _cte(f"""
medians AS (SELECT listing_id, {_r('median(CAST(price AS DOUBLE))')} AS median_price FROM calendar GROUP BY listing_id)
SELECT p_partkey, p_brand,
       {_d(f'COALESCE(CASE WHEN p_size > 25 THEN CAST(p_retailprice AS {MONEY}) END, median_price)')} AS price
FROM part JOIN medians ON p_partkey = listing_id"""),
    "segment_compare": f"""
SELECT c_mktsegment, {_rd(f'sum(CAST(c_acctbal AS {MONEY}) * n_orders) / sum(n_orders)')} AS order_weighted_balance,
       count(DISTINCT c_nationkey) AS n_nations
FROM customer JOIN {ORDERS_PER_CUSTOMER} ON c_custkey = o_custkey GROUP BY c_mktsegment""".strip(),
}

ORACLE_SQL: dict[str, str] = REPORT_SQL | CLEANING_SQL | OPERATOR_SQL
