"""Reading an export, writing reports."""

import csv
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import StructType

from roomledger import bindings, schemas
from roomledger.plans import registry
from roomledger.plans.load import load_market
from roomledger.plans.registry import ALL_REPORTS, REPORTS, run_reports
from roomledger.queries import _exported
from roomledger.sources import readers, scratch
from roomledger.sources.writers import write_report

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def export(spark):
    listings = bindings.raw_listings(spark, SF_DIR)
    extra = bindings.listings(spark, SF_DIR).select(
        "id", "property_type", "room_type", "host_is_superhost", "host_response_time",
        *[f"review_scores_{s}" for s in ("rating", "cleanliness", "checkin", "communication", "location", "value")],
    )
    reviews = bindings.reviews(spark, SF_DIR)
    return {
        "listings": _exported(listings.join(extra, "id"), schemas.LISTINGS, "listings"),
        "calendar": _exported(bindings.raw_calendar(spark, SF_DIR), schemas.CALENDAR, "calendar"),
        "reviews": _exported(reviews, schemas.REVIEWS, "reviews"),
    }


def test_schemas_have_all_columns(spark):
    sizes = [len(StructType.fromDDL(s)) for s in (schemas.LISTINGS, schemas.CALENDAR, schemas.REVIEWS)]
    assert sizes == [75, 7, 6]


def test_a_glob_unions_files_and_bad_cells_are_null(spark, tmp_path):
    header = "listing_id,date,available,price,adjusted_price,minimum_nights,maximum_nights\n"
    (tmp_path / "a_calendar.csv").write_text(header + '1,2024-01-01,t,"$1,000.00",,2,3\n')
    (tmp_path / "b_calendar.csv").write_text(header + "2,someday,f,$5.00,$4.00,x,1.5\n")
    rows = readers.read_calendar(spark, f"{tmp_path}/*_calendar.csv", partitions=3)
    assert rows.rdd.getNumPartitions() == 3
    found = sorted(map(tuple, rows.selectExpr("listing_id", "string(date)", "price", "minimum_nights", "maximum_nights").collect()))
    assert found == [(1, "2024-01-01", "$1,000.00", 2, 3), (2, None, "$5.00", None, None)]


def test_line_breaks_and_quotes_inside_comments(spark, tmp_path):
    text = 'listing_id,id,date,reviewer_id,reviewer_name,comments\n1,2,2024-01-01,3,Ann,"So ""nice"",\n<br/>really"\n'
    (tmp_path / "x_reviews.csv").write_text(text)
    assert readers.read_reviews(spark, str(tmp_path)).first().comments == 'So "nice",\n<br/>really'


def test_write_one_csv_file_with_header(spark, tmp_path):
    df = spark.range(0, 100, 1, 8).selectExpr("id", "id * 2 AS twice")
    write_report(df, f"{tmp_path}/report", single_file=True)
    write_report(df, f"{tmp_path}/report", single_file=True)  # overwrites
    files = list(Path(tmp_path, "report").glob("*.csv"))
    assert len(files) == 1
    with files[0].open() as f:
        rows = list(csv.DictReader(f))
    assert len(rows) == 100 and rows[7] == {"id": rows[7]["id"], "twice": str(2 * int(rows[7]["id"]))}


def test_existing_target_is_an_error_when_asked_for(spark, tmp_path):
    write_report(spark.range(1), f"{tmp_path}/r", format="parquet")
    with pytest.raises(AnalysisException):
        write_report(spark.range(1), f"{tmp_path}/r", format="parquet", mode="error")


def test_scratch_is_in_a_shared_folder(spark):
    class Session:
        def __init__(self, settings):
            self.conf = settings

    own = {"spark.sql.warehouse.dir": "hdfs://n/w"}
    assert scratch.scratch_path(Session(own), "t").startswith("hdfs://n/w/")
    own["spark.checkpoint.dir"] = "hdfs://n/c"
    assert scratch.scratch_path(Session(own), "t").startswith("hdfs://n/c/")
    assert scratch.scratch_path(Session(own), "t") != scratch.scratch_path(Session(own), "t")


@pytest.mark.parametrize("name", ALL_REPORTS)
def test_no_job_starts_while_a_report_is_built(spark, name):
    market = bindings.market(spark, SF_DIR)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", name)
    before = len(tracker.getJobIdsForGroup("building"))
    ALL_REPORTS[name].build(market)
    assert len(tracker.getJobIdsForGroup("building")) == before
    spark.sparkContext.setJobGroup("other", "")


@pytest.mark.parametrize("staged", [False, True])
def test_reports_from_an_export(spark, export, tmp_path, staged):
    market = load_market(spark, **export, partitions=4)
    names = ["occupancy_rate_per_month", "host_tier_revenue_trends", "monthly_revenue_per_neighbourhood"]
    staging = f"{tmp_path}/staging" if staged else None
    written = run_reports(market, f"{tmp_path}/out", names, format="parquet", staging_uri=staging)
    assert written == [f"{tmp_path}/out/{n}" for n in names]
    for name, uri in zip(names, written):
        expected = REPORTS[name].build(market)
        found = spark.read.parquet(uri)
        assert found.columns == expected.columns
        assert sorted(found.collect(), key=str) == sorted(expected.collect(), key=str)
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_all_reports_as_csv(spark, export, tmp_path):
    market = load_market(spark, **export)
    written = run_reports(market, f"{tmp_path}/out", staging_uri=f"{tmp_path}/staging")
    assert len(written) == 19
    for name in REPORTS:
        files = list(Path(tmp_path, "out", name).glob("*.csv"))
        assert files
        if REPORTS[name].bounded:
            assert len(files) == 1


def test_unknown_report(spark):
    with pytest.raises(KeyError, match="nothing"):
        run_reports(None, "unused", ["nothing"])


@pytest.fixture
def market(spark):
    return bindings.market(spark, SF_DIR)


def written_in(monkeypatch, stop_after=None):
    """Names of the reports in the order of their writes; an error after ``stop_after``."""
    seen = []

    def write(df, uri, *args, **kwargs):
        if len(seen) == stop_after:
            raise RuntimeError("lost")
        write_report(df, uri, *args, **kwargs)
        seen.append(uri.rpartition("/")[2])

    monkeypatch.setattr(registry, "write_report", write)
    return seen


def test_a_run_goes_on_after_the_reports_that_are_finished(spark, market, tmp_path, monkeypatch):
    names = ["property_type_trends", "avg_price_by_neighbourhood", "occupancy_rate_per_month", "most_diverse_hosts_by_property_type", "room_type_seasonal_trends"]
    where = {"out_uri": f"{tmp_path}/out", "names": names, "format": "parquet", "staging_uri": f"{tmp_path}/staging", "version": "may"}
    seen = written_in(monkeypatch, stop_after=3)
    with pytest.raises(RuntimeError, match="lost"):
        run_reports(market, **where)
    assert seen == names[:3] and Path(tmp_path, "staging", "calendar").exists()
    # the staged tables serve the second run: without inputs it only needs them
    empty = registry.replace(market, calendar=market.calendar.limit(0), listings=market.listings.limit(0))
    seen = written_in(monkeypatch)
    written = run_reports(empty, **where)
    assert seen == names[3:] and written == [f"{tmp_path}/out/{n}" for n in names]
    for name in names:
        found, expected = spark.read.parquet(f"{tmp_path}/out/{name}"), ALL_REPORTS[name].build(market)
        assert sorted(found.collect(), key=str) == sorted(expected.collect(), key=str)
    assert not Path(tmp_path, "staging").exists()
    seen = written_in(monkeypatch)
    assert run_reports(market, **where) == written and seen == []
    run_reports(market, **where | {"version": "june", "names": names[1:2]})
    assert seen == names[1:2]


LISTING_REPORTS = [n for n, r in ALL_REPORTS.items() if registry.LISTINGS in r.uses]


def test_reports_on_listings_do_not_read_the_calendar_in_a_run(spark, export, tmp_path, monkeypatch):
    """Nor the reviews, but for the distinct ids that the exact response report counts."""
    files = {}

    def write(df, uri, *args, **kwargs):
        files[uri.rpartition("/")[2]] = " ".join(df.inputFiles())

    monkeypatch.setattr(registry, "write_report", write)
    assert {"lowest_occupancy_rate_and_review_scores", "super_hosts_vs_regular_hosts", "host_response_times_stats", "host_tier_revenue_trends", "neighbourhood_group_performance", "property_type_trends"} <= set(LISTING_REPORTS)
    run_reports(load_market(spark, **export), f"{tmp_path}/out", LISTING_REPORTS, staging_uri=f"{tmp_path}/staging")
    for name in LISTING_REPORTS:
        assert "listing_totals" in files[name] and "calendar" not in files[name] and "month_totals" not in files[name]
        assert ("/reviews/" in files[name]) == (name in ("host_response_times_stats", "host_response_times_stats_intended")), name


@pytest.mark.parametrize("name", LISTING_REPORTS)
def test_totals_per_listing_give_the_same_reports(spark, market, name):
    held = registry.replace(market, listing_totals=market.make_listing_totals(sketches=True))
    found, expected = ALL_REPORTS[name].build(held), ALL_REPORTS[name].build(market)
    assert sorted(found.collect(), key=str) == sorted(expected.collect(), key=str)


def test_rejected_records_are_told_with_file_and_columns(spark, tmp_path):
    header = "listing_id,date,available,price,adjusted_price,minimum_nights,maximum_nights\n"
    (tmp_path / "a_calendar.csv").write_text(header + '1,2024-01-01,t,"$1,000.00",,2,3\n2,someday,f,$5.00,$4.00,x,1.5\n')
    (tmp_path / "b_calendar.csv").write_text(header + "3,2024-01-01,t\n4,2024-01-02,f,$1.00,,1,1\n5,,t,,,,\n6,2024-01-01,t,$1.00,,1,many\n")
    rejected = readers.rejected_records(spark, f"{tmp_path}/*_calendar.csv", "calendar")
    found = {(Path(r.file).name, r.record, tuple(r["columns"])) for r in rejected.collect()}
    assert found == {
        ("a_calendar.csv", "2,someday,f,$5.00,$4.00,x,1.5", ("date", "minimum_nights", "maximum_nights")),
        ("b_calendar.csv", "6,2024-01-01,t,$1.00,,1,many", ("maximum_nights",)),
    }
    counts = {(Path(r.file).name, r.column): r.n_records for r in readers.rejected_counts(rejected).collect()}
    assert counts == {("a_calendar.csv", c): 1 for c in ("date", "minimum_nights", "maximum_nights")} | {("b_calendar.csv", "maximum_nights"): 1}
    assert readers.read_calendar(spark, f"{tmp_path}/*_calendar.csv").count() == 6


def test_rejected_records_over_several_lines(spark, tmp_path):
    text = 'listing_id,id,date,reviewer_id,reviewer_name,comments\none,2,2024-01-01,3,Ann,"So ""nice"",\nreally"\n1,2,2024-01-01,3,Ben,fine\n'
    (tmp_path / "x_reviews.csv").write_text(text)
    (found,) = readers.rejected_records(spark, str(tmp_path), "reviews").collect()
    assert found.columns == ["listing_id"] and found.record.startswith("one,2,")


def test_scratch_needs_a_shared_folder():
    class Session:
        def __init__(self, **settings):
            self.conf = {k.replace("_", "."): v for k, v in settings.items()}

    local = {"spark_sql_warehouse_dir": "file:/home/me/spark-warehouse"}
    assert scratch.scratch_path(Session(**local, spark_master="local[4]"), "t").startswith("file:/home/me/")
    with pytest.raises(ValueError, match="checkpoint"):
        scratch.scratch_path(Session(**local, spark_master="yarn"), "t")
    shared = {"spark_sql_warehouse_dir": "hdfs://n/w", "spark_master": "yarn"}
    assert scratch.scratch_path(Session(**shared), "t").startswith("hdfs://n/w/")
