"""What the plans must look like to hold at scale."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from serieslake import schemas as S
from serieslake.operators import sketches, summary
from serieslake.operators.layout import heaviest, if_light
from serieslake.operators.manifest import plan_sync
from serieslake.operators.reconcile import KEYS, observation_types, reconcile
from serieslake.plans import datasets
from serieslake.plans.lake import Lake
from serieslake.queries import catalog
from serieslake.queries import inputs as I


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan_of(df)))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Two raw releases, a dimension and a yearly measure as stored tables."""
    from conftest import SF

    root = tmp_path_factory.mktemp("stored")
    tables = {
        "current": I.current(spark, SF), "all": I.history(spark, SF),
        "series": datasets.silver_series(I.series(spark, SF), I.lookups(spark, SF)), "population": I.nation_years(spark, SF),
        "observations": reconcile([I.current(spark, SF), I.history(spark, SF)]),
    }
    for name, df in tables.items():
        df.write.parquet(str(root / name))
    return {name: spark.read.parquet(str(root / name)) for name in tables}


def test_no_python_in_any_answer(spark):
    lazy = ["reconcile_releases", "best_period_per_series", "best_period_one_pass", "aligned_series", "manifest_plan",
            "manifest_upsert", "run_summary", "decode_dimension", "footnote_decode", "listing_extract", "link_extract",
            "content_fingerprint", "parts_check", "growth_first_last", "rules_quarantine", "rules_warn_metrics"]
    from conftest import SF

    for name in lazy:
        assert not re.search(r"Python|Pandas|Arrow", plan_of(catalog.QUERIES[name](spark, SF))), name


def test_dedup_limits_groups_before_the_shuffle(stored):
    plan = plan_of(reconcile([stored["current"], stored["all"]]))
    partial, exchange = plan.index("Partial"), plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan and exchange < partial  # printed root first
    assert plan.count("Exchange") == 1


def test_one_pass_totals_shuffle_once(stored):
    releases = [stored["current"], stored["all"]]
    one = summary.reconciled_totals(releases, S.QUARTERS)
    two = summary.period_totals(reconcile(releases), S.QUARTERS)
    assert (exchanges(one), exchanges(two)) == (1, 2)
    assert "HashAggregate" in plan_of(one) and "Sort" not in plan_of(one)


def test_dedup_totals_best_year_and_join_share_one_exchange(stored):
    """By series alone; the other exchange is that of the dimension."""
    by = if_light([stored["current"], stored["all"]], "series_id")
    rows = reconcile([stored["current"], stored["all"]], by=by)
    best = summary.best_period(summary.period_totals(rows, S.QUARTERS))
    plan = plan_of(best)
    assert by == "series_id" and plan.count("Exchange") == 1 and "Exchange hashpartitioning(series_id" in plan
    apart = summary.best_period(summary.period_totals(reconcile([stored["current"], stored["all"]]), S.QUARTERS))
    assert plan_of(apart).count("Exchange") == 3
    assert sorted(map(tuple, best.collect())) == sorted(map(tuple, apart.collect()))


def test_heavy_series_are_measured(frame):
    tables = [frame("series_id string", *[("A ",)] * 5, ("B",)), frame("series_id string", ("A",), (None,))]
    assert heaviest(tables, "series_id") == 6 and heaviest([tables[0].limit(0)], "series_id") == 0
    assert if_light(tables, "series_id", 6) == "series_id" and if_light(tables, "series_id", 5) is None


def test_bucketed_silver_is_read_without_a_shuffle(spark, stored, tmp_path):
    lake, now = Lake(spark, str(tmp_path / "lake")), dt.datetime(2026, 1, 2)
    rows = reconcile([stored["current"], stored["all"]], by="series_id")
    counts = lake.publish(rows, "silver.observations", datasets.RULES["silver.observations"], run_at=now, bucket_by="series_id", sort_by=KEYS)
    kept = lake.read("silver.observations")
    assert counts["rows_kept"] == kept.count() == rows.count()
    best = summary.best_period(summary.period_totals(kept, S.QUARTERS))
    assert "Exchange" not in plan_of(best) and "Bucketed: true" in plan_of(best)
    assert sorted(map(tuple, best.collect())) == sorted(map(tuple, summary.best_period(summary.period_totals(rows, S.QUARTERS)).collect()))
    one = kept.filter("series_id = '7'")
    assert "EqualTo(series_id,7)" in plan_of(one) and one.count() > 0
    spark.sql(f"DROP TABLE {lake._current('silver.observations')['table']}")  # another session does not know the table
    assert lake.read("silver.observations").count() == kept.count()


def test_series_filter_reaches_both_scans(stored):
    rows = datasets.gold_series_by_year(
        reconcile([stored["current"], stored["all"]]), stored["population"], series_id="7", period="Q01", nation="NATION_7")
    plan = plan_of(rows)
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*", plan)
    raw = [s for s in scans if "period" in s]
    assert len(raw) == 2
    # Trimmed keys are compared below the union, before anything is sorted or shuffled.
    below = plan[plan.index("Union"):]
    assert below.count("(trim(series_id") >= 2 and below.count("(trim(period") >= 2


def test_gold_reads_only_what_it_needs(stored):
    best = datasets.gold_best_year(stored["observations"], stored["series"])
    plan = plan_of(best)
    read = re.findall(r"ReadSchema: struct<([^>]*)>", best._jdf.queryExecution().explainString(
        best.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    assert any("footnote_codes" not in r and "value" in r for r in read)
    assert any(set(re.findall(r"(\w+):", r)) == {"series_id", "series_label"} for r in read)
    assert "PushedFilters" in plan and "In(period" in plan


def test_yearly_measure_filter_is_pushed_to_its_scan(stored):
    rows = datasets.gold_series_by_year(
        stored["observations"], stored["population"], series_id="7", period="Q01", nation="NATION_7")
    plan = plan_of(rows)
    assert "EqualTo(nation,NATION_7)" in plan and "EqualTo(series_id,7)" in plan and "EqualTo(period,Q01)" in plan


def test_alignment_never_shuffles_by_year_alone(stored):
    rows, yearly = stored["observations"], stored["population"]
    small = summary.aligned_series(rows, yearly, columns=["series_id", "year", "period"], measure="population")
    large = summary.aligned_series(rows, yearly, columns=["series_id", "year", "period"], measure="population", most_rows=3, salts=8)
    assert "BroadcastHashJoin" in plan_of(small) and "Exchange hashpartitioning" not in plan_of(small)
    counted = large.hint("merge")
    assert re.search(r"_salt", plan_of(counted)) and not re.search(r"Exchange hashpartitioning\(year#\d+, \d+\)", plan_of(counted))
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect())) and small.count() > rows.count()


def test_series_by_year_comes_in_order(spark):
    for name in ("series_by_year", "sql_series_by_year"):
        years = [row.year for row in catalog.QUERIES[name](spark, "/root/testdata/sf0.01").collect()]
        assert years == sorted(years) and len(years) > 1, name


def test_stored_rows_are_ordered_on_read(spark, frame, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.publish(frame("year int", *[(k * 7 % 50,) for k in range(50)]).repartition(6), "gold.t", run_at=dt.datetime(2026, 1, 2))
    assert [row.year for row in lake.read("gold.t", order_by=["year"]).collect()] == list(range(50))


def test_sketches_merge(spark):
    """Two halves merged are as good as the whole; NULLs and keys without values do not count."""
    rows = spark.range(100_000).selectExpr("id % 3 AS key", "CASE WHEN id % 3 = 2 THEN NULL ELSE id * 7919 % 100000 END AS u", "id % 2 AS part")
    halves = [sketches.sketch(rows.filter(F.col("part") == part), ["key"], "u") for part in (0, 1)]
    found = {r.key: r for r in sketches.quantile(sketches.merge(halves, ["key"]), ["key"], 0.5, "m").collect()}
    for key in (0, 1):
        values = sorted(r.u for r in rows.filter(F.col("key") == key).collect())
        assert abs(sum(v <= found[key].m for v in values) - len(values) / 2) <= sketches.RANK_ERROR * len(values)
        assert found[key].n_seen == len(values)
    assert 2 not in found


def test_lookups_too_large_to_broadcast_are_shuffled(spark, stored):
    from conftest import SF

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        plan = plan_of(datasets.silver_series(I.series(spark, SF), I.lookups(spark, SF)))
        assert "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan and "SortMergeJoin" in plan
        rows = datasets.silver_series(I.series(spark, SF), I.lookups(spark, SF)).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert rows == I.table(spark, SF, "customer").count()


def test_no_cross_joins(spark):
    from conftest import SF

    for name in ("best_period_per_series", "aligned_series", "manifest_upsert", "decode_dimension", "yearly_profile"):
        plan = plan_of(catalog.QUERIES[name](spark, SF))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_manifest_is_one_join(spark):
    from conftest import SF

    plan = plan_of(plan_sync(I.manifest(spark, SF), I.listing(spark, SF)))
    assert plan.count("FullOuter") == 1


def test_value_types_follow_the_caller(stored):
    exact = reconcile([stored["all"]], types=observation_types("decimal(18,4)"))
    assert dict(exact.dtypes)["value"] == "decimal(18,4)"
    assert exact.filter(F.col("value").isNull()).count() == 0
