"""Rules, publishing, and the full refresh."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from serieslake import schemas as S
from serieslake.operators import access, rules
from serieslake.operators.rules import DROP, FAIL, WARN, Rule, RuleViolation
from serieslake.plans import datasets, statements
from serieslake.plans.lake import Lake

NOW = dt.datetime(2026, 1, 2, 3, 4, 5)
CHECKS = [Rule("key", "k IS NOT NULL", DROP), Rule("positive", "v > 0", DROP), Rule("small", "v < 100", WARN)]


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def data(frame):
    return frame("k string, v int", ("a", 1), ("b", -1), (None, 5), ("c", None), ("d", 500), (None, -7))


def test_drop_treats_null_as_broken(data):
    assert sorted(r.k for r in rules.keep_valid(data, CHECKS).collect()) == ["a", "d"]


def test_counts_balance(data):
    counts = {r.rule: (r.action, r.rows_in, r.rows_broken) for r in rules.rule_counts(data, CHECKS).collect()}
    assert counts == {"key": ("drop", 6, 2), "positive": ("drop", 6, 3), "small": ("warn", 6, 2)}
    broken = rules.quarantine(data, CHECKS[:2]).collect()
    assert len(broken) + rules.keep_valid(data, CHECKS).count() == 6
    assert {tuple(r._broken_rules) for r in broken} == {("positive",), ("key",), ("key", "positive")}


def test_unknown_action_is_refused():
    with pytest.raises(ValueError):
        Rule("x", "true", "ignore")


def test_publish_counts_every_row_although_filters_follow(lake, data):
    counts = lake.publish(data.repartition(3), "silver.t", CHECKS, run_at=NOW)
    assert (counts["rows_in"], counts["rows_kept"]) == (6, 2)
    assert sorted(r.k for r in lake.read("silver.t").collect()) == ["a", "d"]
    assert {(r.rule, r.rows_in, r.rows_broken) for r in lake.rule_log().collect()} == {
        ("key", 6, 2), ("positive", 6, 3), ("small", 6, 2)}


def test_refused_publish_keeps_the_earlier_snapshot(lake, data):
    strict = [Rule("has_v", "v IS NOT NULL", FAIL)]
    lake.publish(data.filter("v IS NOT NULL"), "gold.t", strict, run_at=NOW)
    with pytest.raises(RuleViolation, match="has_v: 1 of 6"):
        lake.publish(data, "gold.t", strict, run_at=NOW)
    assert lake.read("gold.t").count() == 5
    assert sorted((r.seq, r.accepted, r.rows_broken) for r in lake.rule_log().collect()) == [(1, True, 0), (2, False, 1)]
    lake.publish(data.limit(0), "gold.t", strict, run_at=NOW)
    assert lake.read("gold.t").count() == 0


def test_empty_dataset_is_no_pass(lake, data):
    with pytest.raises(RuleViolation, match="0 rows kept"):
        lake.publish(data.filter("v > 1000"), "silver.t", CHECKS, run_at=NOW, min_rows=1)
    with pytest.raises(LookupError):
        lake.read("silver.t")


def test_publish_may_read_what_it_replaces(lake, data):
    lake.publish(data, "silver.t", run_at=NOW)
    for _ in range(2):
        lake.publish(lake.read("silver.t").withColumn("v", F.col("v") + 1), "silver.t", run_at=NOW)
    assert lake.read("silver.t").agg(F.max("v")).first()[0] == 502


def test_partitioned_publish_keeps_types(lake, data):
    lake.publish(data, "silver.t", CHECKS, run_at=NOW, partition_by=["k"])
    assert sorted(map(tuple, lake.read("silver.t").select("k", "v").collect())) == [("a", 1), ("d", 500)]


def test_clustered_publish_counts_once(lake, data):
    counts = lake.publish(data.repartition(3), "silver.t", CHECKS, run_at=NOW, cluster_by=["v", "k"])
    assert (counts["rows_in"], counts["rows_kept"]) == (6, 2)


def test_exposed_by_name(spark, lake, data):
    lake.publish(data, "gold.exposed", CHECKS, run_at=NOW)
    lake.expose("gold.exposed")
    assert spark.table("gold.exposed").count() == 2


def test_unpublished_manifest_is_empty(lake):
    df = lake.read("bronze.manifest", empty=S.MANIFEST)
    assert df.count() == 0 and df.columns == S.MANIFEST.fieldNames()


# --- the whole refresh, from landed files ---------------------------------------------------

FILES = {
    "series": "\t".join(S.SERIES.fieldNames()) + "\n"
    "PRS30006032      \t3000\t6\t03\t2\tS\t\t\t1995\tQ01\t2014\tQ01\n"
    "PRS00000001      \t9999\t6\t03\t2\tU\t\t\t1995\tQ01\t1995\tQ05\n"
    "                 \t3000\t6\t03\t2\tS\t\t\t1995\tQ01\t1995\tQ04\n",
    "observations_current": "series_id        \tyear\tperiod\t       value\tfootnote_codes\n"
    "PRS30006032      \t2014\tQ01\t         9.5\tR\n",
    "observations_all": "series_id        \tyear\tperiod\t       value\tfootnote_codes\n"
    "PRS30006032      \t1995\tQ01\t         2.5\t\nPRS30006032      \t1995\tQ02\t         7.0\t\n"
    "PRS30006032      \t1995\tQ05\t       999.0\t\nPRS30006032      \t2014\tQ01\t         1.0\t\n"
    "PRS30006032      \t2014\tM13\t         1.0\t\nPRS30006032      \t2013\tQ01\t           -\t\n"
    "                 \t2013\tQ01\t         1.0\t\nPRS00000001      \t1995\tQ05\t         1.0\t\n",
    "sector": "sector_code\tsector_name\tdisplay_level\tselectable\tsort_sequence\n3000\tManufacturing\t0\tT\t1\n",
    "class": "class_code\tclass_text\tdisplay_level\tselectable\tsort_sequence\n6\tAll workers\t0\tT\t1\n",
    "measure": "measure_code\tmeasure_text\tdisplay_level\tselectable\tsort_sequence\n03\tHours worked\t0\tT\t1\n",
    "duration": "duration_code\tduration_text\tdisplay_level\tselectable\tsort_sequence\n2\t% change\t0\tT\t1\n",
    "seasonal": "Seasonal_code\tSeasonal_text\nS\tSeasonally Adjusted\n",
    "period": "period\tperiod_abbr\tperiod_name\nQ01\tQTR1\t1st Quarter\n",
    "footnote": "footnote_code\tfootnote_text\nR\tRevised\n",
    "population": '{"annotations": {}, "page": {}, "columns": [], "data": ['
    + ", ".join(
        f'{{"Nation ID": "01000US", "Nation": "United States", "Year": {y}, "Population": {p}}}'
        for y, p in ((2013, "316128839.0"), (2014, "318857056.0"), (2015, "null"))
    )
    + ', {"Nation ID": "X", "Nation": "Elsewhere", "Year": 2014, "Population": 5.0}]}',
}
CHOICE = {"nation": "United States", "first": 2013, "last": 2018, "series_id": "PRS30006032"}


@pytest.fixture
def refreshed(lake, tmp_path):
    paths = {}
    for name, text in FILES.items():
        path = tmp_path / "landing" / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(text)
        paths[name] = str(path)
    datasets.refresh(lake, paths, NOW, **CHOICE)
    return lake


def test_full_refresh(spark, refreshed):
    lake = refreshed
    published = {r.dataset for r in lake.log().collect()}
    assert published == set(datasets.RULES) and len(published) == 17
    best = [tuple(r) for r in lake.read("gold.best_year").collect()]
    label = "Manufacturing: All workers, Hours worked, % change (Seasonally Adjusted)"
    assert best == [("PRS30006032", label, 1995, 9.5)]  # 1995 and 2014 tie; Q05 is not added
    by_year = [tuple(r) for r in lake.read("gold.series_by_year").orderBy("year").collect()]
    assert by_year == [(1995, 2.5, None), (2013, None, 316128839.0), (2014, 9.5, 318857056.0)]
    stats = lake.read("gold.population_stats").first()
    assert (stats.year_start, stats.year_end, stats.n_years, stats.mean_population) == (2013, 2018, 2, 317492947.5)
    broken = {(r.dataset, r.rule): r.rows_broken for r in lake.rule_log().collect()}
    assert broken["bronze.series", "non_null_series_id"] == 1
    assert broken["bronze.observations_all", "non_null_keys"] == 1
    assert broken["silver.observations", "valid_period"] == 1
    assert broken["silver.observations", "has_value"] == 1
    assert broken["bronze.population", "non_null_keys"] == 1
    assert broken["bronze.observations_all", "value_parses"] == 1
    assert broken["bronze.observations_all", "well_formed"] == 0
    assert "_malformed" not in lake.read("bronze.series").columns

    for name in ("silver.observations", "silver.series", "silver.population"):
        lake.expose(name)
    names = {"observations": "silver.observations", "series": "silver.series", "population": "silver.population"}

    def sql(text, *tables, **values):
        return statements.run(spark, text, **{t: names[t] for t in tables}, **values)

    same = {
        "gold.best_year": sql(statements.BEST_YEAR, "observations", "series"),
        "gold.population_stats": sql(statements.POPULATION_STATS, "population", nation="United States", first=2013, last=2018),
        "gold.series_by_year": sql(
            statements.SERIES_BY_YEAR, "observations", "population", nation="United States",
            series_id="PRS30006032", period="Q01"),
    }
    for name, df in same.items():
        table = lake.read(name)
        assert df.dtypes == table.dtypes, name
        assert df.exceptAll(table).count() == 0 and table.exceptAll(df).count() == 0, name
        lake.publish(df, name, datasets.RULES[name], run_at=NOW)
        assert lake.read(name).exceptAll(table).count() == 0, name


def test_range_without_data_fails_the_refresh(refreshed):
    stats = datasets.gold_population_stats(refreshed.read("silver.population"), nation="Nowhere", first=1, last=2)
    with pytest.raises(RuleViolation, match="has_mean"):
        refreshed.publish(stats, "gold.population_stats", datasets.RULES["gold.population_stats"], run_at=NOW)
    assert refreshed.read("gold.population_stats").first().n_years == 2


def test_twice_listed_code_stops_the_refresh(refreshed):
    twice = refreshed.read("bronze.sector")
    refreshed.publish(twice.unionAll(twice), "bronze.sector", run_at=NOW)
    with pytest.raises(RuleViolation, match="sector_code '3000'"):
        datasets.refresh_silver(refreshed, NOW)


def test_malformed_lines_can_refuse_a_file(spark, lake, tmp_path):
    paths = {}
    for name, text in FILES.items():
        (tmp_path / name).write_text(text + ("Q02\tonly two fields\n" if name == "period" else ""))
        paths[name] = str(tmp_path / name)
    with pytest.raises(RuleViolation, match="well_formed: 1 of 2"):
        datasets.refresh_bronze(lake, paths, NOW, malformed=FAIL)
    datasets.refresh_bronze(lake, paths, NOW, malformed=DROP)
    assert [r.period for r in lake.read("bronze.period").collect()] == ["Q01"]
    datasets.refresh_bronze(lake, paths, NOW)
    assert sorted(map(tuple, lake.read("bronze.period").collect())) == [
        ("Q01", "QTR1", "1st Quarter"), ("Q02", "only two fields", None)]


def test_masks_and_row_filters(frame):
    rows = frame("k int, secret string", (1, "a"), (2, "b"), (2, None))
    masked = access.mask_columns(rows, ["secret"], salt="s").collect()
    assert {r.secret for r in masked} == {hashlib.sha256(b"sa").hexdigest(), hashlib.sha256(b"sb").hexdigest(), None}
    rights = frame("reader string, k int", ("ann", 2), ("ann", 2), ("bob", 1))
    assert [r.k for r in access.entitled_rows(rows, rights, "ann", "k").collect()] == [2, 2]
    assert access.entitled_rows(rows, rights, "eve", "k").count() == 0


def test_values_that_cannot_be_stored_are_counted(frame):
    rows = frame("value string", (" 1.5 ",), ("2E3",), ("x",), ("1e30",), ("NaN",), ("",), (None,))
    (counted,) = rules.rule_counts(rows, [datasets.VALUE_PARSES]).collect()
    assert (counted.rows_in, counted.rows_broken) == (7, 3)
