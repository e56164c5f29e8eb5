"""Incremental runs end in the same rows as a full refresh, however the input is split."""

import datetime as dt
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from serieslake.operators.reconcile import reconcile
from serieslake.operators.rules import Rule, keep_valid
from serieslake.plans import datasets
from serieslake.plans.lake import Lake
from serieslake.schemas import SERIES
from serieslake.session import scratch_path
from serieslake.sources.landing import land_release, version_path
from serieslake.sources.text import write_padded
from serieslake.streaming.observations import ObservationState, merge_landed

RAW = "series_id string, year string, period string, value string, footnote_codes string"
RELEASES = ["current", "all"]
LANDED = RAW + ", release string, version string"


def rows_of(df):
    return sorted(map(tuple, df.select("series_id", "year", "period", "value", "footnote_codes").collect()), key=repr)


def order(version):
    return (0, 0, "") if version is None else (1, int(version), "") if version.isdigit() else (2, 0, version)


def full(spark, frame, rows, preference=("current", "all")):
    """The full refresh over the newest version of each release."""
    releases = []
    for name in preference:
        newest = max((r[6] for r in rows if r[5] == name), key=order, default=None)
        releases.append(frame(RAW, *[r[:5] for r in rows if r[5] == name and r[6] == newest]))
    current, history = (*releases, frame(RAW))[:2]
    return rows_of(keep_valid(datasets.silver_observations(current, history), datasets.RULES["silver.observations"]))


row = st.tuples(
    st.sampled_from(["A", "B "]), st.sampled_from(["2000", "2001", "x"]), st.sampled_from(["Q01", "Q02", "M13"]),
    st.sampled_from(["1", "2.5", "-", None]), st.sampled_from([None, "r"]), st.sampled_from(["current", "all"]),
    st.sampled_from(["1", "9", "10"]),
)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=14), st.integers(1, 3), st.randoms(use_true_random=False))
def test_batches_equal_full_refresh(spark, frame, rows, n_batches, rng):
    state = ObservationState(scratch_path(spark, "state"), RELEASES)
    batches = [[] for _ in range(n_batches)]
    for r in rows:
        rng.choice(batches).append(r)
    for batch in batches:
        df = frame(LANDED, *batch)
        state.merge(df)
        if rng.random() < 0.5:
            state.merge(df)  # a replay
    assert rows_of(state.reconciled(spark, ["current", "all"])) == full(spark, frame, rows)


def test_newer_version_replaces_its_release_whole(spark, frame):
    state = ObservationState(scratch_path(spark, "state"), RELEASES)
    state.merge(frame(LANDED, ("A", "2000", "Q01", "1", None, "all", "9"), ("B", "2000", "Q01", "2", None, "all", "9")))
    state.merge(frame(LANDED, ("A", "2000", "Q01", "3", None, "all", "10")))
    assert rows_of(state.reconciled(spark, ["all"])) == [("A", 2000, "Q01", 3, None)]
    state.merge(frame(LANDED, ("C", "2000", "Q01", "4", None, "all", "2")))  # an old version comes late
    assert rows_of(state.reconciled(spark, ["all"])) == [("A", 2000, "Q01", 3, None)]


def test_dropped_rows_are_counted(spark, frame):
    state = ObservationState(scratch_path(spark, "state"), ["all"])
    state.merge(frame(LANDED, ("A", "2000", "M13", "1", None, "all", "1"), (None, "2000", "Q01", "1", None, "all", "1"),
                      ("A", "2000", "Q01", None, None, "all", "1"), ("A", "2000", "Q01", "1", None, "draft", "1")))
    log = {r.release: r for r in state.log(spark).collect()}
    assert (log["all"].version, log["all"].rows_in, log["all"].rows_kept) == ("1", 3, 1)
    assert (log["all"].broken_0, log["all"].broken_1, log["all"].broken_2) == (1, 1, 1)
    assert (log["draft"].version, log["draft"].rows_in) == (None, 1)


def test_batch_without_index_does_not_count(spark, frame):
    state = ObservationState(scratch_path(spark, "state"), RELEASES)
    state.merge(frame(LANDED, ("A", "2000", "Q01", "1", None, "all", "1")))
    # A batch that died before its index was written leaves rows behind.
    stray = spark.read.parquet(f"{state.root}/rows").filter("batch = 0").drop("batch")
    stray.withColumn("value", F.lit(7).cast("decimal(28,10)")).write.partitionBy("bucket").parquet(f"{state.root}/rows/batch=1")
    assert rows_of(state.reconciled(spark, ["all"])) == [("A", 2000, "Q01", 1, None)]
    state.merge(frame(LANDED, ("A", "2000", "Q01", "5", None, "all", "2")))
    assert rows_of(state.reconciled(spark, ["all"])) == [("A", 2000, "Q01", 5, None)]


def batches_of(spark, state):
    return {(r.batch, r.bucket) for r in spark.read.parquet(f"{state.root}/rows").select("batch", "bucket").distinct().collect()}


def test_only_changed_buckets_are_rewritten(spark, frame):
    state = ObservationState(scratch_path(spark, "state"), RELEASES)
    years = [("A", str(y), "Q01", "1", None, "all", "1") for y in range(1990, 2030)]
    state.merge(frame(LANDED, *years))
    before = batches_of(spark, state)
    assert len(before) > 8
    state.merge(frame(LANDED, *[(*r[:6], "2") for r in reversed(years)]))  # the same rows once more
    assert batches_of(spark, state) == before and state.log(spark).filter("version = '2'").count() == 1
    state.merge(frame(LANDED, *[(*r[:6], "3") for r in years[:-1]], ("A", "2029", "Q01", "2", None, "all", "3")))
    assert len(batches_of(spark, state) - before) == 1
    state.merge(frame(LANDED, ("A", "2029", "Q01", "9", None, "current", "1")))
    assert len(batches_of(spark, state) - before) == 2
    kept = {r[1]: r[3] for r in rows_of(state.reconciled(spark, RELEASES))}
    assert len(kept) == 40 and kept[2029] == 9 and kept[2028] == 1
    state.merge(frame(LANDED, *[(*r[:6], "4") for r in years[:1]]))  # nearly all rows leave
    assert rows_of(state.reconciled(spark, RELEASES)) == [("A", 1990, "Q01", 1, None), ("A", 2029, "Q01", 9, None)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reading_the_state_shuffles_nothing(spark, frame):
    state = ObservationState(scratch_path(spark, "state"), RELEASES)
    state.merge(frame(LANDED, *[("A", str(y), "Q01", "1", None, r, "1") for y in range(2000, 2009) for r in RELEASES]))
    for preference in (RELEASES, ["all"], ["current"]):
        df = state.reconciled(spark, preference)
        assert df.count() == 9
        assert not any(word in plan_of(df) for word in ("Exchange", "Sort", "Window", "Join", "Aggregate"))
    other = state.reconciled(spark, ["all", "current"])
    assert other.count() == 9 and "Exchange" in plan_of(other)


def test_marks_of_another_order_do_not_count(spark, frame):
    root = scratch_path(spark, "state")
    ObservationState(root, RELEASES).merge(frame(LANDED, ("A", "2000", "Q01", "1", None, "all", "1"), ("A", "2000", "Q01", "2", None, "current", "1")))
    turned = ObservationState(root, ["all", "current"])
    assert rows_of(turned.reconciled(spark, ["all", "current"])) == [("A", 2000, "Q01", 1, None)]
    with pytest.raises(ValueError, match="16 buckets"):
        ObservationState(root, RELEASES, buckets=4).reconciled(spark, RELEASES)


def test_rules_run_after_the_choice_of_release(spark, frame):
    rules = [Rule("positive", "value > 0", "drop")]
    state = ObservationState(scratch_path(spark, "state"), RELEASES, rules=rules)
    rows = [("A", "2000", "Q01", "-1", None, "current", "1"), ("A", "2000", "Q01", "5", None, "all", "1"), ("B", "2000", "Q01", "6", None, "all", "1")]
    state.merge(frame(LANDED, *rows))
    releases = [frame(RAW, *[r[:5] for r in rows if r[5] == name]) for name in RELEASES]
    assert rows_of(state.reconciled(spark, RELEASES)) == rows_of(keep_valid(reconcile(releases), rules)) == [("B", 2000, "Q01", 6, None)]


@pytest.mark.parametrize("action", ["warn", "drop", "fail"])
def test_malformed_lines_of_the_stream(spark, frame, action):
    landing = scratch_path(spark, "landing")
    lines = ["series_id\tyear\tperiod\tvalue\tfootnote_codes", "A\t2000\tQ01\t1\t", "B\t2000\tQ01", "C\t2000\tQ01\t1\t\textra"]
    for version, text in (("1", lines[:2]), ("2", lines)):
        frame("value string", *[(line,) for line in text]).coalesce(1).write.text(version_path(landing, "all", version))
    state = ObservationState(scratch_path(spark, "state"), RELEASES, malformed=action)
    if action == "fail":
        with pytest.raises(Exception, match="2 malformed lines"):
            merge_landed(spark, landing, state, scratch_path(spark, "checkpoint"))
        assert rows_of(state.reconciled(spark, RELEASES)) == []
        return
    merge_landed(spark, landing, state, scratch_path(spark, "checkpoint"))
    assert [r[0] for r in rows_of(state.reconciled(spark, RELEASES))] == (["A", "B", "C"] if action == "warn" else ["A"])
    assert sorted(r.line for r in state.malformed_lines(spark).collect()) == lines[2:]
    counts = {r.rule: (r.rows_in, r.rows_broken) for r in state.batch_counts(spark).collect()}
    assert counts["well_formed"] == (4, 2) and counts["has_value"] == (4, 1)


def test_withdrawn_release_lets_the_other_back_in(spark, frame):
    state = ObservationState(scratch_path(spark, "state"), RELEASES)
    state.merge(frame(LANDED, ("A", "2000", "Q01", "1", None, "all", "1"), ("A", "2000", "Q01", "9", "R", "current", "1")))
    assert rows_of(state.reconciled(spark, ["current", "all"])) == [("A", 2000, "Q01", 9, "R")]
    assert rows_of(state.reconciled(spark, ["all"])) == [("A", 2000, "Q01", 1, None)]


def test_release_that_is_not_declared_is_left_out(spark, frame):
    state = ObservationState(scratch_path(spark, "state"), ["all"])
    state.merge(frame(LANDED, ("A", "2000", "Q01", "9", None, "draft", "1"), ("A", "2000", "Q01", "1", None, "all", "1")))
    assert rows_of(state.reconciled(spark, ["all"])) == [("A", 2000, "Q01", 1, None)]


def test_landed_release_is_written_once(spark, frame):
    root, widths = scratch_path(spark, "landing"), {"series_id": 9}
    df = frame(RAW, ("A", "2000", "Q01", "1", None))
    path, digest = land_release(df, root, "all", dt.datetime(2026, 1, 2), widths=widths)
    assert "/release=all/version=20260102T000000-" in path
    assert land_release(df.repartition(2), root, "all", dt.datetime(2026, 1, 3), widths=widths, known_hash=digest) is None
    state = ObservationState(scratch_path(spark, "state"), RELEASES)
    merge_landed(spark, root, state, scratch_path(spark, "checkpoint"))
    assert rows_of(state.reconciled(spark, RELEASES)) == [("A", 2000, "Q01", 1, None)]


def test_empty_state(spark):
    assert rows_of(ObservationState(scratch_path(spark, "state"), RELEASES).reconciled(spark, ["all"])) == []


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_landed_versions_stream_into_the_state(spark, frame, files_per_batch):
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    state = ObservationState(scratch_path(spark, "state"), RELEASES)
    rng = random.Random(1)

    def land(release, version, rows):
        write_padded(frame(RAW, *rows).coalesce(1), version_path(landing, release, version), {"series_id": 9, "value": -9})

    seen = []
    for step, release in enumerate(["all", "current", "all"]):
        rows = [("A", str(2000 + rng.randint(0, 2)), f"Q0{q}", str(rng.randint(1, 9)), None) for q in (1, 2)]
        land(release, str(step), rows)
        seen += [(*r, release, str(step)) for r in rows]
        if step:
            merge_landed(spark, landing, state, checkpoint, files_per_batch=files_per_batch)
    merge_landed(spark, landing, state, checkpoint)  # nothing new
    assert rows_of(state.reconciled(spark, ["current", "all"])) == full(spark, frame, seen)
    merge_landed(spark, landing, state, scratch_path(spark, "checkpoint"))  # all files again: the checkpoint was lost
    assert rows_of(state.reconciled(spark, ["current", "all"])) == full(spark, frame, seen)


def test_gold_from_the_state_equals_gold_from_silver(spark, frame, tmp_path):
    codes = ("3000", "6", "03", "2", "S", None, None, "1995", "Q01", "2014", "Q04")
    series = frame(", ".join(f"{f.name} string" for f in SERIES.fields), *[(s, *codes) for s in ("A", "B")])
    empty = {
        lookup: frame(f"{code} string, {text} string")
        for lookup, code, text in (
            ("sector", "sector_code", "sector_name"), ("class", "class_code", "class_text"),
            ("measure", "measure_code", "measure_text"), ("duration", "duration_code", "duration_text"),
            ("seasonal", "seasonal_code", "seasonal_text"))
    }
    rows = [
        (s, str(y), f"Q0{q}", str(q * y % 7), None, release, "1")
        for s in "AB" for y in (2000, 2001) for q in range(1, 6) for release in RELEASES if release == "all" or y == 2001
    ]
    state = ObservationState(scratch_path(spark, "state"), RELEASES)
    for number in range(2):
        state.merge(frame(LANDED, *rows[number::2]))
    lake, now = Lake(spark, str(tmp_path / "lake")), dt.datetime(2026, 1, 2)
    lake.publish(datasets.silver_series(series, empty), "silver.series", run_at=now)
    lake.publish(frame("nation_id string, nation string, year int, population double", ("x", "N", 2000, 1.0)),
                 "silver.population", run_at=now)
    choice = {"nation": "N", "first": 2000, "last": 2001, "series_id": "A"}
    full_rows = reconcile([frame(RAW, *[r[:5] for r in rows if r[5] == name]) for name in RELEASES])
    results = []
    for observations in (full_rows, state.reconciled(spark, RELEASES)):
        datasets.refresh_gold(lake, now, observations=observations, **choice)
        results.append([sorted(map(tuple, lake.read(f"gold.{t}").collect())) for t in ("best_year", "series_by_year")])
    assert results[0] == results[1] and len(results[0][0]) == 2


def test_versions_are_summed_once_and_landed_compressed(spark, tmp_path, monkeypatch):
    from serieslake.queries import catalog

    orders = [(i, i % 7, "O", 100.0 + i, dt.datetime(2000 + i % 3, 1 + i % 12, 1), "1-URGENT") for i in range(60)]
    spark.createDataFrame(orders, catalog.I.TABLES["orders"]).write.parquet(str(tmp_path / "orders.parquet"))
    summed, landed = [], []
    quarters, write = catalog.I.quarter_values, catalog.text.write_padded
    monkeypatch.setattr(catalog.I, "quarter_values", lambda *a, **k: summed.append(a) or quarters(*a, **k))
    monkeypatch.setattr(catalog.text, "write_padded", lambda df, path, *a, **k: landed.append((path, df)) or write(df, path, *a, **k))
    got = catalog.state_ten_versions(spark, str(tmp_path))
    assert len(summed) == 1 and len(landed) == 10
    assert all("Aggregate" not in df._jdf.queryExecution().optimizedPlan().toString() for _, df in landed)
    assert all(name.endswith(".gz") for path, _ in landed for name in os.listdir(path) if name.startswith("part-"))
    want = {(r.series_id, r.year, r.period): float(r.value) for r in quarters(spark, str(tmp_path)).collect()}
    assert {(r.series_id, r.year, r.period): r.value for r in got.collect()} == want
    assert {r.footnote_codes for r in got.collect()} == {"10"}
