"""The manifest: every outcome of a file, idempotence, and untouched rows."""

import datetime as dt
import random

import pytest

from serieslake import schemas as S
from serieslake.operators import checks, manifest
from serieslake.operators.rules import RuleViolation
from serieslake.plans import sync
from serieslake.plans.lake import Lake

DAY = [dt.datetime(2026, 1, d) for d in range(1, 10)]
LISTED = "source string, relative_path string, remote_url string, size_bytes bigint, last_modified string"
T0 = "6/4/2026 8:30 AM"


def listed(frame, *files, extra=""):
    return frame(LISTED + extra, *[(s, p, f"https://h/{s}/{p}", *rest) for s, p, *rest in files])


def empty(frame):
    return frame(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.MANIFEST.fields))


def rows(df):
    return {(r.source, r.relative_path): r for r in df.collect()}


def actions(plan):
    return {(r.source, r.relative_path): r.action for r in plan.collect()}


@pytest.fixture
def first(frame):
    """Six files of one source and one of another, landed on the first day; one since removed."""
    files = [("s", p, 10, T0) for p in ("same", "size", "date", "gone", "back", "fail")] + [("t", "other", 1, T0)]
    day0 = manifest.apply_sync(manifest.plan_sync(empty(frame), listed(frame, *files)), DAY[0])
    without = listed(frame, *[f for f in files if f[1] != "back"])
    return manifest.apply_sync(manifest.plan_sync(day0, without), DAY[1])


def test_all_outcomes(frame, first):
    now = listed(
        frame, ("s", "same", 10, T0, False), ("s", "size", 11, T0, False), ("s", "date", 10, "6/5/2026 8:30 AM", False),
        ("s", "back", 10, T0, False), ("s", "fail", 12, T0, True), ("s", "new", 3, T0, False), ("s", "newfail", 3, T0, True),
        extra=", failed boolean")
    plan = manifest.plan_sync(first, now, sources=["s"])
    assert actions(plan) == {
        ("s", "same"): "skipped", ("s", "size"): "changed", ("s", "date"): "changed", ("s", "gone"): "removed",
        ("s", "back"): "changed", ("s", "fail"): "failed", ("s", "new"): "new", ("s", "newfail"): "failed",
        ("t", "other"): "kept",
    }
    after = rows(manifest.apply_sync(plan, DAY[4]))
    state = {p: (r.status, r.first_seen_at, r.last_seen_at, r.last_ingested_at) for (_, p), r in after.items()}
    assert state == {
        "same": ("active", DAY[0], DAY[4], DAY[0]), "size": ("active", DAY[0], DAY[4], DAY[4]),
        "date": ("active", DAY[0], DAY[4], DAY[4]), "gone": ("removed", DAY[0], DAY[1], DAY[0]),
        "back": ("active", DAY[0], DAY[4], DAY[4]), "fail": ("active", DAY[0], DAY[1], DAY[0]),
        "new": ("active", DAY[4], DAY[4], DAY[4]), "other": ("active", DAY[0], DAY[1], DAY[0]),
    }
    assert after["s", "fail"].size_bytes == 10
    assert manifest.failures(plan) == 2
    summary = {r.source: r for r in manifest.run_summary(plan).collect()}["s"]
    assert (summary.n_listed, summary.n_new, summary.n_changed, summary.n_skipped, summary.n_failed, summary.n_removed) == (
        7, 1, 3, 1, 2, 1)
    assert (summary.active_before, summary.active_after) == (5, 6)
    assert summary.active_after == sum(r.status == "active" for (s, _), r in after.items() if s == "s")
    assert {r.relative_path for r in manifest.to_fetch(plan).collect()} == {"size", "date", "back", "new"}


def test_runs_equal_a_model_of_one_file(frame):
    """Random runs against what must become of a single file, worked out file by file."""
    rng = random.Random(11)
    known, model = empty(frame), {}
    paths = [f"f{i}" for i in range(40)]
    for day in DAY[:4]:
        files, expected = [], {}
        for path in paths:
            size, time, failed = rng.choice([1, 2, None]), rng.choice([T0, None]), rng.random() < 0.2
            before = model.get(path)
            if rng.random() < 0.3:
                if before:
                    expected[path] = {**before, "status": "removed"}
                continue
            files.append(("s", path, size, time, failed))
            known_as = before and before["status"] == "active"
            same = known_as and size in (None, before["size"]) and time in (None, before["time"])
            if failed and not same:
                if before:
                    expected[path] = before
                continue
            expected[path] = {
                "status": "active", "size": size, "time": time, "first": before["first"] if before else day, "seen": day,
                "got": before["got"] if same else day,
            }
        plan = manifest.plan_sync(known, listed(frame, *files, extra=", failed boolean"))
        after = manifest.apply_sync(plan, day).collect()
        model = expected
        assert {r.relative_path: (r.status, r.size_bytes, r.last_modified, r.first_seen_at, r.last_seen_at, r.last_ingested_at)
                for r in after} == {p: tuple(m[k] for k in ("status", "size", "time", "first", "seen", "got"))
                                    for p, m in model.items()}
        known = frame(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.MANIFEST.fields), *map(tuple, after))


def test_schema_is_the_declared_one(first):
    assert [(f.name, f.dataType) for f in first.schema.fields] == [(f.name, f.dataType) for f in S.MANIFEST.fields]


def test_rerun_changes_only_last_seen(frame, first):
    now = listed(frame, ("s", "same", 10, T0), ("s", "size", 11, None), ("s", "new", None, None))
    once = manifest.apply_sync(manifest.plan_sync(first, now), DAY[4])
    plan = manifest.plan_sync(once, now)
    assert set(actions(plan).values()) == {"skipped", "kept"}
    twice = manifest.apply_sync(plan, DAY[5])
    assert rows(once.drop("last_seen_at")) == rows(twice.drop("last_seen_at"))


def test_empty_listing_removes_only_the_sources_in_scope(frame, first):
    none = listed(frame)
    after = rows(manifest.apply_sync(manifest.plan_sync(first, none, sources=["s"]), DAY[4]))
    assert {r.status for (s, _), r in after.items() if s == "s"} == {"removed"}
    assert after["t", "other"].status == "active"


def test_unknown_size_and_time_do_not_count_as_change(frame, first):
    plan = manifest.plan_sync(first, listed(frame, ("s", "same", None, None)), sources=[])
    assert actions(plan)["s", "same"] == "skipped"


def test_hash_decides_where_known(frame):
    extra = ", content_hash string"
    one = listed(frame, ("p", "doc", 5, None, "h1"), extra=extra)
    first = manifest.apply_sync(manifest.plan_sync(empty(frame), one), DAY[0])
    same = listed(frame, ("p", "doc", 6, "later", "h1"), extra=extra)
    other = listed(frame, ("p", "doc", 5, None, "h2"), extra=extra)
    assert actions(manifest.plan_sync(first, same)) == {("p", "doc"): "skipped"}
    plan = manifest.plan_sync(first, other)
    assert actions(plan) == {("p", "doc"): "changed"}
    row = rows(manifest.apply_sync(plan, DAY[1]))["p", "doc"]
    assert (row.content_hash, row.first_seen_at, row.last_ingested_at) == ("h2", DAY[0], DAY[1])


def test_missing_landed_copy_is_fetched_again(frame, first):
    now = listed(frame, ("s", "same", 10, T0), ("s", "size", 10, T0))
    landed = frame("source string, relative_path string", ("s", "same"))
    plan = manifest.plan_sync(first, manifest.with_landed(now, landed), sources=[])
    got = actions(plan)
    assert (got["s", "same"], got["s", "size"]) == ("skipped", "changed")


def test_fetched_content_is_entered_and_its_absence_is_a_failure(frame, first):
    now = listed(frame, ("s", "size", 11, T0), ("s", "new", None, None), ("s", "late", 1, T0), ("s", "same", 10, T0))
    fetched = frame("source string, relative_path string, content_hash string, content_bytes int",
                    ("s", "size", "h", 11), ("s", "new", "n", 77))
    plan = manifest.with_fetched(manifest.plan_sync(first, now, sources=[]), fetched)
    got = actions(plan)
    assert (got["s", "size"], got["s", "new"], got["s", "late"], got["s", "same"]) == ("changed", "new", "failed", "skipped")
    after = rows(manifest.apply_sync(plan, DAY[4]))
    assert (after["s", "new"].size_bytes, after["s", "new"].content_hash) == (77, "n")
    assert after["s", "size"].content_hash == "h"
    assert ("s", "late") not in after


def test_file_listed_twice_is_refused(frame):
    twice = listed(frame, ("s", "a", 1, T0), ("s", "a", 2, T0))
    with pytest.raises(RuleViolation, match="s/a"):
        manifest.check_listing(twice)
    manifest.check_listing(twice.limit(1))


def test_runs_over_a_lake(spark, frame, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    got = frame("source string, relative_path string, content_hash string, content_bytes int", ("s", "a", "h", 1))
    for day, size in ((0, 1), (1, 1), (2, 2)):
        planned = sync.plan(lake, listed(frame, ("s", "a", size, T0)), sources=["s"])
        assert sync.finish(lake, planned, DAY[day], fetched=got).first().n_listed == 1
    row = lake.read(sync.TABLE).first()
    assert (row.first_seen_at, row.last_seen_at, row.last_ingested_at, row.size_bytes) == (DAY[0], DAY[2], DAY[2], 2)

    planned = sync.plan(lake, listed(frame, ("s", "b", 1, T0)), sources=["s"])
    with pytest.raises(sync.SyncFailed, match="1 files"):
        sync.finish(lake, planned, DAY[3], fetched=got)
    assert [(r.relative_path, r.status) for r in lake.read(sync.TABLE).collect()] == [("a", "removed")]


# --- checks on whole inputs -----------------------------------------------------------------


def test_drift_report(spark, tmp_path):
    declared = S.OBSERVATIONS
    headers = {
        "ok": "Series_ID   \tyear\tperiod\t  value\tfootnote_codes\r\nA\t1\tQ01\t1\t\n",
        "swapped": "year\tseries_id\tperiod\tvalue\tfootnote_codes\n",
        "grown": "series_id\tyear\tperiod\tvalue\tfootnote_codes\tunit",
        "cut": "series_id\tyear\tvalue\tfootnote_codes\n" + "x" * 200_000,
    }
    for name, text in headers.items():
        (tmp_path / name).write_text(text, newline="")
    found = checks.headers(spark, str(tmp_path))
    got = {r.relative_path: (r.missing, r.extra, r.reordered, r.drifted) for r in checks.drift_report(found, declared).collect()}
    assert got == {
        "ok": ("", "", False, False), "swapped": ("", "", True, True), "grown": ("", "unit", False, True),
        "cut": ("period", "", False, True),
    }


def test_freshness(frame):
    df = frame("source string, last_ingested_at timestamp", ("a", DAY[0]), ("a", DAY[3]), ("b", DAY[0]), ("c", None))
    got = {r.source: (r.age_seconds, r.stale) for r in checks.freshness(
        df, "source", "last_ingested_at", DAY[4], limit=dt.timedelta(days=2)).collect()}
    assert got == {"a": (86400, False), "b": (4 * 86400, True), "c": (None, True)}


def test_a_file_fetched_twice_is_an_error(frame):
    from serieslake.operators.manifest import with_fetched

    plan = frame("source string, relative_path string, action string", ("s", "a", "new"))
    twice = frame("source string, relative_path string, content_hash string, content_bytes bigint", ("s", "a", "h", 1), ("s", "a", "g", 2))
    with pytest.raises(RuleViolation, match="fetched more than once: s/a"):
        with_fetched(plan, twice)
