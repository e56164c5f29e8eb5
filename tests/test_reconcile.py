"""Reconciliation, decoding and the answers, on hand-written rows."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from serieslake import schemas as S
from serieslake.operators import decode, median, summary
from serieslake.operators.reconcile import overlay, reconcile
from serieslake.operators.rules import keep_valid
from serieslake.plans import datasets

RAW = "series_id string, year string, period string, value string, footnote_codes string"
OBS = "series_id string, year int, period string, value double"


def rows_of(df, *order):
    plain = lambda v: float(v) if isinstance(v, Decimal) else v
    return [tuple(map(plain, r)) for r in df.orderBy(*(order or df.columns)).collect()]


def test_preferred_release_wins(frame):
    current = frame(RAW, ("A", "2001", "Q01", " 9.0 ", None))
    history = frame(RAW, ("A  ", "2001", "Q01", "1.0", "R"), ("A", "2000", "Q01", "2.0", None))
    assert rows_of(reconcile([current, history])) == [("A", 2000, "Q01", 2.0, None), ("A", 2001, "Q01", 9.0, None)]


def test_preferred_null_wins_unless_a_value_is_preferred(frame):
    current = frame(RAW, ("A", "2001", "Q01", "-", None))
    history = frame(RAW, ("A", "2001", "Q01", "2.6", None))
    assert rows_of(reconcile([current, history])) == [("A", 2001, "Q01", None, None)]
    assert rows_of(reconcile([current, history], prefer_present="value")) == [("A", 2001, "Q01", 2.6, None)]


def test_repeats_within_a_release_do_not_depend_on_order(frame):
    rows = [("A", "2001", "Q01", v, f) for v, f in (("3", None), ("2", "b"), ("2", "a"), (None, None))]
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        seen.add(tuple(rows_of(reconcile([frame(RAW, *rows).repartition(3)]))))
    assert seen == {(("A", 2001, "Q01", 2.0, "a"),)}


def test_overlay_equals_reconcile_for_unique_releases(frame):
    schema = OBS + ", footnote_codes string"
    key = lambda i: ("ABC"[i % 3], 2000 + i % 4, f"Q0{1 + i % 2}")
    releases = [
        frame(schema, *{key(i): (*key(i), float(100 * n + i), None) for i in range(n, 12, n + 2)}.values()) for n in (0, 1, 2)
    ]
    text = [r.select(*[F.col(c).cast("string") for c in r.columns]) for r in releases]
    assert rows_of(overlay(releases)) == rows_of(reconcile(text))


def test_silver_rules_drop_bad_keys_and_periods(frame):
    raw = frame(RAW, ("A", "2001", "Q01", "1", None), ("A", "2001", "M13", "1", None), ("A", "20x1", "Q01", "1", None),
                (None, "2001", "Q01", "1", None), ("A", "2001", "Q05", None, None), ("A", "2001", None, "1", None))
    kept = keep_valid(reconcile([raw]), datasets.RULES["silver.observations"])
    assert rows_of(kept.select("period", "value")) == [("Q01", 1.0), ("Q05", None)]


def test_yearly_average_is_not_a_part(frame):
    obs = frame(OBS, ("A", 2000, "Q01", 1.0), ("A", 2000, "Q02", 2.0), ("A", 2000, "Q05", 100.0), ("B", 2000, "Q05", 5.0))
    assert rows_of(summary.period_totals(obs, S.QUARTERS)) == [("A", 2000, 3.0)]


def test_best_period_ties_and_missing_totals(frame):
    totals = frame("series_id string, year int, total_value double", ("A", 2001, 5.0), ("A", 1999, 5.0), ("A", 2002, None),
                   ("B", 2003, None), ("B", 2001, None), ("C", 2000, -1.0), ("C", 2001, None))
    assert rows_of(summary.best_period(totals)) == [("A", 1999, 5.0), ("B", 2001, None), ("C", 2000, -1.0)]


def test_one_pass_totals_equal_the_two_step_ones(frame):
    rng = random.Random(7)
    value = lambda: rng.choice([None, "-", *[f"{rng.randint(-50, 50) / 4}" for _ in range(6)]])
    rows = [
        [(rng.choice("ABC") + " ", str(rng.randint(2000, 2002)), rng.choice(["Q01", "Q02", "Q04", "Q05", None]), value(),
          rng.choice([None, "x"])) for _ in range(120)] for _ in range(2)
    ]
    releases = [frame(RAW, *r) for r in rows]
    two = summary.period_totals(reconcile(releases), S.QUARTERS)
    one = summary.reconciled_totals(releases, S.QUARTERS)
    assert rows_of(one, "series_id", "year") == rows_of(two, "series_id", "year")


def test_series_without_dimension_drops_out(frame):
    best = frame("series_id string, best_year int, total_value double", ("A", 2000, 1.0), ("Z", 2000, 1.0))
    dim = frame("series_id string, series_label string, x int", ("A", "label", 1))
    assert rows_of(summary.with_dimension(best, dim, "series_id", ["series_label"])) == [("A", 2000, 1.0, "label")]


POPULATION = "nation string, year int, population double"


def test_range_summary_edges(frame):
    df = frame(POPULATION, *[("X", y, float(y - 2000)) for y in range(2001, 2006)], ("Y", 2003, 1e9))
    ask = lambda first, last, **k: tuple(summary.range_summary(
        df, year="year", value="population", first=first, last=last, where=F.col("nation") == "X", **k).first())
    assert ask(2002, 2004) == (2002, 2004, 3, 3.0, 1.0)
    assert ask(2002, 2004, population=True)[4] == pytest.approx((2 / 3) ** 0.5)
    assert ask(2002, 2002) == (2002, 2002, 1, 2.0, None)
    assert ask(2002, 2002, population=True) == (2002, 2002, 1, 2.0, 0.0)
    assert ask(1900, 1901) == (1900, 1901, 0, None, None)


def test_alignment_keeps_years_without_measure(frame):
    obs = frame(OBS, ("A", 2000, "Q01", 1.0), ("A", 1999, "Q01", 2.0), ("A", 2000, "Q02", 9.0), ("B", 2000, "Q01", 8.0))
    population = frame(POPULATION, ("X", 2000, 10.0), ("Y", 2000, 20.0), ("Y", 1999, 30.0))
    got = datasets.gold_series_by_year(obs, population, series_id="A", period="Q01", nation="X")
    assert rows_of(got, "year") == [(1999, 2.0, None), (2000, 1.0, 10.0)]


def test_growth(frame):
    df = frame(POPULATION, ("X", 2013, 316.0), ("X", 2018, 327.0), ("X", 2015, 1.0), ("Y", 2000, 0.0), ("Y", 2001, 5.0),
               ("Z", 2000, None))
    got = {r.nation: r for r in summary.growth(df, ["nation"], year="year", value="population").collect()}
    assert (got["X"].change, got["X"].change_pct) == (11.0, 1100.0 / 316.0)
    assert (got["Y"].change, got["Y"].change_pct) == (5.0, None)
    assert "Z" not in got


def test_parts_check(frame):
    full = [("A", 2000, f"Q0{i}", float(i)) for i in range(1, 5)]
    obs = frame(OBS, *full, ("A", 2000, "Q05", 2.5), ("B", 2000, "Q01", 1.0), ("B", 2000, "Q05", 9.0),
                *[("C", *r[1:]) for r in full], ("C", 2000, "Q05", 2.6), *[("D", *r[1:]) for r in full])
    got = {r.series_id: r.agrees for r in summary.parts_check(obs, S.QUARTERS, S.ANNUAL).collect()}
    assert got == {"A": True, "B": None, "C": False, "D": None}
    loose = summary.parts_check(obs, S.QUARTERS, S.ANNUAL, tolerance=0.2)
    assert {r.series_id: r.agrees for r in loose.collect()}["C"] is True


# --- decoding -------------------------------------------------------------------------------


def lookup_tables(frame):
    five = lambda c, t: f"{c} string, {t} string, display_level string, selectable string, sort_sequence string"
    return {
        "sector": frame(five("sector_code", "sector_name"), ("3000", "Manufacturing", "0", "T", "1")),
        "class": frame(five("class_code", "class_text"), ("6", "All workers", "0", "T", "1")),
        "measure": frame(five("measure_code", "measure_text"), ("03", "Hours worked", "0", "T", "1")),
        "duration": frame(five("duration_code", "duration_text"), ("2", "% change", "0", "T", "1")),
        "seasonal": frame("seasonal_code string, seasonal_text string", ("S", "Seasonally Adjusted")),
    }


def series_rows(frame, *codes):
    schema = ", ".join(f"{f.name} string" for f in S.SERIES.fields)
    rows = [(*c, None, None, " 1987", "Q01", "x", "Q04") for c in codes]
    return frame(schema, *rows)


def test_series_label_and_unknown_codes(frame):
    series = series_rows(frame, ("A", "3000", "6", "03", "2", "S"), ("B", "9", None, "x", "", "U"))
    got = datasets.silver_series(series, lookup_tables(frame)).orderBy("series_id").collect()
    assert [r.series_label for r in got] == [
        "Manufacturing: All workers, Hours worked, % change (Seasonally Adjusted)",
        "Unknown sector: unknown class, unknown measure, unknown duration (unknown seasonality)",
    ]
    assert got[0].asDict() == {
        "series_id": "A", "series_label": got[0].series_label, "sector_code": "3000", "sector_name": "Manufacturing",
        "class_code": "6", "class_text": "All workers", "measure_code": "03", "measure_text": "Hours worked",
        "duration_code": "2", "duration_text": "% change", "seasonal_code": "S", "seasonal_text": "Seasonally Adjusted",
        "begin_year": 1987, "begin_period": "Q01", "end_year": None, "end_period": "Q04",
    }


def test_duplicate_lookup_codes_multiply_and_are_found(frame):
    tables = lookup_tables(frame)
    tables["sector"] = tables["sector"].unionAll(tables["sector"])
    lookup = datasets.series_lookups(tables)[0]
    assert rows_of(decode.duplicate_codes(lookup)) == [("3000", 2)]
    series = series_rows(frame, ("A", "3000", "6", "03", "2", "S"))
    assert decode.decode(series, [lookup]).count() == 2


def test_unknown_codes_are_counted(frame):
    lookups = datasets.series_lookups(lookup_tables(frame))
    series = series_rows(frame, *[(s, c, "6", "03", "2", "S") for s, c in (("A", "3000"), ("B", "1"), ("C", "1"), ("D", None))])
    got = {(r.lookup, r.code, r.n) for r in decode.unknown_codes(series, lookups).collect()}
    assert got == {("sector_name", "1", 2), ("sector_name", None, 1)}


def test_footnote_lists(frame):
    lookup = decode.Lookup(frame("footnote_code string, footnote_text string", ("R", "Revised")), "footnote_code",
                           "footnote_text", "unknown footnote")
    got = decode.decode_list(frame("k int, codes string", (1, "R, x"), (2, None), (3, "")), "codes", lookup)
    assert {(r.k, r.footnote_code, r.footnote_text) for r in got.collect()} == {
        (1, "R", "Revised"), (1, "x", "unknown footnote"), (2, None, None), (3, None, None)}


# --- exact median ---------------------------------------------------------------------------


def test_median_of_groups(frame):
    import statistics

    rng = random.Random(3)
    groups = {
        "wide": [rng.randint(-(2**62), 2**62) for _ in range(201)],
        "bounds": [-(2**63), 2**63 - 1, 2**63 - 1, -(2**63), 2**63 - 1],
        "high": [2**62 + 5, 2**62 + 9],
        "even": [rng.randint(0, 10**6) for _ in range(100)],
        "same": [7] * 50,
        "one": [-3],
        "hot": [5] * 300 + [rng.randint(0, 9) for _ in range(31)],
        None: [1, 2],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("even", None), ("void", None)]
    rng.shuffle(rows)
    df = frame("k string, v bigint", *rows).repartition(5)
    got = {r.k: r.median for r in median.exact_median(df, ["k"], "v", scale=2).collect()}
    assert set(got) == set(groups)
    for key, values in groups.items():
        assert got[key] == pytest.approx(statistics.median(values) / 100, rel=1e-15)


def test_median_of_nothing(frame):
    assert median.exact_median(frame("k string, v bigint"), ["k"], "v").count() == 0


def test_equal_totals_tie_whatever_their_parts(frame):
    raw = [("A", str(y), f"Q0{q}", v, None) for y, values in ((2000, ("0.3", "0.2", "0.1")), (2001, ("0.1", "0.2", "0.3"))) for q, v in enumerate(values, 1)]
    observations = datasets.silver_observations(frame(RAW, *raw), frame(RAW))
    best = datasets.gold_best_year(observations, frame("series_id string, series_label string", ("A", "a")))
    assert rows_of(best) == [("A", "a", 2000, 0.6)]
