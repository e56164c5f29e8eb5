"""The datasets of the three layers: how each is built and which rules it must meet."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from serieslake import schemas as S
from serieslake.functions import to_type
from serieslake.operators import summary
from serieslake.operators.layout import if_light
from serieslake.operators.decode import Lookup, decode, duplicate_codes, labelled
from serieslake.operators.reconcile import KEYS, VALUE, reconcile
from serieslake.operators.rules import DROP, FAIL, WARN, Rule, RuleViolation
from serieslake.plans.lake import Lake
from serieslake.sources.documents import flatten, read_documents
from serieslake.sources.text import MALFORMED, read_padded

# Rule names and conditions of each dataset.
OBSERVATION_KEYS = Rule("non_null_keys", "series_id IS NOT NULL AND year IS NOT NULL AND period IS NOT NULL", DROP)
RULES: dict[str, list[Rule]] = {
    "bronze.series": [Rule("non_null_series_id", "series_id IS NOT NULL AND trim(series_id) != ''", DROP)],
    "bronze.observations_current": [OBSERVATION_KEYS],
    "bronze.observations_all": [OBSERVATION_KEYS],
    "bronze.sector": [Rule("non_null_sector_code", "sector_code IS NOT NULL", DROP)],
    "bronze.class": [Rule("non_null_class_code", "class_code IS NOT NULL", DROP)],
    "bronze.measure": [Rule("non_null_measure_code", "measure_code IS NOT NULL", DROP)],
    "bronze.duration": [Rule("non_null_duration_code", "duration_code IS NOT NULL", DROP)],
    "bronze.seasonal": [Rule("non_null_seasonal_code", "seasonal_code IS NOT NULL", DROP)],
    "bronze.period": [Rule("non_null_period", "period IS NOT NULL", DROP)],
    "bronze.footnote": [Rule("non_null_footnote_code", "footnote_code IS NOT NULL", DROP)],
    "bronze.population": [
        Rule("non_null_keys", "`Nation ID` IS NOT NULL AND `Year` IS NOT NULL AND `Population` IS NOT NULL", DROP)
    ],
    "silver.population": [
        Rule("non_null_keys", "nation_id IS NOT NULL AND year IS NOT NULL AND population IS NOT NULL", DROP)
    ],
    "silver.observations": [
        OBSERVATION_KEYS,
        Rule("valid_period", "period IN ('Q01', 'Q02', 'Q03', 'Q04', 'Q05')", DROP),
        Rule("has_value", "value IS NOT NULL", WARN),
    ],
    "silver.series": [Rule("non_null_series_id", "series_id IS NOT NULL", DROP)],
    "gold.population_stats": [Rule("has_mean", "mean_population IS NOT NULL", FAIL)],
    "gold.best_year": [
        Rule("non_null_series_id", "series_id IS NOT NULL", DROP),
        Rule("non_null_best_year", "best_year IS NOT NULL", DROP),
    ],
    "gold.series_by_year": [Rule("non_null_year", "year IS NOT NULL", DROP)],
}

# Counts observations whose value is there but cannot be stored: no number, not finite, or of 19 digits before the
# point and more.  Silver reads them as NULL; digits behind the tenth decimal are rounded.
VALUE_PARSES = Rule("value_parses", f"coalesce(trim(value), '') = '' OR try_cast(trim(value) AS {VALUE}) IS NOT NULL", WARN)

# How some tables are published: an empty silver table is refused, as it breaks no row rule.
PUBLISH: dict[str, dict] = {
    "silver.population": {"min_rows": 1},
    "silver.observations": {"min_rows": 1},
    "silver.series": {"min_rows": 1},
}

# The text extracts that are stored as they come.
EXTRACTS: dict[str, T.StructType] = {
    "series": S.SERIES,
    "observations_current": S.OBSERVATIONS,
    "observations_all": S.OBSERVATIONS,
    "sector": S.SECTOR,
    "class": S.CLASS,
    "measure": S.MEASURE,
    "duration": S.DURATION,
    "seasonal": S.SEASONAL,
    "period": S.PERIOD,
    "footnote": S.FOOTNOTE,
}

# How a series reads, and what stands in for an unknown code.
SERIES_LABEL = "{sector_name}: {class_text}, {measure_text}, {duration_text} ({seasonal_text})"
UNKNOWN = {
    "sector_name": "Unknown sector",
    "class_text": "unknown class",
    "measure_text": "unknown measure",
    "duration_text": "unknown duration",
    "seasonal_text": "unknown seasonality",
}


def bronze_extract(
    spark: SparkSession, name: str, path: str, *, check_header: bool = True, malformed: bool = False
) -> DataFrame:
    return read_padded(spark, path, EXTRACTS[name], check_header=check_header, malformed=malformed)


def bronze_population(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    return flatten(read_documents(spark, path, S.POPULATION_RECORD, lines=lines))


def silver_population(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("`Nation ID`").alias("nation_id"),
        F.col("Nation").alias("nation"),
        F.coalesce(F.trim("Year").try_cast("int"), F.trim("Year").try_cast("double").try_cast("int")).alias("year"),
        F.trim("Population").try_cast("double").alias("population"),
    )


def silver_observations(current: DataFrame, history: DataFrame, *, by: str | None = None) -> DataFrame:
    return reconcile([current, history], by=by)


def series_lookups(tables: Mapping[str, DataFrame]) -> list[Lookup]:
    """The five code lists that make up a series label."""

    def lookup(table: str, code: str, text: str, on: str | None = None) -> Lookup:
        return Lookup(tables[table], code, text, UNKNOWN[text], on)

    return [
        lookup("sector", "sector_code", "sector_name"),
        lookup("class", "class_code", "class_text"),
        lookup("measure", "measure_code", "measure_text"),
        lookup("duration", "duration_code", "duration_text"),
        lookup("seasonal", "seasonal_code", "seasonal_text", on="seasonal"),
    ]


def silver_series(series: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    lookups = series_lookups(tables)
    decoded = labelled(decode(series, lookups), lookups, SERIES_LABEL, "series_label")
    coded = [
        column for lookup in lookups for column in (F.col(lookup.fact).alias(lookup.code), F.col(lookup.text))
    ]
    coverage = [
        to_type("begin_year", "int").alias("begin_year"), F.col("begin_period"),
        to_type("end_year", "int").alias("end_year"), F.col("end_period"),
    ]
    return decoded.select("series_id", "series_label", *coded, *coverage)


def gold_population_stats(population: DataFrame, *, nation: str, first: int, last: int) -> DataFrame:
    return summary.range_summary(
        population, year="year", value="population", first=first, last=last, where=F.col("nation") == nation
    )


def gold_best_year(observations: DataFrame, series: DataFrame) -> DataFrame:
    best = summary.best_period(summary.period_totals(observations, S.QUARTERS))
    return summary.with_dimension(best, series, "series_id", ["series_label"]).select(
        "series_id", "series_label", "best_year", F.col("total_value").cast("double").alias("total_value")
    )


def gold_series_by_year(
    observations: DataFrame, population: DataFrame, *, series_id: str, period: str, nation: str
) -> DataFrame:
    chosen = observations.filter((F.col("series_id") == series_id) & (F.col("period") == period))
    chosen = chosen.withColumn("value", F.col("value").cast("double"))
    yearly = population.filter(F.col("nation") == nation)
    return summary.aligned_series(chosen, yearly, columns=["year", "value"], measure="population")


def check_lookups(lookups: Sequence[Lookup]) -> None:
    """A code listed twice would multiply the series that carry it; raise instead."""
    twice = reduce(DataFrame.unionAll, [
        duplicate_codes(lookup).select(F.lit(lookup.code).alias("list"), F.col("code").cast("string")) for lookup in lookups
    ]).first()
    if twice:
        raise RuleViolation(f"{twice['list']} {twice['code']!r} is listed more than once")


def _publish_all(
    lake: Lake, tables: Mapping[str, DataFrame], run_at: dt.datetime, malformed: str | None = None, **layouts: dict
) -> None:
    """Publish the tables of one layer; they do not depend on each other, so their jobs may overlap."""

    def publish(name: str, df: DataFrame) -> None:
        rules, options = list(RULES[name]), {**PUBLISH.get(name, {}), **layouts.get(name, {})}
        if MALFORMED in df.columns:
            rules.append(Rule("well_formed", f"{MALFORMED} IS NULL", malformed))
            options["rule_columns"] = [MALFORMED]
        if name.startswith("bronze.observations"):
            rules.append(VALUE_PARSES)
        lake.publish(df, name, rules, run_at=run_at, **options)

    with ThreadPoolExecutor(max_workers=8) as pool:
        for done in [pool.submit(publish, name, df) for name, df in tables.items()]:
            done.result()


def refresh_bronze(
    lake: Lake, files: Mapping[str, str], run_at: dt.datetime, *, document_lines: bool = False,
    check_headers: bool = True, malformed: str = WARN,
) -> None:
    """Store the landed files; ``files`` maps the extracts and ``population`` to paths.

    Lines with a wrong field count are counted, and ``malformed`` says what becomes of them:
    warn keeps them (filled up with NULLs, or cut), drop leaves them out, fail refuses the file.
    """
    tables = {
        f"bronze.{name}": bronze_extract(lake.spark, name, files[name], check_header=check_headers, malformed=True)
        for name in EXTRACTS
    }
    tables["bronze.population"] = bronze_population(lake.spark, files["population"], lines=document_lines)
    _publish_all(lake, tables, run_at, malformed)


def refresh_silver(lake: Lake, run_at: dt.datetime) -> None:
    """Typed, deduplicated and decoded tables.

    Observations are stored in buckets of the series, sorted by their key, so that totals and best years shuffle nothing
    and one series is read from few row groups.  If a series is too heavy for a task they are sorted over all files instead.
    """
    lists = {name: lake.read(f"bronze.{name}") for name in ("sector", "class", "measure", "duration", "seasonal")}
    check_lookups(series_lookups(lists))
    current, history = lake.read("bronze.observations_current"), lake.read("bronze.observations_all")
    by = if_light([current, history], "series_id")
    layout = {"bucket_by": by, "sort_by": KEYS} if by else {"cluster_by": KEYS}
    _publish_all(lake, {
        "silver.population": silver_population(lake.read("bronze.population")),
        "silver.observations": silver_observations(current, history, by=by),
        "silver.series": silver_series(lake.read("bronze.series"), lists),
    }, run_at, **{"silver.observations": layout})


def refresh_gold(
    lake: Lake, run_at: dt.datetime, *, nation: str, first: int, last: int, series_id: str,
    period: str = S.QUARTERS[0], observations: DataFrame | None = None,
) -> None:
    """The answers; ``observations`` may come from an incremental state instead of the silver table."""
    observations = lake.read("silver.observations") if observations is None else observations
    population = lake.read("silver.population")
    _publish_all(lake, {
        "gold.population_stats": gold_population_stats(population, nation=nation, first=first, last=last),
        "gold.best_year": gold_best_year(observations, lake.read("silver.series")),
        "gold.series_by_year": gold_series_by_year(
            observations, population, series_id=series_id, period=period, nation=nation),
    }, run_at)


def refresh(
    lake: Lake, files: Mapping[str, str], run_at: dt.datetime, *, nation: str, first: int, last: int,
    series_id: str, period: str = S.QUARTERS[0], **landed: object,
) -> None:
    """Full refresh of all layers; every layer reads the published layer below it.

    ``landed`` are the options of ``refresh_bronze``.
    """
    refresh_bronze(lake, files, run_at, **landed)
    refresh_silver(lake, run_at)
    refresh_gold(lake, run_at, nation=nation, first=first, last=last, series_id=series_id, period=period)
