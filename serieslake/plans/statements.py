"""The gold answers as SQL over named tables; equal to their DataFrame forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from serieslake.schemas import QUARTERS

POPULATION_STATS = """
    SELECT :first AS year_start, :last AS year_end, count(*) AS n_years,
           avg(population) AS mean_population, stddev_samp(population) AS stddev_population
    FROM IDENTIFIER(:population)
    WHERE nation = :nation AND year >= :first AND year <= :last
"""

BEST_YEAR = f"""
    SELECT best.series_id, series.series_label, best.year AS best_year, CAST(best.total_value AS DOUBLE) AS total_value
    FROM (
        SELECT series_id, year, sum(value) AS total_value,
               row_number() OVER (PARTITION BY series_id ORDER BY sum(value) DESC NULLS LAST, year) AS spot
        FROM IDENTIFIER(:observations)
        WHERE period IN {QUARTERS}
        GROUP BY series_id, year
    ) AS best
    INNER JOIN IDENTIFIER(:series) AS series ON series.series_id = best.series_id
    WHERE best.spot = 1
"""

SERIES_BY_YEAR = """
    SELECT seen.year, CAST(seen.value AS DOUBLE) AS value, outside.population
    FROM IDENTIFIER(:observations) AS seen
    LEFT JOIN (SELECT year, population FROM IDENTIFIER(:population) WHERE nation = :nation) AS outside
        ON outside.year = seen.year
    WHERE seen.series_id = :series_id AND seen.period = :period
    ORDER BY seen.year
"""


def run(spark: SparkSession, statement: str, **arguments: object) -> DataFrame:
    """Table names and values are bound as parameters, never pasted into the text."""
    return spark.sql(statement, args=arguments)
