"""The library's inputs, derived from the given tables by Spark."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from serieslake import schemas as S
from serieslake.functions import instant

RUN_AT = dt.datetime(2026, 1, 2)
FIRST_SEEN = dt.datetime(2025, 12, 1)
SITE = "https://data.example.org/"


# The given tables, declared so that reading one needs no look at its files.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf}/{name}.parquet")


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


# --- observations ---------------------------------------------------------------------------


def quarter_values(spark: SparkSession, sf: str, since: str | None = None) -> DataFrame:
    """Quarterly order value per customer, plus the yearly value over four as ``Q05``."""
    orders = table(spark, sf, "orders")
    if since:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz"))
    paid = orders.select(
        "o_custkey", F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"),
        money("o_totalprice").alias("paid"),
    )
    quarters = [F.sum(F.when(F.col("quarter") == i, F.col("paid"))) for i in range(1, 5)]
    yearly = (F.sum("paid") * F.lit(0.25).cast("decimal(3,2)")).cast("decimal(18,4)")
    parts = dict(zip([*S.QUARTERS, S.ANNUAL], [*quarters, yearly], strict=True))
    wide = paid.groupBy("o_custkey", "year").agg(*[column.alias(name) for name, column in parts.items()])
    long = F.array(*[
        F.struct(F.lit(name).alias("period"), F.col(name).cast("decimal(18,4)").alias("value")) for name in parts
    ])
    return wide.select(text("o_custkey").alias("series_id"), "year", F.inline(long)).filter("value IS NOT NULL")


def as_text(values: DataFrame, footnote: str | None = None) -> DataFrame:
    """The same rows as the padded text a raw extract holds."""
    return values.select(
        F.rpad("series_id", 17, " ").alias("series_id"),
        text("year").alias("year"),
        F.concat(F.col("period"), F.lit(" ")).alias("period"),
        F.lpad(text("value"), 24, " ").alias("value"),
        F.lit(footnote).cast("string").alias("footnote_codes"),
    )


def history(spark: SparkSession, sf: str) -> DataFrame:
    return as_text(quarter_values(spark, sf))


def current(spark: SparkSession, sf: str) -> DataFrame:
    """The revised release: the last year, every value higher by 1000."""
    revised = F.col("value") + F.lit(1000)
    values = quarter_values(spark, sf, since="2001-01-01").withColumn("value", revised.cast("decimal(18,4)"))
    return as_text(values, footnote="R")


def repeated(spark: SparkSession, sf: str, open_only: bool = False) -> DataFrame:
    """A release that repeats keys: one row per order line, by part and quarter of shipping."""
    lines = table(spark, sf, "lineitem")
    if open_only:
        lines = lines.filter("l_linestatus = 'O'")
    return lines.select(
        F.concat(text("l_partkey"), F.lit("  ")).alias("series_id"),
        text(F.year("l_shipdate")).alias("year"),
        F.concat(F.lit("Q0"), text(F.quarter("l_shipdate"))).alias("period"),
        F.lpad(text(F.col("l_quantity").cast("decimal(18,2)")), 12, " ").alias("value"),
        F.col("l_returnflag").alias("footnote_codes"),
    )


# --- series and lookups ---------------------------------------------------------------------


def series(spark: SparkSession, sf: str) -> DataFrame:
    """One series per customer, with codes, and its coverage from the orders."""
    orders = table(spark, sf, "orders")
    at = F.year("o_orderdate") * 10 + F.quarter("o_orderdate")
    coverage = orders.groupBy("o_custkey").agg(F.min(at).alias("begin"), F.max(at).alias("end"))
    customers = table(spark, sf, "customer").join(
        table(spark, sf, "nation").select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    joined = customers.join(coverage, F.col("c_custkey") == F.col("o_custkey"), "left")
    year = lambda end: F.expr(f"{end} div 10")
    period = lambda end: F.concat(F.lit("Q0"), text(F.col(end) % 10))
    columns = {
        "series_id": text("c_custkey"),
        "sector_code": text("c_nationkey"),
        "class_code": text("n_regionkey"),
        "measure_code": F.col("c_mktsegment"),
        "duration_code": text(year("end") - year("begin")),
        "seasonal": F.when(F.col("c_acctbal") < 0, "U").otherwise("S"),
        "base_year": F.lit(None).cast("string"),
        "footnote_codes": F.lit(None).cast("string"),
        "begin_year": text(year("begin")),
        "begin_period": period("begin"),
        "end_year": text(year("end")),
        "end_period": period("end"),
    }
    return joined.select(*[column.alias(name) for name, column in columns.items()])


def _lookup(rows: DataFrame, schema, code: Column, description: Column) -> DataFrame:
    names = schema.fieldNames()
    display = {"display_level": F.lit("0"), "selectable": F.lit("T"), "sort_sequence": code}
    return rows.select(
        code.alias(names[0]), description.alias(names[1]),
        *[display[name].cast("string").alias(name) for name in names[2:]],
    )


def lookups(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Code lists; nations from 20 up and year spans from 5 up are left unknown."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    customer = table(spark, sf, "customer")
    segments = customer.select("c_mktsegment").distinct()
    signs = customer.select(F.when(F.col("c_acctbal") < 0, "U").otherwise("S").alias("code")).distinct()
    sign_text = F.when(F.col("code") == "S", "Seasonally Adjusted").otherwise("Not Seasonally Adjusted")
    return {
        "sector": _lookup(nation.filter("n_nationkey < 20"), S.SECTOR, text("n_nationkey"), F.col("n_name")),
        "class": _lookup(region, S.CLASS, text("r_regionkey"), F.col("r_name")),
        "measure": _lookup(segments, S.MEASURE, F.col("c_mktsegment"), F.initcap(F.lower("c_mktsegment"))),
        "duration": _lookup(region, S.DURATION, text("r_regionkey"), F.concat(text("r_regionkey"), F.lit(" years"))),
        "seasonal": _lookup(signs, S.SEASONAL, F.col("code"), sign_text),
    }


def periods(spark: SparkSession, sf: str) -> DataFrame:
    """The period code list: (period, period_abbr, period_name)."""
    quarter = F.quarter("o_orderdate").alias("q")
    return table(spark, sf, "orders").select(quarter).distinct().select(
        F.concat(F.lit("Q0"), text("q")).alias("period"),
        F.concat(F.lit("QTR"), text("q")).alias("period_abbr"),
        F.concat(F.lit("Quarter "), text("q")).alias("period_name"),
    )


def footnotes(spark: SparkSession, sf: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(priority).distinct().select(
        F.substring(priority, 1, 1).alias("footnote_code"), F.substring(priority, 3, 20).alias("footnote_text")
    )


# --- population -----------------------------------------------------------------------------


def nation_years(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly order value per nation, without 1998; summed per customer before the join."""
    spent = table(spark, sf, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.sum(money("o_totalprice")).alias("spent")
    ).filter("year <> 1998")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    totals = spent.join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey", "year").agg(
        F.sum("spent").cast("double").alias("population")
    )
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return totals.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_nationkey").cast("string").alias("nation_id"), F.col("n_name").alias("nation"), "year", "population"
    )


def population_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One nested document per nation; a nation has one record per year."""
    record = F.struct(
        F.col("nation_id").alias("Nation ID"), F.col("nation").alias("Nation"),
        F.col("year").alias("Year"), F.col("population").alias("Population"),
    )
    return nation_years(spark, sf).groupBy("nation_id").agg(F.sort_array(F.collect_list(record)).alias("data")).select(
        F.struct(
            F.struct(F.lit("orders").alias("topic")).alias("annotations"),
            F.struct(F.lit(0).alias("offset")).alias("page"),
            F.array(F.lit("Nation"), F.lit("Year"), F.lit("Population")).alias("columns"),
            "data",
        ).alias("document")
    )


def one_document(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a single, pretty-printed document with all records, and other members around them."""
    records = nation_years(spark, sf).select(
        F.to_json(F.struct(
            F.col("nation_id").alias("Nation ID"), F.col("nation").alias("Nation"), F.col("year").alias("Year"), F.col("population").alias("Population"),
            F.lit('} "quoted" ]{').alias("note"),
        ), {"pretty": "true"}).alias("record"),
        F.row_number().over(Window.orderBy("nation_id", "year")).alias("at"),
    )
    lines = records.select("at", F.concat(F.when(F.col("at") > 1, ",").otherwise(""), F.col("record")).alias("value"))
    around = {0: '{\n  "source": [{"data": [{"Nation": "none"}]}],\n  "data": [', 1 << 30: '],\n  "page": {"data": {"Nation": "none"}}\n}'}
    ends = spark.range(0, 1, 1, 1).select(F.inline(F.array(*[F.struct(F.lit(k).alias("at"), F.lit(v).alias("value")) for k, v in around.items()])))
    return lines.unionByName(ends).coalesce(1).sortWithinPartitions("at").select("value")


# --- landed files ---------------------------------------------------------------------------


def _path() -> Column:
    return F.concat(F.lit("doc/"), text("doc_id"), F.lit(".txt"))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels")
    return table(spark, sf, "documents").join(labels, "doc_id", "left")


def listing(spark: SparkSession, sf: str) -> DataFrame:
    """What the sources list now: all documents but the toxic ones.

    English documents are known by content hash, the others by size and time; those of
    quality 0 cannot be fetched.
    """
    rows = _documents(spark, sf).filter("coalesce(toxic, 0) = 0")
    return rows.select(
        "source", _path().alias("relative_path"),
        F.concat(F.lit(SITE), "source", F.lit("/"), _path()).alias("remote_url"),
        F.col("n_chars").alias("size_bytes"),
        F.lit("1/2/2026 8:30 AM").alias("last_modified"),
        F.when(F.col("lang") == "en", F.sha2("text", 256)).alias("content_hash"),
        F.coalesce(F.col("quality") == 0, F.lit(False)).alias("failed"),
    )


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """What was known before: all but the Spanish documents.

    Those of quality 1 had another size and hash; the German ones of one source were
    marked removed.
    """
    rows = _documents(spark, sf).filter("lang <> 'es'")
    older = F.coalesce(F.col("quality") == 1, F.lit(False))
    seen = instant(FIRST_SEEN)
    return rows.select(
        "source", _path().alias("relative_path"),
        F.concat(F.lit(SITE), "source", F.lit("/"), _path()).alias("remote_url"),
        F.when(older, F.col("n_chars") + 10).otherwise(F.col("n_chars")).alias("size_bytes"),
        F.lit("1/2/2026 8:30 AM").alias("last_modified"),
        F.when(older, F.lit("0")).otherwise(F.sha2("text", 256)).alias("content_hash"),
        F.when((F.col("lang") == "de") & (F.col("source") == "src0"), "removed").otherwise("active").alias("status"),
        seen.alias("first_seen_at"), seen.alias("last_seen_at"), seen.alias("last_ingested_at"),
    )


def landed(spark: SparkSession, sf: str) -> DataFrame:
    """Copies that are there: all but the French ones of one source."""
    return table(spark, sf, "documents").filter("NOT (lang = 'fr' AND source = 'src3')").select(
        "source", _path().alias("relative_path")
    )


def file_contents(spark: SparkSession, sf: str) -> DataFrame:
    """Files to land, one per document: hidden names by language, some without bytes, some that are no UTF-8."""
    mark = F.when(F.col("lang") == "de", "_").when(F.col("lang") == "fr", ".").otherwise("")
    whole = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    content = F.when(F.col("doc_id") % 7 == 0, F.lit(b"")).when(F.col("doc_id") % 11 == 3, F.concat(whole, F.lit(b"\xff"))).otherwise(whole)
    return table(spark, sf, "documents").select(F.concat("source", F.lit("/"), mark, text("doc_id"), F.lit(".txt")).alias("relative_path"), content.alias("content"))


def drifting_extracts(spark: SparkSession, sf: str) -> DataFrame:
    """A file per source whose header follows from its rows: a column lacks, one is named after a language, or two are swapped."""
    rows = table(spark, sf, "documents").groupBy("source").agg(F.min("lang").alias("lang"), F.count("*").alias("n"))
    number = F.col("n") + F.regexp_extract("source", r"\d+", 0).cast("int")
    middle = F.when(number % 4 == 3, F.array(F.lit(" period"), F.lit("year "))).otherwise(F.array(F.lit("year"), F.lit("period")))
    value = F.when(number % 3 == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("VALUE")))
    extra = F.when(number % 3 == 2, F.array(F.concat(F.lit("in_"), "lang"))).otherwise(F.array().cast("array<string>"))
    names = F.concat(F.array(F.lit("series_id")), middle, value, F.array(F.lit("footnote_codes")), extra)
    return rows.select(F.concat("source", F.lit("/extract.txt")).alias("relative_path"), F.encode(F.concat(F.array_join(names, "\t"), F.lit("\nA\t2000\n")), "UTF-8").alias("content"))


def two_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as files of two sources, with their content; every fifth has no listed size."""
    return table(spark, sf, "documents").select(
        F.when(F.col("lang").isin("en", "de"), "a").otherwise("b").alias("source"), text("doc_id").alias("relative_path"),
        F.concat(F.lit(SITE), text("doc_id")).alias("remote_url"),
        F.when(F.col("doc_id") % 5 != 0, F.col("n_chars")).alias("size_bytes"), F.lit("1/2/2026 8:30 AM").alias("last_modified"),
        F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("bigint").alias("n_bytes"), "doc_id", "lang",
    )


def listing_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Directory-listing text, one entry per document; Spanish documents stand for folders."""
    mark = F.when(F.col("lang") == "es", "<dir>").otherwise(text("n_chars"))
    pieces = [
        F.lit("  6/4/2026  8:30 AM "), F.lpad(mark, 12, " "), F.lit(' <A HREF="/pub/'), F.col("source"), F.lit("/"),
        text("doc_id"), F.lit('">doc '), text("doc_id"), F.lit("</A><br>"),
    ]
    return table(spark, sf, "documents").select(
        F.concat(F.lit(SITE), F.lit("pub/"), "source", F.lit("/")).alias("url"), F.concat(*pieces).alias("body")
    )


def broken_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of an extract; one order status lacks two fields, one priority has one too many."""
    fields = [text("o_custkey"), text(F.year("o_orderdate")), F.concat(F.lit("Q0"), text(F.quarter("o_orderdate")))]
    rest = [text(money("o_totalprice")), F.lit("")]
    short, long = F.col("o_orderstatus") == "P", F.col("o_orderpriority") == "1-URGENT"
    line = (
        F.when(short, F.concat_ws("\t", *fields))
        .when(long, F.concat_ws("\t", *fields, *rest, F.lit("extra")))
        .otherwise(F.concat_ws("\t", *fields, *rest))
    )
    return table(spark, sf, "orders").select(line.alias("value"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
