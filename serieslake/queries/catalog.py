"""Every registered query: what it runs on Spark."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from serieslake import schemas as S
from serieslake.functions import byte_length, sha256, to_type, valid_utf8
from serieslake.operators import access, checks, decode, layout, median, reconcile, rules, sketches, summary
from serieslake.operators import manifest as sync
from serieslake.plans import datasets, statements
from serieslake.plans import sync as ingestion
from serieslake.plans.lake import Lake
from serieslake.queries import inputs as I
from serieslake.session import materialize, scratch_path
from serieslake.sources import files, landing, large_documents, text
from serieslake.streaming.observations import ObservationState, merge_landed

Query = Callable[[SparkSession, str], DataFrame]

# Sums of money are exact decimals; results are given as doubles.
EXACT = reconcile.observation_types("decimal(18,4)")
WIDTHS = {"series_id": 17, "year": 6, "period": 7, "value": -24, "footnote_codes": 4}


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


# --- sources --------------------------------------------------------------------------------


def padded_text_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "extract")
    text.write_padded(I.history(spark, sf), path, WIDTHS)
    rows = text.read_padded(spark, path, S.OBSERVATIONS)
    return _doubles(reconcile.typed(rows, EXACT), "value")


def series_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "series")
    text.write_padded(I.series(spark, sf), path, {"series_id": 17, "sector_code": 11, "measure_code": -14})
    return rules.keep_valid(datasets.bronze_extract(spark, "series", path), datasets.RULES["bronze.series"])


def lookup_scan(spark: SparkSession, sf: str) -> DataFrame:
    tables = {
        **I.lookups(spark, sf), "period": I.periods(spark, sf), "footnote": I.footnotes(spark, sf),
    }
    scanned = []
    for name, df in tables.items():
        path = scratch_path(spark, name)
        text.write_padded(df, path, {column: 20 for column in df.columns})
        rows = rules.keep_valid(datasets.bronze_extract(spark, name, path), datasets.RULES[f"bronze.{name}"])
        code, described = df.columns[0], df.columns[-1] if name == "period" else df.columns[1]
        scanned.append(rows.select(F.lit(name).alias("list"), F.col(code).alias("code"), F.col(described).alias("text")))
    return I.union_all(scanned)


def _document_path(spark: SparkSession, sf: str, lines: bool) -> str:
    path = scratch_path(spark, "population")
    options = {} if lines else {"pretty": "true"}
    rows = I.population_documents(spark, sf).select(F.to_json("document", options).alias("value"))
    # A whole-file document needs a file of its own.
    (rows.write if lines else rows.write.option("maxRecordsPerFile", 1)).text(path)
    return path


def document_flatten(spark: SparkSession, sf: str) -> DataFrame:
    bronze = datasets.bronze_population(spark, _document_path(spark, sf, lines=False))
    return datasets.silver_population(rules.keep_valid(bronze, datasets.RULES["bronze.population"]))


def document_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """One pretty-printed document that holds every record, read in ranges of a kilobyte."""
    path = scratch_path(spark, "population")
    I.one_document(spark, sf).write.text(path)
    bronze = large_documents.read_large_documents(spark, path, S.POPULATION_RECORD, range_bytes=1024)
    return datasets.silver_population(rules.keep_valid(bronze, datasets.RULES["bronze.population"]))


def document_lines(spark: SparkSession, sf: str) -> DataFrame:
    bronze = datasets.bronze_population(spark, _document_path(spark, sf, lines=True), lines=True)
    return datasets.silver_population(rules.keep_valid(bronze, datasets.RULES["bronze.population"]))


def document_text_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the documents hold their numbers in quotes."""
    path = scratch_path(spark, "population")
    plain = F.to_json("document")
    quoted = F.regexp_replace(plain, '"(Year|Population)":([0-9.E]+)', '"$1":"$2"')
    rows = I.population_documents(spark, sf).withColumn("nation", F.col("document.data")[0]["Nation ID"].cast("int"))
    rows.select(F.when(F.col("nation") % 2 == 0, quoted).otherwise(plain).alias("value")).write.text(path)
    bronze = datasets.bronze_population(spark, path, lines=True)
    return datasets.silver_population(rules.keep_valid(bronze, datasets.RULES["bronze.population"]))


def _landed_files(spark: SparkSession, sf: str) -> str:
    root = scratch_path(spark, "landing")
    files.land_files(I.file_contents(spark, sf), root)
    return root


def landed_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Every landed file, those without bytes and with hidden names too."""
    return landing.landed_files(spark, _landed_files(spark, sf), glob="*.txt").select("relative_path", "size_bytes")


def landed_content(spark: SparkSession, sf: str) -> DataFrame:
    """Hashes of the landed files, longer ones by ranges of 4 KiB."""
    found = landing.landed_content(spark, _landed_files(spark, sf), range_bytes=4096)
    return found.select("relative_path", "size_bytes", "content_hash", "valid_utf8")


def listing_extract(spark: SparkSession, sf: str) -> DataFrame:
    return landing.parse_listing(I.listing_pages(spark, sf), "body", "url")


def link_extract(spark: SparkSession, sf: str) -> DataFrame:
    return landing.extract_links(I.table(spark, sf, "pages"), "html", "url")


def content_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return I.table(spark, sf, "documents").select(
        "doc_id", byte_length("text").alias("n_bytes"), sha256("text").alias("content_hash"),
        valid_utf8("text").alias("valid_utf8"),
    )


# --- reconciliation and decoding ------------------------------------------------------------


def _observations(spark: SparkSession, sf: str, by: str | None = None) -> DataFrame:
    rows = reconcile.reconcile([I.current(spark, sf), I.history(spark, sf)], types=EXACT, by=by)
    return rules.keep_valid(rows, datasets.RULES["silver.observations"])


def _dimension(spark: SparkSession, sf: str) -> DataFrame:
    return datasets.silver_series(I.series(spark, sf), I.lookups(spark, sf))


def reconcile_releases(spark: SparkSession, sf: str) -> DataFrame:
    return _doubles(_observations(spark, sf), "value")


def overlay_releases(spark: SparkSession, sf: str) -> DataFrame:
    """The same, given that each release holds a key once."""
    releases = [reconcile.typed(df, EXACT) for df in (I.current(spark, sf), I.history(spark, sf))]
    return _doubles(reconcile.overlay(releases), "value")


def _repeated(spark: SparkSession, sf: str) -> list[DataFrame]:
    return [I.repeated(spark, sf, open_only=True), I.repeated(spark, sf)]


def reconcile_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that each release holds many times: the tie-break decides."""
    return _doubles(reconcile.reconcile(_repeated(spark, sf), types=EXACT), "value")


def decode_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return _dimension(spark, sf)


def unknown_codes(spark: SparkSession, sf: str) -> DataFrame:
    return decode.unknown_codes(I.series(spark, sf), datasets.series_lookups(I.lookups(spark, sf)))


def footnote_decode(spark: SparkSession, sf: str) -> DataFrame:
    codes = F.concat_ws(", ", F.substring("o_orderpriority", 1, 1), "o_orderstatus").alias("footnote_codes")
    orders = I.table(spark, sf, "orders").select("o_orderkey", codes)
    lookup = decode.Lookup(I.footnotes(spark, sf), "footnote_code", "footnote_text", "unknown footnote")
    return decode.decode_list(orders, "footnote_codes", lookup)


# --- answers --------------------------------------------------------------------------------


def _best(spark: SparkSession, sf: str) -> DataFrame:
    by = layout.if_light([I.current(spark, sf), I.history(spark, sf)], "series_id")
    return datasets.gold_best_year(_observations(spark, sf, by), _dimension(spark, sf))


def period_totals(spark: SparkSession, sf: str) -> DataFrame:
    return _doubles(summary.period_totals(_observations(spark, sf), S.QUARTERS), "total_value")


def best_period_per_series(spark: SparkSession, sf: str) -> DataFrame:
    return _doubles(_best(spark, sf), "total_value")


def best_period_one_pass(spark: SparkSession, sf: str) -> DataFrame:
    totals = summary.reconciled_totals([I.current(spark, sf), I.history(spark, sf)], S.QUARTERS, types=EXACT)
    best = summary.with_dimension(summary.best_period(totals), _dimension(spark, sf), "series_id", ["series_label"])
    return _doubles(best.select("series_id", "series_label", "best_year", "total_value"), "total_value")


def repeats_best_period(spark: SparkSession, sf: str) -> DataFrame:
    totals = summary.reconciled_totals(_repeated(spark, sf), S.QUARTERS, types=EXACT)
    return _doubles(summary.best_period(totals), "total_value")


def best_period_distribution(spark: SparkSession, sf: str) -> DataFrame:
    best = summary.best_period(summary.period_totals(_observations(spark, sf), S.QUARTERS))
    return summary.distribution(best, "best_year")


def gold_point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return _doubles(_best(spark, sf).filter("series_id = '299'").select("best_year", "total_value"), "total_value")


def _rounded(stats: DataFrame) -> DataFrame:
    # The last digits of double moments depend on the order of the rows.
    moments = ("mean_population", "stddev_population")
    return stats.withColumns({name: F.round(name, 4) for name in moments})


def range_summary(spark: SparkSession, sf: str) -> DataFrame:
    population = I.nation_years(spark, sf)
    return _rounded(datasets.gold_population_stats(population, nation="NATION_7", first=1995, last=2000))


def range_summary_population(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(summary.range_summary(
        I.nation_years(spark, sf), year="year", value="population", first=1996, last=2000,
        where=F.col("nation") == "NATION_3", population=True,
    ))


def series_by_year(spark: SparkSession, sf: str) -> DataFrame:
    rows = datasets.gold_series_by_year(
        _observations(spark, sf), materialize(I.nation_years(spark, sf), "yearly"), series_id="299", period="Q01", nation="NATION_7"
    )
    return _doubles(rows, "value").orderBy("year")


def aligned_series(spark: SparkSession, sf: str) -> DataFrame:
    first = _observations(spark, sf).filter("period = 'Q01'")
    yearly = materialize(I.nation_years(spark, sf), "yearly").filter("nation = 'NATION_7'")
    rows = summary.aligned_series(first, yearly, columns=["series_id", "year", "value"], measure="population")
    return _doubles(rows, "value")


def _cents(spark: SparkSession, sf: str) -> DataFrame:
    cents = (I.money("o_totalprice") * 100).cast("bigint")
    return I.table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), I.money("o_totalprice").alias("value"), cents.alias("cents")
    )


def yearly_profile(spark: SparkSession, sf: str) -> DataFrame:
    rows = _cents(spark, sf)
    profile = summary.yearly_profile(rows, ["year"], "value")
    middle = median.exact_median(rows, ["year"], "cents", scale=2)
    return _doubles(profile.join(middle, "year"), "total", "smallest", "largest")


def running_median(spark: SparkSession, sf: str) -> DataFrame:
    """Medians per year from sketches of two parts of the orders, merged; with the exact one and whether it lies within the stated error."""
    rows = _cents(spark, sf).withColumn("part", F.expr("cents % 2"))
    kept = [materialize(sketches.sketch(rows.filter(F.col("part") == part), ["year"], "cents"), "sketches") for part in (0, 1)]
    merged = sketches.quantile(sketches.merge(kept, ["year"]), ["year"], 0.5, "estimate")
    middle = median.exact_median(rows, ["year"], "cents")
    ranked = rows.join(merged, "year").groupBy("year").agg(
        F.count("*").alias("n"), F.count_if(F.col("cents") < F.col("estimate")).alias("below"), F.count_if(F.col("cents") <= F.col("estimate")).alias("upto")
    )
    half = F.col("n") / 2
    within = (F.col("below") <= half + sketches.RANK_ERROR * F.col("n")) & (F.col("upto") >= half - sketches.RANK_ERROR * F.col("n"))
    return ranked.join(middle, "year").select("year", "n", "median", within.alias("within"))


def median_by_digits(spark: SparkSession, sf: str) -> DataFrame:
    lines = I.table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", (I.money("l_extendedprice") * 100).cast("bigint").alias("cents")
    )
    return median.exact_median(lines, ["l_returnflag", "l_linestatus"], "cents", scale=2)


def growth_first_last(spark: SparkSession, sf: str) -> DataFrame:
    return summary.growth(I.nation_years(spark, sf), ["nation"], year="year", value="population")


def parts_check(spark: SparkSession, sf: str) -> DataFrame:
    return summary.parts_check(_observations(spark, sf), S.QUARTERS, S.ANNUAL)


# --- rules ----------------------------------------------------------------------------------

ORDER_RULES = [
    rules.Rule("known_status", "o_orderstatus IN ('O', 'F')", rules.DROP),
    rules.Rule("not_tiny", "o_totalprice >= 20000", rules.DROP),
    rules.Rule("not_huge", "o_totalprice <= 400000", rules.WARN),
]


def rules_drop(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return rules.keep_valid(rows, ORDER_RULES)


def rules_warn_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rules.rule_counts(I.table(spark, sf, "orders"), ORDER_RULES)


def rules_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    bad = rules.quarantine(I.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), ORDER_RULES)
    return bad.withColumn(rules.BROKEN, F.array_join(rules.BROKEN, ",")).withColumnRenamed(rules.BROKEN, "broken")


def rules_fail_guard(spark: SparkSession, sf: str) -> DataFrame:
    """A refused publish leaves the earlier snapshot in place."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    totals = _doubles(summary.period_totals(_observations(spark, sf), S.QUARTERS), "total_value")
    whole = [rules.Rule("has_total", "total_value IS NOT NULL", rules.FAIL)]
    lake.publish(totals, "gold.totals", whole, run_at=I.RUN_AT)
    holed = totals.withColumn("total_value", F.when(F.col("year") != 1997, F.col("total_value")))
    try:
        lake.publish(holed, "gold.totals", whole, run_at=I.RUN_AT)
    except rules.RuleViolation:
        return lake.read("gold.totals")
    raise AssertionError("the broken rule was not noticed")


def rules_empty_guard(spark: SparkSession, sf: str) -> DataFrame:
    """An empty table breaks no row rule; the least number of rows refuses it, and the earlier snapshot stays."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    totals = _doubles(summary.period_totals(_observations(spark, sf), S.QUARTERS), "total_value")
    lake.publish(totals, "gold.totals", run_at=I.RUN_AT, min_rows=1)
    try:
        lake.publish(totals.filter("year < 0"), "gold.totals", run_at=I.RUN_AT, min_rows=1)
    except rules.RuleViolation:
        return lake.read("gold.totals")
    raise AssertionError("the empty table was not noticed")


def quarantine_rows(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "broken")
    I.broken_extract(spark, sf).write.text(path)
    good, bad = text.split_malformed(text.read_padded(spark, path, S.OBSERVATIONS, header=False, malformed=True))
    fields = F.size(F.split(text.MALFORMED, "\t"))
    return bad.groupBy(F.lit("malformed").alias("kind"), fields.alias("n_fields")).agg(F.count("*").alias("n")).unionByName(
        good.groupBy(F.lit("good").alias("kind"), F.lit(len(S.OBSERVATIONS)).alias("n_fields")).agg(F.count("*").alias("n"))
    )


# --- manifest -------------------------------------------------------------------------------


def _plan(spark: SparkSession, sf: str) -> DataFrame:
    listed = sync.with_landed(I.listing(spark, sf), I.landed(spark, sf))
    return sync.plan_sync(I.manifest(spark, sf), listed)


def manifest_plan(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf).select("source", "relative_path", "action")


def manifest_upsert(spark: SparkSession, sf: str) -> DataFrame:
    after = sync.apply_sync(_plan(spark, sf), I.RUN_AT)
    day = lambda name: F.date_format(name, "yyyy-MM-dd").alias(name)
    return after.select(
        *[f.name for f in S.MANIFEST.fields[:7]], *[day(f.name) for f in S.MANIFEST.fields[7:]]
    )


def manifest_removed(spark: SparkSession, sf: str) -> DataFrame:
    after = sync.apply_sync(_plan(spark, sf), I.RUN_AT)
    gone = after.filter((F.col("status") == sync.REMOVED))
    return gone.select("source", "relative_path", F.date_format("last_seen_at", "yyyy-MM-dd").alias("last_seen"))


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return sync.run_summary(_plan(spark, sf))


# --- publishing and incremental runs --------------------------------------------------------


def _ingested(spark: SparkSession, sf: str) -> Lake:
    """Two ingestion runs over directory-listing pages: all files, then without those in French."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    entries = landing.parse_listing(I.listing_pages(spark, sf), "body", "url")
    files = landing.listed_files(entries, "pub", f"{I.SITE}pub/")
    texts = I.table(spark, sf, "documents")
    path = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))
    content = texts.select(
        F.lit("pub").alias("source"), path.alias("relative_path"), sha256("text").alias("content_hash"), byte_length("text").alias("content_bytes"), "lang"
    )
    gone = content.filter("lang = 'fr'").select("source", "relative_path")
    for listing, run_at in ((files, I.RUN_AT), (files.join(gone, ["source", "relative_path"], "left_anti"), I.RUN_AT + dt.timedelta(days=1))):
        planned = ingestion.plan(lake, listing)
        ingestion.finish(lake, planned, run_at, fetched=content.drop("lang"))
    return lake


def sync_run(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest after three runs: one with failures, one of a single source after copies were lost, and one without news."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    docs = I.two_sources(spark, sf)
    listed = ["source", "relative_path", "remote_url", "size_bytes", "last_modified"]
    got = docs.select("source", "relative_path", F.col("sha256").alias("content_hash"), F.col("n_bytes").alias("content_bytes"), "doc_id")
    try:
        ingestion.finish(lake, ingestion.plan(lake, docs.filter("doc_id % 3 <> 0").select(*listed)), I.RUN_AT, fetched=got.filter("doc_id % 13 <> 4").drop("doc_id"))
    except ingestion.SyncFailed:
        pass
    else:
        raise AssertionError("the failures were not noticed")
    larger = F.col("size_bytes") + F.when(F.col("doc_id") % 17 == 1, 1).otherwise(0)
    second = docs.filter("lang = 'en'").withColumn("size_bytes", larger).select(*listed)
    copies = docs.filter("doc_id % 19 <> 5").select("source", "relative_path")
    for day, landed in ((1, copies), (2, None)):
        planned = ingestion.plan(lake, second, landed=landed, sources=["a"])
        ingestion.finish(lake, planned, I.RUN_AT + dt.timedelta(days=day), fetched=got.drop("doc_id"))
    manifest = lake.read(ingestion.TABLE)
    days = [F.date_format(name, "yyyy-MM-dd").alias(name) for name in ("first_seen_at", "last_seen_at", "last_ingested_at")]
    return manifest.select("source", "relative_path", "size_bytes", "content_hash", "status", *days)


def listing_to_manifest(spark: SparkSession, sf: str) -> DataFrame:
    manifest = _ingested(spark, sf).read(ingestion.TABLE)
    return manifest.select("relative_path", "remote_url", "size_bytes", "content_hash", "status")


def active_files_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Only texts whose file the manifest holds as active."""
    active = landing.active_only(
        I.table(spark, sf, "documents").withColumn("relative_path", F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))),
        _ingested(spark, sf).read(ingestion.TABLE), "pub",
    )
    return active.groupBy("lang").agg(F.count("*").alias("n_files"), F.sum(byte_length("text")).alias("n_bytes"))


def publish_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    lake = Lake(spark, scratch_path(spark, "lake"))
    best = best_period_per_series(spark, sf)
    older = best.filter("best_year < 2001")
    for rows in (older, best):  # the second snapshot replaces the first
        lake.publish(rows, "gold.best_year", datasets.RULES["gold.best_year"], run_at=I.RUN_AT, min_rows=1)
    return lake.read("gold.best_year")


def rule_trend(spark: SparkSession, sf: str) -> DataFrame:
    lake = Lake(spark, scratch_path(spark, "lake"))
    orders = I.table(spark, sf, "orders")
    for day, rows in enumerate((orders, orders.filter("o_orderstatus <> 'P'"))):
        lake.publish(rows, "bronze.orders", ORDER_RULES, run_at=I.RUN_AT + dt.timedelta(days=day))
    return lake.rule_trend()


def _refreshed(spark: SparkSession, sf: str) -> Lake:
    """All layers from landed files, on the given tables written as extracts and documents."""
    extracts = {
        "series": I.series(spark, sf), "observations_current": I.current(spark, sf),
        "observations_all": I.history(spark, sf), **I.lookups(spark, sf),
        "period": I.periods(spark, sf), "footnote": I.footnotes(spark, sf),
    }
    files = {name: scratch_path(spark, name) for name in extracts}
    for name, df in extracts.items():
        text.write_padded(df, files[name], {"series_id": 17, "value": -24})
    files["population"] = _document_path(spark, sf, lines=True)
    lake = Lake(spark, scratch_path(spark, "lake"))
    datasets.refresh(
        lake, files, I.RUN_AT, nation="NATION_7", first=1995, last=2000, series_id="299", document_lines=True
    )
    return lake


def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    return _refreshed(spark, sf).read("gold.best_year")


def _stored_history(spark: SparkSession, sf: str) -> DataFrame:
    """The history for queries that land it more than once; its quarters are summed up once."""
    return I.as_text(materialize(I.quarter_values(spark, sf), "quarters"))


def _land(rows: DataFrame, root: str, release: str, version: str) -> None:
    """Land a version as compressed extracts."""
    text.write_padded(rows, landing.version_path(root, release, version), WIDTHS, compression="gzip")


def incremental_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Versions land in turn and merge into the state; the outcome equals the full refresh."""
    root = scratch_path(spark, "landing")
    state = ObservationState(scratch_path(spark, "state"), ["current", "all"], EXACT)
    checkpoint = scratch_path(spark, "checkpoint")
    history = _stored_history(spark, sf)
    wrong = history.filter("year = '2000'").withColumn("value", F.lit("-"))
    versions = [[("all", "1", wrong)], [("current", "1", I.current(spark, sf)), ("all", "2", history)]]
    for landed in versions:
        for release, version, rows in landed:
            _land(rows, root, release, version)
        merge_landed(spark, root, state, checkpoint)
    return _doubles(state.reconciled(spark, ["current", "all"]), "value")


def _merged(spark: SparkSession, versions: list[list[tuple[str, str, DataFrame]]]) -> ObservationState:
    """A state into which each list of (release, version, rows) was landed and merged in turn."""
    root, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    state = ObservationState(scratch_path(spark, "state"), ["current", "all"])
    for landed in versions:
        for release, version, rows in landed:
            _land(rows, root, release, version)
        merge_landed(spark, root, state, checkpoint)
    return state


def state_dropped_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The second version of the history lacks every third series; so does the state."""
    history = _stored_history(spark, sf)
    fewer = history.filter(F.trim("series_id").cast("int") % 3 != 0)
    state = _merged(spark, [[("all", "1", history)], [("all", "2", fewer), ("current", "1", I.current(spark, sf))]])
    return _doubles(state.reconciled(spark, ["current", "all"]), "value")


def state_invalid_periods(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a period outside the declared ones land as well; the state drops and counts them."""
    history = _stored_history(spark, sf)
    odd = history.withColumn("period", F.regexp_replace("period", "Q05", "M13"))
    state = _merged(spark, [[("all", "1", history.unionByName(odd))]])
    kept = state.reconciled(spark, ["all"]).groupBy("period").agg(F.count("*").alias("n_rows"))
    dropped = state.log(spark).select(F.lit("dropped").alias("period"), (F.col("rows_in") - F.col("rows_kept")).alias("n_rows"))
    return kept.unionByName(dropped)


def state_ten_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Ten numbered versions, the tenth landed before the ninth: it is the tenth that counts."""
    history = _stored_history(spark, sf)
    version = lambda k: ("all", str(k), history.withColumn("footnote_codes", F.lit(str(k))))
    state = _merged(spark, [[version(k) for k in range(1, 9)], [version(10)], [version(9)]])
    return _doubles(state.reconciled(spark, ["all"]), "value")


def best_period_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Every year of a series has the same parts in another order, so the first year is the best."""
    paid = I.table(spark, sf, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("a"), F.max("o_orderkey").alias("b"))
    tenths = lambda c: F.concat(F.lit("0."), F.lpad((F.col(c) % 1000).cast("string"), 3, "0"))
    rows = paid.select(F.col("o_custkey").cast("string").alias("series_id"), F.inline(F.array(*[
        F.struct(F.lit(str(year)).alias("year"), F.lit(quarter).alias("period"), value.alias("value"))
        for year, values in ((2000, (tenths("a"), tenths("b"), F.lit("0.1"))), (2001, (F.lit("0.1"), tenths("b"), tenths("a"))))
        for quarter, value in zip(S.QUARTERS, values, strict=False)
    ])), F.lit(None).cast("string").alias("footnote_codes"))
    observations = datasets.silver_observations(rows, rows.limit(0))
    labels = rows.select("series_id", F.col("series_id").alias("series_label")).distinct()
    return datasets.gold_best_year(observations, labels)


def landed_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A release that is landed again unchanged lands nothing; a revised one becomes a version of its own."""
    root, history = scratch_path(spark, "landing"), _stored_history(spark, sf)
    state, checkpoint = ObservationState(scratch_path(spark, "state"), ["current", "all"], EXACT), scratch_path(spark, "checkpoint")
    wrong = history.withColumn("footnote_codes", F.lit("p"))
    known: dict[str, str] = {}
    for day, (release, rows) in enumerate((("all", wrong), ("all", wrong.repartition(3)), ("all", history), ("current", I.current(spark, sf)))):
        made = landing.land_release(rows, root, release, I.RUN_AT + dt.timedelta(days=day), widths=WIDTHS, known_hash=known.get(release), compression="gzip")
        if (made is None) != (day == 1):
            raise AssertionError("only the repeated release is to be left out")
        known[release] = made[1] if made else known[release]
    merge_landed(spark, root, state, checkpoint)
    return _doubles(state.reconciled(spark, ["current", "all"]), "value")


def stream_rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows seen and broken per rule, as observed in the stream: some periods are unknown, some values are no numbers."""
    history = _stored_history(spark, sf)
    odd = history.withColumn("period", F.regexp_replace("period", "Q05", "M13")).withColumn("value", F.when(F.col("year") == "2000", "-").otherwise(F.col("value")))
    state = _merged(spark, [[("all", "1", history), ("current", "1", I.current(spark, sf))], [("all", "2", odd)]])
    return state.batch_counts(spark).groupBy("rule", "action").agg(F.sum("rows_in").alias("rows_in"), F.sum("rows_broken").alias("rows_broken"))


def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Malformed lines that come through the file stream: in a side table, and counted in the log."""
    root = scratch_path(spark, "landing")
    lines = I.broken_extract(spark, sf).withColumnRenamed("value", "\t".join(S.OBSERVATIONS.fieldNames()))
    plain = {"sep": "\u0001", "quote": "", "header": "true", "ignoreTrailingWhiteSpace": "false", "ignoreLeadingWhiteSpace": "false"}
    lines.write.options(**plain).csv(landing.version_path(root, "all", "1"))
    state = ObservationState(scratch_path(spark, "state"), ["all"])
    merge_landed(spark, root, state, scratch_path(spark, "checkpoint"))
    bad = state.malformed_lines(spark).groupBy(F.lit("malformed").alias("kind"), F.size(F.split("line", "\t")).alias("n_fields")).agg(F.count("*").alias("n"))
    good = state.log(spark).select(F.lit("good").alias("kind"), F.lit(len(S.OBSERVATIONS)).alias("n_fields"), (F.col("rows_in") - F.col("malformed")).alias("n"))
    return bad.unionByName(good)


def withdrawn_release(spark: SparkSession, sf: str) -> DataFrame:
    """Without the revised release the history shows through again."""
    root = scratch_path(spark, "landing")
    state = ObservationState(scratch_path(spark, "state"), ["current", "all"], EXACT)
    for release, rows in (("current", I.current(spark, sf)), ("all", I.history(spark, sf))):
        _land(rows, root, release, "1")
    merge_landed(spark, root, state, scratch_path(spark, "checkpoint"))
    return _doubles(state.reconciled(spark, ["all"]), "value")


# --- checks, access, SQL forms --------------------------------------------------------------


def drift_report(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "headers")
    rows = I.history(spark, sf)
    swapped = rows.select("series_id", "period", "year", "value", "footnote_codes")
    grown = rows.drop("footnote_codes").withColumn("unit", F.lit("USD"))
    for release, df in (("asis", rows), ("swapped", swapped), ("grown", grown)):
        text.write_padded(df, f"{root}/{release}", {"series_id": 17, "value": -24})
    report = checks.drift_report(checks.headers(spark, root, glob="*.csv"), S.OBSERVATIONS)
    return report.select(
        F.substring_index("relative_path", "/", 1).alias("release"), "missing", "extra", "reordered", "drifted"
    ).distinct()


def drift_by_source(spark: SparkSession, sf: str) -> DataFrame:
    """Drift of landed extracts whose headers follow from the rows of their source."""
    root = scratch_path(spark, "headers")
    files.land_files(I.drifting_extracts(spark, sf), root)
    return checks.drift_report(checks.headers(spark, root), S.OBSERVATIONS)


def freshness(spark: SparkSession, sf: str) -> DataFrame:
    report = checks.freshness(
        I.table(spark, sf, "events"), "event_type", "ts", dt.datetime(2024, 1, 31), limit=dt.timedelta(minutes=15)
    )
    return report.withColumn("newest", F.date_format("newest", "yyyy-MM-dd HH:mm:ss"))


def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return checks.duplicate_keys(I.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def masked_view(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = I.table(spark, sf, "nation"), I.table(spark, sf, "region")
    entitled = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("reader"), F.col("n_nationkey").alias("c_nationkey")
    )
    reader = region.agg(F.min("r_name")).first()[0]
    rows = access.entitled_rows(I.table(spark, sf, "customer"), entitled, reader, "c_nationkey")
    return access.mask_columns(rows, ["c_name"], salt="pepper").select("c_custkey", "c_name", "c_nationkey")


def _statement(spark: SparkSession, name: str, tables: dict[str, DataFrame], **arguments: object) -> DataFrame:
    bound = {}
    for table, df in tables.items():
        bound[table] = f"serieslake_{name.lower()}_{table}"
        df.createOrReplaceTempView(bound[table])
    return statements.run(spark, getattr(statements, name), **bound, **arguments)


def sql_best_year(spark: SparkSession, sf: str) -> DataFrame:
    tables = {"observations": _observations(spark, sf), "series": _dimension(spark, sf)}
    return _doubles(_statement(spark, "BEST_YEAR", tables), "total_value")


def sql_population_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_statement(
        spark, "POPULATION_STATS", {"population": I.nation_years(spark, sf)}, nation="NATION_7", first=1995, last=2000
    ))


def sql_series_by_year(spark: SparkSession, sf: str) -> DataFrame:
    tables = {"observations": _observations(spark, sf), "population": I.nation_years(spark, sf)}
    rows = _statement(spark, "SERIES_BY_YEAR", tables, series_id="299", period="Q01", nation="NATION_7")
    return _doubles(rows, "value")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        padded_text_scan, series_scan, lookup_scan, document_flatten, document_ranges, document_lines, landed_listing, landed_content,
        listing_extract, link_extract, content_fingerprint,
        reconcile_releases, reconcile_repeats, overlay_releases, decode_dimension, unknown_codes, footnote_decode,
        period_totals, best_period_per_series, best_period_one_pass, repeats_best_period, best_period_distribution,
        gold_point_lookup, range_summary, range_summary_population, series_by_year, aligned_series,
        yearly_profile, running_median, median_by_digits, growth_first_last, parts_check,
        rules_drop, rules_warn_metrics, rules_quarantine, rules_fail_guard, rules_empty_guard, quarantine_rows,
        manifest_plan, manifest_upsert, manifest_removed, run_summary, sync_run,
        publish_snapshot, rule_trend, full_refresh, incremental_reconcile, withdrawn_release,
        landed_versions, stream_rule_counts, stream_quarantine, state_dropped_keys, state_invalid_periods, state_ten_versions, best_period_ties, document_text_numbers,
        listing_to_manifest, active_files_scan,
        drift_report, drift_by_source, freshness, duplicate_keys, masked_view,
        sql_best_year, sql_population_stats, sql_series_by_year,
    )
}
