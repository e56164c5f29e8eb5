"""Incremental reconciliation: newly landed release versions replace their release in a kept, bucketed state."""

from __future__ import annotations

import threading
import uuid
from collections import defaultdict
from collections.abc import Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from serieslake.operators.reconcile import KEYS, TIE_BREAK, first_by, keep_first, observation_types, typed
from serieslake.operators.rules import DROP, FAIL, WARN, Rule, RuleViolation, keep_valid, rule_aggregates
from serieslake.plans.datasets import RULES
from serieslake.schemas import OBSERVATIONS
from serieslake.session import control_rows, materialize
from serieslake.sources.text import MALFORMED, stream_padded

LANDED = T.StructType([
    *OBSERVATIONS.fields,
    T.StructField("release", T.StringType()),
    T.StructField("version", T.StringType()),
])
Digest = tuple[int, int, int]
NOTHING: Digest = (0, 0, 0)


def version_order(version: str | None) -> tuple[int, int, str]:
    """Whole numbers by value, before all other names by text; a missing version comes first of all."""
    if version is None:
        return 0, 0, ""
    return (1, int(version), "") if version.isascii() and version.isdigit() else (2, 0, version)


class Known(NamedTuple):
    """What the index says: per release its version, per release and bucket its digest, per bucket its live batch."""

    versions: dict[str, str]
    digests: dict[tuple[str, int], Digest]
    live: dict[int, int]
    next_batch: int
    orders: set[str]  # of releases, under which the live buckets were marked

    def filled(self, buckets: Collection[int] | None = None) -> list[int]:
        """The live buckets that hold rows."""
        held = {bucket for (_, bucket), digest in self.digests.items() if digest != NOTHING}
        return sorted(b for b in self.live if b in held and (buckets is None or b in buckets))


@dataclass(frozen=True)
class ObservationState:
    """The newest version of each release, typed and with one row per key, in hash buckets of the key below ``root``.

    A newer version replaces its release as a whole, so rows that left the extract leave the
    state, as in a full refresh.  Each release has a digest per bucket, and only buckets in which
    one changed are written anew; in them every row says whether it is the one that shows under the declared order
    of the releases.  So ``reconciled`` reads the rows that show, and neither sorts nor shuffles.  Choose
    ``buckets`` once, so that one holds about a gigabyte; an existing state refuses another number.

    A version may come in several batches, in any order, and be replayed: rows of the version that is there
    already are added to it, and the first row of a key in a total order stays.  Older versions change nothing.
    Rows that break a rule are kept aside of the answer and dropped on read, after the choice of release, as in
    a full refresh.  Malformed lines are listed in a side table and, by ``malformed``, kept (filled up or cut), dropped, or refused.

    A merge writes whole buckets to a new, numbered folder, and then index entries with its counts.
    Without the entries the folder does not count, so a merge that dies half-way changes nothing, and
    the next one takes its number.  One merge at a time.  The index has one row per merge, release and bucket; the
    driver reads it, and the counts of the landed rows per release, version and bucket.
    """

    root: str
    releases: Sequence[str]
    types: Mapping[str, str] = field(default_factory=observation_types)
    rules: Sequence[Rule] = tuple(RULES["silver.observations"])
    buckets: int = 16
    malformed: str = WARN

    @property
    def _order(self) -> str:
        return "\n".join(self.releases)

    @property
    def _counts(self) -> list[str]:
        return ["rows_in", "rows_kept", *(f"broken_{i}" for i in range(len(self.rules))), "malformed"]

    @property
    def _entry(self) -> dict[str, str]:
        place = {"release": "string", "version": "string", "bucket": "int", "buckets": "int", "rewritten": "boolean", "order": "string"}
        return {**place, "n": "bigint", "total": "decimal(38,0)", "parity": "bigint", **dict.fromkeys(self._counts, "bigint")}

    # --- the index --------------------------------------------------------------------------

    def _index(self, spark: SparkSession) -> DataFrame:
        control_rows(spark, [], self._entry).write.mode("ignore").parquet(f"{self.root}/index/batch=-1")
        columns = ", ".join(f"`{n}` {t}" for n, t in {**self._entry, "batch": "bigint"}.items())
        return spark.read.schema(columns).parquet(f"{self.root}/index").filter("batch >= 0")

    def log(self, spark: SparkSession) -> DataFrame:
        """Every merge's outcome per release: landed rows seen and kept, malformed ones, and rows that break each rule.

        ``version`` is the one that counts afterwards; releases that are not declared, and older versions, have none.
        """
        sums = [F.sum(name).alias(name) for name in self._counts]
        return self._index(spark).groupBy("batch", "release").agg(F.max("version").alias("version"), *sums)

    def _known(self, spark: SparkSession) -> Known:
        known = Known({}, {}, {}, 0, set())
        orders = {}
        rows = sorted(self._index(spark).collect(), key=lambda row: row.batch)
        for row in rows:
            if row.buckets != self.buckets:
                raise ValueError(f"{self.root} has {row.buckets} buckets, not {self.buckets}")
            if row.version is not None:
                known.versions[row.release] = row.version
                known.digests[row.release, row.bucket] = (row.n, int(row.total), row.parity)
            if row.rewritten:
                known.live[row.bucket], orders[row.bucket] = row.batch, row.order
        known.orders.update(orders.values())
        return known._replace(next_batch=rows[-1].batch + 1 if rows else 0)

    # --- rows -------------------------------------------------------------------------------

    def _rows(self, spark: SparkSession, known: Known, buckets: Collection[int] | None = None) -> DataFrame:
        """Live rows with release, bucket and visible; only the folders that the index names are read."""
        columns = {**self.types, "release": "string", "visible": "boolean", "bucket": "int"}
        paths = [f"{self.root}/rows/batch={known.live[bucket]}/bucket={bucket}" for bucket in known.filled(buckets)]
        if not paths:
            return control_rows(spark, [], columns)
        schema = ", ".join(f"{n} {t}" for n, t in columns.items())
        return spark.read.schema(schema).option("basePath", f"{self.root}/rows").parquet(*paths).select(*columns)

    def images(self, spark: SparkSession, releases: Sequence[str] | None = None) -> DataFrame:
        """The rows of each release, those that break rules or do not show included."""
        wanted = list(self.releases if releases is None else releases)
        return self._rows(spark, self._known(spark)).filter(F.col("release").isin(wanted)).select(*self.types, "release")

    def malformed_lines(self, spark: SparkSession) -> DataFrame:
        """batch, release, version and text of every malformed line that landed."""
        control_rows(spark, [], {"release": "string", "version": "string", "line": "string"}).write.mode("ignore").parquet(f"{self.root}/malformed/batch=-1")
        lines = spark.read.schema("release string, version string, line string, batch bigint").parquet(f"{self.root}/malformed")
        return lines.join(F.broadcast(self._index(spark).select("batch").distinct()), "batch")

    def staged(self, landed: DataFrame) -> DataFrame:
        """Raw rows typed, with their bucket; a row-by-row projection, so it serves streams as well."""
        lines = [F.col(MALFORMED)] if MALFORMED in landed.columns else [F.lit(None).cast("string").alias(MALFORMED)]
        rows = typed(landed, self.types, keep=["release", "version", *lines])
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*KEYS), F.lit(self.buckets)).cast("int"))

    def _digest(self) -> list[Column]:
        """Equal for equal rows in any order."""
        each = F.xxhash64(*self.types, *(F.col(name).isNull() for name in self.types))
        return [F.count("*").alias("n"), F.sum(each.cast("decimal(38,0)")).alias("total"), F.bit_xor(each).alias("parity")]

    # --- merging ----------------------------------------------------------------------------

    def merge(self, landed: DataFrame) -> None:
        """Fold newly landed rows (raw text, with release and version) into the state."""
        self.merge_staged(self.staged(landed))

    def merge_staged(self, staged: DataFrame) -> None:
        spark = staged.sparkSession
        rows = materialize(staged, "landed")
        bad = F.col(MALFORMED).isNotNull()
        met = rows.groupBy("release", "version", "bucket", bad.alias("bad")).agg(*self._digest(), *rule_aggregates(self.rules)).collect()
        if any(row.bad for row in met) and self.malformed == FAIL:
            raise RuleViolation(f"{sum(row.n for row in met if row.bad)} malformed lines")
        known = self._known(spark)
        usable = [row for row in met if not row.bad or self.malformed == WARN]
        adding = self._adding(usable, known)
        digests = {release: self._digests(usable, known, release, version) for release, version in adding.items()}
        changed = {
            release: [b for b, digest in of.items() if digest != known.digests.get((release, b), NOTHING) or (known.versions.get(release) == adding[release])]
            for release, of in digests.items()
        }
        rewritten = sorted({bucket for buckets in changed.values() for bucket in buckets})
        if rewritten:
            self._rewrite(rows if self.malformed == WARN else rows.filter(~bad), known, adding, changed, rewritten)
        if any(row.bad for row in met):
            lines = rows.filter(bad).select("release", "version", F.col(MALFORMED).alias("line"))
            lines.write.mode("overwrite").parquet(f"{self.root}/malformed/batch={known.next_batch}")
        entries = self._entries(met, adding, digests, rewritten)
        if entries:
            schema = ", ".join(f"`{n}` {t}" for n, t in self._entry.items())
            spark.createDataFrame(entries, schema).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/index/batch={known.next_batch}")

    def _adding(self, met: Iterable[Row], known: Known) -> dict[str, str]:
        """The landed version of each declared release that is newer than the known one, or the same."""
        latest: dict[str, str] = {}
        for row in met:
            if row.release in self.releases and row.version is not None:
                latest[row.release] = max(latest.get(row.release, row.version), row.version, key=version_order)
        return {name: version for name, version in latest.items() if version_order(version) >= version_order(known.versions.get(name))}

    def _digests(self, met: Iterable[Row], known: Known, release: str, version: str) -> dict[int, Digest]:
        """What the digests become: of the landed rows alone, or with those of the same version before them."""
        landed: dict[int, Digest] = defaultdict(lambda: NOTHING)
        for row in met:
            if (row.release, row.version) == (release, version):
                n, total, parity = landed[row.bucket]
                landed[row.bucket] = (n + row.n, total + int(row.total), parity ^ row.parity)
        if known.versions.get(release) != version:  # buckets that it no longer fills become empty
            held = {b for (name, b), digest in known.digests.items() if name == release and digest != NOTHING}
            return {b: landed.get(b, NOTHING) for b in sorted(held | set(landed))}
        before = {b: known.digests.get((release, b), NOTHING) for b in landed}
        return {b: (n + before[b][0], total + before[b][1], parity ^ before[b][2]) for b, (n, total, parity) in landed.items()}

    def _rewrite(self, rows: DataFrame, known: Known, adding: Mapping[str, str], changed: Mapping[str, list[int]], rewritten: list[int]) -> None:
        """Write the changed buckets: the landed rows, and what they leave in place."""
        columns = [*self.types, "release", "bucket"]
        here = [
            (F.col("release") == name) & (F.col("version") == version) & F.col("bucket").isin(changed[name]) for name, version in adding.items()
        ]
        fresh = rows.filter(reduce(Column.__or__, here)).select(*columns)
        onto = [name for name, version in adding.items() if known.versions.get(name) == version]
        replaced = [(F.col("release") == name) & F.col("bucket").isin(changed[name]) for name in adding if name not in onto]
        held = self._rows(rows.sparkSession, known, rewritten).select(*columns).filter(~reduce(Column.__or__, replaced, F.lit(False)))
        if onto:
            fresh, held = fresh.unionByName(held.filter(F.col("release").isin(onto))), held.filter(~F.col("release").isin(onto))
        image = keep_first(fresh, ["bucket", "release", *KEYS], first_by(TIE_BREAK)).unionByName(held)
        spot = F.row_number().over(Window.partitionBy("bucket", *KEYS).orderBy(self._rank(self.releases)))
        marked = image.repartition(len(rewritten), "bucket").withColumn("visible", spot == 1)
        marked.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/rows/batch={known.next_batch}")

    def _entries(self, met: list[Row], adding: Mapping[str, str], digests: Mapping[str, dict[int, Digest]], rewritten: list[int]) -> list[tuple]:
        """Index rows: counts per release and bucket, and the digests and versions that count from now on."""
        counts: dict[tuple[str, int | None], dict[str, int]] = defaultdict(lambda: dict.fromkeys(self._counts, 0))
        for row in met:
            into = counts[row.release, row.bucket if row.release in adding else None]
            if row.bad:
                into["malformed"] += row.n
            if not row.bad or self.malformed == WARN:
                for name in self._counts[:-1]:
                    into[name] += row[name]
        for release, of in digests.items():
            for bucket in of:
                counts[release, bucket]  # an entry also where nothing landed
        made = []
        for (release, bucket), of in counts.items():
            digest = digests.get(release, {}).get(bucket)
            version = adding.get(release) if digest is not None else None
            n, total, parity = digest or NOTHING
            made.append((release, version, bucket, self.buckets, bucket in rewritten, self._order, n, Decimal(total), parity, *of.values()))
        return made

    @staticmethod
    def _rank(preference: Sequence[str]) -> Column:
        place = F.array_position(F.lit(list(preference)), F.col("release"))
        return F.when(place > 0, place).otherwise(F.lit(len(preference) + 1)).asc()

    def reconciled(self, spark: SparkSession, preference: Sequence[str]) -> DataFrame:
        """One row per key over the named releases, most preferred first; others are withdrawn.

        Under the declared order, and for one release, rows are read as they are; any other choice is made anew.
        """
        known = self._known(spark)
        rows = self._rows(spark, known)
        if list(preference) == list(self.releases) and known.orders <= {self._order}:
            rows = rows.filter("visible")
        else:
            rows = rows.filter(F.col("release").isin(list(preference)))
            if len(preference) > 1:
                rows = keep_first(rows, KEYS, [self._rank(preference)])
        return keep_valid(rows.select(*self.types), self.rules)

    # --- counts of the stream ---------------------------------------------------------------

    def batch_counts(self, spark: SparkSession) -> DataFrame:
        """run, batch, rule, action, rows_in, rows_broken for each micro-batch of each run of ``merge_landed``."""
        counts = dict.fromkeys(self._counts, "bigint")
        control_rows(spark, [], {"batch": "bigint", **counts}).write.mode("ignore").parquet(f"{self.root}/batches/run=none")
        wide = spark.read.schema(", ".join(f"{n} {t}" for n, t in {"batch": "bigint", **counts, "run": "string"}.items())).parquet(f"{self.root}/batches")
        rules = [(rule.name, rule.action, f"broken_{i}") for i, rule in enumerate(self.rules)] + [("well_formed", self.malformed, "malformed")]
        each = F.array(*[
            F.struct(F.lit(name).alias("rule"), F.lit(action).alias("action"), F.col("rows_in"), F.col(broken).alias("rows_broken")) for name, action, broken in rules
        ])
        return wide.select("run", "batch", F.inline(each))


class _BatchCounts(StreamingQueryListener):
    """Gathers what one query's batches observed; the query names its observation and itself alike."""

    def __init__(self, name: str) -> None:
        self.name, self.found, self.ended, self._run = name, {}, threading.Event(), None

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self._run = event.runId

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name) if event.progress.name == self.name else None
        if seen is not None and event.progress.numInputRows:
            self.found[event.progress.batchId] = seen.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self._run:
            self.ended.set()


def merge_landed(
    spark: SparkSession, landing: str, state: ObservationState, checkpoint: str, *, files_per_batch: int | None = None
) -> None:
    """Merge every version landed below ``landing`` since the last call, then stop.

    Versions lie side by side as ``release=<name>/version=<id>/``; a file is read once.  Rule and malformed-line
    counts are observed in the stream itself and stored, one row per batch, when the query has stopped.
    """
    options = {"maxFilesPerTrigger": str(files_per_batch)} if files_per_batch else {}
    name = f"merge-{uuid.uuid4().hex}"
    counts = _BatchCounts(name)
    spark.streams.addListener(counts)
    lines = F.count_if(F.col(MALFORMED).isNotNull()).alias("malformed")
    try:
        query = (
            state.staged(stream_padded(spark, landing, LANDED, malformed=True, **options))
            .observe(name, *rule_aggregates(state.rules), lines)
            .writeStream.queryName(name).foreachBatch(lambda rows, _: state.merge_staged(rows))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        counts.ended.wait(60)
    finally:
        spark.streams.removeListener(counts)
    if counts.found:
        rows = [(batch, *(seen[n] or 0 for n in state._counts)) for batch, seen in sorted(counts.found.items())]
        schema = ", ".join(f"{n} bigint" for n in ["batch", *state._counts])
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{state.root}/batches/run={query.runId}")
