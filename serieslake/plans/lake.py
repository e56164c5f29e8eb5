"""Published tables: checked snapshots behind a log of publishes."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from serieslake.operators.rules import Rule, RuleViolation, count_rows, keep_valid, require, rule_aggregates
from serieslake.session import control_rows

# One line per publish; the newest accepted line of a dataset points to its current snapshot.
LOG = {
    "seq": "bigint", "run_at": "timestamp", "accepted": "boolean", "path": "string", "schema": "string",
    "rows_in": "bigint", "rows_kept": "bigint",
    "rules": "array<struct<rule: string, action: string, rows_in: bigint, rows_broken: bigint>>",
    # Of a bucketed snapshot: the name of its table, and how the table is laid out.
    "table": "string", "layout": "string",
}
#: How the catalog's names of bucketed snapshots begin; the tables are external, so nothing but the name is kept there.
SNAPSHOTS = "default.serieslake"
LAYERS = {
    "bronze": "rows as landed",
    "silver": "typed, deduplicated and decoded rows",
    "gold": "answers",
}


class Lake:
    """Datasets named ``layer.table`` below one root folder.

    A publish writes a new snapshot folder, counts the rules in the same pass, and only
    then adds a line to the dataset's log.  Readers follow the newest accepted line, so
    they never see a half-written or refused snapshot, and what a job reads is never what
    it overwrites.  One publisher per dataset at a time.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        # An empty log with its schema, unless there is one.
        control_rows(spark, [], LOG).write.mode("ignore").parquet(self._log_folder("none"))

    def _log_folder(self, name: str) -> str:
        return f"{self.root}/publishes/dataset={name}"

    def log(self) -> DataFrame:
        """Every publish of every dataset, refused ones included."""
        schema = ", ".join(f"{n} {t}" for n, t in {"dataset": "string", **LOG}.items())
        return self.spark.read.schema(schema).parquet(f"{self.root}/publishes")

    def _newest(self, name: str, accepted_only: bool) -> Row | None:
        columns = ", ".join(f"{n} {t}" for n, t in LOG.items())
        try:  # the folder of this dataset alone is listed and read
            lines = self.spark.read.schema(columns).parquet(self._log_folder(name))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        if accepted_only:
            lines = lines.filter("accepted")
        return lines.orderBy(F.col("seq").desc()).drop("rules").first()

    def _current(self, name: str) -> Row:
        line = self._newest(name, accepted_only=True)
        if line is None:
            raise LookupError(f"{name} was never published")
        return line

    def read(self, name: str, empty: T.StructType | None = None, order_by: Sequence[str] = ()) -> DataFrame:
        """The current snapshot; an unpublished dataset is empty if a schema is given for it.

        A stored table has no order, so rows come in one only if ``order_by`` asks for it.
        """
        rows = self._read(name, empty)
        return rows.orderBy(*order_by) if order_by else rows

    def _read(self, name: str, empty: T.StructType | None) -> DataFrame:
        line = self._newest(name, accepted_only=True)
        if line is None and empty is not None:
            return control_rows(self.spark, [], {f.name: f.dataType.simpleString() for f in empty.fields})
        line = line or self._current(name)
        schema = T.StructType.fromJson(json.loads(line["schema"]))
        if line["table"]:
            self._register(line["table"], schema, line["layout"], line["path"])
            return self.spark.table(line["table"])
        return self.spark.read.schema(schema).parquet(line["path"])

    def _register(self, table: str, schema: T.StructType, layout: str, path: str) -> None:
        """The catalog knows how a bucketed table lies, so that scans of it need no shuffle; the data belong to the folder."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {layout} LOCATION '{path}'")

    def publish(
        self, df: DataFrame, name: str, rules: Sequence[Rule] = (), *, run_at: dt.datetime, min_rows: int = 0,
        partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (), rule_columns: Sequence[str] = (),
        bucket_by: str | None = None, sort_by: Sequence[str] = (),
    ) -> dict[str, int]:
        """Replace a dataset by ``df`` and return its row counts.

        The rules are counted by ``observe`` in the tasks that write, after the last shuffle,
        so one job does both and a retried stage is not counted twice.  A broken fail rule, or
        fewer rows than ``min_rows``, raises after the counts are logged, and the earlier
        snapshot stays current.  ``rule_columns`` serve the rules only and are not stored.

        ``cluster_by`` sorts the table over its files, so that a lookup reads few row groups;
        name enough columns that no one value of them is heavy, as equal rows share a task.
        ``bucket_by`` stores the table in as many hash buckets of one column as the session shuffles into, each sorted by
        ``sort_by``: later steps by that column read it without a shuffle.  ``df`` has to be distributed by it
        (``reconcile(by=...)``), else each task writes a file per bucket; its values have to be light.
        ``partition_by`` alone evens out the files: adaptive execution splits a heavy folder
        over several writers and gathers small ones.
        """
        if cluster_by:
            df = df.repartitionByRange(*partition_by, *cluster_by).sortWithinPartitions(*partition_by, *cluster_by)
        elif partition_by:
            df = df.hint("rebalance", *partition_by)
        seen = Observation()
        kept = keep_valid(df.observe(seen, *rule_aggregates(rules)), rules).drop(*rule_columns)
        newest = self._newest(name, accepted_only=False)
        seq = (newest["seq"] if newest else 0) + 1
        layer, table = name.split(".", 1)
        path = f"{self.root}/{layer}/{table}/snapshot={seq:06d}-{uuid.uuid4().hex[:8]}"
        stored, layout = None, None
        if bucket_by:
            stored = f"{SNAPSHOTS}_{layer}_{table}_{path.rsplit('-', 1)[-1]}"
            buckets = self.spark.conf.get("spark.sql.shuffle.partitions")
            order = f" SORTED BY ({', '.join(f'`{name}`' for name in sort_by)})" if sort_by else ""
            layout = f"CLUSTERED BY (`{bucket_by}`){order} INTO {buckets} BUCKETS"
            self._register(stored, kept.schema, layout, path)
            kept.write.insertInto(stored)
        else:
            kept.write.partitionBy(*partition_by).parquet(path)
        counts = _counts(seen, rules)
        refusal = None
        try:
            require(rules, counts, min_rows)
        except RuleViolation as violation:
            refusal = violation
        line = (
            seq, run_at, refusal is None, path, kept.schema.json(), counts["rows_in"], counts["rows_kept"],
            count_rows(rules, counts), stored, layout,
        )
        control_rows(self.spark, [line], LOG).write.mode("append").parquet(self._log_folder(name))
        if refusal:
            raise refusal
        return counts

    def rule_log(self) -> DataFrame:
        """Every rule count of every publish, refused ones included."""
        return self.log().select("dataset", "seq", "run_at", "accepted", "rows_kept", F.inline("rules"))

    def rule_trend(self) -> DataFrame:
        """Share of broken rows per dataset and rule: over all runs, and in the last one."""
        last = F.max_by(F.struct("rows_in", "rows_broken"), "seq")
        share = lambda broken, rows: F.when(rows > 0, broken / rows)
        return (
            self.rule_log().groupBy("dataset", "rule", "action")
            .agg(F.count("*").alias("runs"), F.sum("rows_in").alias("rows_in"),
                 F.sum("rows_broken").alias("rows_broken"), last.alias("last"))
            .select("dataset", "rule", "action", "runs", "rows_in", "rows_broken",
                    share(F.col("rows_broken"), F.col("rows_in")).alias("share"),
                    share(F.col("last.rows_broken"), F.col("last.rows_in")).alias("last_share"))
        )

    def expose(self, name: str) -> None:
        """Make the current snapshot readable as ``layer.table`` in the session's catalog."""
        layer, table = name.split(".", 1)
        path = self._current(name)["path"]
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{layer}` COMMENT '{LAYERS.get(layer, layer)}'")
        self.spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{table}` AS SELECT * FROM parquet.`{path}`")


def _counts(seen: Observation, rules: Sequence[Rule]) -> dict[str, int]:
    # A plan that is found to be empty before it runs carries no counters.
    none = {"rows_in": 0, "rows_kept": 0, **{f"broken_{i}": 0 for i in range(len(rules))}}
    return {**none, **{k: v for k, v in (seen.get or {}).items() if v is not None}}
