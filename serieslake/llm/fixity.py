"""Fixity audit of WARC archives by Merkle trees.

An archive is a table of WARC records in segments, each record with its place, offset and length in its
segment's file.  A leaf hashes a record with its offset range; a node hashes the hashes and the joint
range of up to ``FANOUT`` nodes below it, within a segment and then over segments up to one root.  Two
replicas are compared from the root down: a level's nodes are looked up only below nodes that differ.

Null pages and addresses are empty records of their own; a null id is kept.  Repeated pages are records
each.  Segments are dealt by row, so no group of equal rows gathers in one.  Columns other than those
named are not read.  An empty archive has no nodes; compared with another, all of that one is reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from serieslake.session import materialize

FANOUT = 16


def warc_record(page_id: str, url: str, payload: str) -> Column:
    """A WARC resource record with the payload as its block."""
    block = F.coalesce(F.col(payload), F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col(page_id).cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(F.col(url), F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block, F.lit("\r\n\r\n"),
    ).cast("binary")


def build_archive(pages: DataFrame, per_segment: int = 1024) -> DataFrame:
    """segment, seq, start, length, page_id, record for every row of ``pages(page_id, url, html)``."""
    segments = max(1, -(-pages.count() // per_segment))
    rows = pages.select("page_id", "url", warc_record("page_id", "url", "html").alias("record"), F.monotonically_increasing_id().alias("_row"))
    dealt = rows.withColumn("segment", F.pmod(F.xxhash64("page_id", "_row"), F.lit(segments)).cast("int"))
    order = Window.partitionBy("segment").orderBy("page_id", "url", "_row")
    length = F.octet_length("record").cast("long")
    return dealt.select(
        "segment", (F.row_number().over(order) - 1).alias("seq"),
        F.coalesce(F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
        length.alias("length"), "page_id", "record",
    )


def leaves(archive: DataFrame) -> DataFrame:
    """The tree's level 0: segment, idx, first, last (bytes), hash of each stored record."""
    last = F.col("start") + F.octet_length("record")
    digest = F.sha2(F.concat(F.col("start").cast("string").cast("binary"), F.lit(b":"), F.sha2("record", 256).cast("binary")), 256)
    return archive.select("segment", F.col("seq").alias("idx"), F.col("start").alias("first"), last.alias("last"), digest.alias("hash"))


def _raised(nodes: DataFrame, across: bool) -> DataFrame:
    """The level above ``nodes``: within segments, or of neighbouring segments if ``across``."""
    key = [F.floor(F.col("segment") / FANOUT).cast("int").alias("segment"), F.lit(0).alias("idx")] if across else ["segment", F.floor(F.col("idx") / FANOUT).cast("int").alias("idx")]
    grouped = nodes.select(*key, F.struct(F.col("segment").alias("s"), F.col("idx").alias("i"), "first", "last", "hash").alias("child"))
    merged = grouped.groupBy("segment", "idx").agg(F.sort_array(F.collect_list("child")).alias("below"))  # FANOUT at most
    text = F.concat_ws("|", F.transform("below", lambda c: F.concat_ws(":", c["s"], c["i"], c["first"], c["last"], c["hash"])))
    return merged.select("segment", "idx", F.array_min("below.first").alias("first"), F.array_max("below.last").alias("last"), F.sha2(text, 256).alias("hash"))


def tree(archive: DataFrame, levels: tuple[int, int] | None = None) -> list[DataFrame]:
    """The levels of an archive's tree, leaves first, each a stored table.

    ``levels``: how many lie within segments and above them; by default as many as this archive needs.
    """
    made = [materialize(leaves(archive), "leaves")]
    if levels is None:
        levels = needed_levels(made[0])
    for k in range(sum(levels)):
        made.append(materialize(_raised(made[-1], across=k >= levels[0]), "nodes"))
    return made


def needed_levels(*leaf_tables: DataFrame) -> tuple[int, int]:
    """Levels until a segment has one node, and from there until one is left, for all of the tables."""
    inner = outer = 0
    for table in leaf_tables:
        most = table.agg(F.max("idx").alias("idx"), F.max("segment").alias("segment")).first()
        while (most.idx or 0) >= FANOUT**inner:
            inner += 1
        while (most.segment or 0) >= FANOUT**outer:
            outer += 1
    return inner, outer


def differing(one: DataFrame, other: DataFrame) -> DataFrame:
    """segment, idx, hash, other_hash of nodes that are not the same in both tables; null where there is none."""
    b = other.select("segment", "idx", F.col("hash").alias("other_hash"))
    return one.select("segment", "idx", "hash").join(b, ["segment", "idx"], "full_outer").filter(~F.col("hash").eqNullSafe(F.col("other_hash")))


def audit(archive: DataFrame, replica: DataFrame) -> DataFrame:
    """segment, seq, status of every record that differs: ``altered``, ``missing`` or ``extra`` in the replica."""
    levels = needed_levels(archive.select("segment", F.col("seq").alias("idx")), replica.select("segment", F.col("seq").alias("idx")))
    one, other = tree(archive, levels), tree(replica, levels)
    bad = differing(one[-1], other[-1])
    for k in range(len(one) - 2, -1, -1):
        parent = F.floor(F.col("idx") / FANOUT).cast("int") if k < levels[0] else F.lit(0)
        above = F.col("segment") if k < levels[0] else F.floor(F.col("segment") / FANOUT).cast("int")
        marked = materialize(bad.select(F.col("segment").alias("_s"), F.col("idx").alias("_i")), "branches")

        def below(nodes: DataFrame, marked: DataFrame = marked, parent: Column = parent, above: Column = above) -> DataFrame:
            return nodes.join(marked, (above == F.col("_s")) & (parent == F.col("_i")), "left_semi")

        bad = differing(below(one[k]), below(other[k]))
    status = F.when(F.col("hash").isNull(), "extra").when(F.col("other_hash").isNull(), "missing").otherwise("altered")
    return bad.select("segment", F.col("idx").alias("seq"), status.alias("status"))
