"""The landing area: listing, versions, and directory-listing text."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from serieslake.functions import resolve_link
from serieslake.sources.files import RANGE, content_digests, list_files
from serieslake.sources.text import write_padded

# Fixed value: one entry of a directory-listing page – date, time, size or <dir>, link.
LISTING_ENTRY = (
    r"(?i)(\d{1,2}/\d{1,2}/\d{4})\s+(\d{1,2}:\d{2}\s*[AP]M)\s+(<dir>|\d+)\s+"
    r'<A HREF="([^"]+)">([^<]+)</A>'
)
ANCHOR = r'(?i)<a\s[^>]*href="([^"]*)"'


def landed_files(spark: SparkSession, root: str, *, glob: str | None = None) -> DataFrame:
    """One row per landed file: path, path below ``root``, size and time; content is not read.

    Empty files and names that begin with ``_`` or ``.`` are files like any other.
    """
    return list_files(spark, root, glob=glob)


def landed_content(spark: SparkSession, root: str, *, glob: str | None = None, range_bytes: int = RANGE) -> DataFrame:
    """One row per landed file with its SHA-256 and whether it is well-formed UTF-8.

    Of a file longer than ``range_bytes`` the ranges are hashed by different tasks; see ``content_digests``.
    """
    return content_digests(list_files(spark, root, glob=glob).drop("modified_at"), range_bytes=range_bytes)


def table_fingerprint(df: DataFrame) -> str:
    """A version id for the rows of ``df``, whatever their order or partitioning.

    Row digests are combined by aggregates that do not care for order, so one tiny row
    reaches the driver.
    """
    digest = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in df.columns])
    row = df.select(digest.alias("d")).agg(
        F.count("*").alias("n"),
        F.coalesce(F.bit_xor("d"), F.lit(0)).alias("x"),
        F.coalesce(F.sum(F.col("d").cast("decimal(38,0)")), F.lit(0)).alias("s"),
    ).select(F.sha2(F.concat_ws("|", "n", "x", "s"), 256).alias("v"))
    return row.first()["v"]


def version_path(root: str, release: str, version: str) -> str:
    """Where one version of a release lands; versions sit side by side and are never rewritten."""
    return f"{root.rstrip('/')}/release={release}/version={version}"


def land_release(
    df: DataFrame, root: str, release: str, run_at: dt.datetime, *, widths: Mapping[str, int], known_hash: str | None = None,
    compression: str = "none",
) -> tuple[str, str] | None:
    """Land a release as a padded extract in a folder of its own; (path, content hash).

    None, and nothing written, if the content is what the manifest knows already.  Version
    names sort by time, so the newest version of a row can be told.
    """
    digest = table_fingerprint(df)
    if digest == known_hash:
        return None
    path = version_path(root, release, f"{run_at:%Y%m%dT%H%M%S}-{digest[:16]}")
    write_padded(df, path, widths, compression=compression)
    return path, digest


def parse_listing(pages: DataFrame, text: str, base_url: str) -> DataFrame:
    """Entries of directory-listing pages, one row each; ``pages`` may hold any number of pages."""
    # The whole text is searched once; the parts are then cut from the short matches.
    part = lambda i: F.regexp_extract("entry", LISTING_ENTRY, i)
    entries = pages.select(
        F.col(base_url).alias("page_url"), F.explode(F.regexp_extract_all(F.col(text), F.lit(LISTING_ENTRY), F.lit(0))).alias("entry")
    )
    return entries.select(
        "page_url",
        F.trim(part(5)).alias("name"),
        resolve_link("page_url", part(4)).alias("remote_url"),
        (F.lower(part(3)) == "<dir>").alias("is_dir"),
        part(3).try_cast("bigint").alias("size_bytes"),
        F.concat_ws(" ", part(1), part(2)).alias("last_modified"),
    )


def listed_files(entries: DataFrame, source: str, base: str) -> DataFrame:
    """The files among the entries of ``parse_listing``, as a listing that a sync plan takes; folders drop out."""
    below = F.col("remote_url").startswith(base)
    return entries.filter(~F.col("is_dir") & below).select(
        F.lit(source).alias("source"), F.substring("remote_url", F.lit(len(base) + 1), F.length("remote_url")).alias("relative_path"),
        "remote_url", "size_bytes", "last_modified",
    )


def active_only(rows: DataFrame, manifest: DataFrame, source: str) -> DataFrame:
    """Rows of files (by ``relative_path``) that the manifest holds as active; withdrawn ones drop out."""
    active = manifest.filter((F.col("source") == source) & (F.col("status") == "active")).select("relative_path")
    return rows.join(active, "relative_path", "left_semi")


def extract_links(pages: DataFrame, html: str, base_url: str) -> DataFrame:
    """Every anchor of every page with its absolute address; addresses in double quotes only."""
    return pages.select(
        F.col(base_url).alias("page_url"),
        F.posexplode(F.regexp_extract_all(F.col(html), F.lit(ANCHOR), F.lit(1))).alias("position", "href"),
    ).withColumn("link", resolve_link("page_url", "href"))
