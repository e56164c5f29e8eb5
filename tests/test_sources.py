"""Scans: padding, blanks, headers, field counts, documents, listings, links."""

from decimal import Decimal

import glob
import hashlib
import os
import time

import pytest
from pyspark.sql import functions as F

from serieslake import schemas as S
from serieslake.functions import resolve_link, to_type, unparsed
from serieslake.operators.reconcile import observation_types, typed
from serieslake.sources import landing, text
from serieslake.sources.documents import flatten, read_documents
from serieslake.sources.text import read_padded, split_malformed, write_padded

HEADER = "series_id        \tyear\tperiod\t       value\tfootnote_codes\n"


def land(tmp_path, text, name="extract.txt"):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, newline="")
    return str(path)


def test_padding_is_stripped_and_blank_is_null(spark, tmp_path):
    path = land(tmp_path, HEADER + "PRS30006011      \t1995\tQ01\t         2.6\t\n" + "           \t1995\tQ01\t 1\t\n")
    rows = [tuple(r) for r in read_padded(spark, path, S.OBSERVATIONS).collect()]
    assert rows == [("PRS30006011", "1995", "Q01", "2.6", None), (None, "1995", "Q01", "1", None)]


def test_unparsable_number_becomes_null_and_is_counted(frame):
    df = frame("v string", (" 2.5 ",), ("-",), ("  ",), (None,))
    rows = df.select(to_type("v", "double").alias("d"), unparsed("v", "double").alias("u")).collect()
    assert [r.d for r in rows] == [2.5, None, None, None]
    assert [bool(r.u) for r in rows] == [False, True, False, False]


def test_swapped_header_stops_the_scan(spark, tmp_path):
    path = land(tmp_path, "year\tseries_id\tperiod\tvalue\tfootnote_codes\n1995\tA\tQ01\t1\t\n")
    with pytest.raises(Exception, match="header does not conform"):
        read_padded(spark, path, S.OBSERVATIONS).collect()
    by_position = read_padded(spark, path, S.OBSERVATIONS, check_header=False).first()
    assert (by_position.series_id, by_position.year) == ("1995", "A")


def test_header_case_does_not_matter(spark, tmp_path):
    path = land(tmp_path, "Seasonal_code\tSeasonal_text\nS\tSeasonally Adjusted\n")
    assert [tuple(r) for r in read_padded(spark, path, S.SEASONAL).collect()] == [("S", "Seasonally Adjusted")]


def test_wrong_field_counts_are_set_apart(spark, tmp_path):
    path = land(tmp_path, HEADER + "A\t1995\tQ01\t1\t\nB\t1995\nC\t1995\tQ01\t1\t\tmore\n")
    good, bad = split_malformed(read_padded(spark, path, S.OBSERVATIONS, malformed=True))
    assert (good.count(), bad.count()) == (1, 2)
    assert [r.series_id for r in good.collect()] == ["A"]
    assert sorted(r._malformed.split("\t")[0] for r in bad.collect()) == ["B", "C"]


def test_padded_round_trip(spark, frame, tmp_path):
    df = frame("series_id string, value string", ("A", "1.5"), ("LONGER THAN WIDE", None))
    path = str(tmp_path / "out")
    write_padded(df, path, {"series_id": 6, "value": -8})
    text = sorted(r.value for r in spark.read.text(path).collect())
    assert "A     \t     1.5" in text
    back = read_padded(spark, path, S.text_schema("series_id", "value"))
    assert sorted(map(tuple, back.collect())) == [("A", "1.5"), ("LONGER THAN WIDE", None)]


def test_compressed_extracts_hold_the_same_rows_in_bounded_files(frame, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text, "LINES_PER_FILE", 40)
    rows = [(f"S{i}", "1995", "Q01", str(i), None if i % 2 else "R") for i in range(100)]
    df = frame("series_id string, year string, period string, value string, footnote_codes string", *rows).coalesce(1)
    size = {}
    for kind in ("none", "gzip"):
        path = str(tmp_path / kind)
        write_padded(df, path, {"series_id": 17, "value": -24}, compression=kind)
        assert sorted(tuple(r) for r in read_padded(spark, path, S.OBSERVATIONS).collect()) == sorted(rows)
        files = [f for f in os.listdir(path) if f.startswith("part-")]
        assert len(files) == (3 if kind == "gzip" else 1)
        size[kind] = sum(os.path.getsize(os.path.join(path, f)) for f in files)
    assert size["gzip"] < size["none"] / 3


def test_typed_observations(frame):
    raw = frame("series_id string, year string, period string, value string, footnote_codes string",
                ("A   ", " 1995", "Q01 ", "   2.6", None))
    assert tuple(typed(raw, observation_types()).first()) == ("A", 1995, "Q01", Decimal("2.6"), None)


DOCUMENT = """{"annotations": {"x": 1}, "page": {"limit": 0}, "columns": ["a"],
 "data": [{"Nation ID": "01000US", "Nation": "United States", "Year": 2013, "Population": 316128839.0},
          {"Nation ID": "01000US", "Nation": "United States", "Year": 2014, "Population": null}]}"""


@pytest.mark.parametrize("lines", [False, True])
def test_nested_document(spark, tmp_path, lines):
    text = DOCUMENT.replace("\n", " ") if lines else DOCUMENT
    df = flatten(read_documents(spark, land(tmp_path, text, "p.json"), S.POPULATION_RECORD, lines=lines))
    assert df.columns == ["Nation ID", "Nation", "Year", "Population"]
    assert sorted(r.Year for r in df.collect()) == ["2013", "2014"]


def test_column_name_with_space_survives_parquet(spark, tmp_path):
    df = flatten(read_documents(spark, land(tmp_path, DOCUMENT, "p.json"), S.POPULATION_RECORD))
    df.write.parquet(str(tmp_path / "t"))
    assert "Nation ID" in spark.read.parquet(str(tmp_path / "t")).columns


def test_landed_files_and_hashes(spark, tmp_path):
    land(tmp_path, "abc", "pr/pr.class")
    (tmp_path / "pr" / "bad.bin").write_bytes(b"\xff\xfe")
    listed = {r.relative_path: r.size_bytes for r in landing.landed_files(spark, str(tmp_path)).collect()}
    assert listed == {"pr/pr.class": 3, "pr/bad.bin": 2}
    content = {r.relative_path: r for r in landing.landed_content(spark, str(tmp_path)).collect()}
    assert content["pr/pr.class"].content_hash == hashlib.sha256(b"abc").hexdigest()
    assert (content["pr/pr.class"].valid_utf8, content["pr/bad.bin"].valid_utf8) == (True, False)


def test_table_fingerprint_ignores_order_but_not_values(frame):
    a = frame("k int, v string", (1, "x"), (2, None), (2, None))
    b = frame("k int, v string", (2, None), (1, "x"), (2, None)).repartition(3)
    c = frame("k int, v string", (2, None), (1, "x"))
    assert landing.table_fingerprint(a) == landing.table_fingerprint(b)
    assert landing.table_fingerprint(a) != landing.table_fingerprint(c)


LISTING = (
    '<A HREF="/pub/">[To Parent Directory]</A><br><br>\n'
    '  6/4/2026  8:30 AM          102 <A HREF="/pub/time/pr.class">pr.class</A><br>'
    ' 12/14/2025 11:05 PM        &lt;dir&gt; <A HREF="/x">x</A><br>'
    '  6/4/2026 12:30 pm        <dir> <a href="sub/">sub</a><br>\n'
)


def test_listing_entries(frame):
    pages = frame("url string, body string", ("https://h.example/pub/time/", LISTING), ("https://h.example/", "none"))
    rows = [tuple(r) for r in landing.parse_listing(pages, "body", "url").orderBy("name").collect()]
    assert rows == [
        ("https://h.example/pub/time/", "pr.class", "https://h.example/pub/time/pr.class", False, 102, "6/4/2026 8:30 AM"),
        ("https://h.example/pub/time/", "sub", "https://h.example/pub/time/sub/", True, None, "6/4/2026 12:30 pm"),
    ]


BASES = ["https://h.example/a/b/c.html?q=1#f", "http://h.example", "https://h.example/a/", "https://h.example/x?y=/z/w"]
HREFS = [
    "/p/q", "p", "./p", "../p", "../../../p", "a/./b/../c", "?n=2", "#top", "", "//other.example/x", "mailto:a@b",
    "https://other.example/y", "/a/b/..", "/a/b/.", "p?x=../y", "..", "/", ".", "/et.", "a//b",
]


def test_links_resolve_like_the_standard(frame):
    from urllib.parse import urljoin

    pairs = [(base, href) for base in BASES for href in HREFS]
    rows = frame("b string, h string", *pairs).select("b", "h", resolve_link("b", "h").alias("r")).collect()
    assert {(r.b, r.h): r.r for r in rows} == {(b, h): urljoin(b, h) for b, h in pairs}


def test_scratch_follows_the_session_setting(spark):
    from serieslake.session import scratch_path

    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared)
    assert not os.path.exists(a)


def test_materialize_keeps_rows_and_schema(frame):
    from serieslake.session import materialize

    df = frame("a int, b string", (1, "x"), (2, None)).withColumn("c", F.col("a").cast("decimal(18,4)"))
    back = materialize(df, "t")
    assert back.dtypes == df.dtypes and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_shuffles_behind_a_stored_table_are_removed(spark):
    from serieslake.session import CLEANUP, materialize

    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    held = lambda: {f for folder in folders for f in glob.glob(f"{folder}/**/shuffle_*.data", recursive=True)}
    before, setting = held(), spark.conf.get(CLEANUP, None)
    df = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    stored = materialize(df, "t")
    until = time.monotonic() + 10  # files are removed in the background
    while held() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not held() - before
    assert spark.conf.get(CLEANUP, None) == setting
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.collect()))


def test_settings_grow_with_the_shuffle():
    from serieslake.session import sized_for

    assert sized_for(1 << 40, 400)["spark.sql.shuffle.partitions"] == "4096"
    assert sized_for(100 << 40, 8000)["spark.sql.shuffle.partitions"] == str(100 << 12)
    assert sized_for(100 << 40, 8000, most=50_000)["spark.sql.shuffle.partitions"] == "50000"
    assert sized_for(0, 8)["spark.sql.shuffle.partitions"] == "16"


def test_numbers_in_quotes_are_read(spark, tmp_path):
    from serieslake.plans.datasets import bronze_population, silver_population

    records = '{"Nation ID": "n", "Nation": "N", "Year": "2013", "Population": "12.5"}, {"Nation ID": "n", "Nation": "N", "Year": 2014, "Population": 13}'
    path = land(tmp_path, '{"data": [%s, {"Nation ID": "n", "Nation": "N", "Year": 2015.0, "Population": " 1e3 "}]}' % records, "q.json")
    rows = silver_population(bronze_population(spark, path)).collect()
    assert sorted((r.year, r.population) for r in rows) == [(2013, 12.5), (2014, 13.0), (2015, 1000.0)]


def test_headers_of_odd_paths(spark, tmp_path):
    import gzip

    from serieslake.operators.checks import headers
    from serieslake.sources.files import store_address

    (tmp_path / "with space").mkdir()
    (tmp_path / "with space" / "a%b.txt").write_text("one\ttwo\n1\t2\n")
    (tmp_path / "with space" / "c.txt.gz").write_bytes(gzip.compress(b"three\n4\n"))
    found = {r.relative_path.split("/")[-1]: r.found for r in headers(spark, str(tmp_path / "with space")).collect()}
    assert found == {"a%b.txt": ["one", "two"], "c.txt.gz": ["three"]}
    assert store_address("s3a://bucket/a b/c.txt") == "s3://bucket/a%20b/c.txt"
    assert store_address("file:/x y") == "file:///x%20y"
    (tmp_path / "long").mkdir()
    (tmp_path / "long" / "x.txt").write_text("x" * (1 << 21))
    with pytest.raises(Exception, match="no line break"):
        headers(spark, str(tmp_path / "long")).collect()
