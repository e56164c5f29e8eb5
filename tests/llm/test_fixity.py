"""Audits find exactly the records that differ; trees and ranges by plain definitions."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from serieslake.llm import fixity
from serieslake.session import materialize


@pytest.fixture
def archive(frame):
    rng = random.Random(4)
    pages = [(i, f"u{i}", "x" * rng.randint(0, 60) + "é", 1) for i in range(700)] + [(None, None, None, 1), (3, "u3", "copy", 1), (3, "u3", "copy", 1), (9, "", "", 1)]
    return materialize(fixity.build_archive(frame("page_id long, url string, html string, segment int", *pages), per_segment=40), "archive")


def test_records_and_offsets(archive):
    rows = archive.collect()
    assert len(rows) == 704
    for segment in {r.segment for r in rows}:
        own = sorted((r for r in rows if r.segment == segment), key=lambda r: r.seq)
        assert [r.seq for r in own] == list(range(len(own)))
        file, record = b"".join(bytes(r.record) for r in own), own[-1]
        assert all(file[r.start : r.start + r.length] == bytes(r.record) for r in own)
        header, block = bytes(record.record).split(b"\r\n\r\n", 1)
        assert header.startswith(b"WARC/1.0\r\n") and int(header.split(b"Content-Length: ")[1]) == len(block) - 4


def test_tree_has_one_root_and_covers_all(archive):
    levels = fixity.tree(archive)
    root = levels[-1].collect()
    assert len(root) == 1
    leaf = {(r.segment, r.seq): hashlib.sha256(f"{r.start}:{hashlib.sha256(r.record).hexdigest()}".encode()).hexdigest() for r in archive.collect()}
    assert {(r.segment, r.idx): r.hash for r in levels[0].collect()} == leaf
    first = {}
    for r in sorted(levels[0].collect(), key=lambda r: (r.segment, r.idx)):
        first.setdefault((r.segment, r.idx // 16), []).append(f"{r.segment}:{r.idx}:{r.first}:{r.last}:{r.hash}")
    assert {(r.segment, r.idx): r.hash for r in levels[1].collect()} == {k: hashlib.sha256("|".join(v).encode()).hexdigest() for k, v in first.items()}


def test_audit_finds_planted_damage(archive):
    rng = random.Random(6)
    keys = [(r.segment, r.seq) for r in archive.collect()]
    altered, missing = rng.sample(keys, 5), rng.sample(keys, 3)
    at = lambda chosen: F.concat_ws(":", "segment", "seq").isin([f"{a}:{b}" for a, b in chosen])
    replica = archive.withColumn("record", F.when(at(altered), F.lit(b"?")).otherwise(F.col("record"))).filter(~at(missing))
    got = {(r.segment, r.seq): r.status for r in fixity.audit(archive, replica).collect()}
    assert got == {**dict.fromkeys(altered, "altered"), **dict.fromkeys(missing, "missing")}
    back = {(r.segment, r.seq): r.status for r in fixity.audit(replica, archive).collect()}
    assert back == {**dict.fromkeys(altered, "altered"), **dict.fromkeys(missing, "extra")}


def test_equal_and_empty(archive, frame):
    assert fixity.audit(archive, archive).count() == 0
    none = fixity.build_archive(frame("page_id long, url string, html string"))
    assert fixity.audit(none, none).count() == 0
    assert {r.status for r in fixity.audit(archive, none).collect()} == {"missing"}
    assert fixity.audit(archive, none).count() == archive.count()


def test_query_equals_sql(spark, sf):
    from oracle import connect, duckdb_rows, spark_rows

    from serieslake.llm.queries import OP3_SQL, op3_fixity_audit

    assert spark_rows(op3_fixity_audit(spark, sf)) == duckdb_rows(connect(sf), OP3_SQL)
