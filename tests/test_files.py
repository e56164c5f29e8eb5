"""Listing, landing and hashing of files, against the operating system and plain hashing."""

import hashlib
import io
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from serieslake.sources import files


def tree(root):
    return {os.path.relpath(os.path.join(folder, name), root): os.path.getsize(os.path.join(folder, name)) for folder, _, names in os.walk(root) for name in names}


def test_listing_holds_every_file(spark, tmp_path):
    for path, content in {"a.txt": b"1", "_b.txt": b"22", ".c.txt": b"333", "empty": b"", "x/y/z/deep": b"4", "x/_hidden/.e": b"", "x/with space/%41": b"5"}.items():
        target = tmp_path / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content)
    (tmp_path / "nothing").mkdir()
    rows = files.list_files(spark, str(tmp_path)).collect()
    assert {r.relative_path: r.size_bytes for r in rows} == tree(tmp_path) and len(rows) == 7
    assert {r.path for r in rows} == {f"file:{tmp_path}/{path}" for path in tree(tmp_path)}
    assert all(abs(r.modified_at.timestamp() - os.path.getmtime(tmp_path / r.relative_path)) < 1 for r in rows)
    assert {r.relative_path for r in files.list_files(spark, f"file:{tmp_path}", glob="*.txt").collect()} == {"a.txt", "_b.txt", ".c.txt"}
    assert {r.relative_path for r in files.list_files(spark, str(tmp_path), hidden=False).collect()} == {"a.txt", "empty", "x/y/z/deep", "x/with space/%41"}
    assert files.list_files(spark, str(tmp_path / "nowhere")).count() == 0


def test_landed_files_hold_their_bytes(spark, frame, tmp_path):
    rows = [("p/q.bin", bytearray(b"\x00\xff")), ("_r", bytearray(b"")), ("n", None)]
    made = {r.relative_path: (r.size_bytes, r.content_hash) for r in files.land_files(frame("relative_path string, content binary", *rows), str(tmp_path / "in")).collect()}
    assert made == {path: (len(content or b""), hashlib.sha256(content or b"").hexdigest()) for path, content in rows}
    assert (tmp_path / "in/p/q.bin").read_bytes() == b"\x00\xff" and tree(tmp_path / "in") == {"p/q.bin": 2, "_r": 0, "n": 0}


def whole(data, size):
    parts = [data[k : k + size] for k in range(0, len(data), size)] or [b""]
    hashes = [hashlib.sha256(part).hexdigest() for part in parts]
    try:
        data.decode()
    except UnicodeDecodeError:
        return hashes, False
    return hashes, True


pieces = st.sampled_from([b"a", "é".encode(), "世".encode(), "😀".encode(), b"\x80", b"\xc3", b"\xe4\xb8", b"\xf0\x9f\x98", b"\xff", b"\xed\xa0\x80"])


@settings(max_examples=300, deadline=None)
@given(st.lists(pieces, max_size=12).map(b"".join), st.integers(4, 9), st.integers(4, 9))
def test_ranges_equal_the_whole(data, size, block):
    found = [files.range_digest(io.BytesIO(data), len(data), k, size, block) for k in range(0, max(1, len(data)), size)]
    hashes, valid = whole(data, size)
    assert [h for h, _ in found] == hashes
    assert all(ok for _, ok in found) == valid


def test_large_file_is_hashed_by_several_tasks(spark, tmp_path):
    data = os.urandom(300_000)
    (tmp_path / "large").write_bytes(data)
    (tmp_path / "none").write_bytes(b"")
    listed = files.list_files(spark, str(tmp_path))
    found = {r.relative_path: r.content_hash for r in files.content_digests(listed, range_bytes=10_000).collect()}
    hashes, _ = whole(data, 10_000)
    assert found == {"large": hashlib.sha256("".join(hashes).encode()).hexdigest(), "none": hashlib.sha256(b"").hexdigest()}
    ranges = files.content_digests(listed.filter("size_bytes > 0"), range_bytes=10_000)
    assert "Exchange hashpartitioning(path" in ranges._jdf.queryExecution().executedPlan().toString()
    once = {r.relative_path: r.content_hash for r in files.content_digests(listed).collect()}
    assert once["large"] == hashlib.sha256(data).hexdigest()


def test_changed_file_is_an_error(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"12345")
    listed = files.list_files(spark, str(tmp_path)).withColumn("size_bytes", F.lit(9).cast("bigint"))
    with pytest.raises(Exception, match="ended 4 bytes early"):
        files.content_digests(listed).collect()
