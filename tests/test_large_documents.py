"""Documents read in byte ranges, against a whole parse."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from serieslake.sources.documents import flatten, read_documents
from serieslake.sources.large_documents import ESCAPED, PLAIN, STRING, read_large_documents, records, transitions

odd = st.text('a"\\{}[]:,é😀\n ', max_size=8)
leaf = st.one_of(st.none(), st.booleans(), st.integers(-99, 99), odd)
value = st.recursive(leaf, lambda v: st.one_of(st.lists(v, max_size=3), st.dictionaries(odd, v, max_size=3)), max_leaves=6)
document = st.fixed_dictionaries({"source": value, 'da"ta': value, "data": st.lists(st.dictionaries(odd, value, max_size=3), max_size=6), "end": value})


def states(block, begin):
    """The same, a byte at a time."""
    state, depth = begin, 0
    for byte in block:
        if state == ESCAPED:
            state = STRING
        elif state == STRING:
            state = {34: PLAIN, 92: ESCAPED}.get(byte, STRING)
        elif byte == 34:
            state = STRING
        else:
            depth += (byte in b"{[") - (byte in b"}]")
    return state, depth


@settings(max_examples=300, deadline=None)
@given(document, st.integers(1, 20), st.booleans())
def test_maps_of_ranges_compose(doc, size, pretty):
    text = json.dumps(doc, indent=2 if pretty else None, ensure_ascii=False).encode()
    state, depth = PLAIN, 0
    for k in range(0, len(text), size):
        block = text[k : k + size]
        found = transitions(block)
        assert found[state] == states(block, state)
        assert all(found[s] == states(block, s) for s in (STRING, ESCAPED) if b"\\" not in block)
        state, depth = found[state][0], depth + found[state][1]
    assert (state, depth) == (PLAIN, 0)


def test_records_equal_a_whole_parse(spark, tmp_path):
    docs = [
        {"source": [{"data": [{"no": 1}]}], "data": [{"a": '}{"\\'}, {}, {"b": {"data": [{"c": 1}]}, "é": "世😀" * 30}], "end": {"data": {"x": {}}}},
        {"data": [], "x": [{"no": 2}]},
        {"q\"data": [{"no": 3}], "data": [{"k": k, "s": "\\\\" * (k % 5) + '"' * (k % 3)} for k in range(40)], "data2": [{"no": 4}]},
    ]
    for k, doc in enumerate(docs):
        (tmp_path / f"{k}.json").write_text(json.dumps(doc, indent=k or None, ensure_ascii=False))
    (tmp_path / "empty.json").write_text("")
    expected = sorted(json.dumps(record, sort_keys=True) for doc in docs for record in doc["data"])
    for size in (7, 64, 1 << 20):
        rows = [r.value for r in records(spark, str(tmp_path), range_bytes=size).collect()]
        assert sorted(json.dumps(json.loads(row), sort_keys=True) for row in rows) == expected


def test_one_pretty_document_is_read_by_many_tasks(spark, tmp_path):
    schema = T.StructType([T.StructField("Nation ID", T.StringType()), T.StructField("n", T.StringType())])
    doc = {"annotations": {"topic": "x"}, "data": [{"Nation ID": f"N{k}", "n": k / 4 if k % 2 else str(k)} for k in range(500)]}
    path = tmp_path / "one.json"
    path.write_text(json.dumps(doc, indent=4))
    df = read_large_documents(spark, str(path), schema, range_bytes=2000)
    assert df.rdd.getNumPartitions() > 3 and df.columns == ["Nation ID", "n"]
    plain = flatten(read_documents(spark, str(path), schema))
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, plain.collect()))


def test_document_that_does_not_close(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"data": [{"a": 1}')
    with pytest.raises(Exception, match="does not close"):
        records(spark, str(tmp_path), range_bytes=5).collect()
