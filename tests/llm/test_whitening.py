import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from serieslake.llm import whitening
from serieslake.llm.common import table
from serieslake.llm.queries import op13_whitening


def plain(rows):
    """n, deviations, whitened, explained of a list of equally long vectors, by the definition."""
    x = np.floor(np.array(rows, float) * 1024).astype(int) + 100000
    n, sums = len(x), x.sum(0)
    deviations = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    return n, deviations, centred @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def by_row(df, key="vec_id"):
    found = {}
    for row in df.collect():
        found.setdefault(row[key], {})[row.component] = row
    return found


def agrees(found, ids, rows):
    n, deviations, whitened, explained = plain(rows)
    sign = [math.copysign(1, found[ids[0]][k + 1].whitened * whitened[0, k]) for k in range(whitened.shape[1])]
    assert set(found) == set(ids)
    for i, key in enumerate(ids):
        assert sorted(found[key]) == list(range(1, len(explained) + 1))
        for k, share in enumerate(explained):
            row = found[key][k + 1]
            assert row.n == n and row.deviation == deviations[i]
            assert row.whitened == pytest.approx(sign[k] * whitened[i, k], abs=1e-8)
            assert row.explained == pytest.approx(share, rel=1e-9) and 0 <= row.identity_error < 1e-9


def test_query_equals_definition(spark, sf):
    rows = table(spark, sf, "embeddings").collect()
    agrees(by_row(op13_whitening(spark, sf)), [row.vec_id for row in rows], [row.embedding for row in rows])


def test_unusable_vectors_are_dropped(frame):
    rng = np.random.default_rng(3)
    good = [(k, [float(v) for v in rng.normal(size=5)]) for k in range(40)]
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [math.nan, 0.0, 0.0, 0.0, 0.0]), (103, [math.inf, 0.0, 0.0, 0.0, 0.0]), (104, []), (105, [1.0, 2.0])]
    df = frame("vec_id long, embedding array<double>", *good, *bad).withColumns({"n": F.lit("x"), "component": F.lit(-1)})
    agrees(by_row(whitening.whiten(df)), [k for k, _ in good], [v for _, v in good])


@pytest.mark.parametrize("group", [1, 3])
def test_many_blocks_and_groups(frame, monkeypatch, group):
    monkeypatch.setattr(whitening, "BLOCK_VALUES", 40)
    monkeypatch.setattr(whitening, "SPLIT", 2)
    rng = np.random.default_rng(5)
    rows = [(k, [float(v) for v in rng.normal(size=4) * [5, 1, 0.5, 0.1] + 50]) for k in range(333)]
    agrees(by_row(whitening.whiten(frame("vec_id long, embedding array<double>", *rows).repartition(5), group=group)), list(range(333)), [v for _, v in rows])


def test_large_entries_stay_exact(frame):
    rows = [(k, [1e12 * k, -3e11 * k * k, 7.0]) for k in range(1, 6)]
    found = by_row(whitening.whiten(frame("vec_id long, embedding array<double>", *rows)))
    _, deviations, _, _ = plain([v for _, v in rows])
    assert [int(found[k][1].deviation) for k in range(1, 6)] == deviations and max(deviations) > 1 << 64
    assert whitening.whiten(frame("vec_id long, embedding array<double>", (1, [1e300, 0.0]), (2, [-1e300, 0.0]))).count() == 4


def test_no_variance_repeats_and_null_ids(frame):
    df = frame("vec_id long, embedding array<float>", (1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0]))
    rows = whitening.whiten(df).collect()
    assert sorted((row.vec_id or 0, row.component) for row in rows) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2)]
    assert {(row.n, int(row.deviation), row.whitened, row.explained, row.identity_error) for row in rows} == {(3, 0, None, None, None)}
    line = whitening.whiten(frame("vec_id long, embedding array<float>", (1, [1.0, 2.0]), (2, [3.0, 4.0]))).collect()
    assert {(row.component, row.whitened is None) for row in line} == {(1, False), (2, True)}
    assert {round(row.explained, 12) for row in line} == {0, 1}


def test_empty_tables(frame):
    schema = "vec_id string, embedding array<float>"
    for df in (frame(schema), frame(schema, ("a", None), ("b", []))):
        out = whitening.whiten(df)
        assert out.collect() == [] and out.columns[:3] == ["vec_id", "component", "n"] and dict(out.dtypes)["vec_id"] == "string"
