"""Each stage against what its operator says of the stage's input; the whole against a plain chain."""

import numpy as np
import pytest

import corpus_pipeline
from serieslake.llm import decontamination, language, pieces, quality, simhash
from serieslake.llm.common import table, tokenizer_path
from serieslake.session import materialize


@pytest.fixture(scope="module")
def stages(spark):
    sf = "/root/testdata/sf0.001"
    made = [table(spark, sf, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        made.append(materialize(stage(spark, made[-1], sf), name.replace(" ", "-")))
    return sf, made


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_their_columns_and_subsets(stages):
    _, made = stages
    for before, after in zip(made[:-2], made[1:-1], strict=True):
        assert after.columns == before.columns
        rows = {tuple(r) for r in before.collect()}
        assert {tuple(r) for r in after.collect()} <= rows


def test_decisions_take_effect(spark, stages):
    sf, made = stages
    labels, bench = table(spark, sf, "labels"), table(spark, sf, "benchmark")
    good = quality.score(made[0], quality.fit(made[0], labels)).filter("predicted = 1")
    assert ids(made[1]) == ids(good)
    model = language.fit(made[1])
    named = language.predict(made[1], model).filter(f"lang_pred <> 'und' and score >= {language.least_probability(model)}")
    assert ids(made[2]) == ids(named)
    groups = simhash.near_groups(made[2])
    assert ids(made[3]) == sorted({r.component_id for r in groups.collect()})
    held = {r.doc_id for r in decontamination.leaks(made[3], bench).collect()}
    assert ids(made[4]) == sorted(set(ids(made[3])) - held)
    path = tokenizer_path("piece_bpe_32k.model")
    texts = {r.doc_id: r.text for r in made[4].collect()}
    for row in made[5].collect():
        assert row.ids == np.frombuffer(pieces.pieces(path).encode([texts[row.doc_id]])[0], "<i4").tolist()
        assert pieces.pieces(path).decode(row.ids) == texts[row.doc_id]


def test_clean_documents_stay(spark, stages):
    sf, made = stages
    good = {r.doc_id for r in table(spark, sf, "labels").filter("quality = 1").collect()}
    assert len(good & set(ids(made[1]))) > 0.97 * len(good)
    assert made[2].count() >= 0.99 * made[1].count()


def test_edge_rows_pass_through(spark, frame, tmp_path):
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "A plain sentence of the text.", "en", None, 3), (4, "word " * 40_000, "en", "s", 1), (4, "word " * 40_000, "en", "s", 1)]
    for name, schema in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        frame(schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    for kept in (rows, []):
        docs = frame(kinds, *kept)
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, str(tmp_path)), name.replace(" ", "-"))
        assert docs.columns == ["doc_id", "lang", "source", "ids"]


def test_run_gives_the_last_stage(spark, stages):
    sf, made = stages
    assert ids(corpus_pipeline.run(spark, sf)) == ids(made[-1])
