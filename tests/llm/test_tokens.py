"""Token counts and token files against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from serieslake.llm import run_maps, token_counts, token_files
from serieslake.llm.common import slices, tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n\n", "plain words here", "Ünïcode Straße ΣΑΣ İstanbul", "café é́", "it's 'tis we'll 'S",
    "<|endoftext|>a<|startoftext|> b<|endoftext|", "a\x1cb\x1d c", "x y z　w​v", "日本語のテキスト 🇩🇪👍🏽", "!!!???...", "a" * 3000,
    "12 345,6 ½", "\x00\x01", "word " * 9000, "thonerand" * 5000, "ａｂｃ ﬁ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture
def docs(frame):
    rng = random.Random(5)
    made = ["".join(rng.choice("aeinorst  .,ñß'!1") for _ in range(rng.randint(1, 400))) for _ in range(150)]
    return frame("doc_id long, text string, lang string, ids string", *[(i, t, "en", "x") for i, t in enumerate(ODD + made)], (7, "plain words here", None, None))


def test_counts_equal_the_library(docs, library):
    got = sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, PATH, chunk=1000).collect())
    want = sorted(
        (r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect()
    )
    assert got == want


BITS = [
    "İ", "ı", "’", "‘", "“", "”", ".", ",", "'", "'s", "'LL", " ", "  ", "\n", "\t", "\x1c", "\x1f", "\x85", "\xa0", "\u200b", "a", "B", "th", "E", "é", "e\u0301", "\u0301", "\u0307", "ß",
    "Σ", "ς", "ﬁ", "K", "Å", "½", "²", "1", "23", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "日", "本", "語", "\u0958", "한", "ᄒ", "ᅡ", "ᆫ", "👍🏽", "🇩🇪", "\x00", "\x07", "\u202e", "word",
    "Prof", "!", "?", "-", "_", "@", "x",
]


def test_fuzzed_texts_equal_the_library(library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(1, 40))) for _ in range(30_000)] + ["Prof. İ. Yılmaz’ın evi"]
    want = [found.ids for found in library.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.counter(PATH).counts(texts) == [len(ids) for ids in want]
    encoder = token_files.encoder(PATH)
    assert [np.frombuffer(encoder.encode(text), "<i4").tolist() for text in texts] == want


def test_state_maps_compose_in_any_grouping(library):
    count = token_counts.counter(PATH)
    text = "It's over; won't <|endoftext|> naïveté\n  and  thoner.ander " * 3 + "q" * 40
    for width in (1, 3, 7, 50):
        maps = [count.state_map(text[i : i + width]) for i in range(0, len(text), width)]
        for block in (2, 5, 64):
            prefixes = token_counts.scan(maps, count.combine, block)
            assert len(prefixes) == len(maps)
            assert count.finish(prefixes[-1]) == len(library.encode(text, add_special_tokens=False).ids)


def chunked(count, text, size):
    maps = []
    for i in range(0, len(text), size):
        before = min(i, token_counts.AROUND)
        maps.append(count.state_map(text[i - before : i + size + token_counts.AROUND], before, size))
    return maps


def test_texts_without_white_space(library):
    """Runs of letters through chunks without any border, periodic ones too, with and without marks around them."""
    count, rng = token_counts.counter(PATH), random.Random(2)
    texts = [rng.choice(["a", "ab", "aab", "日本", "the"]) * rng.randint(200, 500) for _ in range(8)]
    texts += ["".join(rng.choice("acgt") for _ in range(rng.randint(300, 1500))) for _ in range(8)]
    texts += ["x. " + "".join(rng.choice(["Word", "über", "Straße", "ПРИВЕТ", "日本語"]) for _ in range(150)) + end for end in ("", "!", "'s more", "\u0301", "1", "。x", " y")]
    texts += ["".join(rng.choice(BITS) for _ in range(300)) for _ in range(100)]
    linked = 0
    for text in texts:
        for size in (40, 100, 333):
            maps = chunked(count, text, size)
            linked += sum(bool(one.links) for one in maps)
            assert count.total(maps) == len(library.encode(text, add_special_tokens=False).ids), text
    assert linked > 100


def test_run_maps_are_associative():
    count = token_counts.counter(PATH)
    a, b, c = [run_maps.unpacked(one.links) for one in chunked(count, "thehouseonthehill" * 60, 100)[1:4]]
    assert run_maps.joined(run_maps.joined(a, b), c) == run_maps.joined(a, run_maps.joined(b, c))


def test_a_long_run_is_counted_by_many_tasks(spark, frame, library, monkeypatch):
    from serieslake.llm import common

    monkeypatch.setattr(common, "TASK_CHARACTERS", 50_000)
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("acgt"), 400_000)) + "日本語のテキスト" * 20_000
    df = frame("doc_id long, text string", (1, text), (2, "short one"), (3, text + "."))
    parts = common.long_parts(df.withColumnRenamed("doc_id", "row"), 32_768, 64, 64)
    assert parts.rdd.getNumPartitions() > 8
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, PATH).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in ((1, text), (2, "short one"), (3, text + "."))}


def test_files_hold_the_library_s_ids(spark, docs, library, tmp_path):
    target = str(tmp_path / "tokens")
    token_files.write_tokens(docs, PATH, target)
    rows = sorted(token_files.read_tokens(spark, target).collect(), key=lambda r: r.start)
    source = sorted(docs.collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == [r.doc_id for r in source]
    by_id = {r.doc_id: r for r in rows if r.doc_id != 7}
    for doc in source:
        if doc.doc_id != 7:
            assert by_id[doc.doc_id].ids == [*library.encode(doc.text or "", add_special_tokens=False).ids, 1]
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        at += len(r.ids)
    sums = {(r.start, r.ids_crc32) for r in token_files.with_checksum(token_files.read_tokens(spark, target)).collect()}
    assert sums == {(r.start, zlib.crc32(np.asarray(r.ids, "<u4").tobytes())) for r in rows}


def test_files_have_page_indexes_and_prune(spark, frame, tmp_path):
    import pyarrow.parquet as pq

    target = str(tmp_path / "tokens")
    token_files.write_tokens(frame("doc_id long, text string", *[(i, f"word{i} next") for i in range(3000)]).coalesce(1), PATH, target)
    file = next(f for f in sorted((tmp_path / "tokens").glob("part-*")) if pq.ParquetFile(f).metadata.num_rows)
    column = pq.ParquetFile(file).metadata.row_group(0).column(1)
    assert column.has_offset_index and column.has_column_index
    plan = token_files.read_tokens(spark, target).select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan


def test_empty_table(spark, frame, tmp_path):
    docs = frame("doc_id long, text string")
    assert token_counts.count_tokens(docs, PATH).count() == 0
    token_files.write_tokens(docs, PATH, str(tmp_path / "none"))
    assert token_files.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_slices_cut_at_gaps_only():
    text = "abc def ghij " * 50
    assert "".join(slices(text, 20)) == text
    assert all(part[0] == " " for part in list(slices(text, 20))[1:])
    assert list(slices("x" * 100, 20)) == ["x" * 100]
