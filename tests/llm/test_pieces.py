"""Best paths against a plain dynamic programme, encodings against the library; chunks against whole texts; round trips."""

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from serieslake.llm import pieces as p
from serieslake.llm.common import table, tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")
ODD = ["", " ", "a", "  two  spaces ", "tab\tand\nline", "日本語 テスト 😀", "x" * 700, "ñandú über-straße", "\x00", "end ", "aa bb" * 300]


@pytest.fixture(scope="module")
def model():
    return p.Pieces(PATH)


@pytest.fixture(scope="module")
def merges():
    return p.pieces(PATH)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def fuzzed(seed, n):
    rng = random.Random(seed)
    bits = ["a", "b", "th", "ing", "e", "é", "ñ", "日", "本", "😀", " ", "  ", "      ", "\n", "\t", ".", ",", "'s", "word", "12", "0", "-", "--", "=", "the ", " house", "x" * 9, "<s>", "\x00", "ß"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for _ in range(n)]


def plain(model, text):
    """All pieces at all places, score by score."""
    best = [(0, None)] + [None] * len(text)
    for at in range(len(text)):
        choices = [(text[at : at + n], None) for n in range(1, model.reach + 2) if at + n <= len(text)]
        for piece, _ in choices:
            score = model.scores.get(piece, model.unknown if len(piece) == 1 else None)
            if score is not None and (best[at + len(piece)] is None or best[at][0] + score > best[at + len(piece)][0]):
                best[at + len(piece)] = (best[at][0] + score, at)
    made, at = [], len(text)
    while at:
        piece = text[best[at][1] : at]
        made = ([model.ids[piece]] if piece in model.ids else [model.bytes[b] for b in piece.encode()]) + made
        at = best[at][1]
    return made, best[-1][0]


def texts():
    rng = random.Random(9)
    return ODD + ["".join(rng.choice("abcdeinorst   é日.") for _ in range(rng.randint(1, 200))) for _ in range(60)]


def mark(model, text):
    return (model.prefix + text).replace(" ", p.SPACE) if text else ""


def test_whole_texts_equal_the_plain_programme(model):
    for text, raw in zip(texts(), model.encode(texts()), strict=True):
        assert np.frombuffer(raw, "<i4").tolist() == plain(model, mark(model, text))[0]


@pytest.mark.parametrize("size", [1, 3, 17, 40, 150])
def test_chunks_reach_the_same_score(model, size):
    for text in texts():
        whole = mark(model, text)
        if not whole:
            continue
        cuts = [(whole[i : i + size + model.reach], min(size, len(whole) - i)) for i in range(0, len(whole), size)]
        states = p.border_states([model.matrix(*cut) for cut in cuts])
        ids = [np.frombuffer(model.between(*cut, i, j), "<i4") for cut, i, j in zip(cuts, states, states[1:], strict=False)]
        ids = np.concatenate(ids)
        want, score = plain(model, whole)
        assert int(model.score_of[ids].sum()) == score
        assert model.decode(ids.tolist()) == text


def test_matrices_are_associative(model):
    whole = mark(model, "some words and more of them, without an end" * 3)
    cuts = [(whole[i : i + 20 + model.reach], min(20, len(whole) - i)) for i in range(0, len(whole), 20)]
    a, b, c = [model.matrix(*cut) for cut in cuts][:3]
    assert (p.times(p.times(a, b), c) == p.times(a, p.times(b, c))).all()


def test_the_library_agrees_up_to_rounding(model):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    changed = proto.ModelProto()
    with open(PATH, "rb") as file:
        changed.ParseFromString(file.read())
    changed.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    library = sentencepiece.SentencePieceProcessor(model_proto=changed.SerializeToString())
    rng = random.Random(3)
    words = ["".join(rng.choice("aeinorstlmd") for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    same = 0
    for word, raw in zip(words, model.encode(words), strict=True):
        own, other = np.frombuffer(raw, "<i4"), library.encode(word)
        same += own.tolist() == other
        assert model.score_of[own].sum() >= model.score_of[other].sum()  # the library adds 32-bit floats
    assert same > 0.98 * len(words)


def test_ids_equal_the_library(spark, merges, library):
    """Every document, and texts of odd parts."""
    docs = [row.text or "" for row in table(spark, "/root/testdata/sf0.01", "documents").select("text").collect()]
    for some in (docs, texts(), fuzzed(1, 3000), ["a" * 5000, " " * 5000, "the house" * 900, "日本" * 3000]):
        assert [np.frombuffer(raw, "<i4").tolist() for raw in merges.encode(some)] == library.encode(some)


def chunked(merges, text, size):
    whole = mark(merges, text)
    cuts = []
    for i in range(0, len(whole), size):
        before = min(i, merges.behind)
        cuts.append((whole[i - before : i + size + merges.reach], before, min(size, len(whole) - i), i == 0, i + size >= len(whole)))
    packed = [merges.measured(*cut) for cut in cuts]
    states = merges.settled(packed)
    return b"".join(merges.traced(*cut[:3], i, j) for cut, i, j in zip(cuts, states, states[1:], strict=False)), cuts


@pytest.mark.parametrize("size", [1, 3, 17, 60, 400])
def test_chunks_equal_the_library(merges, library, size):
    for text in [t for t in texts() if t] + fuzzed(2, 80) + ["a" * 300, " " * 300, "thehouse" * 40, "日本語" * 60]:
        assert np.frombuffer(chunked(merges, text, size)[0], "<i4").tolist() == library.encode(text), text


def test_links_are_associative(merges):
    for text in ("thehousewordingsabab" * 6, "some words and more of them " * 5):
        _, cuts = chunked(merges, text, 30)
        a, b, c = [merges.links(*cut) for cut in cuts[:3]]
        assert p.joined(p.joined(a, b), c) == p.joined(a, p.joined(b, c))


def test_other_files_are_refused(tmp_path):
    proto, model = p.read_model(PATH)
    model.trainer_spec.model_type = proto.TrainerSpec.CHAR
    (tmp_path / "c.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="neither"):
        p.pieces(str(tmp_path / "c.model"))


def test_table_equals_the_library(merges, library, frame):
    rows = [(i, t, "x") for i, t in enumerate([*texts(), "nowhitespace" * 60, "ab " * 300])] + [(3, "again and again", "y"), (3, "again and again", "y"), (None, None, None)]
    docs = frame("doc_id long, text string, ids string", *rows)
    for chunk in (37, 100_000):
        encoded = p.encode(docs, PATH, chunk=chunk)
        assert encoded.columns == ["doc_id", "ids"]
        assert sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=repr) == sorted(((i, library.encode(t or "")) for i, t, _ in rows), key=repr)
        got = sorted(((r.doc_id is None, r.doc_id, r.text) for r in p.decode(encoded, PATH).collect()), key=repr)
        assert got == sorted(((i is None, i, t or "") for i, t, _ in rows), key=repr)
    assert p.encode(frame("doc_id long, text string"), PATH).count() == 0


def test_a_long_text_is_spread_over_tasks(spark, frame, monkeypatch):
    from serieslake.llm import common

    monkeypatch.setattr(common, "TASK_CHARACTERS", 1000)
    df = frame("row long, text string", (1, "日本語" * 4000))
    parts = common.long_parts(df, 500, 16, 15)
    assert parts.rdd.getNumPartitions() == 12
    assert len({r.task for r in parts.select(F.spark_partition_id().alias("task")).collect()}) > 4
    rows = sorted(parts.collect(), key=lambda r: r.part)
    assert "".join(r.text[r.before : r.before + 500] for r in rows) == "日本語" * 4000 and {r.n_parts for r in rows} == {24}
