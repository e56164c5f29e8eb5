import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from serieslake.llm import spelling
from serieslake.llm.common import table
from serieslake.llm.queries import op11_spelling_variants

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def counted(docs):
    """Words and counts by the definition."""
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {word: n for word, n in counts.items() if n >= 3}


def near_words(word, among):
    made = {word[:i] + c + word[i + k :] for i in range(len(word) + 1) for c in ("", *LETTERS) for k in (0, 1)}
    return [other for other in made if other != word and other in among]


def plain(docs):
    counts = counted(docs)
    form, rows = {}, []
    for word, n in counts.items():
        near = near_words(word, counts)
        best = min(near, key=lambda other: (-counts[other], other), default=None)
        form[word] = (best if best and counts[best] >= 2 * n else None), len(near)
    for word, n in counts.items():
        root = word
        while form[root][0]:
            root = form[root][0]
        rows.append((word, form[word][0], root, n, form[word][1], counts.get(form[word][0])))
    return sorted(rows, key=lambda row: row[0])


def found(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=lambda row: row[0])


def test_query_equals_definition(spark, sf):
    docs = [(row.doc_id, row.text) for row in table(spark, sf, "documents").collect()]
    expected = plain(docs)
    assert sum(row[1] is not None for row in expected) > 100 and any(row[1] and row[1] != row[2] for row in expected)
    assert found(op11_spelling_variants(spark, sf)) == expected


CASES = [
    "house house house house house house hous hous hous houses houses houses",  # too short, and longer
    "aaaaaa aaaaaa aaaaaa aaaaa aaaaa aaaaa aaaaa aaaaa aaaaa aaaaaaa aaaaaaa aaaaaaa",  # runs of one letter count once
    "ABCDE abcde AbcdÉ abcdÉ abcdÉ ABCDÉ abcdé abcdé abcdé",  # only A-Z are lowered
    " ".join(["flour"] * 40 + ["floor"] * 20 + ["flood"] * 10 + ["bloods"] * 3 + ["blood"] * 5),  # forms of forms
    " ".join(["tangle"] * 4 + ["jangle"] * 12 + ["bangle"] * 12 + ["mangles"] * 3),  # ties fall to the smaller
    " ".join(["abcdefghijklmnopqrstuvwxyz"] * 9 + ["abcdefghijklmnopqqstuvwxyz"] * 3 + ["abcdefghijklmnopqrstuvwxy"] * 3 + ["bcdefghijklmnopqrstuvwxyz"] * 4),
]


def test_cases(frame):
    docs = [(k, text) for k, text in enumerate(CASES)]
    assert found(spelling.variants(frame("doc_id long, text string", *docs))) == plain(docs)


def test_made_up_words(frame):
    rng = np.random.default_rng(11)
    words = ["".join(rng.choice(list("abé"), rng.integers(5, 12))) for _ in range(1500)] + ["abéab" * 5 + "".join(rng.choice(list("ab"), 3)) for _ in range(200)]
    docs = [(k, " ".join(rng.choice(words, 60))) for k in range(300)]
    assert found(spelling.variants(frame("doc_id long, text string", *docs).repartition(5))) == plain(docs)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abÿ", min_size=1, max_size=40), min_size=2, max_size=2))
def test_numbers_tell_nodes_apart(words):
    numbered = []
    for word in words:
        letters = np.frombuffer(word.encode("latin-1"), np.uint8).astype(np.uint64)[None]
        high, low = spelling.node_numbers(letters)
        numbered.append([(int(high[0, k]), int(low[0, k])) for k in range(len(word) + 1)])
    for i, a in enumerate(numbered[0]):
        for j, b in enumerate(numbered[1]):
            assert (a == b) == (words[0][:i] == words[1][:j])


def test_very_long_words_and_texts(frame, monkeypatch):
    monkeypatch.setattr(spelling, "PORTION", 1000)
    word = "xyz" * 20_000
    docs = [(1, " ".join([word] * 6 + [word[:-1]] * 3)), (2, "yes yes " * 200_000 + "other " * 3)]
    assert found(spelling.variants(frame("doc_id long, text string", *docs))) == plain_long(docs, word)


def plain_long(docs, word):
    counts = counted(docs)
    near = {word: word[:-1], word[:-1]: word}
    rows = []
    for w, n in counts.items():
        other = near.get(w) if near.get(w) in counts else None
        form = other if other and counts[other] >= 2 * n else None
        rows.append((w, form, form or w, n, int(other is not None), counts.get(form)))
    return sorted(rows, key=lambda row: row[0])


def test_many_words_at_one_pair(frame):
    """All letters at one place: each word is near all others, and the counts grow with the letters, not their square."""
    words = ["prefix" + c + "suffix" for c in LETTERS]
    docs = [(k, " ".join(words)) for k in range(4)]
    df = frame("doc_id long, text string", *docs)
    rows = found(spelling.variants(df))
    assert rows == plain(docs) and max(row[4] for row in rows) > 60


def test_nulls_repeats_and_other_columns(frame):
    docs = [(None, "green green grean"), (None, "green green grean"), (3, None), (4, ""), (5, "grean")]
    df = frame("doc_id long, text string", *docs).withColumns({"n": F.lit("x"), "word": F.lit(1), "id": F.lit(2)})
    assert found(spelling.variants(df)) == plain(docs)


@pytest.mark.parametrize("rows", [[], [("a", "rare words only")]])
def test_empty_results(frame, rows):
    out = spelling.variants(frame("doc_id string, text string", *rows))
    assert out.collect() == [] and out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
