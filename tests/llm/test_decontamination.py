"""Template matches against a plain search, re-parameterised items, slots, edge cases."""

import re

import numpy as np

from serieslake.llm import decontamination as d
from serieslake.llm.common import hash_filter, may_hold, table

ITEM = "A farmer called Anna bought 12 apples for 3 dollars and gave 5 of them to Bert. How many apples does Anna have left after 7 days?"
OTHER = "The train leaves the old station at dawn and reaches the northern harbour before the evening bells ring out."
FILL = "Nothing of this sort was ever written down by anyone in the village before the storm came over the hills."


def plain_leaks(docs, items, least=6):
    """Windows of eight lower-case words held verbatim, from plain word lists."""
    words = lambda text: [w.lower() for w in d._WORD.findall(text or "")]
    found = set()
    for doc_id, text in docs:
        own = words(text)
        windows = {tuple(own[i : i + 8]) for i in range(len(own) - 7)}
        for item_id, item in items:
            wanted = words(item)
            parts = [tuple(wanted[i : i + 8]) for i in range(len(wanted) - 7)]
            if parts and sum(p in windows for p in parts) >= min(least, len(parts)):
                found.add((doc_id, item_id))
    return found


def test_given_tables_against_plain_search(spark, sf):
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    got = {(r.doc_id, r.item_id) for r in d.leaks(docs, items).collect()}
    want = plain_leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == want and want
    kept = {r.doc_id for r in d.keep_clean(docs, items).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {doc_id for doc_id, _ in want}


def rows():
    changed = re.sub("Anna", "Clara", ITEM).replace("Bert", "David").replace("12", "40").replace(" 3 ", " 9 ")
    mixed = ITEM.replace("called Anna", "called Clara").replace("Anna have", "Emma have")  # one name stands for two
    return [
        (1, f"{FILL} {ITEM} {FILL}"), (2, f"{FILL} {changed}"), (3, FILL), (4, f"{FILL}\n{OTHER.upper()}"), (5, OTHER[:60]),
        (6, mixed), (7, None), (8, ""), (9, "word " * 30_000 + ITEM), (1, f"{FILL} {ITEM} {FILL}"), (None, OTHER), (10, "1 2 3 4 5 6 7 8 9 10 11 12 13 14"), (12, re.sub("[.,?]", "", ITEM.lower())), (11, "short but exact words"),
    ]


def items():
    return [(100, ITEM), (101, OTHER), (102, ITEM), (103, None), (104, ""), (None, "an item without any number that stands for itself alone"), (105, "Short but exact words"), (106, "too few words")]


def test_verbatim_and_new_parameters(frame):
    docs = frame("doc_id long, text string, item_id int, key1 string", *[(*r, 1, "x") for r in rows()])
    bench = frame("item_id long, text string, hash string", *[(*r, "x") for r in items()])
    got = {(r.doc_id, r.item_id): r for r in d.leaks(docs, bench).collect()}
    assert {k: v.reparameterised for k, v in got.items() if k[0] != 6} == {
        (1, 100): False, (2, 100): True, (4, 101): False, (9, 100): False, (None, 101): False, (11, 105): False, (12, 100): False,
    }
    assert got[1, 100].coverage == 1 and got[9, 100].first_word > 29_000
    if (6, 100) in got:  # windows that keep one name may still match; those with the other may not
        assert got[6, 100].coverage < 0.8
    kept = d.keep_clean(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} - {6} == {3, 5, 7, 8, 10}


def test_filter_holds_every_hash(frame):
    windows = d.benchmark_windows(frame("item_id long, text string", *items()))
    bits = hash_filter(windows, "hash")
    held = np.array([row.hash for row in windows.collect()])
    assert may_hold(bits, held).all()
    assert may_hold(bits, np.random.default_rng(0).integers(-(1 << 63), 1 << 63, 1000)).sum() < 5


def test_empty_tables(frame):
    none, docs = frame("item_id long, text string"), frame("doc_id long, text string", *rows())
    assert d.leaks(docs, none).count() == 0
    assert d.keep_clean(docs, none).count() == len(rows())
    assert d.leaks(frame("doc_id long, text string"), frame("item_id long, text string", *items())).count() == 0


def test_names_that_begin_sentences(frame):
    item = "Anna has 12 apples. Bert gives Anna 5 more. Clara takes 3 of them."
    changed = "Dora has 40 apples. Emil gives Dora 7 more. Frida takes 9 of them."
    one_for_two = "Dora has 40 apples. Emil gives Emil 7 more. Emil takes 9 of them."
    docs = frame("doc_id long, text string", (1, f"{FILL} {changed} {FILL}"), (2, f"{FILL} {item}"), (3, FILL), (4, f"{FILL} {one_for_two}"))
    bench = frame("item_id long, text string", (100, item))
    got = {r.doc_id: r for r in d.leaks(docs, bench).collect()}
    assert {k: r.reparameterised for k, r in got.items()} == {1: True, 2: False}
    assert got[2].coverage == 1
    assert {r.doc_id for r in d.keep_clean(docs, bench).collect()} == {3, 4}


def test_items_of_numbers_and_of_few_words(frame):
    exact = {200: "What is 5 percent of 80", 201: "12 + 30 = 42 and 7 times 6 is 42", 202: "2 4 8 16 32 64 128 256 512 1024 2048", 203: "Name three rivers", 204: "Why?", 205: "= ?"}
    other = ["What is 5 percent of 90", "12 + 30 = 42 and 7 times 5 is 35", "3 6 12 24 48 96 192 384 768 1536", "Name three rivers of the north", "But why?", "?"]
    bench = frame("item_id long, text string", *exact.items())
    held = [(k, f"{FILL}\n{text}\n{FILL}") for k, text in exact.items()]
    whole = [(k + 1000, text) for k, text in exact.items()]
    docs = frame("doc_id long, text string", *held, *whole, (2000, "Name\nthree rivers"), *((k, f"{FILL}\n{text}\n{FILL}") for k, text in enumerate(other)))
    got = {(r.doc_id, r.item_id): r for r in d.leaks(docs, bench).collect()}
    assert set(got) == {(k, k) for k in exact} | {(k + 1000, k) for k in exact} | {(2000, 203)}
    assert all(r.coverage == 1 and not r.reparameterised for r in got.values())
    assert got[203, 203].first_word == len(FILL.split()) and got[1203, 203].first_word == 0
    assert {r.doc_id for r in d.keep_clean(docs, bench).collect()} == set(range(len(other)))
