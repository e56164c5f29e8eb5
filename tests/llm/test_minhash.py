"""Fingerprints and edited texts against plain definitions."""

import hashlib
import random

import numpy as np

from serieslake.llm import minhash


def plain_shingles(text):
    words = [minhash.xxh64_intdigest(w) for w in text.lower().split()]
    size, mask = min(5, len(words)), (1 << 64) - 1
    made = []
    for i in range(len(words) - size + 1 if size else 0):
        h = (size + sum(w * int(s) for w, s in zip(words[i : i + size], minhash._STEPS))) & mask
        h = ((h ^ h >> 29) * 0xBF58476D1CE4E5B9) & mask
        made.append(h ^ h >> 32)
    return made


def plain_signature(text):
    mask, made = (1 << 64) - 1, []
    for factor, shift in zip(minhash._FACTOR.tolist(), minhash._SHIFT.tolist()):
        low = min([(h * factor + shift) & mask for h in plain_shingles(text)], default=mask)
        made.append((((low ^ low >> 31) * 0x9E3779B97F4A7C15) & mask) >> 48)
    return made


def sample():
    rng = random.Random(8)
    texts = [None, "", "one", "four words are few", "Exactly five words stand here", "a b c d e f g h", "ß é\nü  x", "same text " * 9, "same text " * 9]
    texts += [" ".join(f"w{rng.randint(0, 50)}" for _ in range(rng.randint(1, 300))) for _ in range(40)]
    ids = rng.sample(range(1000), len(texts))
    return [*zip(ids, texts), (ids[0], "second row of an id"), (None, "no id"), (ids[3], texts[3])]


def test_rows_equal_the_definition(frame):
    rows = sample()
    got = minhash.fingerprints_and_classes(frame("doc_id long, text string, part int, role string", *[(*r, 1, "x") for r in rows]).repartition(7)).collect()
    assert len(got) == len(rows)
    # Texts of one id may stand in either order; follow the order in which they were written.
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    by_id = {}
    for doc_id, text in ordered:
        by_id.setdefault(doc_id, []).append(text or "")
    keys = list(by_id)
    for row in got:
        own = [t for t in by_id[row.doc_id] if "".join(f"{v:04x}" for v in plain_signature(t)) == row.fingerprint]
        following = by_id[keys[(keys.index(row.doc_id) + 1) % len(keys)]]
        choices = by_id[row.doc_id] * (len(by_id[row.doc_id]) > 1) + following
        made = {hashlib.sha256(minhash.edited(t, f).encode()).hexdigest(): (t, f) for t in own for f in choices}
        text, behind = made[row.edited_sha256]
        changed = minhash.edited(text, behind)
        assert row.n_chars == len(text)
        assert row.edited_fingerprint == "".join(f"{v:04x}" for v in plain_signature(changed))
        a, b, c = (np.array(plain_signature(t)) for t in (text, changed, behind))
        assert (row.near_edited, row.near_next) == ((a == b).mean(), (a == c).mean())


def test_likeness_estimates_jaccard():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(4000)]
    for share in (0.2, 0.5, 0.8, 0.95):
        error = []
        for _ in range(12):
            a = [rng.choice(words) for _ in range(3000)]
            b = a[: int(len(a) * share)] + [rng.choice(words) for _ in range(600)]
            sa, sb = (set(plain_shingles(" ".join(x))) for x in (a, b))
            pair = minhash.signatures([" ".join(a), " ".join(b)])
            error.append(minhash.likeness(pair[:1], pair[1:])[0] - len(sa & sb) / len(sa | sb))
        assert abs(np.mean(error)) < 0.08


def test_edited_text():
    assert minhash.edited("abcdefgh", "XYZ") == "abcdefXY"
    assert minhash.edited("abcdefghi", "X") == "abcdefX"
    assert minhash.edited("ab", "X") == "ab"
    assert minhash.edited("", "X") == ""


def test_one_row_and_none(frame):
    row = minhash.fingerprints_and_classes(frame("doc_id long, text string", (5, "a b c d e f"))).collect()[0]
    assert (row.near_next, row.edited_sha256) == (1.0, hashlib.sha256(b"a b c d a b").hexdigest())
    assert minhash.fingerprints_and_classes(frame("doc_id long, text string")).count() == 0


def test_classes_equal_all_pairs(frame):
    rng = random.Random(12)
    rows = [(1, None), (2, ""), (3, "few words"), (4, "few words")]
    for _ in range(15):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([12, 80, 300]))]
        for _ in range(6):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = "changed"
            rows.append((100 + len(rows), " ".join(words)))
    sets = [set(plain_shingles(text or "")) for _, text in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(i):
                if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    want = {doc_id: min(d for (d, _), k in zip(rows, label) if k == label[i]) for i, (doc_id, _) in enumerate(rows)}
    docs = frame("doc_id long, text string", *rows)
    got = {r.doc_id: r.class_id for r in minhash.fingerprints_and_classes(docs).collect()}
    assert got == want


def test_blocks_find_the_same_classes(frame):
    words = [f"w{i}" for i in range(60)]
    docs = frame("doc_id long, text string", *[(i, " ".join(words[: 50 + i % 10])) for i in range(10)])
    prints = minhash.fingerprint_documents(docs)
    for block in (2, 256):
        assert len({r.root for r in minhash.near_classes(docs, prints, block=block).collect()}) == 1


def near_copies(rng, n, edits):
    """Shingle sets of copies of one text with so many words changed; most copies are alike to none."""
    base, made = [f"w{i}" for i in range(400)], []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(*edits)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 300)}"
        made.append(np.unique(minhash.shingles(minhash.word_hashes(" ".join(words)))))
    return made


def classes_of(links, n):
    label = list(range(n))
    for i, j in links:
        a, b = sorted((label[i], label[j]))
        label = [a if x == b else x for x in label]
    return label


def all_pairs(sets, least):
    held = [set(s.tolist()) for s in sets]
    return [(i, j) for j in range(len(held)) for i in range(j) if len(held[i] & held[j]) >= least * len(held[i] | held[j])]


def test_shared_counts_equal_the_definition(monkeypatch):
    rng = random.Random(4)
    for columns, pairs in ((1024, 1 << 20), (3, 5)):  # in one go, and in many
        monkeypatch.setattr(minhash, "COLUMNS", columns)
        monkeypatch.setattr(minhash, "PAIRS", pairs)
        # some shingles are in most sets, some in few
        sets = [np.array(sorted({*range(rng.randint(0, 6)), *rng.sample(range(100, 400), rng.randint(0, 9))}), np.uint64) for _ in range(60)]
        sets += [np.zeros(0, np.uint64)] * 2
        for left, right in ((sets, sets), (sets[:20], sets[20:]), ([], sets), (sets, []), (sets[-2:], sets[-2:])):
            want = [[len(np.intersect1d(x, y)) for y in right] for x in left]
            assert np.array_equal(minhash.shared_counts(left, right), np.array(want, int).reshape(len(left), len(right)))


def test_forest_within_and_across():
    rng = random.Random(6)
    sets = [*near_copies(rng, 50, (0, 12)), *([np.zeros(0, np.uint64)] * 3)]
    rng.shuffle(sets)
    n, cut = len(sets), 21
    alike = set(all_pairs(sets, 0.8))
    whole = minhash.jaccard_forest(sets, 0.8)
    inner = [(i + cut, j + cut) for i, j in minhash.jaccard_forest(sets[cut:], 0.8)]
    across = minhash.jaccard_forest(sets[:cut], 0.8, sets[cut:])
    parts = [*minhash.jaccard_forest(sets[:cut], 0.8), *inner, *across]
    assert {tuple(sorted(link)) for link in [*whole, *parts]} <= alike
    assert all((i < cut) != (j < cut) for i, j in across)
    want = classes_of(alike, n)
    assert classes_of(whole, n) == classes_of(parts, n) == want
    assert len(whole) == n - len(set(want)) < len(alike)


def test_unlike_near_copies_are_not_compared_one_by_one(monkeypatch):
    sets, calls, real = near_copies(random.Random(7), 200, (9, 14)), [], np.intersect1d
    monkeypatch.setattr(np, "intersect1d", lambda *a, **b: calls.append(1) or real(*a, **b))
    links = minhash.jaccard_forest(sets, 0.8)
    assert len(calls) < len(sets)
    monkeypatch.undo()
    assert classes_of(links, 200) == classes_of(all_pairs(sets, 0.8), 200)


def test_a_group_that_fits_one_block_is_sent_once(frame, monkeypatch):
    stored, real = {}, minhash.materialize
    monkeypatch.setattr(minhash, "materialize", lambda df, label: stored.setdefault(label, real(df, label)))
    words = [f"w{i}" for i in range(300)]
    docs = frame("doc_id long, text string", *[(i, " ".join([*words, f"x{i}"])) for i in range(300)])
    prints = minhash.fingerprint_documents(docs)
    want = {r.key: r.root for r in minhash.near_classes(docs, prints).collect()}
    assert (len(want), len(set(want.values()))) == (300, 1)
    assert stored["blocks"].count() == 0
    for limits in ({"block": 70}, {"block_bytes": 100_000}):
        stored.clear()
        assert {r.key: r.root for r in minhash.near_classes(docs, prints, **limits).collect()} == want
        assert stored["blocks"].first().blocks > 4


def test_fingerprints_are_stored_once(frame, monkeypatch):
    stored, real = [], minhash.materialize

    def recorded(df, label):
        stored.append(real(df, label))
        return stored[-1]

    monkeypatch.setattr(minhash, "materialize", recorded)
    rows = [(i, f"{i} a b c d e f g h") for i in range(80)]
    got = minhash.fingerprints_and_classes(frame("doc_id long, text string", *rows)).collect()
    assert sorted(r.doc_id for r in got) == list(range(80))
    whole = sum(t.count() for t in stored if "edited_fingerprint" in t.columns)
    assert 80 <= whole < 120  # four parts: a first, a last and a finished row each
