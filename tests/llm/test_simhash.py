"""SimHash groups against all pairs."""

import random
import re

import numpy as np
import xxhash

from serieslake.llm import simhash
from serieslake.llm.components import components


def plain_fingerprint(text, length=3):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + length]) for i in range(max(1, len(words) - length + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, most=2):
    prints = [plain_fingerprint(text) for _, text in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= most and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    first = {}
    for (doc_id, _), group in zip(rows, label, strict=True):
        if doc_id is not None:
            first[group] = min(first.get(group, doc_id), doc_id)
    return [(doc_id, f"{p:016x}", first.get(g)) for (doc_id, _), p, g in zip(rows, prints, label, strict=True)]


def sample():
    rng = random.Random(3)
    words = ["alpha", "Beta", "gamma", "ÄRGER", "delta x", "1,5", "eps\x1cilon"]
    rows = [(100, None), (101, ""), (102, " \t\n"), (103, "one"), (104, "ONE"), (105, "two words"), (None, "no id here at all"), (7, "a b c")]
    for g in range(12):
        base = [rng.choice(words) + str(rng.randint(0, 99)) for _ in range(rng.choice([5, 60, 300]))]
        for _ in range(8):
            edited = list(base)
            for _ in range(rng.randint(0, 2)):
                edited[rng.randrange(len(edited))] = rng.choice(words)
            rows.append((rng.randint(0, 10_000), " ".join(edited)))
    return rows + rows[-5:]


def test_groups_equal_all_pairs(frame):
    rows = sample()
    got = simhash.near_groups(frame("doc_id long, text string, fp string, root int", *[(*r, "x", 1) for r in rows]))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain_groups(rows), key=key)


def test_one_of_each_group_stays(frame):
    rows = sample()
    docs = frame("doc_id long, text string, lang string", *[(*r, "en") for r in rows])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = plain_groups(rows)
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == sorted({(g is None, g) for _, _, g in groups})


def test_links_of_dense_buckets():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, dtype=np.uint64)
    flips = np.array([[1 << int(b) for b in rng.integers(0, 64, 3)] for _ in range(400)], np.uint64)
    members = np.unique(centre ^ np.bitwise_xor.reduce(flips, axis=1))
    near = np.bitwise_count(members[:, None] ^ members) <= 2
    label = np.arange(len(members))
    for _ in range(len(members)):
        label = np.where(near, label[None, :], len(members)).min(1)
    found = np.arange(len(members))
    for block in (64, 2048):
        links = simhash.bucket_links(members, 2, block)
        assert all(near[i, j] for i, j in links)
        assert len(links) == len(members) - len(np.unique(label))
    assert len(found) == len(members)


def test_long_text_equals_parts(monkeypatch):
    text = "Lorem ipsum  dolor\nsit amet " * 400 + "end"
    import serieslake.llm.simhash as module

    whole = module.fingerprints([text], 3)
    assert whole.view(np.uint64)[0] == plain_fingerprint(text)
    monkeypatch.setattr(module, "slices", lambda t: __import__("serieslake.llm.common", fromlist=["x"]).slices(t, 50))
    monkeypatch.setattr(module, "portions", lambda ts: [(i, i + 1) for i in range(len(ts))])
    assert list(module.fingerprints([text, "", "one", "a b"], 3)) == [whole[0], *module.fingerprints(["", "one", "a b"], 3)]
    assert module.fingerprints(["one"], 3).view(np.uint64)[0] == plain_fingerprint("one")


def test_empty(frame):
    docs = frame("doc_id long, text string")
    assert simhash.near_groups(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0


def test_components_of_chains_and_hubs(spark, frame):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(300)] + [(5000, 5000), (7001, 7000), (None, 3)]
    rng.shuffle(links)
    got = dict(map(tuple, components(frame("a long, b long", *links)).collect()))
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(300)}, 7000: 7000, 7001: 7000}


def test_stars_settle_in_one_round(frame, monkeypatch):
    import serieslake.llm.components as module

    rounds, real = [], module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, label: (rounds.append(label), real(df, label))[1])
    got = dict(map(tuple, components(frame("a long, b long", (2, 1), (1, 3), (4, 1), (9, 8), (9, 9), (None, 1))).collect()))
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8}
    assert rounds.count("stars") == 1
