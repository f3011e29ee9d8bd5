from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm import brute
from tillstream.llm import jaccard_join as op
from tillstream.llm.common import table
from tillstream.llm.components import components


def results(docs):
    return {r[0]: tuple(r[1:]) for r in op.linked(docs).collect()}


def edited(text, changes, rng):
    own = text.split()
    for at in rng.sample(range(len(own)), changes):
        own[at] = f"e{rng.randrange(10**9)}"
    return " ".join(own)


def test_against_brute_force(documents, prose):
    rng = random.Random(3)
    rows = [(i, prose(rng.choice([3, 5, 8, 40, 150, 400]), i)) for i in range(40)]
    for i, (_, text) in enumerate(rows[:30]):
        count = len(text.split())
        rows += [(100 + 10 * i + j, edited(text, min(count, rng.randrange(0, 1 + count // 18)), rng))
                 for j in range(rng.randrange(0, 5))]
    rows += [(900, rows[3][1].upper()), (901, " ".join(reversed(rows[3][1].split())))]
    assert results(documents(rows)) == brute.components(rows)


def test_whole_small_table(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    found = op.op6_jaccard_join(spark, sf_dir)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == brute.components(rows)


def test_similarity_on_the_threshold_links(documents):
    # 3 of 4 shingles in common, and 74 of 99.
    a = "a b c d e f g".split()
    rows = [(1, " ".join(a)), (2, " ".join([*a, "h"]))]
    base = [f"w{i}" for i in range(103)]
    rows += [(3, " ".join(base)), (4, " ".join(base[:78]))]
    assert results(documents(rows)) == brute.components(rows)
    assert brute.components(rows)[2][1] == 1 and brute.components(rows)[4][1] == 4


def test_large_group_of_near_copies(documents, prose):
    rng = random.Random(5)
    text = prose(120, 1)
    rows = [(i, edited(text, rng.randrange(0, 5), rng)) for i in range(400)]
    assert results(documents(rows)) == brute.components(rows)


def test_hot_shingles_are_split(documents, prose, monkeypatch):
    """A tiny limit splits every block of the group; nothing is lost between its parts."""
    monkeypatch.setattr(op, "HOT_ROWS", 20)
    rng = random.Random(6)
    text = prose(60, 1)
    rows = [(i, edited(text, rng.randrange(0, 4), rng)) for i in range(150)]
    rows += [(1000 + i, prose(40, 50 + i)) for i in range(10)]
    assert results(documents(rows)) == brute.components(rows)


def test_tree_keeps_every_similar_pair():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 2**63, rng.integers(5, 200)).astype(np.uint64)
        for _ in range(5):
            drop = rng.random(len(base)) < rng.choice([0.02, 0.1, 0.3])
            sets.append(np.unique(base[~drop]) if (~drop).any() else base)
    maps = np.stack([op._bitmap(s, 256) for s in sets])
    sizes = np.array([len(s) for s in sets], np.int64)
    tree = op.SignatureTree(maps, sizes, np.arange(len(sets)), sizes - op._bits(maps),
                            np.ones_like(sizes))
    kept = {tuple(sorted(p)) for i, j in tree.pairs() for p in zip(i.tolist(), j.tolist())}
    count = 0
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            shared = len(np.intersect1d(sets[a], sets[b]))
            if 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                count += 1
                assert (a, b) in kept
    assert count and len(kept) < len(sets) * (len(sets) - 1) / 4


def test_bitmaps_of_different_widths_never_understate_what_is_shared():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    sets = []
    for n in (3, 30, 100, 300, 400, 900, 1200):
        base = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        sets += [base, base[rng.random(len(base)) < 0.85]]
    signatures = pa.array([op._bitmap(s, op._signature_bits(len(s))).tobytes() for s in sets])
    sizes = np.array([len(s) for s in sets], np.int64)
    maps, bits, repeats = op._wide_maps(signatures)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            most = op._bits(maps[[i]] & maps[[j]])[0] // min(repeats[i], repeats[j])
            most += min(sizes[i] - bits[i], sizes[j] - bits[j])
            assert most >= len(np.intersect1d(a, b))


def test_odd_rows(documents, clashing, prose):
    long = prose(30_000, 4)
    rows = [(1, None), (2, ""), (3, " \t"), (4, "One two"), (5, "one TWO"), (6, "two one"),
            (7, long), (8, long + " end"), (None, "one two"), (9, "ÉÉ a"), (10, "éé a")]
    found = results(clashing(documents(rows)))
    assert [found[i] for i in (1, 2, 3)] == [(0, 1), (0, 2), (0, 3)]
    assert found[4] == found[5] == found[None] == (1, 4) and found[6] == (1, 6)
    assert found[8][1] == 7 and found[9][1] == 9 and found[10][1] == 10


def test_repeated_ids_and_empty_table(documents, clashing, prose):
    text = prose(30, 1)
    rows = op.linked(documents([(5, text), (5, text), (3, text)])).collect()
    assert sorted(tuple(r) for r in rows) == [(3, 26, 3), (5, 26, 3), (5, 26, 3)]
    assert op.linked(documents([])).count() == 0
    kept = op.keep_one(clashing(documents([(5, text), (5, text), (3, text), (None, "x"), (9, None)])))
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 9]


def test_signatures_are_folded_before_they_meet_blocks(spark):
    import pyarrow as pa

    rng = np.random.default_rng(6)
    signatures = [bytes(rng.integers(0, 256, 8 << n, dtype=np.uint8)) for n in range(13)]
    marks = spark.createDataFrame([(i, 9, bytearray(s)) for i, s in enumerate(signatures)],
                                  "owner long, n long, signature binary")
    folded = [bytes(r["signature"]) for r in op._folded(marks).orderBy("owner").collect()]
    assert max(map(len, folded)) == 8 * op.WIDE_WORDS
    for whole, less in zip(op._wide_maps(pa.array(signatures)), op._wide_maps(pa.array(folded))):
        assert (whole == less).all()


def test_rows_without_id_are_kept_and_linked(documents, clashing, prose):
    text, other, third = prose(40, 1), prose(40, 2), prose(40, 3)
    rows = [(5, text), (None, text), (None, text + " end"), (None, "x"), (None, other),
            (None, other + " end"), (None, third), (9, None), (None, None), (None, "y z")]
    kept = op.keep_one(clashing(documents(rows)), null_ids=True)
    assert kept.columns == clashing(documents([])).columns
    found = sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect())
    twin = [r for r in found if r[1].startswith(other)]
    assert len(twin) == 1
    assert [r for r in found if r not in twin] == sorted(
        [(5, text), (0, "x"), (0, third), (9, ""), (0, ""), (0, "y z")])
    assert op.keep_one(documents([]), null_ids=True).count() == 0


@pytest.mark.parametrize("edges, expected", [
    ([], {}), ([(1, 1)], {}),
    ([(i, i + 1) for i in range(40)], {i: 0 for i in range(41)}),
    ([(9, i) for i in range(1, 9)] + [(20, 21)], {**{i: 1 for i in range(1, 10)}, 20: 20, 21: 20}),
])
def test_components(spark, edges, expected):
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r[0], r[1]) for r in rows) == sorted(expected.items())
