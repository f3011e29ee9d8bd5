"""Spelling variants against comparing all pairs of words."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillstream.llm import spelling
from tillstream.llm.acceptor import Acceptors


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs):
    count = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= 2}
    out = {}
    for w, n in words.items():
        links = [x for x in words if near(w, x)]
        best = min(links, key=lambda x: (-words[x], x), default=None)
        out[w] = (best if links and words[best] >= 10 * n else None, n, len(links))

    def root(w):
        while out[w][0] is not None:
            w = out[w][0]
        return w

    return {w: (form, root(w), n, links, words[form] if form else None)
            for w, (form, n, links) in out.items()}


def found(docs, **more):
    rows = spelling.variants(docs, **more).collect()
    assert len(rows) == len({r["word"] for r in rows})
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


words = st.lists(st.text("ab", min_size=1, max_size=6), unique=True, max_size=30)


@settings(max_examples=150, deadline=None)
@given(words, st.integers(1, 5))
def test_composition_finds_each_pair_once(listed, length):
    own = sorted(w for w in listed if len(w) == length)
    longer = sorted(w for w in listed if len(w) == length + 1)
    machine = Acceptors()
    a, b = machine.add(own), machine.add(longer)
    assert (machine.words[a], machine.words[b]) == (len(own), len(longer))
    replaced = [tuple(sorted((own[i], own[j]))) for i, j in machine.replaced(a)]
    inserted = [(own[i], longer[j]) for i, j in machine.inserted(a, b)]
    assert sorted(replaced) == sorted(
        (x, y) for x in own for y in own if x < y and near(x, y))
    assert sorted(inserted) == sorted((x, y) for x in own for y in longer if near(x, y))


def test_equal_endings_are_one_state():
    machine = Acceptors()
    machine.add(["aending", "bending", "cending"])
    # The letters of "ending", the state after it, and the start.
    assert len(machine.final) == 8


@pytest.mark.parametrize("most", [spelling.SHARD, 3])
def test_against_all_pairs(spark, documents, most):
    """Also with shards cut again and again."""
    import random

    rng = random.Random(3)
    pool = ["".join(rng.choice("abé") for _ in range(rng.choice([7, 7, 8, 9]))) for _ in range(60)]
    pool += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababa", "abababab", "bababab"]
    rows = [(i, " ".join(rng.choices(pool, weights=range(1, len(pool) + 1), k=40)))
            for i in range(30)]
    assert found(documents(rows), most=most) == brute(rows)


def test_forms_lead_to_a_root(spark, documents):
    rows = [(1, "rareword " * 2 + "rarewords " * 25 + "rarewordss " * 300 + "farawayone " * 2)]
    result = found(documents(rows))
    assert result == brute(rows)
    assert len({r[1] for w, r in result.items() if w.startswith("rare")}) == 1


def test_odd_rows(spark, documents, clashing):
    long = "z" * 3000
    rows = [(None, "Elephant elephant"), (1, None), (2, ""), (3, "123 --"), (4, "ELEPHANT elephanT"),
            (4, "ELEPHANT elephanT"), (5, f"{long} {long} {long}y {long}y x{long} x{long}"),
            (6, "ÉLÉPHANT Éléphant élephant élephant"), (7, "seven77seven")]
    assert found(clashing(documents(rows))) == brute(rows)


def test_no_rows(spark, documents):
    assert found(documents([])) == {}
