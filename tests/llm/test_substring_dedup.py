from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from tillstream.llm import substring_dedup as op
from tillstream.llm.common import table
from tillstream.llm.suffix import SuffixAutomaton


def results(docs, **options):
    rows = op.without_repeats(docs, **options).selectExpr(
        "doc_id", "n_words", "n_removed", "sha2(kept, 256) AS kept_sha256").collect()
    return {r[0]: tuple(r[1:]) for r in rows}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=14), max_size=6), st.integers(1, 5))
def test_automaton_finds_the_earliest_place(passages, most):
    automaton, place, ends = SuffixAutomaton(), 0, {}
    for words in passages:
        automaton.add(words, place)
        for end in range(len(words)):
            for length in range(1, end + 2):
                ends.setdefault(tuple(words[end + 1 - length:end + 1]), place + end)
        place += len(words) + 1
    automaton.settle()
    for words in passages:
        for at, (matched, end) in enumerate(automaton.matches(words, most)):
            assert matched == min(most, at + 1)
            assert end == ends[tuple(words[at + 1 - matched:at + 1])]


def test_windows_that_are_equal_select_the_same_gram(prose):
    import pyarrow as pa

    text, levels = prose(400, 1, 30), np.zeros(1 << 20, np.int8)
    both = [op.segments(op.grams(pa.scalar(t)), levels) for t in (text, f"x y z {text} q r")]
    of_window = [np.repeat(g, n) for g, _, n, _ in both]
    assert (of_window[1][3:3 + len(of_window[0])] == of_window[0]).all()


def test_against_brute_force(documents, prose):
    rng = random.Random(7)
    shared = [prose(n, 100 + n) for n in (19, 20, 25, 60, 200)]
    rows = []
    for i in range(60):
        parts = [prose(rng.randrange(0, 60), i)]
        for _ in range(rng.randrange(0, 4)):
            parts += [rng.choice(shared), prose(rng.randrange(0, 30), 1000 + i)]
        rows.append((i * 3, " \n".join(parts)))
    rows += [(500 + i, rows[5][1]) for i in range(4)] + [(600, "a " * 300), (601, "a " * 50)]
    rows += [(700 + n, " ".join("pqrstuvwxyz"[i % n] + str(n) for i in range(20 + n // 2 + 3)))
             for n in range(2, 11)]
    assert results(documents(rows)) == brute.without_repeats(rows)


def test_whole_small_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = op.op1_substring_dedup(spark, sf_dir)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == brute.without_repeats(rows)


def test_odd_rows(documents, clashing, prose):
    long = prose(40_000, 3)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, long), (6, long + " tail"),
            (None, prose(30, 9)), (7, prose(30, 9)), (8, "\u00a0 \u2003 \x1f")]
    found = results(clashing(documents(rows)))
    assert found[1][:2] == found[2][:2] == found[3][:2] == (0, 0)
    assert found[4][:2] == (1, 0) and found[5][:2] == (40_000, 0)
    assert found[6][:2] == (40_001, 40_000)
    assert found[None][:2] == (30, 0) and found[7][:2] == (30, 30)
    assert found[8][0] == 3


def test_rows_that_repeat_an_id_do_not_remove_each_other(documents, prose):
    text = prose(50, 2)
    docs = documents([(1, text), (1, text), (2, text)])
    rows = sorted(tuple(r)[:3] for r in op.without_repeats(docs).collect())
    assert rows == [(1, 50, 0), (1, 50, 0), (2, 50, 50)]


def test_empty_table(documents):
    assert op.without_repeats(documents([])).count() == 0


@pytest.mark.parametrize("window", [6, 7, 11])
def test_other_windows(documents, prose, window):
    rows = [(i, prose(60, i % 5, 40)) for i in range(12)]
    expected = brute.without_repeats(rows, window)
    assert results(documents(rows), window=window) == expected
