"""I-Match fingerprints: slices, odd rows, and what edits do to the likeness."""

from __future__ import annotations

import hashlib

import pytest

from tillstream.llm import imatch


def prints(docs):
    return {r["doc_id"]: r for r in imatch.fingerprints(docs).collect()}


def test_no_python_and_one_shuffle_of_texts(spark, sf_dir):
    rows = imatch.op11_imatch(spark, sf_dir)
    plan = rows._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct"))
    executed = rows._jdf.queryExecution().executedPlan().toString()
    assert executed.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_edits_and_strangers(spark, documents, prose):
    rows = [(i, prose(200, i)) for i in range(60)]
    found = prints(documents(rows))
    assert all(r["near_edited"] > r["near_next"] for r in found.values())
    assert sum(r["near_edited"] for r in found.values()) / 60 > 0.25
    assert sum(r["near_next"] for r in found.values()) / 60 < 0.02


def test_edited_text_runs_around(spark, documents, prose, monkeypatch):
    rows = [(i * 7, prose(3 + i, i) + "é😀") for i in range(40)]
    found = prints(documents(rows))
    for at, (doc_id, text) in enumerate(rows):
        moved = len(text) // 4
        edited = text[:len(text) - moved] + rows[(at + 1) % 40][1][:moved]
        assert found[doc_id]["n_chars"] == len(text)
        assert found[doc_id]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


def test_equal_texts_have_equal_fingerprints(spark, documents, prose):
    copy = prose(300, 1)
    found = prints(documents([(i, copy if i % 3 else prose(50, i)) for i in range(30)]))
    assert len({found[i]["fingerprint"] for i in range(30) if i % 3}) == 1
    assert found[1]["near_next"] == 1.0 and found[2]["near_next"] == 0.0


def test_odd_rows(spark, documents, clashing):
    rows = [(None, "no id"), (1, None), (2, ""), (3, "!!! ..."), (4, "??? ..."), (5, "word"),
            (6, "x y " * 50_000), (7, "one two three"), (7, "one two three"), (8, "Ab"), (9, "aB")]
    found = imatch.fingerprints(clashing(documents(rows))).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] and by_id[1]["near_next"] == 1.0
    assert by_id[1]["n_chars"] == 0 and by_id[1]["near_edited"] == 1.0
    assert by_id[3]["fingerprint"] != by_id[4]["fingerprint"] and by_id[3]["near_next"] == 0.0
    assert by_id[8]["fingerprint"] == by_id[9]["fingerprint"]
    assert sorted(r["near_next"] for r in found if r["doc_id"] == 7) == [0.0, 1.0]
    assert all(0 <= r["near_edited"] <= 1 for r in found)


@pytest.mark.parametrize("rows", [[], [(5, "just one document here")]])
def test_few_rows(spark, documents, rows):
    found = imatch.fingerprints(documents(rows)).collect()
    assert len(found) == len(rows)
    # A single document is followed by itself.
    assert all(r["near_next"] == 1.0 for r in found)


def test_a_widely_copied_text_keeps_its_terms(spark, documents, prose):
    """A third of all rows are copies; their terms count as if there was one."""
    copy = prose(100, 5)
    rows = [(i, copy if i % 3 == 0 else prose(80, 100 + i)) for i in range(90)]
    found = prints(documents(rows))
    assert found[0]["fingerprint"][0] == "b" and found[0]["near_edited"] > 0


def test_larger_lexicons_are_shuffled(spark, documents, prose, monkeypatch):
    docs = documents([(i, prose(60, i)) for i in range(20)])
    broadcast = prints(docs)
    monkeypatch.setattr(imatch, "BROADCAST_TERMS", 0)
    assert prints(docs) == broadcast
