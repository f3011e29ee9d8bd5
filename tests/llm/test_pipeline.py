"""Each stage of the pipeline on its own input, and the whole run."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from tests.llm import brute
from tillstream.llm import mixing, toxicity
from tillstream.llm.common import table, written


@pytest.fixture(scope="module")
def stored(spark):
    """The stages' inputs and outputs, in order."""
    sf_dir = "/root/testdata/sf0.001"
    docs = [table(spark, sf_dir, "documents")]
    for name, stage in pipeline.STAGES:
        docs.append(written(stage(spark, docs[-1], sf_dir), name))
    return docs


def test_stages_are_named_and_keep_the_columns(stored):
    assert [name for name, _ in pipeline.STAGES] == [
        "toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert all(docs.schema == stored[0].schema for docs in stored[:-1])
    assert all(docs.count() > 0 for docs in stored)


def test_toxic_documents_go_and_others_stay(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smallest table has too few labels to learn from
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    bad = {r[0] for r in toxicity.scored(docs, model).filter("predicted = 1").collect()}
    left = {r["doc_id"] for r in pipeline.drop_toxic(spark, docs, sf_dir).collect()}
    assert bad and left == {r["doc_id"] for r in docs.collect()} - bad


def test_one_of_equal_texts_stays(stored):
    newest = {}
    for r in stored[1].collect():
        key = brute.ascii_lower(r["text"])
        newest[key] = max(newest.get(key, -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in stored[2].collect()) == sorted(newest.values())


def test_one_of_near_copies_stays(stored):
    found = brute.components([(r["doc_id"], r["text"]) for r in stored[2].collect()])
    assert sorted(r["doc_id"] for r in stored[3].collect()) == sorted({c for _, c in found.values()})


def test_rows_come_as_often_as_the_mix_takes_them(stored):
    plan = {r["doc_id"]: r["copies"] for r in mixing.schedule(stored[3]).collect()}
    counts = {}
    for r in stored[4].collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    assert counts == {d: n for d, n in plan.items() if n}


def test_every_row_is_packed(stored):
    pieces = stored[5].collect()
    assert sum(r["piece"] == 0 for r in pieces) == stored[4].count()
    ends = {}
    for r in pieces:
        ends.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in ends.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
        assert own[-1][0] + own[-1][1] <= 2048


def test_run_is_registered_and_repeats(spark, stored, sf_dir):
    rows = contract.queries()["pipeline"](spark, sf_dir)
    assert rows.columns == stored[5].columns
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, stored[5].collect()))


def test_stages_take_empty_and_odd_rows(spark, documents, sf_dir):
    odd = [(None, None), (1, None), (2, ""), (3, "x" * 100_000), (3, "x" * 100_000), (4, "a b")]
    for rows in ([], odd):
        docs = documents(rows)
        for name, stage in pipeline.STAGES:
            docs = written(stage(spark, docs, sf_dir), name)
        assert (docs.count() > 0) == bool(rows)


def test_unique_rows_without_id_reach_the_packing(spark, documents, sf_dir, prose):
    docs = documents([(None, prose(30, i)) for i in range(4)] + [(i, prose(30, 9 + i))
                                                               for i in range(4)])
    for name, stage in pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    assert len({r["text"] for r in docs.filter("doc_id is null").collect()}) == 4
    assert len({r["text"] for r in docs.collect()}) == 8
