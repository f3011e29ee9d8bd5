"""Token counts and packing."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tillstream.llm import packing, token_counts
from tillstream.llm.common import table
from tillstream.llm.tokens import encoder, vocabulary_path

ODD_TEXTS = ["", " ", "a  b", "tab\t\ttab \n\n x", "don't I'LL we've", "naïve 日本語 🙂🙂", "12345 6.7",
             "x" * 5000, "  y", "<|endoftext|>", "a<|endoftext|> b", "\x00\x1f", "end ",
             "ﬁ é", "\r\n \r\nz"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_are_the_library_s(spark, sf_dir, library):
    texts = ODD_TEXTS + [r["text"] for r in table(spark, sf_dir, "documents").collect()]
    own = encoder(vocabulary_path())
    assert all(own.ids(t) == ids(library, t)[:-1] for t in texts)
    assert 50256 not in own.ordinary("a<|endoftext|> b")


def check_packing(rows, docs, library, capacity):
    """Pieces make up the documents, and sequences are gapless and no longer than allowed."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == {d for d, _ in docs}
    for doc_id, text in docs:
        own, whole = sorted(by_doc[doc_id], key=lambda r: r["piece"]), ids(library, text)
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert len(own) == max(1, -(-len(whole) // capacity))
        assert all(r["length"] == capacity for r in own[1:])
        at = 0
        for r in own:
            part = np.array(whole[at:at + r["length"]], "<u4")
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(whole)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_sequence), sum(r["length"] for r in rows)


def test_packing_a_table(spark, library):
    sf_dir = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    found = packing.op10_best_fit_packing(spark, sf_dir)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                             "offset"]
    sequences, tokens = check_packing(found.collect(), docs, library, 2048)
    assert sequences <= -(-tokens // 2048) + 2


def test_packing_odd_rows(spark, documents, clashing, library, prose):
    docs = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(100, None), (101, prose(9000, 1))]
    rows = packing.pack(clashing(documents(docs)), vocabulary_path(), 64).collect()
    check_packing(rows, docs, library, 64)
    same = packing.pack(documents([(1, "a b"), (1, "a b"), (None, "c")]), vocabulary_path()).collect()
    assert sorted((r["length"], r["offset"]) for r in same)[0][0] == 2 and len(same) == 3
    assert packing.pack(documents([]), vocabulary_path()).count() == 0


def test_sequences_hold_the_ids(spark, documents, library, prose):
    docs = [(i, prose(5 + 7 * i, i)) for i in range(20)]
    packed = packing.pack(documents(docs), vocabulary_path(), 128, with_ids=True)
    rows, whole = packed.collect(), {r[0]: r[1] for r in packing.sequences(packed).collect()}
    for r in rows:
        own = whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]]
        assert own == r["ids"] == ids(library, docs[r["doc_id"]][1])[r["start"]:][:r["length"]]


@pytest.mark.parametrize("capacity, seed", [(16, 1), (50, 2), (200, 3), (2048, 4)])
def test_plans(capacity, seed):
    rng = random.Random(seed)
    histogram = {}
    for _ in range(3000):
        length = min(capacity, int(rng.paretovariate(0.7)))
        histogram[length] = histogram.get(length, 0) + 1
    bins = packing.plan(histogram, capacity)
    used = {}
    for count, filling in bins:
        assert 0 < sum(length * n for length, n in filling.items()) <= capacity
        for length, n in filling.items():
            used[length] = used.get(length, 0) + count * n
    assert used == histogram
    total = sum(length * n for length, n in histogram.items())
    assert sum(count for count, _ in bins) <= -(-total // capacity) + 2
    assert len(bins) <= 3 * capacity + 50


def test_exact_complements():
    left = np.zeros(20, np.int64)
    left[[3, 5, 9]] = 1, 2, 1
    assert packing._fill(9, left) == [9]
    assert packing._fill(10, left) == [5, 5]
    assert sorted(packing._fill(13, left)) == [3, 5, 5] and packing._fill(18, left) is None
    left[5] = 1
    assert packing._fill(10, left) is None and packing._fill(6, left) is None


def test_counts_of_a_table(spark, sf_dir, library):
    found = token_counts.op4_token_counts(spark, sf_dir).collect()
    library.encode_special_tokens = True
    rows = table(spark, sf_dir, "documents").collect()
    assert {r["doc_id"]: r["n_tokens"] for r in found} == {
        r["doc_id"]: len(library.encode(r["text"], add_special_tokens=False).ids) for r in rows}
    library.encode_special_tokens = False


@pytest.mark.parametrize("block_bytes", [2, 6, 10, 64, 1 << 20])
def test_documents_cross_blocks(documents, clashing, prose, block_bytes):
    rows = [(1, ""), (2, "a"), (3, prose(40, 1)), (4, None), (5, ""), (6, "<|endoftext|>"),
            (7, prose(200, 2)), (7, "twice"), (None, "no id")]
    docs = clashing(documents(rows)).coalesce(1)
    blocks, manifest = token_counts.flat_streams(docs, vocabulary_path(), block_bytes=block_bytes)
    found = token_counts.scan(blocks)
    counts = sorted((r["doc_id"] or 0, r["n_tokens"], r["closed"])
                    for r in found.join(manifest, ["stream", "ordinal"]).collect())
    own = encoder(vocabulary_path())
    assert counts == sorted((d or 0, len(own.ordinary(t or "")), True) for d, t in rows)


@pytest.mark.parametrize("tokens, expected", [
    ([], []), ([9], [(0, 0, True)]), ([1, 2], [(0, 2, False)]),
    ([1, 9, 9, 2, 3, 9, 4], [(0, 1, True), (2, 0, True), (3, 2, True), (6, 1, False)]),
])
@pytest.mark.parametrize("block_bytes", [2, 4, 1024])
def test_raw_files(spark, tmp_path, tokens, expected, block_bytes):
    (tmp_path / "tokens.bin").write_bytes(np.array(tokens, "<u2").tobytes())
    blocks = token_counts.blocks_of_files(spark, str(tmp_path), block_bytes)
    found = token_counts.scan(blocks, end_id=9).orderBy("ordinal").collect()
    assert [(r["start"], r["n_tokens"], r["closed"]) for r in found] == expected
    assert [r["ordinal"] for r in found] == list(range(len(expected)))


def test_counts_of_nothing(documents):
    blocks, manifest = token_counts.flat_streams(documents([]), vocabulary_path())
    assert token_counts.scan(blocks).count() == 0 and manifest.count() == 0
