"""Exact dedup, mixing and URL filters: against SQL, and on odd rows."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from suite.compare import connect, differences, type_differences
from tillstream.llm import exact_dedup, mixing, url_filter
from tillstream.llm.queries import ORACLES, QUERIES
from tillstream.session import scratch_folder


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, sf_dir, name):
    connection = connect(sf_dir)
    rows = QUERIES[name](spark, sf_dir)
    assert differences(rows, connection.execute(ORACLES[name])) == []
    assert type_differences(rows, connection.execute(ORACLES[name])) == []


@pytest.mark.parametrize("name", ["op3_exact_dedup", "op5_source_mixing", "op7_url_filter"])
def test_no_python_in_the_plan(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def index(spark):
    return exact_dedup.DigestIndex(spark, scratch_folder(spark, "digest-index"), 4)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_dedup_odd_rows(spark, documents, clashing):
    rows = [(1, None), (2, ""), (3, "Ab É"), (4, "aB É"), (5, "ab é"), (None, "x"), (6, "y" * 300_000),
            (7, "Y" * 300_000), (8, "K"), (9, "\u212a")]
    found = {r[0]: tuple(r[1:]) for r in exact_dedup.decisions(
        clashing(documents(rows)), index(spark)).collect()}
    assert found[1] == (2, 2, False, sha("")) and found[2] == (2, 2, True, sha(""))
    assert found[3] == (4, 2, False, sha("ab É")) and found[5] == (5, 1, True, sha("ab é"))
    assert found[None] == (None, 1, True, sha("x")) and found[6][:3] == (7, 2, False)
    assert found[8][0] == 8 and found[9][0] == 9


def test_an_index_keeps_its_number_of_buckets(spark, documents):
    own = exact_dedup.DigestIndex(spark, scratch_folder(spark, "digest-index"), 8)
    docs = documents([(i, f"text {i}") for i in range(200)])
    assert exact_dedup.keep_rows(docs, own).count() == 200
    again = exact_dedup.DigestIndex(spark, own.folder, 16)
    assert again.buckets == 8
    rows = exact_dedup.decisions(docs, again).collect()
    assert len(rows) == 200 and not any(r["kept"] for r in rows)
    assert again.rows().count() == 200


def test_dedup_over_batches(spark, documents):
    own = index(spark)
    first = exact_dedup.keep_rows(documents([(1, "a"), (2, "A"), (3, "b")]), own).collect()
    assert sorted(r["doc_id"] for r in first) == [2, 3]
    second = exact_dedup.decisions(documents([(9, "a"), (8, "c"), (7, "C")]), own).collect()
    assert {r["doc_id"]: (r["keep_id"], r["kept"]) for r in second} == {
        9: (2, False), 8: (8, True), 7: (8, False)}
    assert own.rows().count() == 3
    again = exact_dedup.DigestIndex(spark, own.folder, 4)
    assert exact_dedup.keep_rows(documents([(5, "A"), (6, "d")]), again).count() == 1


def test_dedup_keeps_one_of_repeated_rows_and_takes_empty_tables(spark, documents, clashing):
    kept = exact_dedup.keep_rows(clashing(documents([(1, "a"), (1, "a"), (1, "b"), (None, "c"),
                                                     (None, "c")])), index(spark)).collect()
    assert sorted((r["text"], r["doc_id"]) for r in kept) == [("a", 1), ("b", 1), ("c", None)]
    own = index(spark)
    assert exact_dedup.decisions(documents([]), own).count() == 0
    assert own.rows().count() == 0


def test_a_second_batch_does_not_shuffle_the_index(spark, documents):
    own = index(spark)
    assert exact_dedup.decisions(documents([(1, "a"), (2, "b")]), own).count() == 2
    batch = documents([(3, "a"), (4, "c")]).select(
        "doc_id", F.unhex(exact_dedup.digest_of(F.col("text"))).alias("digest"))
    plan = own.looked_up(batch)._jdf.queryExecution().executedPlan().toString()
    # One exchange, of the batch's own digests; the index is read bucket by bucket.
    assert plan.count("Exchange") == 1 and "SelectedBucketsCount: 4 out of 4" in plan


def taken(docs, **options):
    return {r["doc_id"]: r for r in mixing.schedule(docs, **options).collect()}


def test_a_bin_of_equal_times_is_split(spark, documents, monkeypatch):
    """A source each, all of one size: every finish time is the same."""
    docs = documents([(i, "w " * 7, f"s{i:04}") for i in range(600)])
    whole = taken(docs)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 40)
    split = taken(docs)
    assert split == whole
    assert sum(r["copies"] * r["size"] for r in split.values()) == 600 * 7


def test_targets_are_capped_and_reshared(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 490), (None, 100)],
                                  "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    # 5, 2, 1, 5: a stops at 30, and the null source at 300; 1270 remain for 2 : 1.
    assert found["a"] == 30 and found[None] == 300
    assert found["b"] == pytest.approx(1270 * 2 / 3) and found["c"] == pytest.approx(1270 / 3)


def test_mix_comes_near_its_targets(documents, prose):
    rows = [(i, prose(1 + i % 40, i), f"s{min(i % 7, 3)}") for i in range(700)]
    plan = taken(documents(rows))
    for source in {r[2] for r in rows}:
        own = [plan[r[0]] for r in rows if r[2] == source]
        total = sum(r["size"] * r["copies"] for r in own)
        assert abs(total - own[0]["target"]) <= 40
        assert max(r["copies"] for r in own) <= 3
    assert sum(r["size"] * r["copies"] for r in plan.values()) <= sum(len(r[1].split()) for r in rows)
    assert {d: r["copies"] for d, r in taken(documents(rows[::-1])).items()} == {
        d: r["copies"] for d, r in plan.items()}


def test_mix_odd_rows(documents, clashing, prose):
    rows = [(1, None, "a"), (2, "", "a"), (3, prose(50_000, 1), "a"), (4, "x y", None),
            (None, "p q r", "b"), (6, "same", "c"), (6, "same", "c"), (7, None, "empty")]
    plan = mixing.schedule(clashing(documents(rows))).collect()
    assert len(plan) == len(rows)
    sizes = sorted((r["doc_id"] or 0, r["size"], r["copies"] <= 3) for r in plan)
    assert sizes == sorted((r[0] or 0, len((r[1] or "").split()), True) for r in rows)
    assert mixing.schedule(documents([])).count() == 0
    assert mixing.schedule(documents([(1, None), (2, "")])).filter("size > 0").count() == 0


def test_mixed_rows_repeat_as_often_as_planned(documents, clashing, prose):
    docs = clashing(documents([(i, prose(10, i), "ab"[i > 3]) for i in range(40)]))
    plan = {d: r["copies"] for d, r in taken(docs).items()}
    rows = mixing.mixed(docs)
    assert rows.columns == docs.columns
    counts = {}
    for r in rows.collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    assert counts == {d: n for d, n in plan.items() if n}
    assert mixing.mixed(documents([])).count() == 0


def test_mixed_rows_without_id_or_with_a_shared_one(documents, clashing, prose):
    rows = [(None, prose(5 + i, i), "ab"[i > 3]) for i in range(12)]
    rows += [(1, prose(5 + i, 50 + i), "ab"[i > 3]) for i in range(12)]
    rows += [(2, "same words", "a")] * 3 + [(3, "x y", None), (4, None, "a")]
    docs = clashing(documents(rows))
    key = F.concat_ws(":", F.coalesce(F.col("doc_id"), F.lit(0)), "text")
    planned, counts = {}, {}
    for r in mixing.schedule(docs, key=key).collect():
        planned[r["key"]] = planned.get(r["key"], 0) + r["copies"]
    for r in mixing.mixed(docs).select(key.alias("key")).collect():
        counts[r["key"]] = counts.get(r["key"], 0) + 1
    assert counts == {k: n for k, n in planned.items() if n}
    assert any(k.startswith("0:") for k in counts)


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, (u, h) in enumerate(rows)],
                                 "page_id long, url string, html string, host string, rank int")


@pytest.mark.parametrize("url, host, path, rule", [
    (None, "", "", None), ("", "", "", None), ("no host", "", "", None),
    ("http://A.Example.COM/en/x?q#f", "a.example.com", "/en/x", "example.com/en/"),
    ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/"),
    ("http://m.www.example.com/en/1", "m.www.example.com", "/en/1", "www.example.com/en/"),
    ("http://example.com/de/", "example.com", "/de/", "com/"),
    ("http://badexample.com/en/", "badexample.com", "/en/", "com/"),
    ("https://x.net/es/1", "x.net", "/es/1", "net/es/"), ("https://x.net/es", "x.net", "/es", None),
    ("https://x.net?u=/es/", "x.net", "", None), ("https://x.com", "x.com", "", None),
    ("a://b://c/d", "b:", "//c/d", None), ("x://É.net/fr/", "É.net", "/fr/", "net/fr/"),
    ("http://h.org/a\nb#c", "h.org", "/a\nb", None), ("http://com/z", "com", "/z", "com/"),
])
def test_rules(spark, url, host, path, rule):
    found = url_filter.judge(pages(spark, [(url, None)])).first()
    assert (found["host"], found["path"], found["rule"]) == (host, path, rule)
    if rule:
        assert found["verdict"] == dict((r, v) for v, r in url_filter.RULES)[rule]


def test_trust_and_distrust_spread_over_links(spark):
    good, bad = "http://www.example.com/en/1", "http://bad.net/es/1"
    link = '<a href="{}">'.format
    rows = [(good, link("https://friend.org/x") + link("/local") + link("//Other.Info")), (bad, None),
            ("http://friend.org/y", ""), ("http://pal.biz/z", link("http://bad.net/home")),
            ("http://nobody.info/", None), ("http://other.info/", None), ("http://bad.net/de/", None),
            ("http://sub.bad.net/de/", None)]
    found = {r["host"] + r["path"]: r["verdict"]
             for r in url_filter.judge(pages(spark, rows)).collect()}
    assert found["friend.org/y"] == found["other.info/"] == found["nobody.info/"] == "allow"
    assert found["pal.biz/z"] == found["bad.net/de/"] == found["sub.bad.net/de/"] == "block"


def test_pages_may_be_empty_or_repeat(spark):
    assert url_filter.judge(pages(spark, [])).count() == 0
    same = pages(spark, [("http://a.net/es/", "x" * 500_000)])
    assert url_filter.judge(same.union(same)).count() == 2
