from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tillstream.llm import toxicity as op
from tillstream.llm.automaton import TermMachine
from tillstream.llm.common import table


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_machine_against_edit_distance():
    rng = random.Random(1)
    terms = ["".join(rng.choices("abc", k=rng.randrange(3, 9))) for _ in range(25)]
    machine = TermMachine(terms)
    for _ in range(3000):
        word = "".join(rng.choices("abcd", k=rng.randrange(0, 10)))
        near = min([d for t in terms if (d := distance(t, word)) == 0 or (d == 1 and len(t) >= 5)],
                   default=None)
        match = machine.match(word)
        assert (match and match[1]) == near
        assert near is None or distance(machine.names[match[0]], word) == near


def test_stems_take_any_ending():
    machine = TermMachine(["clown"], ["lowe"])
    assert machine.names[machine.match("lowe")[0]] == machine.names[machine.match("loweist")[0]]
    assert machine.match("low") is None and machine.match("xlowe") is None
    assert machine.match("klown")[1] == machine.match("clwn")[1] == machine.match("clowns")[1] == 1


def test_held_out_documents_of_a_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = op.op2_toxicity(spark, sf_dir)
    assert rows.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert rows.count() == table(spark, sf_dir, "documents").count()
    judged = rows.join(table(spark, sf_dir, "labels"), "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["toxic"] for r in judged) >= 0.97 * len(judged)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
               for r in rows.collect())


def labelled(spark, documents, n=400):
    """Documents in which 'blorgh' and words from 'zanku' are what makes them toxic."""
    rng, rows, labels = random.Random(2), [], []
    for i in range(n):
        own = [f"w{rng.randrange(900)}" for _ in range(30)]
        toxic = i % 3 == 0
        if toxic:
            own[rng.randrange(30)] = rng.choice(["blorgh", "zankuta", "zankuri", "zankulo", "zankue"])
        rows.append((i, " ".join(own)))
        labels.append((i, 1, int(toxic)))
    return documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def words():
    return " ".join(f"w{i}" for i in range(20))


def test_misspellings_stems_and_quotations(spark, documents, words):
    model = op.learn(*labelled(spark, documents))
    assert "blorgh" in model.terms and any("zankuwhat".startswith(s) for s in model.stems)
    scorer = op.Scorer(model)

    def score(text):
        return scorer.score(*scorer.hits(text)[:3])

    assert score(f"{words} Blorgh!") > 0.9 and score(f"{words} zankuxx") > 0.9
    assert score(f"{words} b1orgh") > 0.5 and score(f"{words} blorrgh") > 0.5
    assert score(words) < 0.1 and score(None) < 0.1 and score("") < 0.1
    assert score(f'he said "you blorgh man" {words}') < score(f"you blorgh man {words}")


def test_misspellings_inside_a_stem(spark, documents, words):
    model = op.learn(*labelled(spark, documents))
    scorer = op.Scorer(model)
    assert model.stems and all(
        scorer.hits(f"{words} {wrong}")[:3] == (0, 1, 0)
        for wrong in ("zenkuta", "2ankuri", "ankulo", "znkue", "zannkuta"))
    assert scorer.score(*scorer.hits(f"{words} z4nkuta")[:3]) > 0.5
    assert scorer.hits(f"{words} zankuwhat")[:3] == (1, 0, 0)


def test_terms_that_clean_documents_quote(spark, documents, words):
    docs, labels = labelled(spark, documents)
    rng, quoting = random.Random(3), []
    for i in range(60):
        own = [f"w{rng.randrange(900)}" for _ in range(30)]
        own[rng.randrange(2, 28)] = rng.choice(['"blorgh"', 'he said "you blorgh man" loudly'])
        quoting.append((1000 + i, " ".join(own)))
    more = spark.createDataFrame([(r[0], 1, 0) for r in quoting], labels.schema)
    model = op.learn(docs.union(documents(quoting)), labels.union(more))
    scorer = op.Scorer(model)
    assert "blorgh" in model.terms
    assert scorer.score(*scorer.hits(f"{words} blorgh")[:3]) > 0.9
    assert scorer.score(*scorer.hits(f'he said "you blorgh man" {words}')[:3]) < 0.5


def test_quotation_is_told_alike_when_counting(spark):
    rng = random.Random(4)
    for i in range(5):
        tokens = [rng.choice(["a", "b", '"a', 'b"', '"c"', 'c",', "d"]) for _ in range(40)]
        own = " ".join(tokens)
        plain = {t.strip(op.TRIM) for at, t in enumerate(tokens) if not op.Scorer._quoted(
            tokens[max(0, at - op.WINDOW):at], t, tokens[at + 1:at + 1 + op.WINDOW])}
        sample = spark.createDataFrame([(i, 0, own, tokens)],
                                       "doc_id long, toxic int, text string, words array<string>")
        assert {r["word"] for r in op._counted(sample).filter("other_docs > 0").collect()} == plain


def test_shared_passages_do_not_fold_the_sample(spark, documents, prose):
    header = prose(30, 99)
    rows = [(i, f"{header} {prose(30, i)}") for i in range(100)]
    rows += [(100 + i, prose(30, 98)) for i in range(20)]
    docs = documents([*rows, (200, None), (201, "")])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(202)],
                                   "doc_id long, quality int, toxic int")
    sample = op._sample(docs, labels, op.SAMPLE).collect()
    usable = {r["doc_id"] for r in docs.filter(~op.is_held_out(docs["doc_id"])).collect()}
    own = [i for i in usable if i < 100]
    assert sum(r["doc_id"] < 100 for r in sample) >= len(own) - 2
    # Copies fold to one row per label.
    assert sorted(r["toxic"] for r in sample if 100 <= r["doc_id"] < 200) == [0, 1]


def test_odd_rows(spark, documents, clashing):
    docs, labels = labelled(spark, documents)
    model = op.learn(docs, labels)
    rows = [(1, None), (2, ""), (3, "blorgh " * 60_000), (None, "blorgh"), (4, "fine"), (4, "blorgh"),
            (5, "w1 " * 100_000 + "blorgh")]
    more = clashing(documents(rows))
    found = [(r["doc_id"], r["predicted"]) for r in op.scored(more, model).collect()]
    assert found == [(1, 0), (2, 0), (3, 1), (None, 1), (4, 0), (4, 1), (5, 1)]
    kept = op.keep_clean(more, model)
    assert kept.columns == more.columns
    assert [r["text"] for r in kept.collect()] == [None, "", "fine"]
    assert op.scored(documents([]), model).count() == 0


def test_without_labels(spark, documents):
    docs, labels = labelled(spark, documents, 30)
    for few in (labels.limit(0), labels.filter("toxic = 0"), labels.withColumn(
            "toxic", labels["toxic"].cast("int") * None)):
        model = op.learn(docs, few)
        assert model.terms == [] and op.scored(docs, model).filter("predicted = 1").count() == 0
    assert op.learn(documents([]), labels).terms == []


def test_rich_lexicons_and_samples_without_words(spark, documents):
    docs, labels = labelled(spark, documents, 30)
    model = op.learn(docs.withColumn("text", F.lit("")), labels)
    assert model.terms == [] and op.scored(docs, model).filter("predicted = 1").count() == 0
    # 4,500 words, each in half of the toxic documents and between other words each time.
    rng, terms, rows = random.Random(5), [f"{i:x}q{i * 7919 % 4500}z" for i in range(4500)], []
    for i in range(100):
        own = [t for at, t in enumerate(terms) if (at + i) % 2 == 0]
        rng.shuffle(own)
        rows += [(2 * i, " ".join(own)), (2 * i + 1, f"clean words {i}")]
    model = op.learn(documents(rows), spark.createDataFrame(
        [(r[0], 1, 1 - r[0] % 2) for r in rows], labels.schema))
    assert len(model.terms) > 4000


def test_held_out_labels_are_not_read(spark, documents):
    docs, labels = labelled(spark, documents)
    from pyspark.sql import functions as F

    lies = labels.withColumn("toxic", F.when(op.is_held_out(F.col("doc_id")), 1 - F.col("toxic"))
                             .otherwise(F.col("toxic")))
    assert op.learn(docs, lies).terms == op.learn(docs, labels).terms
