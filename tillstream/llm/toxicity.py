"""Toxicity from a learned lexicon, matched with misspellings and weighed by context.

Learning reads at most `SAMPLE` labelled documents outside the held-out fold (the first ones by a
hash of their id), one of each group of near copies with one label. Words and word beginnings are
counted over them in Spark; a term is what occurs in several toxic documents in different
surroundings and nearly never in others, unless quoted there. Beginnings shared by several such
words become stems. Terms form a trie, with all words of the stems that toxic documents use, and
Levenshtein automata run over it (`automaton`), so that a word one edit away from a term counts as
its misspelling, unless clean sample documents use that word. A stem that a word begins with
exactly wins over misspellings.

A document is scored from its whole text: hits are sorted into plain ones, misspelled ones and
quoted ones (quotation marks in the context window on both sides), and a logistic model fitted to
the sample weighs them. Its prior weights stand in for kinds of hits the sample does not show.

A null or empty text has no hits and a low score. A null doc_id falls into the held-out fold.
Documents that repeat an id are scored one by one; of an id's conflicting labels, 1 counts. Without
usable labels the lexicon is empty and every score low. No documents give no rows. Labels, source
and language are never read when scoring; extra columns pass `keep_clean` unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.automaton import TermMachine
from tillstream.llm.common import WORD, table, written

SAMPLE = 20_000
FOLDS = 5
# Least hashes that near copies share; texts with a share j of common shingles do by j ** 8.
FOLD_HASHES = 8
LEAST_DOCS, LEAST_ODDS = 3, 25.0
# How many words may look like terms by chance alone.
CHANCE = 0.01
STEM_LENGTHS = (4, 5, 6)
LEAST_STEM_WORDS, SAME = 3, 0.95
WINDOW = 6
QUOTES = frozenset("\"“”„«»‹›")
# Bias, weight of hits, and how much less misspelled and quoted ones weigh, before any label is seen.
PRIOR = np.array([-4.0, 6.0, -1.0, -3.0])
PRIOR_STRENGTH = 0.5
TRIM = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "“”„«»‹›¿¡…’‘"
WORDS_KEPT = 400_000


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


@dataclass
class Model:
    terms: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)
    clean_words: frozenset[str] = frozenset()
    weights: np.ndarray = field(default_factory=PRIOR.copy)


class Scorer:
    """Scores texts with a model; kept words spare most runs of the automaton."""

    def __init__(self, model: Model):
        self.model = model
        self.machine = TermMachine(model.terms, model.stems)
        self.kept: dict[str, int] = {}

    def _kind(self, token: str) -> int:
        """0 no hit, 1 a term, 2 a misspelled one."""
        word = token.strip(TRIM)
        match = self.machine.match(word) if word else None
        if match is None or (match[1] and word in self.model.clean_words):
            return 0
        return 2 if match[1] else 1

    def hits(self, text: str | None) -> tuple[int, int, int, list[str]]:
        """Numbers of plain, misspelled and quoted hits, and the misspelled words not quoted."""
        tokens = (text or "").lower().split()
        kept = self.kept
        if len(kept) > WORDS_KEPT:
            kept.clear()
        marked = {}
        for token in set(tokens):
            kind = kept.get(token)
            if kind is None:
                kind = kept[token] = self._kind(token)
            if kind:
                marked[token] = kind
        if not marked:
            return 0, 0, 0, []
        counts, wrong = [0, 0, 0, 0], []
        for at, token in enumerate(tokens):
            kind = marked.get(token)
            if kind:
                before = tokens[max(0, at - WINDOW):at]
                after = tokens[at + 1:at + 1 + WINDOW]
                kind = 3 if self._quoted(before, token, after) else kind
                counts[kind] += 1
                if kind == 2:
                    wrong.append(token.strip(TRIM))
        return counts[1], counts[2], counts[3], wrong

    @staticmethod
    def _quoted(before: list[str], token: str, after: list[str]) -> bool:
        opens = token[0] in QUOTES or any(t[0] in QUOTES for t in before)
        closes = not QUOTES.isdisjoint(token[-2:]) or any(
            not QUOTES.isdisjoint(t[-2:]) for t in after)
        return opens and closes

    def score(self, plain: int, wrong: int, quoted: int) -> float:
        total = float(self.model.weights @ features(plain, wrong, quoted))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, total))))


def features(plain: int, wrong: int, quoted: int) -> np.ndarray:
    hits = plain + wrong + quoted
    strength = 1 + math.log(hits) / 4 if hits else 0.0
    # A text with a plain hit is judged by that; the others only count where there is none.
    return np.array([1.0, strength, float(not plain and wrong > 0),
                     float(not plain and not wrong and quoted > 0)])


def _sample(docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """(doc_id, toxic, text, words) to learn from, near copies of one label folded to one."""
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()
                           & ~is_held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(size)
    texts = docs.select("doc_id", F.lower("text").alias("text")).join(chosen, "doc_id")
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    pairs = F.transform(F.slice(F.col("words"), 1, F.greatest(F.size("words") - 2, F.lit(1))),
                        lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))

    def least(seed: int) -> Column:
        return F.array_min(F.transform("pairs", lambda pair: F.xxhash64(pair, F.lit(seed))))

    # Texts without words have no least shingles and stand for themselves.
    alike = F.when(F.size("pairs") > 0, F.array(*map(least, range(FOLD_HASHES)))).otherwise(
        F.array(F.xxhash64("doc_id")))
    keyed = texts.withColumn("words", words).withColumn("pairs", pairs).withColumn("alike", alike)
    # One document speaks for all of its label that share every least shingle.
    return keyed.groupBy("toxic", "alike").agg(
        F.min_by(F.struct("doc_id", "toxic", "text", "words"), "doc_id").alias("d")).select("d.*")


def _counted(sample: DataFrame) -> DataFrame:
    """Per word of the sample: toxic and other documents, different surroundings in toxic ones.

    Where other documents quote a word it does not count: that is what `quoted_hits` weighs.
    """
    marks = f"[{''.join(sorted(QUOTES))}]"
    opens = F.transform("words", lambda word: F.substring(word, 1, 1).rlike(marks))
    closes = F.transform("words", lambda word: F.substring(word, -2, 2).rlike(marks))
    marked = sample.withColumn("quotes", (F.col("toxic") == 0) & F.col("text").rlike(marks))
    marked = marked.withColumns({name: F.when(F.col("quotes"), found) for name, found in (
        ("opens", opens), ("closes", closes))})

    def quoted(at: Column) -> Column:
        # As in `Scorer._quoted`, with the word itself on both sides.
        before = F.slice("opens", F.greatest(at - WINDOW, F.lit(0)) + 1,
                         F.least(at, F.lit(WINDOW)) + 1)
        after = F.slice("closes", at + 1, F.lit(WINDOW + 1))
        return F.array_contains(before, True) & F.array_contains(after, True)

    # The surroundings are looked up before words become rows, or each row would carry the text.
    placed = F.transform("words", lambda word, at: F.struct(
        F.btrim(word, F.lit(TRIM)).alias("word"),
        F.xxhash64(F.get("words", at - 1), F.get("words", at + 1)).alias("context"),
        F.when(F.col("quotes"), quoted(at)).otherwise(False).alias("quoted")))
    found = marked.select("doc_id", "toxic", F.explode(placed).alias("p")).select(
        "doc_id", "toxic", "p.*").filter("word != ''")
    return found.groupBy("word", "doc_id", "toxic").agg(
        F.min("context").alias("context"), F.min("quoted").alias("quoted")).groupBy("word").agg(
        F.count_if(F.col("toxic") == 1).alias("toxic_docs"),
        F.count_if((F.col("toxic") == 0) & ~F.col("quoted")).alias("other_docs"),
        F.approx_count_distinct(F.when(F.col("toxic") == 1, F.col("context")), 0.05)
        .alias("contexts"))


def _odds(toxic_docs: int, other_docs: int) -> Column:
    share = (F.col("toxic_docs") + 0.5) / (toxic_docs + 1)
    return share / ((F.col("other_docs") + 0.5) / (other_docs + 1))


def learn(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model:
    sample = written(_sample(docs, labels, size), "toxicity-sample")
    numbers = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_other = numbers.get(1, 0), numbers.get(0, 0)
    if not n_toxic or not n_other:
        return Model()
    words = written(_counted(sample), "toxicity-words")
    n_words = words.count()
    if not n_words:
        return Model()
    odds = _odds(n_toxic, n_other)
    # A word of that many documents meets only toxic ones with a chance of (share of toxic)**n.
    least = max(LEAST_DOCS, math.ceil(
        math.log(n_words / CHANCE) / math.log((n_toxic + n_other) / n_toxic)))
    strong = ((F.col("toxic_docs") >= least) & (F.col("contexts") >= least)
              & (odds >= LEAST_ODDS) & (F.col("toxic_docs") > 20 * F.col("other_docs")))
    begun = words.withColumn("stem", F.explode(F.array(*[
        F.substring("word", 1, n) for n in STEM_LENGTHS]))).filter(
        F.char_length("word") > F.char_length("stem"))
    stems = begun.groupBy("stem").agg(
        F.sum("toxic_docs").alias("toxic_docs"), F.sum("other_docs").alias("other_docs"),
        F.sum("contexts").alias("contexts"),
        F.count_if(F.col("toxic_docs") > 0).alias("n_words"))
    # What the sample holds bounds the rows collected here and below.
    found = stems.filter(strong & (F.col("n_words") >= LEAST_STEM_WORDS)).collect()
    stem_list = _stems({r["stem"]: r["toxic_docs"] for r in found})
    terms = [r["word"] for r in words.filter(strong & (F.char_length("word") >= 3)).orderBy(
        F.col("toxic_docs").desc(), "word").collect()]
    terms += _family(words, set(stem_list), terms)
    model = Model(terms, stem_list)
    return _fitted(model, sample)


def _family(words: DataFrame, stems: set[str], terms: list[str]) -> list[str]:
    """What else toxic documents use of words that begin with a stem.

    Stems match exactly, so only whole words in the trie catch a misspelling of their beginnings.
    """
    begins = F.array(*[F.substring("word", 1, n) for n in STEM_LENGTHS])
    known = F.broadcast(words.sparkSession.createDataFrame(
        [(s,) for s in sorted(stems)], "stem string"))
    rows = words.filter((F.col("toxic_docs") > 20 * F.col("other_docs"))).withColumn(
        "stem", F.explode(F.array_distinct(begins))).join(known, "stem", "left_semi")
    return sorted({r["word"] for r in rows.select("word").collect()} - set(terms))


def _stems(found: dict[str, int]) -> list[str]:
    """The shortest beginnings, made longer as long as that loses next to nothing."""
    longer: dict[str, list[str]] = {}
    for stem in sorted(found, key=lambda s: (len(s), s)):
        root = next((stem[:n] for n in STEM_LENGTHS if stem[:n] in longer), stem)
        longer.setdefault(root, []).append(stem)
    return [max((s for s in own if found[s] >= SAME * found[root]),
                key=lambda s: (len(s), found[s], s)) for root, own in longer.items()]


def _fitted(model: Model, sample: DataFrame) -> Model:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            rows = [scorer.hits(text.as_py()) for text in batch.column("text")]
            plain, wrong, quoted, words = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), *(pa.array(c, pa.int64()) for c in (plain, wrong, quoted)),
                 pa.array(words, pa.list_(pa.string()))],
                names=["toxic", "plain", "wrong", "quoted", "words"])

    # One small row per sampled document, so at most `size` of them.
    rows = sample.select(F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(
        count, "toxic int, plain long, wrong long, quoted long, words array<string>").collect()
    clean = frozenset(w for r in rows if r["toxic"] == 0 for w in r["words"])
    x = np.array([features(r["plain"], sum(w not in clean for w in r["words"]), r["quoted"])
                  for r in rows])
    y = np.array([r["toxic"] for r in rows], float)
    weights = PRIOR.copy()
    for _ in range(50):  # Newton steps of a logistic regression held to the prior
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - y) + PRIOR_STRENGTH * (weights - PRIOR)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + PRIOR_STRENGTH * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        weights = weights - step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return Model(model.terms, model.stems, clean, weights)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted and the hits behind them, one row per document."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            rows = [scorer.hits(text.as_py())[:3] for text in batch.column(2)]
            scores = np.array([scorer.score(*r) for r in rows])
            counts = np.array(rows, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                 pa.array((scores >= 0.5).astype(np.int32)),
                 *(pa.array(counts[:, i].copy()) for i in range(3))],
                names=["doc_id", "held_out", "score", "predicted", "plain_hits",
                       "misspelled_hits", "quoted_hits"])

    rows = docs.select(F.col(id_col).cast("long"), is_held_out(F.col(id_col)).alias("held_out"),
                       F.col(text_col))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int, "
                                  "plain_hits long, misspelled_hits long, quoted_hits long")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that are not toxic, in one pass and without a shuffle."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            good = [scorer.score(*scorer.hits(text.as_py())[:3]) < 0.5
                    for text in batch.column(place)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, learn(docs, table(spark, sf_dir, "labels")))
