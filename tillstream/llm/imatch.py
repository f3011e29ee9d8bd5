"""I-Match fingerprints: hashes of the distinct terms that randomised subsets of a lexicon keep.

A term is a lower-cased run of ASCII letters, digits, underscores and any characters beyond ASCII.
The lexicon holds the terms whose inverse document frequency lies in a band: in at most one of
`COMMON` documents (or in one document only) and in at least one of `RARE`. It has at most `RARE`
times as many terms as a document has distinct ones on average, whatever the size of the corpus. A
text that more than one of `HOT` documents share counts once; there are fewer than `HOT` such texts.

The lexicon is parted at random into `SUBSETS` parts (by four bits of a term's scrambled CRC-32), and
each part is thinned to nested subsets: at level l it keeps a term if 16 other bits are below
2**(16-l). A document is hashed at three levels chosen from its number of distinct terms, which leave
some 2 to 4, 1 to 2 and at most 1 of its terms in each part before the lexicon is asked (documents of
few terms start at level 0, with all of them); a document, however long, looks up some `SUBSETS` * 4
terms.
A fingerprint is a kind, the first level and `SUBSETS` hashes a level, each the start of the
MD5 of the subset's sorted terms, dots where nothing is left. Kinds: `b` terms in the band; `a` all
terms, for documents of up to `FEW` distinct terms of which none is in the band; `-` the text's MD5,
where there is neither. Likeness is the share of equal hashes among those of the levels in common
that are not empty on both sides; 1 for equal fingerprints, 0 for different kinds.

The edited text of a document ends in the start of the next document's text. Documents are dealt to
slices of ids once, together with their texts; all else (both fingerprints, and the comparison with
the next document's) is computed within the slice. The first document of each slice is also given to
the slice before it.

Null texts count as empty. Documents are ordered by id, null first, then by the text's 64-bit hash;
rows that repeat an id and its text follow each other. A single document follows itself. No rows
give no rows. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstream.llm.common import crc32_sql, table, written

TERM = r"[\w\x{80}-\x{10FFFF}]+"
COMMON, RARE, HOT = 20, 10_000, 1000
SUBSETS, LEVELS, HEX = 16, 3, 8
BLOCKS = SUBSETS * LEVELS
FEW = 64
FACTOR = 2654435761 % 2**31
EMPTY = "." * HEX
# Texts of a slice, and how many slices at most (their bounds are part of the plan).
SLICE_BYTES, MOST_SLICES = 64 << 20, 1 << 16
# A larger lexicon is joined by a shuffle instead of a broadcast; the rows are the same.
BROADCAST_TERMS = 4_000_000


def terms_of(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def _copies(docs: DataFrame) -> DataFrame:
    return written(docs.groupBy("text_hash").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"),
        F.max(F.octet_length("text")).alias("bytes")), "text-copies")


def lexicon(docs: DataFrame, copies: DataFrame, total: int) -> DataFrame:
    """The 64-bit hashes of the terms in the band, of (doc_id, text, text_hash)."""
    hot = copies.filter(F.col("n") * HOT > total).select("text_hash", "first_id")
    counted = docs.join(F.broadcast(hot), "text_hash", "left").filter(
        F.col("first_id").isNull() | F.col("doc_id").eqNullSafe(F.col("first_id")))
    # Outer, since Spark would split every text twice to leave out those without terms.
    counts = (counted.select(F.explode_outer(terms_of(F.col("text"))).alias("term"))
              .filter("term IS NOT NULL").groupBy(F.xxhash64("term").alias("term_hash")).agg(F.count(F.lit(1)).alias("df")))
    df = F.col("df")
    return written(counts.filter((df * RARE >= total) & ((df * COMMON <= total) | (df == 1)))
                   .select("term_hash"), "lexicon")


def _slice_of(bounds: list[int]) -> Column:
    """How many bounds are below the id, found in two steps of about the root of their number."""
    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds) - 1) + 1

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b < F.col("doc_id")))

    def literal(values: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")

    before = below(literal(bounds[width - 1::width])) * width
    return before + below(F.slice(literal(bounds), before + 1, F.lit(width)))


def _sliced(docs: DataFrame, slices: int) -> DataFrame:
    """Adds `slice` and `ghost`; the first rows of a slice come again as ghosts of the one before."""
    cuts = [i / slices for i in range(1, slices)]
    found = docs.agg(F.percentile_approx("doc_id", cuts, max(10_000, 10 * slices))).first()[0] \
        if cuts else None
    sliced = docs.withColumn("slice", _slice_of(sorted(set(found or []))))
    firsts = sliced.groupBy("slice").agg(F.min(F.struct("doc_id", "text_hash")).alias("first")).select(
        "slice", "first.*").orderBy("slice").collect()
    # The last slice is followed by the first one.
    ghosts = [(firsts[i - 1][0], doc_id, text_hash)
              for i, (_, doc_id, text_hash) in enumerate(firsts)]
    heads = docs.sparkSession.range(1).select(F.inline(F.from_json(
        F.lit(json.dumps([dict(zip(("slice", "head_id", "head_hash"), row, strict=True))
                          for row in ghosts])),
        "array<struct<slice: int, head_id: bigint, head_hash: bigint>>")))
    again = docs.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head_id"))
                      & (F.col("text_hash") == F.col("head_hash"))).select(
        *docs.columns, "slice", F.lit(True).alias("ghost"))
    return sliced.withColumn("ghost", F.lit(False)).unionByName(again)


def _level(distinct: Column) -> Column:
    """The first of the three levels: 2**(level+5) is at most the number of terms, or it is 0."""
    return F.least(F.greatest(F.length(F.bin(distinct.cast("long"))) - 6, F.lit(0)),
                   F.lit(17 - LEVELS))


def _highest(level: Column) -> Column:
    """The largest number that is kept at the level."""
    return F.call_function("shiftright", F.lit(65535), level)


def _scrambled(term: Column) -> Column:
    """32 bits: the lowest four tell the part, the upper half the level."""
    mixed = (F.crc32(term) * F.lit(FACTOR).cast("long")).bitwiseAND(F.lit(2**32 - 1))
    return mixed.bitwiseXOR(F.shiftright(mixed, 15))


def _number(scrambled: Column) -> Column:
    return F.shiftright(scrambled, 16)


def _with_fingerprint(rows: DataFrame) -> DataFrame:
    """Adds `fingerprint` to rows of kind, level, terms (sorted) and whole (for texts without any).

    Each step is a projection of its own, so that nothing is computed anew per subset.
    """
    def kept(j: int, step: int) -> Column:
        if not step:
            return F.filter("members", lambda x: x["bits"].bitwiseAND(F.lit(SUBSETS - 1)) == j)
        return F.filter(f"kept{step - 1}_{j}",
                        lambda x: _number(x["bits"]) <= F.col(f"highest{step}"))

    def hashed(name: str) -> Column:
        joined = F.array_join(F.transform(F.col(name), lambda x: x["term"]), " ")
        return F.when(F.size(name) == 0, F.lit(EMPTY)).otherwise(
            F.substring(F.md5(joined.cast("binary")), 1, HEX))

    rows = rows.withColumns({
        "members": F.transform("terms", lambda t: F.struct(
            t.alias("term"), _scrambled(t).alias("bits"))),
        **{f"highest{step}": _highest(F.col("level") + step) for step in range(1, LEVELS)}})
    for step in range(LEVELS):
        rows = rows.withColumns({f"kept{step}_{j}": kept(j, step) for j in range(SUBSETS)})
    blocks = [hashed(f"kept{step}_{j}") for step in range(LEVELS) for j in range(SUBSETS)]
    return rows.withColumn("fingerprint", F.when(F.size("terms") == 0, F.concat(
        F.lit("-00"), "whole")).otherwise(F.concat("kind", F.lpad(
            F.col("level").cast("string"), 2, "0"), *blocks)))


def likeness(one: Column, other: Column) -> Column:
    """0 to 1, of two fingerprints."""
    shift = (F.substring(other, 2, 2).cast("int") - F.substring(one, 2, 2).cast("int")) * SUBSETS

    def block(print_: Column, i: Column) -> Column:
        return F.substring(print_, i * HEX + 4, F.lit(HEX))

    common = F.filter(
        F.sequence(F.greatest(shift, F.lit(0)), F.least(shift, F.lit(0)) + BLOCKS - 1),
        lambda i: (block(one, i) != EMPTY) | (block(other, i - shift) != EMPTY))
    equal = F.filter(common, lambda i: block(one, i) == block(other, i - shift))
    alike = F.substring(one, 1, 1) == F.substring(other, 1, 1)
    return (F.when(one == other, 1.0)
            .when(~alike | (F.abs(shift) >= BLOCKS) | (F.substring(one, 1, 1) == "-"), 0.0)
            .when(F.size(common) == 0, 0.0)
            .otherwise(F.size(equal) / F.size(common)))


def _terms_to_look_up(rows: DataFrame) -> DataFrame:
    """One row per text and term that some subset keeps, and one without term per document."""
    sides = rows.withColumn("side", F.explode(F.when(F.col("ghost"), F.array(F.lit(0))).otherwise(
        F.array(F.lit(0), F.lit(1)))))
    text = sides.withColumn("text", F.when(F.col("side") == 0, F.col("text")).otherwise(
        F.col("edited")))
    # The lambda keeps this projection out of the code that explodes, which would otherwise split the
    # text again for every row that it makes.
    listed = text.withColumns({"terms": F.filter(terms_of(F.col("text")), F.isnotnull),
                               "whole": F.md5(F.col("text").cast("binary"))})
    sized = listed.withColumn("distinct", F.size("terms")).withColumn(
        "highest", _highest(_level(F.col("distinct"))))
    single = sized.select(
        "slice", "position", "ghost", "side", "distinct", "highest", "doc_id", "n_chars",
        "whole", "edited_sha256",
        F.explode_outer(F.concat(F.array(F.lit(None).cast("string")), "terms")).alias("term"))
    return single.filter(F.col("term").isNull() | (
        _number(_scrambled(F.col("term"))) <= F.col("highest"))).drop("highest")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "text_hash", F.xxhash64("text"))
    copies = _copies(own)
    total, size = copies.agg(F.coalesce(F.sum("n"), F.lit(0)),
                             F.coalesce(F.sum(F.col("n") * F.col("bytes")), F.lit(0))).first()
    terms = lexicon(own, copies, total)
    known = terms.withColumn("known", F.lit(True))
    if terms.count() <= BROADCAST_TERMS:
        known = F.broadcast(known)

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = max(1, min(MOST_SLICES, max(3 * partitions, size // SLICE_BYTES)))
    order = Window.partitionBy("slice").orderBy(
        "ghost", F.col("doc_id").asc_nulls_first(), "text_hash")
    placed = _sliced(own, slices).withColumns({
        "next_text": F.lead("text").over(order), "position": F.row_number().over(order)})
    n_chars = F.char_length("text").cast("long")
    moved = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - moved),
                      F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), moved))
    rows = placed.withColumn("n_chars", n_chars).withColumn("edited", edited)
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))

    term = F.col("term")
    looked_up = _terms_to_look_up(rows).withColumn("term_hash", F.when(
        term.isNotNull(), F.xxhash64("term"))).join(known, "term_hash", "left")
    banded = F.col("known").isNotNull()
    wanted = looked_up.filter(term.isNull() | banded | (F.col("distinct") <= FEW))

    def once(name: str) -> Column:
        return F.max(F.when(term.isNull(), F.col(name)))

    carried = ["ghost", "doc_id", "n_chars", "whole", "edited_sha256", "distinct"]
    found = wanted.groupBy("slice", "position", "side").agg(
        *[once(name).alias(name) for name in carried],
        F.collect_list(F.when(banded, term)).alias("inside"),
        F.collect_list(F.when(~banded, term)).alias("outside"))
    inside = F.size("inside") > 0
    printed = _with_fingerprint(found.select(
        "slice", "position", "side", *carried,
        F.when(inside, "b").otherwise("a").alias("kind"), _level(F.col("distinct")).alias("level"),
        F.array_sort(F.when(inside, F.col("inside")).otherwise(F.col("outside"))).alias("terms")))

    def of(side: int, name: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(name)))

    marked = printed.groupBy("slice", "position").agg(
        *[of(0, name).alias(name) for name in
          ("ghost", "doc_id", "n_chars", "edited_sha256", "fingerprint")],
        of(1, "fingerprint").alias("edited_fingerprint"))
    along = Window.partitionBy("slice").orderBy("position")
    return marked.withColumn("next_fingerprint", F.lead("fingerprint").over(along)).filter(
        ~F.col("ghost")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def op11_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def _near_sql(one: str, other: str) -> str:
    shift = f"({SUBSETS} * (substring({other}, 2, 2)::INT - substring({one}, 2, 2)::INT))"
    mine, theirs = (f"substring({one}, i * {HEX} + 4, {HEX})",
                    f"substring({other}, (i - {shift}) * {HEX} + 4, {HEX})")
    return f"""CASE WHEN {one} = {other} THEN 1.0
  WHEN {one}[1] <> {other}[1] OR {one}[1] = '-' THEN 0.0
  ELSE coalesce((SELECT sum(CASE WHEN {mine} = {theirs} THEN 1 ELSE 0 END) / count(*)
                 FROM range({BLOCKS}) AS r(i)
                 WHERE i - {shift} BETWEEN 0 AND {BLOCKS - 1}
                   AND ({mine} <> '{EMPTY}' OR {theirs} <> '{EMPTY}')), 0.0)
  END::DOUBLE"""


OP11_SQL = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
total AS (SELECT count(*) AS total FROM docs),
hot AS (SELECT text, min(doc_id) AS first_id FROM docs, total GROUP BY text, total
        HAVING count(*) * {HOT} > total),
placed AS (
  SELECT doc_id, text, length(text) AS n_chars,
         coalesce(lead(doc_id) OVER ids, first_value(doc_id) OVER ids) AS next_id,
         coalesce(lead(text) OVER ids, first_value(text) OVER ids) AS next_text
  FROM docs WINDOW ids AS (ORDER BY doc_id NULLS FIRST)),
texts AS (
  SELECT doc_id, 0 AS side, text FROM placed
  UNION ALL
  SELECT doc_id, 1, substring(text, 1, n_chars - n_chars // 4)
                    || substring(next_text, 1, n_chars // 4) FROM placed),
termed AS (
  SELECT doc_id, side, text, list_distinct(regexp_extract_all(lower(text), '{TERM}')) AS terms
  FROM texts),
lexicon AS (
  SELECT term FROM (
    SELECT unnest(t.terms) AS term FROM termed t LEFT JOIN hot h ON h.text = t.text
    WHERE t.side = 0 AND (h.first_id IS NULL OR h.first_id = t.doc_id)), total
  GROUP BY term, total
  HAVING count(*) * {RARE} >= total AND (count(*) * {COMMON} <= total OR count(*) = 1)),
leveled AS (
  SELECT doc_id, side, text, len(terms) AS n, terms,
         least(greatest(length(bin(len(terms))) - 6, 0), {17 - LEVELS}) AS level FROM termed),
single AS (SELECT doc_id, side, n, level, unnest(terms) AS term FROM leveled),
mixes AS (
  SELECT term, ({crc32_sql('term')}::BIGINT * {FACTOR}) & 4294967295 AS mix
  FROM (SELECT DISTINCT term FROM single)),
parts AS (
  SELECT s.*, l.term IS NOT NULL AS banded, xor(mix, mix >> 15) & {SUBSETS - 1} AS j,
         xor(mix, mix >> 15) >> 16 AS part
  FROM single s JOIN mixes m ON m.term = s.term LEFT JOIN lexicon l ON l.term = s.term),
kept AS (SELECT * FROM parts WHERE part <= (65535 >> level)),
kinds AS (
  SELECT doc_id, side, bool_or(banded) AS banded FROM kept WHERE banded OR n <= {FEW}
  GROUP BY doc_id, side),
hashes AS (
  SELECT k.doc_id, k.side, step, j,
         substring(md5(string_agg(k.term, ' ' ORDER BY k.term)), 1, {HEX}) AS hash
  FROM kept k JOIN kinds t ON t.doc_id = k.doc_id AND t.side = k.side, range({LEVELS}) AS r(step)
  WHERE k.banded = t.banded AND k.part <= (65535 >> (level + step::INT))
  GROUP BY k.doc_id, k.side, step, j),
grid AS (
  SELECT l.doc_id, l.side, l.level, t.banded, string_agg(coalesce(h.hash, '{EMPTY}'), ''
           ORDER BY a.step, b.j) AS blocks
  FROM leveled l JOIN kinds t ON t.doc_id = l.doc_id AND t.side = l.side,
       range({LEVELS}) AS a(step), range({SUBSETS}) AS b(j)
       LEFT JOIN hashes h ON h.doc_id = l.doc_id AND h.side = l.side AND h.step = a.step AND h.j = b.j
  GROUP BY l.doc_id, l.side, l.level, t.banded),
prints AS (
  SELECT l.doc_id, l.side, sha256(l.text) AS sha,
         CASE WHEN g.doc_id IS NULL THEN '-00' || md5(l.text)
              ELSE (CASE WHEN g.banded THEN 'b' ELSE 'a' END)
                   || lpad(l.level::VARCHAR, 2, '0') || g.blocks END AS print
  FROM leveled l LEFT JOIN grid g ON g.doc_id = l.doc_id AND g.side = l.side),
found AS (
  SELECT p.doc_id, p.n_chars, e.sha AS edited_sha256, o.print AS fingerprint,
         e.print AS edited_fingerprint, x.print AS next_fingerprint
  FROM placed p JOIN prints o ON o.doc_id = p.doc_id AND o.side = 0
  JOIN prints e ON e.doc_id = p.doc_id AND e.side = 1
  JOIN prints x ON x.doc_id = p.next_id AND x.side = 0)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
       {_near_sql('fingerprint', 'edited_fingerprint')} AS near_edited,
       {_near_sql('fingerprint', 'next_fingerprint')} AS near_next
FROM found
"""
