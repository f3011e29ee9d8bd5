"""N-gram Jaccard join by signature trees, and the components of its links.

1. One pass hashes each text's distinct 5-word shingles; documents with equal sets fold into one
   class, whose least doc_id stands for it.
2. How often shingles occur is sketched over all documents (fixed size). Every class lists the
   shingles that, in the order (frequency level, hash), come first: two sets that are similar
   enough share one of these, whatever the order, and with rare ones first a common line or
   passage does not bring everybody together.
3. Listed shingles are dealt into buckets with a 256-bit OR bitmap of their set and its size. In
   each bucket, the sets that list a shingle form a signature tree: nodes hold the OR of their
   members' bitmaps and the range of their sizes, a traversal of pairs of nodes drops a pair when
   even the greatest possible overlap is too small. What is left are candidates.
4. Candidates that pass the same bound on signatures as long as their sets are verified on the
   whole sets. Where many sets list a shingle this goes in rounds: first they are only compared
   with one centre and one neighbour, then those not connected by that with a few members of the
   largest group, so that a group of thousands of near copies costs a few stars instead of all its
   pairs; what was linked is contracted after each round, and the last round compares all that is
   not yet connected and leaves nothing out.

A document with no more than four words has its whole sequence as its only shingle; one without
words, or with a null text, has no set and is linked with nothing. Rows that repeat an id get a row
each and have the links of all texts with that id. Rows without id belong to the class of their
set; if no row of that class has an id, their component is null. No documents give no rows. Extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.common import table, written
from tillstream.llm.components import components
from tillstream.llm.sketch import levels_of, slot, slot_counts, usual_count
from tillstream.llm.words import ODD, hashed, mixed, runs, words_of

SHINGLE, PERCENT = 5, 75
BUCKET_ROWS = 1 << 19
# A shingle listed by more sets than this is split over several tasks.
HOT_ROWS = 1 << 16
SLOTS = 1 << 20
LEAF, FAN, PAIRS_AT_ONCE = 16, 8, 1 << 16
# Blocks up to this size compare all pairs at once. In larger ones, one shingle in so many also
# compares neighbours in the first round, and strays try so many members in the second.
SMALL, NEIGHBOURS, PARTNERS = 8, 8, 3
BITMAP_WORDS, WIDE_WORDS = 4, 16


def shingles(text: pa.Scalar, n: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct n-word shingles of a text."""
    words = hashed(words_of(text, lower=True))
    return np.unique(runs(words, min(n, len(words)) or 1))


def least_overlap(a, b, percent: int = PERCENT):
    """Sets of sizes a and b are similar when they share this many: 100 i >= p (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


# --- one row per document --------------------------------------------------------------------

def _bitmap(hashes: np.ndarray, bits: int) -> np.ndarray:
    """OR of one bit per shingle; `bits` is a power of two."""
    found = np.zeros(bits, bool)
    found[(hashes & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(found).view(np.uint64)


def _signature_bits(n: int) -> int:
    """Four to eight bits per shingle, so that few fall together, and no less than a bucket's."""
    return max(WIDE_WORDS * 64, 1 << (4 * n - 1).bit_length())


LISTED = ("doc_id long, n long, digest binary, bitmap binary, listed binary, signature binary")


def _listed(docs: DataFrame, levels, percent: int) -> DataFrame:
    """Size, digest, bitmaps and listed shingles of each document's set; nulls for an empty one."""
    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for text in batch.column(1):
                found = shingles(text)
                n = len(found)
                row: tuple = (n, None, None, None, None)
                if n:
                    # A similar set is no smaller than n * p / 100 and shares all but these many.
                    take = n + percent * n // -100 + 1
                    order = np.lexsort((mixed(found), levels.value[slot(found)]))[:take]
                    row = (n, hashlib.blake2b(found.tobytes(), digest_size=16).digest(),
                           _bitmap(found, BITMAP_WORDS * 64).tobytes(), found[order].tobytes(),
                           _bitmap(found, _signature_bits(n)).tobytes())
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out[0], pa.int64()),
                 *(pa.array(c, pa.binary()) for c in out[1:])],
                names=["doc_id", "n", "digest", "bitmap", "listed", "signature"])

    return docs.mapInArrow(listing, LISTED)


# --- listed shingles, dealt into buckets -----------------------------------------------------

PACKED = "bucket int, tokens binary, owners binary, sizes binary, maps binary"


def _dealt(listed: DataFrame, parts, buckets: int) -> DataFrame:
    """One row per batch and bucket, with the batch's listed shingles that fall into it.

    The sets that list a hot shingle go to as many places as `parts` has for it.
    """
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = [np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column("listed")]
            lengths = [len(v) for v in lists]
            tokens = np.concatenate(lists)
            row = np.repeat(np.arange(len(lists)), lengths)
            owners = batch.column("doc_id").to_numpy()
            part = mixed(owners.view(np.uint64))[row] % parts.value[slot(tokens)].astype(np.uint64)
            bucket = (mixed(tokens + part * ODD) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            tokens, row, bucket = tokens[order], row[order], bucket[order]
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
            sizes = batch.column("n").to_numpy()
            maps = np.frombuffer(b"".join(batch.column("bitmap").to_pylist()), np.uint64).reshape(
                -1, BITMAP_WORDS)
            out: list[list] = [[] for _ in range(5)]
            for a, b in zip(edges, edges[1:], strict=False):
                own, at = np.unique(row[a:b], return_inverse=True)
                packed = np.empty(b - a, [("token", "<u8"), ("at", "<u4")])
                packed["token"], packed["at"] = tokens[a:b], at
                for column, value in zip(out, (
                        int(bucket[a]), packed.tobytes(), owners[own].tobytes(),
                        sizes[own].astype(np.int32).tobytes(), maps[own].tobytes()), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int32()), *(pa.array(c, pa.binary()) for c in out[1:])],
                names=["bucket", "tokens", "owners", "sizes", "maps"])

    return listed.mapInArrow(deal, PACKED)


# --- signature trees -------------------------------------------------------------------------

def _bits(maps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(maps).sum(axis=1, dtype=np.int64)


class SignatureTree:
    """Sets that list one shingle, as nodes with OR bitmaps, size ranges and contracted groups."""

    def __init__(self, maps: np.ndarray, sizes: np.ndarray, groups: np.ndarray,
                 spare: np.ndarray, repeats: np.ndarray, percent: int = PERCENT):
        # Alike sets should share a leaf: same group first, then size, then bits.
        self.order = np.lexsort((maps[:, 0], sizes, groups))
        self.percent = percent
        maps, sizes, groups, spare, repeats = (
            x[self.order] for x in (maps, sizes, groups, spare, repeats))
        self.levels = [(maps, sizes, sizes, spare, groups, groups, repeats)]
        self.fans = []
        fan = LEAF
        while len(self.levels[-1][0]) > 1:
            low = self.levels[-1]
            starts = np.arange(0, len(low[0]), fan)
            self.levels.append((
                np.bitwise_or.reduceat(low[0], starts), np.minimum.reduceat(low[1], starts),
                np.maximum.reduceat(low[2], starts), np.maximum.reduceat(low[3], starts),
                np.minimum.reduceat(low[4], starts), np.maximum.reduceat(low[5], starts),
                np.minimum.reduceat(low[6], starts)))
            self.fans.append(fan)
            fan = FAN

    def _possible(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether members of two nodes may overlap enough and are not all connected already."""
        maps, least, most, spare, first, last, repeats = self.levels[level]
        shared = _bits(maps[i] & maps[j]) // np.minimum(repeats[i], repeats[j])
        shared += np.minimum(spare[i], spare[j])
        shared = np.minimum(shared, np.minimum(most[i], most[j]))
        fits = shared >= least_overlap(least[i], least[j], self.percent)
        # The larger of two sizes counts against what the smaller set can share.
        larger = np.maximum(least[i], least[j])
        fits &= 100 * np.minimum(most[i], most[j]) >= self.percent * larger
        one_group = (first[i] == last[i]) & (first[j] == last[j]) & (first[i] == first[j])
        return fits & ~one_group

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row pairs (i, j) that no node pair above them rules out, in bounded portions."""
        top = len(self.levels) - 1
        todo = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while todo:
            level, i, j = todo.pop()
            if len(i) > PAIRS_AT_ONCE:
                half = len(i) // 2
                todo += [(level, i[:half], j[:half]), (level, i[half:], j[half:])]
                continue
            fits = self._possible(level, i, j)
            i, j = i[fits], j[fits]
            if not level:
                if len(i):
                    yield self.order[i], self.order[j]
                continue
            fan, count = self.fans[level - 1], len(self.levels[level - 1][0])
            step = np.arange(fan)
            a = np.repeat((i[:, None] * fan + step), fan, axis=1).ravel()
            b = np.tile((j[:, None] * fan + step), (1, fan)).ravel()
            inside = (a < count) & (b < count) & ((a < b) if not level - 1 else (a <= b))
            todo.append((level - 1, a[inside], b[inside]))


@dataclass
class Rows:
    """Sets listed in a bucket, one per position."""

    owners: np.ndarray
    sizes: np.ndarray
    maps: np.ndarray
    groups: np.ndarray
    # How many shingles share a bit with another one of their set, and how often a bitmap
    # repeats itself.
    spare: np.ndarray
    repeats: np.ndarray
    percent: int

    def possible(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of positions that are not connected yet and may overlap enough."""
        open_ = (self.groups[i] != self.groups[j]) & (self.owners[i] != self.owners[j])
        i, j = i[open_], j[open_]
        n, m = self.sizes[i], self.sizes[j]
        shared = _bits(self.maps[i] & self.maps[j]) // np.minimum(self.repeats[i], self.repeats[j])
        shared += np.minimum(self.spare[i], self.spare[j])
        shared = np.minimum(shared, np.minimum(n, m))
        fits = shared >= least_overlap(n, m, self.percent)
        return i[fits], j[fits]


def _all_pairs(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of several blocks of one small size."""
    a, b = np.triu_indices(size, 1)
    return (starts[:, None] + a).ravel(), (starts[:, None] + b).ravel()


def _near(rows: Rows, own: np.ndarray, token: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row with the centre and, for some shingles, with a neighbour in an order of theirs."""
    owners = rows.owners[own]
    i, j = np.full(len(own), own[owners.argmin()]), own
    if token % NEIGHBOURS == 0:
        dealt = own[np.argsort(mixed(owners.view(np.uint64) ^ np.uint64(token)))]
        i, j = np.concatenate([i, dealt[:-1]]), np.concatenate([j, dealt[1:]])
    return rows.possible(i, j)


def _strays(rows: Rows, own: np.ndarray, token: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows outside the largest group with some of its members, which differ by shingle."""
    groups = rows.groups[own]
    values, counts = np.unique(groups, return_counts=True)
    largest = groups == values[counts.argmax()]
    members, strays = own[largest], own[~largest]
    draws = mixed(rows.owners[strays].view(np.uint64) ^ np.uint64(token))
    order = strays[np.argsort(draws)]
    i, j = [order[:-1]], [order[1:]]
    for _ in range(PARTNERS):
        i.append(strays)
        j.append(members[(draws % np.uint64(len(members))).astype(np.int64)])
        draws = mixed(draws)
    return rows.possible(np.concatenate(i), np.concatenate(j))


def _tree(rows: Rows, own: np.ndarray, _: int) -> tuple[np.ndarray, np.ndarray]:
    """All rows with each other, as far as the signature tree does not rule it out."""
    tree = SignatureTree(rows.maps[own], rows.sizes[own], rows.groups[own], rows.spare[own],
                         rows.repeats[own], rows.percent)
    found = [rows.possible(own[i], own[j]) for i, j in tree.pairs()]
    if not found:
        return own[:0], own[:0]
    i, j = (np.concatenate(side) for side in zip(*found, strict=True))
    return i, j


def _blocks(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by shingle, and where in it blocks of equal shingles start and how long they are."""
    order = np.argsort(tokens, kind="stable")
    tokens = tokens[order]
    starts = np.flatnonzero(np.diff(tokens, prepend=~tokens[:1]))
    return order, starts, np.diff(starts, append=len(tokens))


def _pairs_of(rows: Rows, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Distinct pairs of owners, the smaller one first."""
    left, right = (rows.owners[np.concatenate(side)] if found else rows.owners[:0]
                   for side in (zip(*found, strict=True) if found else ((), ())))
    return np.unique(np.sort(np.stack([left, right]), axis=0), axis=1)


FIRST = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("token", pa.int64())])


def _first_round(dealt: DataFrame, parts, percent: int) -> DataFrame:
    """Pairs (a, b) that share a listed shingle and may be similar, and the large blocks.

    Small blocks compare all pairs. Of large ones, and of what is here of split ones, each row is
    compared with few others, and the block itself comes out as rows (token, a) without b.
    """
    def search(bucket: pa.Table) -> pa.Table:
        tokens, at, owners, sizes, maps, base = [], [], [], [], [], 0
        for packed, own, n, bits in zip(*(bucket.column(c) for c in (
                "tokens", "owners", "sizes", "maps")), strict=True):
            listed = np.frombuffer(packed.as_buffer(), [("token", "<u8"), ("at", "<u4")])
            tokens.append(listed["token"])
            at.append(listed["at"].astype(np.int64) + base)
            owners.append(np.frombuffer(own.as_buffer(), np.int64))
            sizes.append(np.frombuffer(n.as_buffer(), np.int32).astype(np.int64))
            maps.append(np.frombuffer(bits.as_buffer(), np.uint64).reshape(-1, BITMAP_WORDS))
            base += len(owners[-1])
        owner, size, bits = map(np.concatenate, (owners, sizes, maps))
        rows = Rows(owner, size, bits, owner, size - _bits(bits), np.ones_like(size), percent)
        token, at = np.concatenate(tokens), np.concatenate(at)
        order, starts, counts = _blocks(token)
        token, at = token[order], at[order]
        found = []
        is_large = (counts > SMALL) | (parts.value[slot(token[starts])] > 1)
        for count in range(2, SMALL + 1):
            i, j = _all_pairs(starts[(counts == count) & ~is_large], count)
            found.append(rows.possible(at[i], at[j]))
        large = [slice(s, s + n) for s, n in zip(
            starts[is_large].tolist(), counts[is_large].tolist(), strict=True)]
        found += [_near(rows, at[block], int(token[block.start])) for block in large]
        pairs = _pairs_of(rows, found)
        whole = np.concatenate([np.arange(b.start, b.stop) for b in large] or [starts[:0]])
        nothing = pa.nulls(pairs.shape[1], pa.int64()), pa.nulls(len(whole), pa.int64())
        return pa.concat_tables([
            pa.table([pairs[0], pairs[1], nothing[0]], schema=FIRST),
            pa.table([owner[at[whole]], nothing[1], token[whole].view(np.int64)], schema=FIRST)])

    return dealt.groupBy("bucket").applyInArrow(search, "a long, b long, token long")


def _wide_maps(signatures: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures as bitmaps of one width, how many bits each had set, and how often it repeats.

    Longer ones are folded, shorter ones repeated. What two repeated ones share, they share as
    often as the longer of them repeats.
    """
    maps = np.zeros((len(signatures), WIDE_WORDS), np.uint64)
    bits, repeats = np.zeros(len(signatures), np.int64), np.ones(len(signatures), np.int64)
    lengths = pc.binary_length(signatures).to_numpy() // 8
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        own = np.frombuffer(b"".join(signatures.take(pa.array(at)).to_pylist()), np.uint64).reshape(
            len(at), length)
        if length > WIDE_WORDS:
            own = np.bitwise_or.reduce(own.reshape(len(at), -1, WIDE_WORDS), axis=1)
        bits[at] = _bits(own)
        repeats[at] = max(1, WIDE_WORDS // length)
        maps[at] = np.tile(own, max(1, WIDE_WORDS // length))
    return maps, bits, repeats


def _folded(marks: DataFrame) -> DataFrame:
    """`marks` with signatures of at most `WIDE_WORDS` words, which is all a bucket looks at."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for signature in batch.column("signature"):
                own = np.frombuffer(signature.as_buffer(), np.uint64)
                if len(own) > WIDE_WORDS:
                    own = np.bitwise_or.reduce(own.reshape(-1, WIDE_WORDS))
                out.append(own.tobytes())
            place = batch.schema.get_field_index("signature")
            yield batch.set_column(place, "signature", pa.array(out, pa.binary()))

    return marks.mapInArrow(fold, marks.schema)


def _later_round(blocks: DataFrame, marks: DataFrame, compare: Callable,
                 percent: int) -> DataFrame | None:
    """Pairs (a, b) of large blocks (token, owner) that are not connected yet and may be similar.

    `marks` has doc_id, n, signature and component. Blocks within one component are left out; None
    if all are.
    """
    placed = blocks.join(marks.select(F.col("doc_id").alias("owner"), "component"), "owner")
    mixed_blocks = placed.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.ceil(F.count(F.lit(1)) / HOT_ROWS).alias("parts")).filter("low < high").select(
        "token", "parts")
    # Every two parts of a block meet in one piece.
    part = F.pmod(F.xxhash64("owner"), F.col("parts"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    pieces = placed.join(mixed_blocks, "token").select(
        "token", "owner", "component", part.alias("part"), other.alias("other")).select(
        F.xxhash64("token", F.least("part", "other"), F.greatest("part", "other")).alias("token"),
        "owner", "component")
    # Folded first, a row is bounded in bytes, so a bucket bounded in rows is as well.
    rows = written(pieces.join(_folded(marks.select(
        F.col("doc_id").alias("owner"), "n", "signature")), "owner"), "open-blocks")
    open_rows = rows.count()
    if not open_rows:
        return None
    buckets = max(64, open_rows // BUCKET_ROWS)

    def search(bucket: pa.Table) -> pa.Table:
        columns = {c: bucket.column(c).combine_chunks() for c in bucket.column_names}
        token, owner, size, group = (columns[c].to_numpy() for c in (
            "token", "owner", "n", "component"))
        maps, bits, repeats = _wide_maps(columns["signature"])
        rows = Rows(owner, size, maps, group, size - bits, repeats, percent)
        order, starts, counts = _blocks(token)
        found = []
        for start, count in zip(starts.tolist(), counts.tolist(), strict=True):
            own = order[start:start + count]
            found.append(compare(rows, own, int(token[own[0]]) & ((1 << 64) - 1)))
        a, b = _pairs_of(rows, found)
        starts = np.flatnonzero(np.diff(a, prepend=~a[:1]))
        ends = np.append(starts[1:], len(b))[:len(starts)]
        return pa.table([
            a[starts], pa.array([b[i:j].tobytes() for i, j in zip(starts, ends, strict=True)],
                                pa.binary())], names=["a", "partners"])

    def merge(part: pa.Table) -> pa.Table:
        partners = [np.frombuffer(v.as_buffer(), np.int64) for v in part.column("partners")]
        a = np.repeat(part.column("a").to_numpy(), [len(v) for v in partners])
        pairs = np.unique(np.stack([a, np.concatenate(partners)]), axis=1)
        return pa.table([pairs[0], pairs[1]], names=["a", "b"])

    # Sets that are alike share many shingles; their pairs are folded before they become rows.
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(buckets)))
    found = dealt.groupBy("bucket").applyInArrow(search, "a long, partners binary")
    return found.groupBy(F.pmod(F.xxhash64("a"), F.lit(buckets)).alias("part")).applyInArrow(
        merge, "a long, b long")


# --- verification ----------------------------------------------------------------------------

def _plausible(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The pairs that could still be similar going by signatures as long as their sets.

    These are a tenth of a whole set or 128 bytes, so few whole sets travel in vain.
    """
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = []
            for n, m, x, y in zip(batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist(),
                                  batch.column("s_a"), batch.column("s_b"), strict=True):
                own, other = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                # A longer signature folds down to the shorter one's length.
                width = min(len(own), len(other))
                own, other = (np.bitwise_or.reduce(v.reshape(-1, width)) for v in (own, other))
                spare = min(n - int(np.bitwise_count(own).sum()),
                            m - int(np.bitwise_count(other).sum()))
                shared = int(np.bitwise_count(own & other).sum()) + spare
                fits.append(min(shared, n, m) >= least_overlap(n, m, percent))
            yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    joined = pairs
    for side in ("a", "b"):
        joined = joined.join(marks.select(
            F.col("doc_id").alias(side), F.col("n").alias(f"n_{side}"),
            F.col("signature").alias(f"s_{side}")), side)
    return joined.mapInArrow(check, "a long, b long").distinct()


def _whole_sets(docs: DataFrame) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(text).view(np.int64) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "set"])

    return docs.mapInArrow(build, "id long, set array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    wanted = pairs.select(F.col("a").alias("doc_id")).union(
        pairs.select(F.col("b").alias("doc_id"))).distinct()
    # A broadcast of at most `SLOTS` numbers keeps most texts out of the shuffle before the join.
    slot_of = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).cast("int")
    slots = wanted.select(slot_of.alias("slot")).distinct()
    near = texts.withColumn("slot", slot_of).join(
        F.broadcast(slots), "slot", "left_semi").drop("slot")
    sets = written(_whole_sets(near.join(wanted, "doc_id", "left_semi")), "candidate-sets")
    joined = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
    joined = joined.join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    return joined.filter(shared * 100 >= union * percent).select("a", "b")


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links) of every row."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counts = slot_counts(docs.select("text"), shingles)
    share = docs.sparkSession.sparkContext.broadcast
    levels = share(levels_of(counts, by_excess=True))
    parts = share(np.maximum(1, (counts - usual_count(counts)) // HOT_ROWS).astype(np.int32))
    sets = written(_listed(docs, levels, percent), "listed")
    classes = written(sets.filter("digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.min("n").alias("n")), "shingle-classes")
    ids = classes.filter("id is not null").select(F.col("id").alias("doc_id"))
    # There are about as many classes as documents; the join takes the same way at every size.
    listed = sets.filter("digest is not null").drop("digest").join(
        ids.hint("merge"), "doc_id", "left_semi")
    total = classes.agg(F.sum(F.col("n") * (100 - percent) / 100 + 1)).first()[0] or 0
    buckets = max(64, int(total) // BUCKET_ROWS)

    first = written(_first_round(
        _dealt(listed.drop("signature"), parts, buckets), parts, percent), "first-round")
    blocks = first.filter("token is not null").select("token", F.col("a").alias("owner"))
    pairs, known = first.filter("token is null").select("a", "b"), None
    marks = written(listed.select("doc_id", "n", "signature"), "marks")
    for compare in (_strays, _tree, None):
        pairs = written(_plausible(pairs.distinct(), marks, percent), "plausible")
        edges = _verified(pairs, docs, percent)
        # What was linked before is there as one edge per vertex, not as all its links.
        known = written(components(edges if known is None else edges.union(known)), "components")
        if compare:
            placed = marks.join(known, marks["doc_id"] == known["vertex"], "left").withColumn(
                "component", F.coalesce("component", "doc_id")).drop("vertex")
            found = _later_round(blocks, placed, compare, percent)
            if found is None:
                break
            pairs = written(found, "candidates")

    named = classes.join(known, classes["id"] == known["vertex"], "left").select(
        "digest", F.coalesce("component", "id").alias("component"))
    return sets.select("doc_id", "n", "digest").join(named, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             null_ids: bool = False) -> DataFrame:
    """The rows of `docs` whose id is their component's least one.

    Rows without id are left out, or with `null_ids` stand under a 64-bit hash of their text and
    are linked like any other; one of them stays where nothing with an id is in its component.
    """
    if not null_ids:
        stay = linked(docs, id_col, text_col).filter("doc_id = component_id").select(
            F.col("doc_id").alias("__id")).distinct()
        return docs.join(stay, docs[id_col] == stay["__id"], "left_semi")
    doc_id = F.col(id_col).cast("long")
    keyed = docs.withColumn("__id", F.coalesce(doc_id, F.xxhash64(
        F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))))
    found = linked(keyed, "__id", text_col)
    hashes = keyed.filter(doc_id.isNull()).select(
        F.col("__id").alias("doc_id"), F.lit(True).alias("hash")).distinct()
    first = F.min(F.struct(F.coalesce("hash", F.lit(False)).alias("hash"), "doc_id"))
    stay = found.join(hashes, "doc_id", "left").groupBy("component_id").agg(
        first["doc_id"].alias("__id"))
    return keyed.join(stay, "__id", "left_semi").select(*docs.columns)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents"))
