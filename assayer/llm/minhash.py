"""Near-duplicate documents by DartMinHash signatures and a banded join.

A document is the set of its five-word shingles (or, weighted, the multiset: the second
occurrence is an element of its own).  Darts are thrown by hash at the region of each
element, element by rank: cells of the rank axis get a Poisson number of darts, each with a
rank and one of ``k`` coordinates.  Only darts below a rank that leaves about k ln k + 2k of
them are made, so a signature costs little more than reading the shingles.  The earliest
dart of each coordinate is kept; two documents agree in a coordinate with the probability of
their Jaccard similarity.

Exact copies are first reduced to one document.  Bands of the signature are keys; in every
bucket of a key the members are tied to one leader (a combine and a join), and again in the
finer buckets of two bands together.  The ties are verified by exact similarity, and
components of verified ties are the classes so far.  Members of buckets that still hold
several classes then meet where they share one of their rarest shingles, as many as a pair
of similar sets cannot avoid sharing (a prefix filter, with filters of size and place), and
pairs of different classes are verified.  Near copies thus cost few pairs, and unlike texts
with a common passage meet only where their own words are too few to tell them apart.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import stored
from assayer.llm.components import components
from assayer.llm.crf import SPACE, in_parts

SHINGLE, SIMILAR, BANDS, ROWS = 5, 0.8, 20, 5
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U(30))
        x = x * U(0xBF58476D1CE4E5B9)
        x = x ^ (x >> U(27))
        x = x * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
LETTER = mix(np.arange(256, dtype=np.uint64) + U(0x1234567))


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[U(1)], np.cumprod(np.full(max(n - 1, 0), U(base)))])[:n]


def word_hashes(raw: bytes) -> np.ndarray:
    """A hash of each word: a polynomial over its bytes, from running sums of the text."""
    b = np.frombuffer(raw, np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64)
    space = SPACE[b]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    first, last = edge[::2], edge[1::2]
    with np.errstate(over="ignore"):
        sums = np.concatenate([[U(0)], np.cumsum(LETTER[b] * _powers(BASE, len(b)))])
        return mix((sums[last] - sums[first]) * _powers(INVERSE, len(b))[first] + (last - first).astype(np.uint64))


def shingles(words: np.ndarray, weighted: bool = False) -> np.ndarray:
    """Distinct hashes of runs of SHINGLE words; a shorter text is one run."""
    if not len(words):
        return words
    n = max(1, len(words) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(SHINGLE, len(words))):
            out = mix(out * U(3) + words[k : k + n])
        if not weighted:
            return np.unique(out)
        out.sort()
        start = np.flatnonzero(np.concatenate([[True], out[1:] != out[:-1]]))
        turn = np.arange(n) - np.repeat(start, np.diff(np.append(start, n)))
        return np.unique(mix(out + turn.astype(np.uint64) * U(BASE)))


#: Rank cells: [0, 2^-12), then doubling up to 1, then of width 1.
SMALL = 12
POISSON_TERMS = 10


def _cells(most: float) -> tuple[np.ndarray, np.ndarray]:
    low = [0.0, *(2.0**-j for j in range(SMALL, 0, -1))]
    low += [float(j) for j in range(1, int(np.ceil(most)))]
    low = np.array([x for x in low if x < most])
    high = np.where(low < 1, np.maximum(low * 2, 2.0**-SMALL), low + 1)
    return low, high - low


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> U(11)).astype(np.float64) * 2.0**-53


def signature(elements: np.ndarray, k: int = BANDS * ROWS) -> np.ndarray:
    """The earliest dart (a 64-bit name) of each of ``k`` coordinates."""
    most = (k * np.log(k) + 2 * k) / len(elements)
    with np.errstate(over="ignore"):
        while True:
            low, width = _cells(most)
            seeds = mix(np.arange(1, len(low) + 1, dtype=np.uint64) * U(BASE))
            cell = mix(elements[None, :] ^ seeds[:, None])
            drawn, term, below = np.zeros(cell.shape, np.int64), np.exp(-width)[:, None], np.exp(-width)[:, None]
            u = _unit(cell)
            for j in range(1, POISSON_TERMS + 1):
                more = u >= below
                if not more.any():
                    break
                drawn += more
                term = term * width[:, None] / j
                below = below + term
            hit = np.flatnonzero(drawn.ravel())
            times = drawn.ravel()[hit]
            source = np.repeat(hit, times)
            turn = np.arange(len(source)) - np.repeat(np.cumsum(times) - times, times)
            dart = mix(cell.ravel()[source] + (turn.astype(np.uint64) + U(1)) * U(INVERSE))
            row = source // len(elements)
            rank = low[row] + width[row] * _unit(mix(dart + U(1)))
            inside = rank < most
            dart, rank = dart[inside], rank[inside]
            at = (mix(dart + U(2)) % U(k)).astype(np.int64)
            order = np.lexsort((dart, rank))
            names, where = np.unique(at[order], return_index=True)
            if len(names) == k:
                return dart[order][where]
            most *= 2


def bands(sign: np.ndarray, rows: int = ROWS) -> np.ndarray:
    out = np.zeros(len(sign) // rows, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(rows):
            out = mix(out * U(3) + sign.reshape(-1, rows)[:, k])
        return (out ^ mix(np.arange(len(out), dtype=np.uint64) + U(77))).view(np.int64)


def _sets(texts: Sequence[str | None], weighted: bool) -> Iterator[np.ndarray]:
    for text in texts:
        yield shingles(word_hashes((text or "").encode("utf-8", "replace")), weighted)


def _short(elements: np.ndarray) -> np.ndarray:
    """The set as it is compared: distinct 32-bit hashes."""
    return np.unique((elements >> U(32)).astype(np.uint32)).view(np.int32)


def signed(docs: DataFrame, *, weighted: bool = False, n_bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """id, key (md5 of the text), size (of the set that is compared) and bands; bands are null
    for texts without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, sizes = [], []
            for s in _sets(batch.column(2).to_pylist(), weighted):
                out.append(bands(signature(s, n_bands * rows), rows) if len(s) else None)
                sizes.append(len(_short(s)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(out, pa.list_(pa.int64()))],
                names=["id", "key", "size", "bands"],
            )

    return docs.select("id", F.unhex(F.md5("text")).alias("key"), "text").mapInArrow(
        run, "id long, key binary, size int, bands array<long>"
    )


BITS = 1 << 23


def bitmap(ids: DataFrame) -> np.ndarray:
    """A bitmap of the hashed ids, of fixed size (BITS / 8 bytes) whatever their number: the
    bits are joined by word before at most BITS / 64 words reach the driver."""
    bit = F.pmod(F.xxhash64("id"), F.lit(BITS))
    words = ids.select(F.floor(bit / 64).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(id), {BITS}) % 64 as int))").alias("v"))
    out = np.zeros(BITS // 64, np.int64)
    for row in words.groupBy("w").agg(F.bit_or("v").alias("v")).toLocalIterator():
        out[row.w] = row.v
    return out.view(np.uint64)


def shingled(docs: DataFrame, ids: DataFrame, *, weighted: bool = False) -> DataFrame:
    """id and set (32-bit hashes of the shingles) of the documents in ``ids``.  A bitmap of
    the ids keeps other texts from being shuffled; where it fills up, the semi join after it
    does the work alone."""
    wanted = bitmap(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy().astype(np.uint64)
            batch = batch.filter(pa.array((wanted[(at >> U(6)).astype(np.int64)] >> (at & U(63))) & U(1) > 0))
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for begin, end in in_parts(texts):
                sets = [_short(s) for s in _sets(texts[begin:end], weighted)]
                yield pa.RecordBatch.from_arrays([ids.slice(begin, end - begin), pa.array(sets, pa.list_(pa.int32()))], names=["id", "set"])

    place = F.pmod(F.xxhash64("id"), F.lit(BITS)).alias("place")
    sets = docs.select("id", "text", place).mapInArrow(run, "id long, set array<int>")
    return sets.join(ids, "id", "left_semi").dropDuplicates(["id"])


def ties(keyed: DataFrame) -> DataFrame:
    """Pairs (a, b) of a bucket's members and its leader.  ``keyed`` has id and bands."""
    two = "transform(bands, (v, i) -> xxhash64(v, bands[(i + 1) % size(bands)], i))"
    rows = keyed.where("bands is not null").select(
        "id", F.posexplode(F.concat("bands", F.expr(two))).alias("place", "bucket")
    ).select("id", (F.col("place") % 2).alias("turn"), F.xxhash64("place", "bucket").alias("bucket"))
    order = F.struct(F.xxhash64("id", "turn").alias("o"), F.col("id").alias("id"))
    leaders = rows.groupBy("bucket").agg(F.min(order).alias("m"), F.count("*").alias("n")).where("n > 1")
    return rows.join(leaders.select("bucket", F.col("m.id").alias("leader")), "bucket").where("id <> leader").select(
        F.greatest("id", "leader").alias("a"), F.least("id", "leader").alias("b")
    ).distinct()


def _fits(one: Column, other: Column, similar: float) -> Column:
    return F.least(one, other) >= similar * F.greatest(one, other) - 1e-9


def verified(pairs: DataFrame, sets: DataFrame, *, similar: float = SIMILAR) -> DataFrame:
    """The pairs whose sets (id, set) have a Jaccard similarity of ``similar`` or more."""
    one = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
    both = one.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    fits = _fits(F.size("sa"), F.size("sb"), similar)
    shared = F.when(fits, F.size(F.array_intersect("sa", "sb"))).otherwise(0)
    union = F.size("sa") + F.size("sb") - F.col("shared")
    return both.withColumn("shared", shared).where((F.col("shared") > 0) & (F.col("shared") >= F.lit(similar) * union - 1e-9)).select("a", "b")


#: Members that share a shingle in one task of the join of prefixes.
MEMBERS = 1024


def prefixes(sets: DataFrame, *, similar: float = SIMILAR) -> DataFrame:
    """id, size, token, n and place: the shingles of each set (id, set) that can be the
    rarest one it shares with a set as similar as ``similar``.

    Shingles are ordered by the number ``n`` of sets that hold them, then by hash; ``place``
    counts from 0 over the whole set.  A set of which at least similar * size shingles are
    shared has its first shared one at a place of at most size - similar * size.  Shingles
    of one set only come first in the order; they count as places and are left out.
    """
    each = sets.select("id", F.size("set").alias("size"), F.explode("set").alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    held = each.join(often, "token").groupBy("id", "size").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("held"))
    alone = F.col("size") - F.size("held")
    count = F.floor(F.col("size") - F.lit(similar) * F.col("size") + 1e-9).cast("int") + 1 - alone
    first = F.slice("held", F.lit(1), F.greatest(count, F.lit(0)))
    return held.select("id", "size", alone.alias("alone"), F.posexplode(first).alias("k", "t")).select(
        "id", "size", F.col("t.token").alias("token"), F.col("t.n").alias("n"), (F.col("alone") + F.col("k")).alias("place")
    )


def meetings(rows: DataFrame, others: DataFrame, *, similar: float = SIMILAR) -> DataFrame:
    """Pairs (a, b) of ``rows`` with ``others`` (prefixes with root) of another root that
    share a shingle which leaves both enough places to be as similar as ``similar``.

    A shingle of many sets is dealt out by its number of holders: ``others`` in parts of
    about MEMBERS, ``rows`` to each part."""
    parts = F.ceil(F.col("n") / MEMBERS).cast("int")
    dealt = others.withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
    sent = rows.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    sent = sent.select("token", "part", *[F.col(c).alias(f"l_{c}") for c in ("id", "size", "root", "place")])
    least = F.lit(similar / (1 + similar)) * (F.col("size") + F.col("l_size")) - 1e-6
    left = F.least(F.col("size") - F.col("place"), F.col("l_size") - F.col("l_place"))
    met = sent.join(dealt, ["token", "part"]).where(
        (F.col("root") != F.col("l_root")) & _fits(F.col("size"), F.col("l_size"), similar) & (left >= least)
    )
    return met.select(F.greatest("id", "l_id").alias("a"), F.least("id", "l_id").alias("b")).distinct()


def completed(keyed: DataFrame, sets: DataFrame, tried: DataFrame, roots: DataFrame, *, similar: float = SIMILAR) -> DataFrame:
    """``roots`` (id, root) joined by all pairs that share a band and are alike.

    ``keyed`` has id, size and bands of the documents in ``sets``; ``tried`` are the pairs
    that need no second look.  The members of buckets that hold several classes meet where
    they share a shingle of their ``prefixes``, which no pair as similar as ``similar``
    fails to do.  First every member meets one of each other class, then all members of the
    classes that are left but a shingle's largest meet those of all others.
    """
    rows = keyed.select("id", F.posexplode("bands").alias("place", "bucket")).select("id", F.xxhash64("place", "bucket").alias("bucket"))
    here = rows.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    # the leader has settled a bucket of two
    several = here.groupBy("bucket").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    several = several.where("n > 2 and lo <> hi").select("bucket")
    ids = stored(here.join(several, "bucket").select("id").distinct())
    if ids.isEmpty():
        return roots
    first = stored(prefixes(sets.join(ids, "id", "left_semi"), similar=similar))
    for last in (False, True):
        classed = first.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
        each = classed.groupBy("token", "root").agg(F.count("*").alias("c"), F.min(F.struct(F.xxhash64("id").alias("o"), "id")).alias("m"))
        main = each.groupBy("token").agg(F.max(F.struct("c", "root")).alias("top"), F.count("*").alias("classes")).where("classes > 1")
        classed = stored(classed.join(main.select("token", F.col("top.root").alias("main")), "token"))
        if last:
            new = meetings(classed.where("root <> main"), classed, similar=similar)
        else:
            chosen = each.select("token", F.col("m.id").alias("id"))
            new = meetings(classed.join(chosen, ["token", "id"], "left_semi"), classed.where("root <> main"), similar=similar)
        new = stored(new.join(tried, ["a", "b"], "left_anti"))
        near = stored(verified(new, sets, similar=similar))
        if not near.isEmpty():
            roots = stored(components(near.unionByName(roots.select(F.col("id").alias("a"), F.col("root").alias("b")))))
        tried = tried.unionByName(new)
    return roots


def id_of() -> Column:
    """doc_id; null is stood in for by a hash of the text."""
    stand_in = F.xxhash64("text").bitwiseOR(F.lit(1 << 62)).bitwiseAND(F.lit((1 << 63) - 1))
    return F.coalesce(F.col("doc_id").cast("long"), stand_in)


def classes(docs: DataFrame, *, similar: float = SIMILAR, weighted: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, class_id (the least id of its class of
    near copies) and kept (whether it is that one).

    Rows of one doc_id are one document.  Null texts and texts without a word are classes of
    their own.  Texts under five words are one shingle.  A null doc_id takes part under a
    hash of its text, which is its class_id where nothing smaller is alike.  Other columns
    are ignored; an empty table gives an empty result.
    """
    given = docs.select(id_of().alias("id"), "text")
    sign = stored(signed(given, weighted=weighted))
    worded = sign.where("bands is not null")
    # written, so that the join below deals its rows out anew and a text of many copies can be split
    copies = stored(worded.groupBy("key").agg(F.min("id").alias("rep")))
    reps = worded.join(copies.select(F.col("rep").alias("id")).distinct(), "id", "left_semi").select("id", "size", "bands")
    pairs = stored(ties(reps))
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    sets = stored(shingled(given, ids, weighted=weighted))
    roots = stored(components(verified(pairs, sets, similar=similar)))
    roots = completed(reps.join(ids, "id", "left_semi"), sets, pairs, roots, similar=similar)
    member = sign.join(copies, "key", "left").withColumn("rep", F.coalesce("rep", "id")).select("id", "rep")
    # texts that share an id share a class: their representatives are tied as well
    split = member.groupBy("id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi")
    if not split.isEmpty():
        both = member.join(split, "id").select(F.col("rep").alias("a"), F.col("lo").alias("b"))
        roots = stored(components(roots.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(both)))
    found = member.join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    return found.select(
        F.col("id").alias("doc_id"), F.coalesce("root", "rep").alias("class_id"),
        (F.col("id") == F.coalesce("root", "rep")).alias("kept"),
    )


def without_copies(docs: DataFrame, *, similar: float = SIMILAR, weighted: bool = False) -> DataFrame:
    """``docs`` with one row of each class, all columns kept: the one of least doc_id, and
    of several rows with that id, one."""
    kept = classes(docs, similar=similar, weighted=weighted).where("kept").select(F.col("doc_id").alias("__id")).distinct()
    named = docs.withColumn("__id", id_of())
    return named.join(kept, "__id", "left_semi").dropDuplicates(["__id"]).select(docs.columns)
