"""Mixing sources to target weights.

The words of each source, its documents one after the other, are cut into blocks of a
fixed length.  The mix is a row of slots, dealt in output shards; each slot takes one
block.  A pseudorandom permutation of all slots decides which source a slot belongs to, so
a shard's counts by source are multinomial draws without replacement, and the counts of
the whole mix meet the targets.  A slot's number within its source, through the source's
own pseudorandom permutation of block numbers, names the block; blocks are joined by
number.  Each source has a permutation of its own for every time it is gone through.
Nothing is drawn from a generator with state, so reruns agree.

Integer hashes and modular arithmetic only; only sums per source reach the driver's plan,
none its memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from assayer.llm.common import WORD, stored

BUCKETS = 1024
#: Rounds of the block permutations.
ROUNDS = 24


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """One row per source: source, source_size, target.  Sources by code point, null last,
    take ``weights`` in turn and share all words; a share stops at ``most`` times the
    source's size and the excess goes to the others by weight until none is above.

    With sources sorted by size / weight, those that stop come first: the windows run over
    one row per source.
    """
    listed = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    by_room = W.orderBy((F.col("source_size") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before, after = by_room.rowsBetween(W.unboundedPreceding, -1), by_room.rowsBetween(0, W.unboundedFollowing)
    stop = most * F.col("source_size")
    ahead = listed.withColumn("w", weight).withColumn("all", F.sum("source_size").over(W.partitionBy()))
    level = (F.col("all") - F.coalesce(F.sum(stop).over(before), F.lit(0.0))) / F.sum("w").over(after)
    ahead = ahead.withColumns(
        {"level": level, "stop": stop.cast("double"), "at": F.row_number().over(by_room)}
    )
    free = F.col("level") * F.col("w") <= F.col("stop")
    # the first source that its share does not stop sets the level of all after it
    ahead = ahead.withColumn("final", F.min_by("level", F.when(free, F.col("at"))).over(W.partitionBy()))
    share = F.least(F.coalesce(F.col("final"), F.lit(0.0)) * F.col("w"), F.col("stop"))
    return ahead.select("source", "source_size", share.alias("target"))


def permuted(number: str, n: str, *key: str) -> str:
    """SQL: the place of ``number`` in a pseudorandom permutation of 0 to n - 1 that ``key``
    picks, for any n up to 2^62.  Each round pairs x with k - x modulo n, k drawn from key and
    round, and swaps the two if a hash of round and the greater one says so: a permutation
    whatever n is.  Hashes are reduced before they are added, so nothing overflows."""
    keys = ", ".join(key)
    step = (
        f"transform(array(pmod(pmod(xxhash64({keys}, r), {n}) - x, {n})), y -> "
        f"if((xxhash64({keys}, r, greatest(x, y)) & 1L) = 1L, y, x))[0]"
    )
    return f"aggregate(sequence(1, {ROUNDS}), cast({number} as bigint), (x, r) -> {step})"


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, source, size > 0, more) with ``start``, the number of words of its
    source that come before.  Running sums are taken within hashed buckets of a source and
    then over its buckets, so a large source is no single group."""
    bucket = docs.withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "size"), F.lit(BUCKETS)))
    within = W.partitionBy("source", "__bucket").orderBy("doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    totals = bucket.groupBy("source", "__bucket").agg(F.sum("size").alias("__all"))
    over = W.partitionBy("source").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("source").alias("__s"), F.col("__bucket").alias("__b"),
        F.coalesce(F.sum("__all").over(over), F.lit(0)).alias("__offset"),
    )
    local = bucket.withColumn("__local", F.coalesce(F.sum("size").over(within), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("__s")) & (F.col("__bucket") == F.col("__b"))
    return local.join(offsets, same).withColumn("start", F.col("__local") + F.col("__offset")).drop(
        "__bucket", "__b", "__s", "__local", "__offset"
    )


def slots(sources: DataFrame, *, block: int, shard: int, most: int, seed: int) -> DataFrame:
    """The slots of the mix: shard, slot, source, block, epoch (how often the block was
    taken before).  ``sources`` has source, source_size and target.  Slot counts by source
    are rounded targets in blocks of the source's mean length, and no block is taken more
    than ``most`` times."""
    spark = sources.sparkSession
    blocks = F.ceil(F.col("source_size") / block)
    wanted = F.least(F.round(F.col("target") * blocks / F.col("source_size")).cast("long"), blocks * most)
    listed = sources.where("source_size > 0").withColumns({"blocks": blocks, "slots": wanted})
    by = W.orderBy(F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    listed = stored(listed.withColumn("first", F.coalesce(F.sum("slots").over(by), F.lit(0))))
    total = listed.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-total // shard))
    x, y = F.col("id") % shards, F.floor(F.col("id") / shards).cast("long")
    dealt = spark.range(shards * shard).select((F.col("id") % shards).alias("shard"), y.alias("slot"), x.alias("x"), y.alias("y"))
    for turn in range(4):  # Feistel rounds over shards x slots: a permutation of all slots
        dealt = dealt.withColumn("x", (F.col("x") + F.pmod(F.xxhash64("y", F.lit(seed + turn)), F.lit(shards))) % F.lit(shards))
        dealt = dealt.withColumn("y", (F.col("y") + F.pmod(F.xxhash64("x", F.lit(~seed - turn)), F.lit(shard))) % F.lit(shard))
    dealt = dealt.select("shard", "slot", (F.col("x") * shard + F.col("y")).alias("place")).where(F.col("place") < total)
    # sources own ranges of places; the range join goes by equal pieces of the places
    piece = max(1, total // 256)
    owner = listed.where("slots > 0").select(
        "source", "first", "slots", "blocks",
        F.explode(F.sequence(F.floor(F.col("first") / piece), F.floor((F.col("first") + F.col("slots") - 1) / piece))).alias("piece"),
    )
    owned = dealt.withColumn("piece", F.floor(F.col("place") / piece)).join(owner, "piece").where(
        "place >= first and place < first + slots"
    )
    numbered = owned.selectExpr(
        "shard", "slot", "source", "cast(blocks as bigint) as blocks", "(place - first) % blocks as number",
        "(place - first) div cast(blocks as bigint) as epoch",
    )
    return numbered.selectExpr(
        "shard", "slot", "source", f"{permuted('number', 'blocks', 'source', 'epoch', str(seed))} as block", "epoch"
    )


def taken_pieces(placed_docs: DataFrame, dealt: DataFrame, block: int) -> DataFrame:
    """Documents and slots joined by block number: source, start, size, doc_id of the
    document, epoch, and the words ``from`` to ``to`` (exclusive) taken in it."""
    spread = placed_docs.withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)))
    )
    named = dealt.select(F.col("source").alias("__s"), F.col("block").alias("__k"), "epoch")
    same = F.col("source").eqNullSafe(F.col("__s")) & (F.col("block") == F.col("__k"))
    begin = F.greatest(F.col("block") * block, F.col("start")) - F.col("start")
    end = F.least((F.col("block") + 1) * block, F.col("start") + F.col("size")) - F.col("start")
    return spread.join(named, same).select(
        "doc_id", "source", "start", "size", "epoch", begin.alias("from"), end.alias("to")
    )


def mixture(
    docs: DataFrame,
    *,
    weights: Sequence[float] = (5, 2, 1),
    most: int = 3,
    block: int = 64,
    shard: int = 4096,
    seed: int = 7,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): doc_id, size, source_size, target, taken.

    Null texts have size 0; rows of size 0 are never taken.  A null source is one source,
    the last.  Repeated rows are separate documents.  Other columns are ignored; an empty
    table gives an empty result.
    """
    sizes = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    goal = stored(targets(sizes, weights, most))
    here = stored(placed(sizes.where("size > 0")))
    pieces = taken_pieces(here, slots(goal, block=block, shard=shard, most=most, seed=seed), block)
    words = pieces.groupBy("source", "start").agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
    words = words.withColumnsRenamed({"source": "__s", "start": "__at"})
    same = F.col("source").eqNullSafe(F.col("__s")) & (F.col("start") == F.col("__at"))
    counted = here.join(words, same, "left").select(
        "doc_id", "source", "size", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
    none = sizes.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    with_goal = goal.select(F.col("source").alias("__s"), "source_size", "target")
    return counted.unionByName(none).join(with_goal, F.col("source").eqNullSafe(F.col("__s"))).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def mixed_documents(
    docs: DataFrame,
    *,
    weights: Sequence[float] = (5, 2, 1),
    most: int = 3,
    block: int = 64,
    shard: int = 4096,
    seed: int = 7,
) -> DataFrame:
    """The mix as documents: one row per document and epoch with the words taken in it, all
    columns of ``docs`` kept.  A text that is taken whole stays as it is; of others, the
    taken words are kept with the space after them.  Documents that nothing is taken of
    go, those with null or empty texts among them.  ``n_chars``, where there, follows the text.
    A null source is one source; repeated rows are separate documents; an empty table gives an
    empty result; columns of any other name are carried along."""
    used = ("doc_id", "text", "source")
    # Columns of the caller's keep out of the way of those made here.
    own = {c: c if c in used else f"__own{k}" for k, c in enumerate(docs.columns)}
    worded = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in own.items()]).withColumn("size", word_count(F.col("text"))).where("size > 0")
    here = stored(placed(worded))
    sizes = here.select("doc_id", "source", "start", "size")
    goal = stored(targets(sizes, weights, most))
    pieces = taken_pieces(sizes, slots(goal, block=block, shard=shard, most=most, seed=seed), block)
    taken = pieces.groupBy(F.col("source").alias("__s"), F.col("start").alias("__at"), "epoch").agg(
        F.sum(F.col("to") - F.col("from")).alias("__n"),
        F.sort_array(F.collect_list(F.struct("from", "to"))).alias("__parts"),
    )
    same = F.col("source").eqNullSafe(F.col("__s")) & (F.col("start") == F.col("__at"))
    cut = F.expr(
        "element_at(transform(array(regexp_extract_all(text, '[^\\\\x20\\\\x09-\\\\x0D]+[\\\\x20\\\\x09-\\\\x0D]*', 0)), "
        "w -> array_join(flatten(transform(__parts, p -> slice(w, cast(p.from + 1 as int), cast(p.to - p.from as int)))), '')), 1)"
    )
    out = here.join(taken, same).withColumn("text", F.when(F.col("__n") < F.col("size"), cut).otherwise(F.col("text")))
    if "n_chars" in own:
        out = out.withColumn(own["n_chars"], F.length("text").cast("long"))
    return out.select(*[F.col(a).alias(c) for c, a in own.items()])
