"""Connected components of a graph given as pairs of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import stored


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One step: every id's larger (or smaller) neighbours are tied to the least id near it.
    The least ids are combined on the map side; the join back splits a hub's pairs."""
    if large:
        near = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        out = near.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        least = pairs.groupBy("a").agg(F.min("b").alias("low"))
        out = pairs.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
    return out.where("a <> b").distinct()


def components(pairs: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """``id`` and ``root`` (the least id of its component) of every id in ``pairs``.

    Large-star and small-star steps by turns, the pairs written to the shared folder after
    each round, until a round changes nothing; rounds grow with the logarithm of the size.
    Pairs of one id with itself and repeated pairs do nothing; nulls are left out.  An empty
    table gives an empty result.
    """
    here = stored(
        pairs.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b"))
        .where(f"{first} is not null and {second} is not null").where("a <> b").distinct()
    )
    before = None
    while True:
        state = here.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        here = stored(_star(_star(here, True), False))
    roots = here.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
    return here.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(roots)
