"""Near-duplicate embeddings by counting collisions of one-dimensional projections.

Unit vectors of cosine ``similar`` or more are at most r = sqrt(2 - 2 similar) apart, and a
random direction shows a difference of about r / sqrt(d).  Vectors are projected on many
directions.  They are sorted by label, by the window cells of the first two projections and
by the third, and cut into blocks of that order; only blocks whose windows can meet are
brought together.  There, for every query vector, the vectors within its window are counted
over all projections, and pairs that collide often enough are verified by their cosine.  The
window and the least count are calibrated so that a pair just at the threshold is missed
with a chance under 1 in 1,000.

A pair of blocks returns sums and star-shaped ties, not its pairs, so the output is linear
in the rows even where thousands of vectors are alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import stored
from assayer.llm.components import components

PROJECTIONS, BLOCK, SEED = 16, 64, 11
COARSE, FINE = 4.0, 2.0  # windows in units of r / sqrt(d)


def directions(d: int) -> np.ndarray:
    """PROJECTIONS unit directions (d x PROJECTIONS), at right angles as far as d allows."""
    rng = np.random.default_rng(SEED)
    return np.concatenate(
        [np.linalg.qr(rng.normal(size=(d, d)))[0] for _ in range(-(-PROJECTIONS // d))], axis=1
    )[:, :PROJECTIONS]


def least_count(missed: float = 1e-4) -> int:
    """The largest count that a pair at the threshold fails to reach with a chance of at
    most ``missed``."""
    p = erf(FINE / sqrt(2))
    below = 0.0
    for count in range(PROJECTIONS + 1):
        below += comb(PROJECTIONS, count) * p**count * (1 - p) ** (PROJECTIONS - count)
        if below > missed:
            return count
    return PROJECTIONS


def reach(similar: float) -> float:
    return sqrt(max(0.0, 2 - 2 * similar)) + 1e-9


ROWS = "label long, d int, c1 long, c2 long, p3 double, id long, copies long, vector binary"
BLOCKS = (
    "label long, d int, c1 long, c2 long, low double, high double, block long, "
    "ids array<long>, copies array<long>, vectors binary"
)


def _projected(batches: Iterator[pa.RecordBatch], similar: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.array([len(v) for v in batch.column(3).to_pylist()] if batch.num_rows else [], np.int64)
        for d in np.unique(sizes):
            part = batch.filter(pa.array(sizes == d))
            v = np.array(part.column(3).to_pylist(), np.float64)
            v /= np.sqrt((v * v).sum(1))[:, None]
            p = v @ directions(int(d))
            cell = COARSE * reach(similar) / sqrt(d)
            spare = np.zeros(len(v))
            one, two, three = (p[:, k] if p.shape[1] > k else spare for k in range(3))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.full(len(v), d, np.int32)), pa.array(np.floor(one / cell).astype(np.int64)),
                 pa.array(np.floor(two / cell).astype(np.int64)), pa.array(three), part.column(1), part.column(2),
                 pa.array([row.tobytes() for row in v], pa.binary())],
                names=["label", "d", "c1", "c2", "p3", "id", "copies", "vector"],
            )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of at most BLOCK sorted rows of one cell."""
    key, rows = None, []

    def block() -> list:
        ids = [r[1] for r in rows]
        return [*key, rows[0][0], rows[-1][0], ids[0], ids, [r[2] for r in rows], b"".join(r[3] for r in rows)]

    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(),
             pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    names = ["label", "d", "c1", "c2", "low", "high", "block", "ids", "copies", "vectors"]

    def batch_of(found: list) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [[]] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        done = []
        for label, d, c1, c2, p3, one, copies, vector in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and ((label, d, c1, c2) != key or len(rows) == BLOCK):
                done.append(block())
                rows = []
            key = (label, d, c1, c2)
            rows.append((p3, one, copies, vector))
        yield batch_of(done)
    if rows:
        yield batch_of([block()])


def _linked(x: np.ndarray, y: np.ndarray, d: int, similar: float) -> np.ndarray:
    """Which pairs collide often enough and have the cosine."""
    turn = directions(d)
    px, py = x @ turn, y @ turn
    window = FINE * reach(similar) / sqrt(d)
    hits = np.zeros((len(x), len(y)), np.int8)
    for k in range(px.shape[1]):
        hits += np.abs(px[:, k, None] - py[None, :, k]) <= window
    out = np.zeros(hits.shape, bool)
    i, j = np.nonzero(hits >= least_count())
    out[i, j] = np.einsum("nd,nd->n", x[i], y[j]) >= similar
    return out


def _roots(linked: np.ndarray, ix: np.ndarray, iy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least id near each row, spread along the links until nothing changes."""
    top = np.iinfo(np.int64).max
    rx = ix.copy()
    while True:
        ry = np.minimum(iy, np.where(linked, rx[:, None], top).min(0))
        new = np.minimum(rx, np.where(linked, ry[None, :], top).min(1))
        if (new == rx).all():
            return rx, ry
        rx = new


def _compared(batches: Iterator[pa.RecordBatch], similar: float) -> Iterator[pa.RecordBatch]:
    names = ["id", "links", "root"]
    for batch in batches:
        out: list[np.ndarray] = []
        for k in range(batch.num_rows):
            d, bx, idx, nx, vx, by, idy, ny, vy = (batch.column(c)[k].as_py() for c in range(9))
            x, y = np.frombuffer(vx).reshape(-1, d), np.frombuffer(vy).reshape(-1, d)
            ix, iy = np.array(idx, np.int64), np.array(idy, np.int64)
            linked = _linked(x, y, d, similar)
            if bx == by:
                np.fill_diagonal(linked, False)
            if not linked.any():
                continue
            rx, ry = _roots(linked, ix, iy)
            sides = [(linked @ np.array(ny, np.int64), linked.any(1), ix, rx)]
            if bx != by:
                sides.append((np.array(nx, np.int64) @ linked, linked.any(0), iy, ry))
            for total, has, ids, root in sides:
                out.append(np.stack([ids[has], total[has], root[has]]))
        found = np.concatenate(out, 1) if out else np.zeros((3, 0), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=names)


#: Half of the cells around a cell, itself included; the other half sees this one.
AROUND = ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))


def links(reps: DataFrame, *, similar: float) -> DataFrame:
    """``reps``: label, id, copies, vector (array<double>), distinct within a label.  Sums
    (id, links, root): vectors linked to id, and an id of its component, by block pair."""
    rows = reps.select("label", "id", "copies", "vector").mapInArrow(lambda b: _projected(b, similar), ROWS)
    by = ["label", "d", "c1", "c2", "p3"]
    blocks = stored(rows.repartitionByRange(*by).sortWithinPartitions(*by, "id").mapInArrow(_blocks, BLOCKS))
    around = F.array(*[F.struct(F.lit(a).alias("u"), F.lit(b).alias("v")) for a, b in AROUND])
    x = blocks.withColumn("o", F.explode(around)).select(
        "label", "d", (F.col("c1") + F.col("o.u")).alias("c1"), (F.col("c2") + F.col("o.v")).alias("c2"),
        (F.expr("o.u = 0 and o.v = 0")).alias("own"), F.col("low").alias("low_x"), F.col("high").alias("high_x"),
        F.col("block").alias("bx"), F.col("ids").alias("ix"), F.col("copies").alias("nx"), F.col("vectors").alias("vx"),
    )
    window = F.lit(COARSE * reach(similar)) / F.sqrt("d")
    met = x.join(blocks, ["label", "d", "c1", "c2"]).where(
        (~F.col("own") | (F.col("bx") <= F.col("block")))
        & (F.col("low_x") - window <= F.col("high")) & (F.col("low") - window <= F.col("high_x"))
    )
    return met.select("d", "bx", "ix", "nx", "vx", "block", "ids", "copies", "vectors").mapInArrow(
        lambda b: _compared(b, similar), "id long, links long, root long"
    )


def near_duplicates(vectors: DataFrame, *, similar: float = 0.98) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Vectors are compared when their labels are equal and not null, and their lengths are
    equal.  Null, empty and zero vectors and those with null or non-finite components link
    with nothing, nor do rows of null vec_id.  Equal vectors of one label are linked and
    stand for one another; repeated rows are linked copies.  Other columns are ignored; an
    empty table gives an empty result.
    """
    given = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    whole = F.expr(
        "vec_id is not null and label is not null and size(vector) > 0 and forall(vector, v -> v is not null "
        "and not isnan(v) and abs(v) < double('Infinity')) and exists(vector, v -> v <> 0)"
    )
    keyed = given.withColumn("vector", F.when(whole, F.transform("vector", lambda v: v + F.lit(0.0)))).withColumns(
        {"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(5), "vector")}
    )
    key = ["label", "h1", "h2"]
    sound = keyed.where("vector is not null")
    reps = stored(sound.groupBy(*key).agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("vector").alias("vector")
    ))
    found = stored(links(reps, similar=similar))
    sums = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found, "id", "root")
    rep = reps.drop("vector").join(sums, "id", "left").join(roots, "id", "left").select(
        *key, F.coalesce("root", "id").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")
    )
    alike = keyed.where("vector is not null").select("vec_id", *key).join(rep, key).select("vec_id", "links", "root")
    alone = keyed.where("vector is null").select("vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("root"))
    return alike.unionByName(alone).select(
        "vec_id", F.col("links").alias("n_links"), F.col("root").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("root"), F.lit(True)).alias("kept"),
    )
