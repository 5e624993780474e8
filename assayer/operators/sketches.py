"""Column profiles from sketches that merge: distinct counts and percentiles by estimate.

A sketch of a column is some kilobytes, whatever the column holds: HyperLogLog for distinct
values, KLL for percentiles, beside exact counts and extremes.  Sketches are made in one pass
without a shuffle of values, by part of the table where asked, and are plain binary columns:
stored runs or partitions merge later without another look at the rows.  Exact profiles
(``profile``) stay the default.

Errors: distinct counts are off by 0.8 percent (standard error, 2^14 registers); a percentile
is the value of a rank that is off by less than 0.5 percent of the rows (99 percent sure, k =
800).  Counts and extremes are exact.  NaN is left out of percentiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.functions.exprs import name, rows_of, text
from assayer.operators.keystate import NUMBERED, as_text
from assayer.operators.profile import PERCENTILES, numeric_columns, text_columns

REGISTERS, K = 14, 800
KEYS = ["table", "field", "kind"]
SKETCH_COLUMNS = [*KEYS, "cn", "filled", "hll", "kll", "min_num", "max_num", "min_text", "max_text"]


def sketches(df: DataFrame, table: str, by: str | None = None) -> DataFrame:
    """One row per column with its sketches (``SKETCH_COLUMNS``); with ``by`` (SQL) one per
    column and ``part``, the value of ``by`` as text.

    The sketches of all columns are made side by side in one aggregate.  Texts and dates have
    a range as text, numbers as doubles.  An empty table gives empty sketches, and with
    ``by`` none.
    """
    numbers = numeric_columns(df)
    wanted, rows = ["count(*) as cn"], []
    for i, f in enumerate(text_columns(df) + numbers):
        value, numeric = name(f.name), f in numbers
        told = f"cast({value} as bigint)" if isinstance(f.dataType, NUMBERED) else as_text(value, f.dataType)
        wanted += [f"count({value}) as c{i}", f"hll_sketch_agg({told}, {REGISTERS}) as h{i}",
                   f"min({value}) as lo{i}", f"max({value}) as hi{i}"]
        if numeric:
            wanted.append(f"kll_sketch_agg_double(cast({value} as double), {K}) as k{i}")
        kinds = (("num", "double", numeric), ("text", "string", not numeric))
        rows.append({
            "table": text(table), "field": text(f.name.upper()), "kind": text("numeric" if numeric else "text"),
            "cn": "cn", "filled": f"c{i}", "hll": f"h{i}", "kll": f"k{i}" if numeric else "cast(null as binary)",
            **{f"{end}_{kind}": f"cast({short}{i} as {dtype})" if ours else f"cast(null as {dtype})"
               for kind, dtype, ours in kinds for end, short in (("min", "lo"), ("max", "hi"))},
        })
    if not rows:
        raise ValueError("no column to profile")
    grouped = df.groupBy(F.expr(f"cast({by} as string)").alias("part")) if by else df.groupBy()
    return grouped.agg(*[F.expr(e) for e in wanted]).selectExpr(*(["part"] if by else []), rows_of(rows))


def merge(parts: DataFrame) -> DataFrame:
    """Sketches of equal table, field and kind as one: of parts, partitions or stored runs of
    disjoint rows."""
    return parts.groupBy(*KEYS).agg(
        F.sum("cn").alias("cn"), F.sum("filled").alias("filled"), F.expr("hll_union_agg(hll)").alias("hll"),
        F.expr("kll_merge_agg_double(kll)").alias("kll"),
        *[F.expr(f"{end}({end}_{kind})").alias(f"{end}_{kind}") for kind in ("num", "text") for end in ("min", "max")],
    ).select(SKETCH_COLUMNS)


def estimates(sketched: DataFrame) -> DataFrame:
    """``(table, field, kind, cn, nd, n_null, min_text, max_text, min_num, <percentiles>, max_num)``
    from sketches; ``nd`` and the percentiles are estimates, the rest is exact."""
    def percentile(p: float) -> str:
        return f"if(kind = 'numeric' and kll_sketch_get_n_double(kll) > 0, kll_sketch_get_quantile_double(kll, {p}D), null)"

    return sketched.selectExpr(
        *[name(k) for k in KEYS], "cn", "if(filled = 0, 0L, hll_sketch_estimate(hll)) as nd", "cn - filled as n_null",
        "min_text", "max_text", "min_num", *[f"{percentile(p)} as {n}" for n, p in PERCENTILES.items()], "max_num",
    )
