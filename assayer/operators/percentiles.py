"""Exact percentiles of many columns at once by radix selection, without one task ever
holding a column.

Spark's ``percentile`` keeps all distinct values of a column in one buffer.  Here a value is
a whole number of 64 bits that orders as the values do, and a wanted rank is narrowed down
16 bits at a time: rows are summed by the leading bits, running sums over these at most
65,536 groups tell which of them hold a wanted rank, and only values with these leading bits
go on to the next 16.  Four rounds end at the value, whatever the distribution: outliers,
values crowded at several scales and heavy ties cost the same.

Counted values and their keys are dealt out once, and every round reads that one exchange:
all of its columns, without a filter of its own, or it would be another exchange over another
scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.functions.exprs import text

#: Bits left below the leading ones, round by round; a round resolves 16 of 64.
ROUNDS = (48, 32, 16, 0)
#: 2^52 steps from one power of two to the next; infinity lies above all powers.
STEPS, TOP = 1 << 52, 2047


#: 2^(64 k - 1024) and 2^k, whose products are the powers of two of normal doubles.
COARSE = "array(" + ", ".join(f"{2.0 ** (64 * k - 1024)!r}D" for k in range(32)) + ")"
FINE = "array(" + ", ".join(f"{2.0 ** k!r}D" for k in range(64)) + ")"
LEAST_NORMAL = "2.2250738585072014E-308D"


def _power_of_two(exponent: str) -> str:
    """2^exponent for -1022 to 1023, looked up: Spark's ``pow`` takes some ten times as long."""
    return f"({COARSE}[({exponent} + 1024) div 64] * {FINE}[({exponent} + 1024) % 64])"


def order_key(value: str) -> dict[str, str]:
    """Columns to add, one after the other, that end in ``key``: a BIGINT that orders as the
    doubles do, equal for equal values; 0.0 and -0.0 are one value, NaN is the greatest, and
    NULL has the key 0."""
    size, inf = f"abs({value})", "double('infinity')"
    near = (
        f"case when {value} is null or isnan({value}) or {size} < {LEAST_NORMAL} or {size} = {inf} then -1022"
        f" else greatest(-1022, least(1023, cast(floor(log2({size})) as int))) end"
    )
    # The logarithm may be off by one next to a power of two.
    power = (
        f"case when {size} < {_power_of_two('near')} then greatest(near - 1, -1022)"
        f" when near < 1023 and {size} >= {_power_of_two('least(near + 1, 1023)')} then near + 1 else near end"
    )
    steps = (
        f"if({size} < {LEAST_NORMAL}, cast({size} / 4.9E-324D as bigint),"
        f" (power + 1023) * {STEPS}L + cast(({size} / {_power_of_two('power')} - 1) * {STEPS}L as bigint))"
    )
    return {
        "near": near,
        "power": power,
        # Never NULL in the eyes of the optimizer, which else filters on it below the counting.
        "key": f"coalesce(case when {value} = 0 then 0L when isnan({value}) then {TOP * STEPS + 1}L"
               f" when {size} = {inf} then cast(signum({value}) as bigint) * {TOP * STEPS}L"
               f" else cast(signum({value}) as bigint) * {steps} end, 0L)",
    }


def with_order_key(df: DataFrame, value: str = "value") -> DataFrame:
    for column, expression in order_key(value).items():
        df = df.selectExpr("*", f"{expression} as {column}")
    return df.drop("near", "power")


def _holding(df: DataFrame, keys: list[str], order: str, wanted: str, keep: list[str]) -> DataFrame:
    """Keep the rows of each group whose ranks include a wanted one, with those ranks.

    Ranks run on from ``start``, in the order given, ``n`` per row.
    """
    window = f"sum(n) over (partition by {', '.join(keys)} order by {order})"
    ranked = df.selectExpr("*", f"start + {window} as next").selectExpr("*", "next - n as first")
    return ranked.selectExpr(
        *keep, "first as start", f"filter({wanted}, w -> w.rank >= first and w.rank < next) as hits"
    ).where("size(hits) > 0")


def leading(keyed: DataFrame, held: DataFrame | None, before: int, shift: int) -> DataFrame:
    """Rows summed by the leading bits of their key down to ``shift``, of the groups in
    ``held`` (column_id, bits, of what is above ``before``) or of all."""
    bits = F.expr(f"shiftright(key, {shift})").alias("bits")
    if held is None:
        return keyed.groupBy("column_id", bits).agg(F.sum("n").alias("n")).selectExpr(
            "*", "0L as start", "sum(n) over (partition by column_id) as total")
    # Broadcast: at most two rows per percentile and column.
    near = F.broadcast(held.selectExpr("column_id as of", "bits as above", "start", "total"))
    among = keyed.join(near, F.expr(f"column_id = of and shiftright(key, {before}) = above"))
    value = [] if shift else ["value"]
    return among.groupBy("column_id", "above", "start", "total", bits, *value).agg(F.sum("n").alias("n"))


def percentiles_of(counts: DataFrame, percentiles: dict[str, float]) -> DataFrame:
    """``(column_id, <name>…)``: percentiles interpolated linearly between neighbouring ranks.

    ``counts`` holds ``(column_id, value, n)`` with distinct non-NULL double values.
    """
    ranks = "array(" + ", ".join(
        f"named_struct('name', {text(f'{name}_{side}')}, 'rank', cast({edge}({p}D * (total - 1)) as bigint))"
        for name, p in percentiles.items()
        for side, edge in (("low", "floor"), ("high", "ceil"))
    ) + ")"
    keyed = with_order_key(counts.select("column_id", "value", "n")).repartition("column_id", "key")
    held = _holding(leading(keyed, None, 0, ROUNDS[0]), ["column_id"], "bits", ranks, ["column_id", "bits", "total"])
    for before, shift in zip(ROUNDS, ROUNDS[1:]):
        value = [] if shift else ["value"]
        held = _holding(leading(keyed, held, before, shift), ["column_id", "above"], ", ".join(["bits", *value]), ranks,
                        ["column_id", "bits", "total", *value])
    edges = held.selectExpr("column_id", "value", "total", "inline(hits)").groupBy("column_id").agg(
        F.max("total").alias("total"), *[
            F.expr(f"max(if(name = '{name}_{side}', value, null)) as {name}_{side}")
            for name in percentiles for side in ("low", "high")
        ],
    )

    def interpolated(name: str, p: float) -> str:
        position = f"({p}D * (total - 1))"
        share = f"({position} - floor({position}))"
        low, high = f"{name}_low", f"{name}_high"
        return f"if({low} = {high}, {low}, {low} * (1 - {share}) + {high} * {share}) as {name}"

    return edges.selectExpr("column_id", *[interpolated(name, p) for name, p in percentiles.items()])


def value_statistics(counts: DataFrame, percentiles: dict[str, float]) -> DataFrame:
    """``(column_id, nd, <name>…)`` from ``(column_id, value, n)`` with distinct values."""
    distinct = counts.groupBy("column_id").agg(F.expr("count_if(n > 0) as nd"))
    return distinct.join(percentiles_of(counts, percentiles), "column_id")
