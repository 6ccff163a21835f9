"""Column profiles in a few passes over the table."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, frexp

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The type names profiled as numbers.
NUMERIC_TYPES = ("integer", "long", "float", "double")

# Bits of a double's fraction, and how many of them a pass for an exact percentile settles.
FRACTION = 52
DIGIT = 13

SKETCH_ERROR = 0.02  # relative standard deviation of sketched numbers of distinct values


def _columns_of(df: DataFrame, kinds: Sequence[str], columns: Sequence[str] | None) -> list[str]:
    chosen = df.columns if columns is None else list(columns)
    return [name for name in chosen if df.schema[name].dataType.typeName() in kinds]


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _rows_of(wide: DataFrame, structs: list[Column]) -> DataFrame:
    """One output row per struct of a single aggregated row."""
    return wide.select(F.inline(F.array(*structs)))


def _text(df: DataFrame, name: str) -> Column:
    """A value as text, equal exactly where the values are."""
    column, kind = _quoted(name), df.schema[name].dataType.typeName()
    if kind in ("float", "double"):
        return (column + F.lit(0.0).cast(kind)).cast("string")  # one zero instead of two
    if kind == "binary":
        return F.hex(column)
    return F.to_json(column) if kind in ("struct", "array", "variant") else column.cast("string")


def profile_counts(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Per column: type, rows, nulls, non-nulls, distinct values (null counts as one).

    Values are counted as ``(column number, text)``, which combine before the one
    shuffle they need, and a frequent value or null arrives once per task.
    ``approximate`` counts distinct values by mergeable sketches instead: one pass
    whose shuffle does not grow with the values.
    """
    names = df.columns if columns is None else list(columns)
    if not names:
        raise ValueError("there must be a column to profile")
    types = [df.schema[name].dataType.typeName() for name in names]
    if approximate:
        return _sketched_counts(df, names, types)
    cells = [
        F.struct(F.lit(i).alias("number"), _text(df, name).alias("value"))
        for i, name in enumerate(names)
    ]
    values = df.select(F.inline(F.array(*cells))).groupBy("number", "value")
    counts = values.agg(F.count("*").alias("rows")).groupBy("number").agg(
        F.sum("rows").alias("rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("rows"))).alias("nulls"),
        F.count("*").alias("distinct"),
    )
    # An empty table has no values, so the columns come from the list of names.
    listed = df.sparkSession.range(len(names)).select(
        F.col("id").cast("int").alias("number"),
        F.element_at(F.array(*map(F.lit, names)), (F.col("id") + 1).cast("int")).alias("column"),
        F.element_at(F.array(*map(F.lit, types)), (F.col("id") + 1).cast("int")).alias("data_type"),
    )
    zero = F.lit(0).cast("long")
    rows, nulls = F.coalesce("rows", zero), F.coalesce("nulls", zero)
    return listed.join(counts, "number", "left").select(
        "column", "data_type", rows.alias("row_count"), nulls.alias("null_count"),
        (rows - nulls).alias("non_null_count"), F.coalesce("distinct", zero).alias("distinct_count"),
    )


def _sketched_counts(df: DataFrame, names: Sequence[str], types: Sequence[str]) -> DataFrame:
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, name in enumerate(names):
        sketch = F.approx_count_distinct(_text(df, name), SKETCH_ERROR)
        aggregates += [F.count(_quoted(name)).alias(f"filled{i}"), sketch.alias(f"distinct{i}")]
    structs = []
    for i, (name, kind) in enumerate(zip(names, types, strict=True)):
        nulls = F.col("n") - F.col(f"filled{i}")
        structs.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(kind).alias("data_type"),
                F.col("n").alias("row_count"),
                nulls.alias("null_count"),
                F.col(f"filled{i}").alias("non_null_count"),
                (F.col(f"distinct{i}") + (nulls > 0).cast("long")).alias("distinct_count"),
            )
        )
    return _rows_of(df.agg(*aggregates), structs)


def distinct_count_errors(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: whether the sketched number of distinct values is near the exact one.

    Near is within four times the sketch's relative standard deviation.
    """
    exact = profile_counts(df, columns)
    sketched = profile_counts(df, columns, approximate=True)
    sketched = sketched.select("column", F.col("distinct_count").alias("estimate"))
    off = F.abs(F.col("estimate") - F.col("distinct_count"))
    return exact.join(sketched, "column").select(
        "column", "distinct_count",
        (off <= F.ceil(F.col("distinct_count") * (4 * SKETCH_ERROR))).alias("near"),
    )


def profile_numeric(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    percentiles: Sequence[float] = (0.25, 0.5, 0.75),
    accuracy: int = 10_000,
    exact: bool = False,
) -> DataFrame:
    """Per numeric column: mean, sample stddev, min, max and percentiles, nulls left out.

    The percentiles are ``percentile_approx`` sketches, so a value's rank is
    off by at most ``rows / accuracy`` and memory does not grow with the data.
    ``exact`` finds the true ones with :func:`exact_percentiles`, which runs a
    few passes at once.
    """
    names = _columns_of(df, NUMERIC_TYPES, columns)
    found = exact_percentiles(df, names, percentiles) if exact else {}
    aggregates = []
    for i, name in enumerate(names):
        col = _quoted(name)
        aggregates += [
            F.avg(col).alias(f"mean{i}"),
            F.stddev_samp(col).alias(f"stddev{i}"),
            F.min(col).cast("double").alias(f"min{i}"),
            F.max(col).cast("double").alias(f"max{i}"),
        ]
        if exact:
            ranks = [F.lit(found[name, p]).cast("double") for p in percentiles]
            aggregates.append(F.array(*ranks).alias(f"p{i}"))
        else:
            sketch = F.percentile_approx(col, list(percentiles), accuracy)
            aggregates.append(sketch.alias(f"p{i}"))
    structs = []
    for i, name in enumerate(names):
        ranks = [
            F.get(f"p{i}", F.lit(j)).cast("double").alias(f"p{p * 100:g}")
            for j, p in enumerate(percentiles)
        ]
        structs.append(
            F.struct(
                F.lit(name).alias("column"),
                F.col(f"mean{i}").alias("mean"),
                F.col(f"stddev{i}").alias("stddev"),
                F.col(f"min{i}").alias("min"),
                F.col(f"max{i}").alias("max"),
                *ranks,
            )
        )
    return _rows_of(df.agg(*aggregates), structs)


def exact_percentiles(
    df: DataFrame, columns: Sequence[str], percentiles: Sequence[float]
) -> dict[tuple[str, float], float | None]:
    """The value of rank ``ceil(p * n)`` for every column and ``p``; nulls and NaN left out.

    A column of nulls and NaN has None. Infinities are values like others, and
    zeros of either sign are one value. This is radix selection on the 64 bits
    of a double: the first pass counts rows by sign and exponent, each of the
    next by ``DIGIT`` bits of the fraction among the rows that share the bits so
    far, so five passes settle any column of any length. A search ends earlier
    once its rows are all one value. The driver sees ``2 ** DIGIT`` counts per
    search and pass at most.
    """
    value = {name: _quoted(name).cast("double") for name in columns}
    kept = {name: F.when(~F.isnan(x), x + F.lit(0.0)) for name, x in value.items()}
    found: dict[tuple[str, float], float | None] = dict.fromkeys(
        (name, p) for name in columns for p in percentiles
    )
    # (column, p) -> least and largest value of the rows in question, and the rank among them.
    searching = {case: (None, None, None) for case in found}
    shift = FRACTION
    while searching:
        ranges = list(dict.fromkeys((name, *s[:2]) for (name, _), s in searching.items()))
        groups = _count_digits(df, kept, ranges, shift)
        left = {}
        for (name, p), (low, high, rank) in searching.items():
            inside = groups[ranges.index((name, low, high))]
            if rank is None:
                rank = max(1, ceil(p * sum(g["n"] for g in inside)))
            for g in inside:
                if rank <= g["n"]:
                    if g["least"] == g["most"]:
                        found[name, p] = g["least"]
                    else:
                        left[name, p] = (g["least"], g["most"], rank)
                    break
                rank -= g["n"]
        searching = left
        shift -= DIGIT
    return found


def _exponents(rows: DataFrame) -> DataFrame:
    """Adds ``digit``: the exponent bits of ``x``, negative for values below zero.

    Infinities come last, and values under the least normal one share the bits 0.
    """
    size = F.abs("x")
    tiny, endless = size < F.lit(2.0**-1022), size == F.lit(float("inf"))
    near = F.when(~tiny & ~endless, F.floor(F.log2(size)).cast("int"))
    rows = rows.withColumn("near", near)
    # The logarithm may be rounded across a power of two.
    above = size >= F.pow(F.lit(2.0), F.col("near") + 1)
    below = size < F.pow(F.lit(2.0), F.col("near"))
    normal = F.col("near") + F.when(above, 1024).when(below, 1022).otherwise(1023)
    bits = F.when(tiny, 0).when(endless, 2047).otherwise(normal)
    return rows.withColumn("digit", F.when(F.col("x") < 0, -bits).otherwise(bits).cast("long"))


def _scale(some: float | None) -> tuple[float, float, float]:
    """What to divide by, subtract and multiply with to turn a value into its fraction bits.

    It holds for all values with the exponent bits of ``some``; below zero larger
    bits are smaller values, so there the bits are negative.
    """
    if not some or abs(some) < 2.0**-1022:
        return 2.0**-537, 0.0, 2.0**537
    sign = 1.0 if some > 0 else -1.0
    return sign * 2.0 ** (frexp(some)[1] - 1), 1.0, sign * 2.0**FRACTION


def _count_digits(df: DataFrame, kept: dict[str, Column], ranges: list, shift: int) -> list[list]:
    """Rows of each range by the digit of their bits at ``shift``, smallest value first.

    Ranges of one column do not overlap, so a row has one entry per column at
    most. The table of ranges, broadcast, has a row per column and percentile.
    """
    names = list(dict.fromkeys(r[0] for r in ranges))
    entries = [F.struct(F.lit(i).alias("of"), kept[n].alias("x")) for i, n in enumerate(names)]
    rows = df.select(F.inline(F.array(*entries))).where("x IS NOT NULL")
    if shift == FRACTION:
        rows = _exponents(rows.withColumnRenamed("of", "range"))
    else:
        table = [
            (i, names.index(n), low, high, *_scale(low)) for i, (n, low, high) in enumerate(ranges)
        ]
        known = df.sparkSession.createDataFrame(
            table,
            "range int, of int, low double, high double, unit double, one double, factor double",
        )
        bits = ((F.col("x") / F.col("unit") - F.col("one")) * F.col("factor")).cast("long")
        rows = rows.join(F.broadcast(known), "of").where("x BETWEEN low AND high")
        rows = rows.withColumn("digit", F.shiftright(bits, shift))
    counted = rows.groupBy("range", "digit").agg(
        F.count("*").alias("n"), F.min("x").alias("least"), F.max("x").alias("most")
    )
    groups: list[list] = [[] for _ in ranges]
    for row in sorted(counted.collect(), key=lambda r: r["least"]):
        groups[row["range"]].append(row)
    return groups


def percentile_ranks(
    df: DataFrame,
    columns: Sequence[str],
    percentiles: Sequence[float] = (0.25, 0.5, 0.75),
    accuracy: int = 10_000,
) -> DataFrame:
    """Per column and percentile: whether the sketch's value has a rank within ``rows / accuracy``.

    One pass for the sketches and one to count the rows up to their values.
    """
    profiled = profile_numeric(df, columns, percentiles, accuracy).collect()
    names = [f"p{p * 100:g}" for p in percentiles]
    cases = [(r["column"], p, r[n]) for r in profiled for p, n in zip(percentiles, names, strict=True)]
    aggregates = []
    for i, (column, _, v) in enumerate(cases):
        x = _quoted(column).cast("double")
        aggregates += [
            F.count(x).alias(f"n{i}"),
            F.count_if(x < F.lit(v)).alias(f"low{i}"),
            F.count_if(x <= F.lit(v)).alias(f"high{i}"),
        ]
    structs = []
    for i, (column, p, _) in enumerate(cases):
        n, low, high = (F.col(f"{k}{i}") for k in ("n", "low", "high"))
        slack = F.ceil(n / accuracy)
        near = (low + 1 - slack <= F.ceil(F.lit(p) * n)) & (F.ceil(F.lit(p) * n) <= high + slack)
        structs.append(
            F.struct(F.lit(column).alias("column"), F.lit(p).alias("percentile"), near.alias("within"))
        )
    return _rows_of(df.agg(*aggregates), structs)


def profile_top_values(
    df: DataFrame, columns: Sequence[str] | None = None, k: int = 10
) -> DataFrame:
    """The ``k`` most frequent values of each string column, equal counts by value.

    A null takes a place among the ``k`` and is left out afterwards. Spark
    turns the rank filter into a per-task top ``k``, so only ``k`` values per
    task and column reach the final ranking.
    """
    names = _columns_of(df, ("string",), columns)
    values = df.select(
        F.inline(
            F.array(*[F.struct(F.lit(n).alias("column"), _quoted(n).alias("value")) for n in names])
        )
    )
    order = Window.partitionBy("column").orderBy(F.desc("value_count"), F.asc("value"))
    return (
        values.groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("value_count"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .filter(F.col("value").isNotNull())
        .select("column", "value", "value_count")
    )


def profile_boolean(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per boolean column: true and false counts and their share of the non-null rows."""
    names = _columns_of(df, ("boolean",), columns)
    aggregates = []
    for i, name in enumerate(names):
        aggregates += [
            F.count_if(_quoted(name)).alias(f"true{i}"),
            F.count_if(~_quoted(name)).alias(f"false{i}"),
        ]
    structs = []
    for i, name in enumerate(names):
        yes, no = F.col(f"true{i}"), F.col(f"false{i}")
        total = F.nullif(yes + no, F.lit(0))
        structs.append(
            F.struct(
                F.lit(name).alias("column"),
                yes.alias("true_count"),
                no.alias("false_count"),
                (yes * 100.0 / total).alias("true_percentage"),
                (no * 100.0 / total).alias("false_percentage"),
            )
        )
    return _rows_of(df.agg(*aggregates), structs)
