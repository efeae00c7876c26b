"""Mergeable moments of a sampled signal.

A sampled component carries its whole signal as text. Shuffling that text to
de-duplicate observations and then exploding it would move the largest
column of the table across the network. Instead each observation's signal is
reduced inside the task that reads it, with higher-order array functions, to
a small struct

    n   number of non-null samples
    s   their sum (double)
    mn  minimum (float; NaN sorts above every number, as in ``min``)
    mx  maximum (float)
    m2  sum of squared deviations from the observation's own mean

and only these structs are de-duplicated and aggregated. Partial states of
several observations merge exactly for n, s, mn, mx. The mean is ``S / N`` (null
when N = 0, as with ``avg``).

The standard deviation needs the squared deviations of observations' means from a
group's mean, which plain sums of squares lose to cancellation. So observations
meet in *cells* of a group: those whose means have the same upper 8 bits, the cell's
pivot ``p``. Within a cell, a mean is ``p`` plus a whole number ``d`` of steps of 2**-48 of
the pivot's size, and ``sum(n*d)`` and ``sum(n*d*d)`` are whole numbers in wide
decimals: exact, so they may be added in any order, and later (see
``equilibra.plans.refresh``). A cell's squared deviations are taken around its own
rounded mean, still in whole numbers, and only cells, of which a group has
few (its means' upper 8 bits), are met in doubles. No row is made per sample
and no group's mean is joined back: two small aggregations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("n", "s", "mn", "mx", "m2")
#: A double times 2**45 + 1, less what that adds beyond it, keeps its upper 8 bits.
PIVOT = float((1 << 45) + 1)
STEPS = 48
#: The mergeable state of a cell besides its keys; all are sums but ``MN`` and ``MX``.
CELL = ("P", "N", "S", "MN", "MX", "A", "B", "Q")


def _without_nulls(v: Column) -> Column:
    """``v`` without its nulls. Looking for NaN gives false only where there is neither NaN nor null; then no
    lambda is run, and ``v`` is asked for more than once, so that Spark makes it in compiled code before."""
    some = F.coalesce(F.array_contains(v, F.lit(float("nan")).cast("float")), F.lit(True))
    return F.when(some, F.filter(v, lambda x: x.isNotNull())).otherwise(v)


def add_moments(df: DataFrame, name: str, values: Column, *, std: bool = True) -> DataFrame:
    """Add struct column ``name`` with the moments of ``values`` (array<float>, nulls ignored)."""
    return add_all_moments(df, {name: values}, std=std)


def add_all_moments(df: DataFrame, values: dict[str, Column], *, std: bool = True, nulls: bool = True) -> DataFrame:
    """Add a struct column of moments for each named array. Arrays are evaluated once, and
    the mean needed by ``m2`` comes from a first projection; each step is one projection for all names.

    Without ``std``, for products that ask for no deviation, ``m2`` is null. ``nulls=False``: the
    arrays hold none."""
    tmp = {name: f"_{name}_v" for name in values}
    df = df.select("*", *[(_without_nulls(v) if nulls else v).alias(tmp[name]) for name, v in values.items()])

    def first(name: str) -> Column:
        v = F.col(tmp[name])
        return F.struct(
            F.size(v).alias("n"),
            F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double")).alias("s"),
            F.array_min(v).alias("mn"),
            F.array_max(v).alias("mx"),
        )

    def whole(name: str) -> Column:
        m = F.col(name)
        mean = F.try_divide(m["s"], m["n"])
        m2 = F.aggregate(F.col(tmp[name]), F.lit(0.0), lambda acc, x: acc + F.pow(x.cast("double") - mean, 2)) if std else F.lit(None).cast("double")
        return F.struct(m["n"].alias("n"), m["s"].alias("s"), m["mn"].alias("mn"), m["mx"].alias("mx"), m2.alias("m2"))

    df = df.withColumns({name: first(name) for name in values})
    return df.withColumns({name: whole(name) for name in values}).drop(*tmp.values())


def partial_aggs(m: Column, prefix: str) -> list[Column]:
    """Aggregate columns ``<prefix>_{N,S,MN,MX}`` merging moment structs."""
    return [
        F.sum(m["n"]).alias(f"{prefix}_N"),
        F.sum(m["s"]).alias(f"{prefix}_S"),
        F.min(m["mn"]).alias(f"{prefix}_MN"),
        F.max(m["mx"]).alias(f"{prefix}_MX"),
    ]


def _unit(pivot: Column) -> Column:
    """Steps per unit in the cell of a pivot."""
    return F.coalesce(F.pow(F.lit(2.0), F.lit(STEPS) - F.floor(F.log2(F.abs(pivot)))), F.lit(1.0))


def cells(rows: DataFrame, keys: list[str], m: Column, sums: tuple[str, ...] = ()) -> DataFrame:
    """Merge the moment structs ``m`` of ``rows`` into cells: (keys, CELL), and the added up columns ``sums``."""
    mean = F.try_divide(m["s"], m["n"])
    rows = rows.withColumn("_n", m["n"]).withColumn("P", mean * PIVOT - (mean * PIVOT - mean))
    # Means that are no finite numbers have no steps; their m2 makes the deviation NaN.
    step = F.when(F.abs("P") < float("inf"), F.rint((mean - F.col("P")) * _unit(F.col("P"))).cast("decimal(13,0)"))
    rows = rows.withColumn("_d", step).withColumn("_nd", F.col("_n").cast("decimal(10,0)") * F.col("_d"))
    return rows.groupBy(*keys, "P").agg(
        F.sum("_n").alias("N"),
        F.sum(m["s"]).alias("S"),
        F.min(m["mn"]).alias("MN"),
        F.max(m["mx"]).alias("MX"),
        F.sum("_nd").cast("decimal(38,0)").alias("A"),
        F.sum(F.col("_nd") * F.col("_d")).cast("decimal(38,0)").alias("B"),
        F.sum(m["m2"]).alias("Q"),
        *[F.sum(c).alias(c) for c in sums],
    )


def merge_cells(state: DataFrame, keys: list[str]) -> DataFrame:
    """Cells of coarser keys, or of several states: sums of whole numbers, in any order."""
    total = [F.sum(c).alias(c) for c in ("N", "S")] + [F.min("MN").alias("MN"), F.max("MX").alias("MX")]
    total += [F.sum(c).cast("decimal(38,0)").alias(c) for c in ("A", "B")] + [F.sum("Q").alias("Q")]
    return state.groupBy(*keys, "P").agg(*total)


def _met(state: DataFrame) -> DataFrame:
    """Adds ``_c``: of a cell with samples its number, mean and sum of squared deviations."""
    wide = lambda c: c.cast("decimal(38,0)")
    state = state.withColumn("_at", F.rint(F.col("A").cast("double") / F.col("N")).cast("decimal(13,0)")).withColumn("_u", _unit(F.col("P")))
    shift, n = F.col("_at"), F.col("N").cast("decimal(20,0)")
    rest = wide(F.col("A")) - wide(shift * n)
    once = wide(shift * F.col("A"))
    around = wide(F.col("B")) - once - once + wide(wide(shift * shift) * n)
    state = state.withColumn("_r", rest.cast("double")).withColumn("_w", around.cast("double"))
    squares = (F.col("_w") - F.col("_r") * F.col("_r") / F.col("N")) / (F.col("_u") * F.col("_u"))
    mean = F.col("P") + (F.col("_at").cast("double") + F.col("_r") / F.col("N")) / F.col("_u")
    # Where a mean is no finite number, A and B are null and Q is NaN.
    met = F.struct(F.col("N").alias("n"), F.coalesce(mean, F.lit(float("nan"))).alias("mean"), (F.coalesce(F.greatest(squares, F.lit(0.0)), F.lit(0.0)) + F.col("Q")).alias("m2"))
    return state.withColumn("_c", F.when(F.col("N") > 0, met)).drop("_at", "_u", "_r", "_w")


def _deviation(list_: Column) -> Column:
    """Sample standard deviation of a group's cells, around the mean of their means."""
    one = list_[0]["mean"]
    n = F.aggregate(list_, F.lit(0).cast("long"), lambda a, c: a + c["n"])
    mean = one + F.aggregate(list_, F.lit(0.0), lambda a, c: a + c["n"] * (c["mean"] - one)) / n
    squares = F.aggregate(list_, F.lit(0.0), lambda a, c: a + c["m2"] + c["n"] * F.pow(c["mean"] - mean, 2))
    return F.when(n > 1, F.sqrt(squares / (n - 1)))


def statistics(state: DataFrame, keys: list[str], prefixes: list[str], sums: tuple[str, ...] = ()) -> DataFrame:
    """Per group ``<prefix>_{N,S,MN,MX,D}`` from its cells; several prefixes are told
    apart by the number ``_j``. ``sums``: further columns to add up."""
    state, aggs = _met(state), [F.sum(c).alias(c) for c in sums]
    for j, prefix in enumerate(prefixes):
        mine = (lambda c: F.col(c)) if len(prefixes) == 1 else (lambda c, j=j: F.when(F.col("_j") == j, F.col(c)))
        # Bounded: a cell for each upper 8 bits that the means of a group have.
        aggs += [F.sum(mine("N")).alias(f"{prefix}_N"), F.sum(mine("S")).alias(f"{prefix}_S"), F.min(mine("MN")).alias(f"{prefix}_MN"), F.max(mine("MX")).alias(f"{prefix}_MX")]
        aggs.append(F.sort_array(F.collect_list(mine("_c"))).alias(f"{prefix}_L"))
    out = state.groupBy(*keys).agg(*aggs)
    for prefix in prefixes:
        out = out.withColumn(f"{prefix}_D", F.when(F.size(f"{prefix}_L") > 0, _deviation(F.col(f"{prefix}_L")))).drop(f"{prefix}_L")
    return out


def grouped(rows: DataFrame, keys: list[str], moments: dict[str, str], sums: tuple[str, ...] = (), *, std: bool) -> DataFrame:
    """Merge moment structs per group: ``<prefix>_{N,S,MN,MX}`` of each (prefix -> column),
    the added up columns ``sums`` and, with ``std``, the standard deviation ``<prefix>_D``."""
    if not std:
        return rows.groupBy(*keys).agg(*[a for prefix, c in moments.items() for a in partial_aggs(F.col(c), prefix)], *[F.sum(c).alias(c) for c in sums])
    if len(moments) == 1:
        return statistics(cells(rows, keys, F.col(*moments.values()), sums), keys, list(moments), sums)
    # A row per moment struct, not per sample; the further sums go with the first.
    once = lambda j, c: F.col(c) if j == 0 else F.lit(None).cast(rows.schema[c].dataType)
    each = F.array(*[F.struct(F.lit(j).alias("_j"), F.col(c).alias("_m"), *[once(j, x).alias(x) for x in sums]) for j, c in enumerate(moments.values())])
    state = cells(rows.select(*keys, F.inline(each)), [*keys, "_j"], F.col("_m"), sums)
    return statistics(state, keys, list(moments), sums)


def mean_of(prefix: str) -> Column:
    return F.try_divide(F.col(f"{prefix}_S"), F.col(f"{prefix}_N"))


def min_of(prefix: str) -> Column:
    return F.col(f"{prefix}_MN")


def max_of(prefix: str) -> Column:
    return F.col(f"{prefix}_MX")


def stddev_of(prefix: str) -> Column:
    return F.col(f"{prefix}_D")
