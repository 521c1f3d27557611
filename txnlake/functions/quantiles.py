"""Exact interpolated quantiles of large columns, by radix refinement.

Each wanted place lies in a bracket of values, at first the whole range of its group. A pass counts
the rows of each open bracket in many bins that never fall as the value grows, with the smallest
and largest value of each bin, in partial sums. The bin that holds the place is its next bracket, until
a bracket is one value. So a pass moves a few thousand rows for each bracket, no task ranks or
merges a group, and nothing is estimated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnlake.functions.jobs import written

#: Bins of a bracket in one pass.
BINS = 4096
#: Brackets whose ends are further apart than this factor get bins of equal ratio.
RATIO = 4096.0
#: Rows that callers may have ranked in one window instead, see `small`.
WHOLE = 1_000_000


def unpivoted(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (feature, value) over several numeric columns."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "feature", "value")


def quantiles(df: DataFrame, value: str, by: list[str], shares: list[float],
              few_groups: bool = False, small: bool = False) -> DataFrame:
    """Rows (by..., share, quantile) for each share in `shares`, linearly interpolated.

    The place of share q among n rows is q*(n-1). `few_groups` says that the number of groups
    is known to be small, so tables with one row per group may be broadcast. `small` says that
    df was counted and has at most WHOLE rows, so it can be ranked in one pass.
    """
    sized = F.broadcast if few_groups or not by else (lambda table: table)
    # A struct as the key lets a null group meet itself in a join.
    group = F.struct(*by) if by else F.struct(F.lit(1).alias("all"))
    rows = df.filter(F.col(value).isNotNull()).select(
        group.alias("_g"), F.col(value).cast("double").alias("_v"))

    ends = [(q, f"{edge}(double('{float(q)!r}') * (_n - 1))", f"_{edge}{i}")
            for i, q in enumerate(shares) for edge in ("floor", "ceil")]
    if small:
        ranked = _ranked(rows).withColumn("_n", F.sum("_copies").over(Window.partitionBy("_g")))
        found = ranked.groupBy("_g").agg(F.max("_n").alias("_n"), *[F.expr(
            f"max(CASE WHEN {place} >= _upto - _copies AND {place} < _upto THEN _v END)").alias(name) for _, place, name in ends])
    else:
        found = _refined(rows, [place for _, place, _ in ends], sized).select(
            "_g", "_n", *[F.expr(f"_at[cast({place} AS long)]").alias(name) for _, place, name in ends])

    place = [f"(double('{float(q)!r}') * (_n - 1))" for q in shares]
    # Interpolate from the nearer end.
    result = """CASE
        WHEN {t} >= 0.5D THEN _ceil{i} - (_ceil{i} - _floor{i}) * (1 - {t})
        ELSE _floor{i} + (_ceil{i} - _floor{i}) * {t} END"""
    pairs = ", ".join(
        f"named_struct('share', double('{float(q)!r}'), 'quantile', "
        f"{result.format(i=i, t=f'({p} - floor({p}))')})"
        for i, (q, p) in enumerate(zip(shares, place, strict=True)))
    return found.select("_g", F.expr(f"explode(array({pairs}))").alias("_q")).select(
        *[F.col(f"_g.{c}") for c in by], "_q.share", "_q.quantile")


def _ranked(rows: DataFrame) -> DataFrame:
    """Values with their copies and the number of rows up to them, per group."""
    counted = rows.groupBy("_g", "_v").agg(F.count("*").alias("_copies"))
    upto = F.sum("_copies").over(
        Window.partitionBy("_g").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    return counted.withColumn("_upto", upto)


def _bin() -> Column:
    """The bin of _v in the bracket _b: its ends have bins of their own, what lies between never falls."""
    return F.expr(f"""CASE WHEN _v = _b.low THEN 0 WHEN _v = _b.high THEN {BINS - 1}
        ELSE 1 + cast(floor({BINS - 2 - 1e-6} * greatest(0D, least(1D, nanvl(coalesce(CASE
            WHEN _b.low > 0 AND ln(_b.high) - ln(_b.low) > ln({RATIO}D) THEN (ln(_v) - ln(_b.low)) / (ln(_b.high) - ln(_b.low))
            WHEN _b.high < 0 AND ln(-_b.low) - ln(-_b.high) > ln({RATIO}D) THEN 1 - (ln(-_v) - ln(-_b.high)) / (ln(-_b.low) - ln(-_b.high))
            ELSE try_divide(_v / 2 - _b.low / 2, _b.high / 2 - _b.low / 2) END, 0D), 0D)))) AS int) END""")


def _refined(rows: DataFrame, places: list[str], sized) -> DataFrame:
    """(_g, _n, _at): the values at some places of each group, as a map from the place.

    places are expressions of _n. A pass has a row for each bin of each open bracket, at most BINS for
    a bracket and one bracket for a place.
    """
    ranks = F.expr(f"array_distinct(array({', '.join(f'cast({place} AS long)' for place in places)}))")
    whole = rows.groupBy("_g").agg(F.count("*").alias("_n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
    sizes = written(whole, "groups")
    brackets = sizes.select("_g", F.struct("low", "high", F.lit(0).cast("long").alias("before"), ranks.alias("ranks")).alias("_b"))
    done = []
    while True:
        done.append(brackets.filter("_b.low <=> _b.high"))
        opened = brackets.filter("NOT _b.low <=> _b.high")
        if opened.isEmpty():
            break
        # At most one bracket for each place.
        by_group = opened.groupBy("_g").agg(F.collect_list("_b").alias("_bs"))
        inside = rows.join(sized(by_group), "_g").withColumn("_b", F.get(F.filter(
            "_bs", lambda one: F.col("_v").between(one["low"], one["high"])), F.lit(0))).filter("_b IS NOT NULL")
        bins = inside.groupBy("_g", F.col("_b.before").alias("_from"), F.col("_b.ranks").alias("_ranks"), _bin().alias("_bin")).agg(
            F.count("*").alias("_rows"), F.min("_v").alias("low"), F.max("_v").alias("high"))
        earlier = Window.partitionBy("_g", "_from").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("before", F.col("_from") + F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        held = F.filter("_ranks", lambda rank: (rank >= F.col("before")) & (rank < F.col("before") + F.col("_rows")))
        brackets = written(bins.withColumn("ranks", held).filter(F.size("ranks") > 0).select(
            "_g", F.struct("low", "high", "before", "ranks").alias("_b")), "brackets")
    values = reduce(DataFrame.unionByName, done).select("_g", F.explode("_b.ranks").alias("_rank"), F.col("_b.low").alias("_v"))
    at = values.groupBy("_g").agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))
    return sizes.select("_g", "_n").join(sized(at), "_g")
