"""Exact, linearly interpolated quantiles by distributed radix selection.

Every double has a 64-bit key of the same order. A round counts the rows of each
group per next 21 or 22 bits of the key and keeps, for every wanted rank, the one cell
that holds it; three rounds reach single values. Most ranks end sooner: the lowest
and the highest value of a cell are known, so a cell of one or two values, or a rank
at its edge, needs no further round.

Groups of every size, and any number of them, can go this way. The first round reads
the rows and combines map-side; only rows in cells with undecided ranks go on, as
different values with a count, dealt out by (group, value), so neither a hot group
nor a hot value meets in one task. What is sorted per group are its cells: a thousand
per power of two that its values span, four million at most. Wanted cells are joined
by (group, cell); the caller may know them to be few. Nothing runs before the result is asked
for. Aggregates with quantiles send only large groups this way; the rows of small ones
meet in a task (``by_group_size``), with the same results.

Null and NaN are ignored, negative zero is zero, infinities are values. Between two
values the result is interpolated as ``percentile`` does it, to the last bit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Groups are counted by this many hashes of their keys; a group whose hash has more rows is spread over tasks.
HASHES, GATHERED_ROWS = 2**18, 10_000
# Groups whose wanted cells, two per quantile, may be broadcast.
FEW = 20_000
# Bits of the key left after each round.
ROUNDS = (42, 21, 0)
# Smallest normal double, and how many doubles there are between two powers of two.
NORMAL, PER_OCTAVE = 2.0**-1022, 2**52


def _number(value: str) -> str:
    """A column as ranked values: doubles, neither NaN nor negative zero."""
    return f"CASE WHEN NOT isnan(CAST(`{value}` AS DOUBLE)) THEN CAST(`{value}` AS DOUBLE) + 0.0D END"


def with_order_key(df: DataFrame, value: str, name: str = "_key") -> DataFrame:
    """Adds a long that orders doubles as they are ordered, one step per double; not for NaN.

    The exponent comes from a logarithm that may be off by one near powers of two
    and is put right by the quotient; powers of two and quotients by them are exact.
    Step by step, so that each is worked out once.
    """
    quotient = f"abs(`{value}`) / pow(2D, _about)"
    normal = f"(_exponent + 1023) * {PER_OCTAVE}L + CAST((abs(`{value}`) / pow(2D, _exponent) - 1) * {PER_OCTAVE}D AS BIGINT)"
    size = f"""CASE WHEN abs(`{value}`) < {NORMAL!r}D THEN CAST(abs(`{value}`) / 4.9E-324D AS BIGINT)
        WHEN abs(`{value}`) = double('inf') THEN {2047 * PER_OCTAVE}L ELSE {normal} END"""
    return (
        df.selectExpr("*", f"floor(log2(least(abs(`{value}`), 1.7976931348623157E308D))) AS _about")
        .selectExpr("*", f"{quotient} AS _quotient")
        .selectExpr("*", "_about + CASE WHEN _quotient >= 2 THEN 1 WHEN _quotient < 1 THEN -1 ELSE 0 END AS _exponent")
        .selectExpr("*", f"{size} AS _size")
        .selectExpr(*[f"`{c}`" for c in df.columns], f"CASE WHEN `{value}` < 0 THEN -_size ELSE _size END AS `{name}`")
    )


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    """Join condition: equal columns, nulls included."""
    return F.expr(" AND ".join(f"{left}.`{c}` <=> {right}.`{c}`" for c in columns))


def group_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], few: bool = False) -> DataFrame:
    """Quantiles per group, one row per (keys, prob): columns keys, ``prob``, ``value``.

    Groups without values give no row. Keys may be null: null is a group. With ``few``
    groups, known to be at most ``FEW``, the wanted cells are broadcast and no rows move
    to meet them.
    """
    keys = list(keys)
    quoted = [f"`{k}`" for k in keys]
    rows = with_order_key(df.selectExpr(*quoted, f"{_number(value)} AS _v").where("_v IS NOT NULL"), "_v").selectExpr("*", "1L AS _n")
    # First round: the ranks of a group follow from its size.
    ranks = ", ".join(
        f"named_struct('prob', {p!r}D, 'end', {end}, 'rank', CAST({cut}({p!r}D * (_rows - 1)) AS BIGINT))"
        for p in sorted({float(p) for p in probs}) for end, cut in ((0, "floor"), (1, "ceil"))
    )
    group = ", ".join(quoted) or "NULL"
    cells = _cells(rows, keys, ROUNDS[0]).selectExpr("*", f"sum(_n) OVER (PARTITION BY {group}) AS _rows")
    found = [_hits(cells.selectExpr("*", f"array({ranks}) AS _wanted"), keys)]
    for shift, before in zip(ROUNDS[1:], ROUNDS):
        wanted = (
            found[-1].where("_value IS NULL").groupBy(*keys, "_rows", "_cell")
            .agg(F.expr("sort_array(collect_list(named_struct('prob', prob, 'end', end, 'rank', rank))) AS _wanted"))
            .withColumnRenamed("_cell", "_parent")
        )
        wanted = F.broadcast(wanted) if few else wanted
        inside = rows.withColumn("_parent", F.shiftright("_key", before)).alias("r").join(
            wanted.alias("w"), _same("r", "w", [*keys, "_parent"])
        ).select("r.*", "_rows", "_wanted")
        if before == ROUNDS[0]:
            # The last round starts from the different values in these cells.
            inside = inside.groupBy(*[c for c in inside.columns if c != "_n"]).agg(F.sum("_n").alias("_n"))
            rows = inside.drop("_parent", "_rows", "_wanted")
        found.append(_hits(_cells(inside, [*keys, "_parent", "_rows", "_wanted"], shift), keys))
    ends = found[0].where("_value IS NOT NULL").select(*keys, "_rows", "prob", "end", "_value")
    for more in found[1:]:
        ends = ends.unionByName(more.where("_value IS NOT NULL").select(*keys, "_rows", "prob", "end", "_value"))
    at, low, high = "(prob * (_rows - 1))", "max(CASE WHEN end = 0 THEN _value END)", "max(CASE WHEN end = 1 THEN _value END)"
    return (
        ends.groupBy(*keys, "_rows", "prob").agg(F.expr(f"{low} AS _lo"), F.expr(f"{high} AS _hi"))
        .selectExpr(*quoted, "prob", f"CASE WHEN _lo = _hi THEN _lo ELSE (ceil{at} - {at}) * _lo + ({at} - floor{at}) * _hi END AS value")
    )


def _cells(rows: DataFrame, keys: Sequence[str], shift: int) -> DataFrame:
    """Per (keys, ``_cell``): rows, rows in earlier cells of the keys, lowest and highest value."""
    group = ", ".join(f"`{k}`" for k in keys) or "NULL"
    return (
        rows.groupBy(*keys, F.shiftright("_key", shift).alias("_cell"))
        .agg(F.sum("_n").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
        .selectExpr("*", f"sum(_n) OVER (PARTITION BY {group} ORDER BY _cell) - _n AS _before")
    )


def _hits(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The wanted ranks that fall into each cell, counted from its start, with their value where it is known."""
    inside = "filter(_wanted, w -> w.rank >= _before AND w.rank < _before + _n)"
    return (
        cells.selectExpr(*[f"`{k}`" for k in keys], "_rows", "_cell", "_n", "_min", "_max", "_before", f"inline({inside})")
        .withColumn("rank", F.expr("rank - _before"))
        .withColumn("_value", F.expr("CASE WHEN rank = 0 THEN _min WHEN rank = _n - 1 OR _min = _max THEN _max END"))
        .drop("_n", "_min", "_max", "_before")
    )


def unpivoted(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Long form (keys, ``column``, ``value``) of numeric columns."""
    cells = [f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns]
    return df.selectExpr(*[f"`{k}`" for k in keys], f"stack({len(columns)}, {', '.join(cells)}) AS (column, value)")


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Whole-table quantiles of several columns: ``column``, ``prob``, ``value``."""
    return group_quantiles(unpivoted(df, columns), ["column"], "value", probs, few=True)


def quantile_row(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """One row with one named column per wanted (column, probability)."""
    columns = sorted({c for c, _ in wanted.values()})
    probs = sorted({p for _, p in wanted.values()})
    found = column_quantiles(df, columns, probs)
    return found.agg(*[F.expr(f"{_value_of(c, p)} AS `{name}`") for name, (c, p) in wanted.items()])


def _value_of(column: str, prob: float) -> str:
    """Aggregate expression: one quantile out of a long table of them."""
    return f"max(CASE WHEN column = '{column}' AND prob = {float(prob)!r}D THEN value END)"


def with_row(df: DataFrame, name: str, row: DataFrame) -> DataFrame:
    """Give every row of ``df`` a one-row table as a struct column: one scalar subquery, no join."""
    return df.withColumn(name, row.select(F.struct(*row.columns).alias("_row")).scalar())


def quantiles_by_key(df: DataFrame, keys: Sequence[str], quantiles: dict[str, tuple[str, float]], few: bool = False) -> DataFrame:
    """One row per group with a value: keys and one column per quantile ``{name: (column, prob)}``."""
    columns = sorted({c for c, _ in quantiles.values()})
    probs = sorted({p for _, p in quantiles.values()})
    found = group_quantiles(unpivoted(df, columns, keys), [*keys, "column"], "value", probs, few)
    return found.groupBy(*keys).agg(*[F.expr(f"{_value_of(c, p)} AS `{name}`") for name, (c, p) in quantiles.items()])


def quantile_aggregates(quantiles: dict[str, tuple[str, float]]) -> list[Column]:
    """The same quantiles as aggregates, whose state holds a group's different values."""
    return [F.expr(f"percentile({_number(c)}, {float(p)!r}D)").alias(name) for name, (c, p) in quantiles.items()]


def ranked_aggregates(
    rows: DataFrame, keys: Sequence[str], quantiles: dict[str, tuple[str, float]], distinct: dict[str, str]
) -> tuple[DataFrame, list[Column]]:
    """Counts of distinct values, and the same quantiles, of groups whose rows are in one task.

    (rows with ranks, aggregates over them): rows are sorted by group and value once per column, so
    that an aggregate's state is a few numbers, however many groups there are.
    """
    group = Window.partitionBy(*keys)
    found = []
    for name, column in distinct.items():
        rows = rows.withColumn(f"_rank_{column}", F.dense_rank().over(group.orderBy(F.col(column).asc_nulls_last())))
        last = F.max(F.when(F.col(column).isNotNull(), F.col(f"_rank_{column}")))
        found.append(F.coalesce(last, F.lit(0)).cast("long").alias(name))
    for name, (column, prob) in quantiles.items():
        value, at, n = f"_v_{column}", f"_at_{column}", f"_n_{column}"
        if value not in rows.columns:
            ranked = group.orderBy(F.col(value).asc_nulls_last())
            rows = rows.withColumn(value, F.expr(_number(column))).withColumns({
                at: F.row_number().over(ranked) - 1,
                n: F.count(value).over(ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
            })
        here, end = f"({float(prob)!r}D * (`{n}` - 1))", f"({float(prob)!r}D * (max(`{n}`) - 1))"
        low, high = (f"max(CASE WHEN `{at}` = {cut}{here} THEN `{value}` END)" for cut in ("floor", "ceil"))
        between = f"(ceil{end} - {end}) * {low} + ({end} - floor{end}) * {high}"
        found.append(F.expr(f"CASE WHEN {low} = {high} THEN {low} ELSE {between} END").alias(name))
    return rows, found


def by_group_size(
    df: DataFrame, keys: Sequence[str], gathered: Callable[[DataFrame], DataFrame], spread: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``gathered`` on the groups of ``keys`` that fit a task, ``spread`` on the others, put together.

    Both have to give the same columns and, for a group, the same row. Rows of small groups move once,
    as they are, to the task of their group: aggregates that follow move nothing more. Rows are
    counted by a hash of the keys, as a few numbers per task; groups that share a hash
    with more than ``GATHERED_ROWS`` rows count as large, so all groups of a task that are held at once
    stay small. At most one hash in ``GATHERED_ROWS`` rows is large: their list is broadcast.
    Beyond ``HASHES`` times ``GATHERED_ROWS`` rows all groups go the second way.
    """
    keys = list(keys)
    place = F.pmod(F.xxhash64(*keys), F.lit(HASHES)).cast("int").alias("_hash")
    rows = df.select("*", place)
    crowded = F.broadcast(rows.groupBy("_hash").agg(F.expr("count(1) AS _n")).where(f"_n > {GATHERED_ROWS}").select("_hash"))
    small = rows.join(crowded, "_hash", "left_anti").drop("_hash").repartition(*keys)
    large = rows.join(crowded, "_hash", "left_semi").drop("_hash")
    return gathered(small).unionByName(spread(large))


def aggregate_with_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    quantiles: dict[str, tuple[str, float]],
    distinct: dict[str, str] | None = None,
) -> DataFrame:
    """``groupBy(keys).agg(...)`` plus exact quantiles ``{name: (column, prob)}`` and distinct values ``{name: column}``.

    The aggregates must merge from small partial states. Null keys form a group;
    filter them first where they should not.
    """
    keys, distinct = list(keys), distinct or {}

    def gathered(rows: DataFrame) -> DataFrame:
        rows, ranked = ranked_aggregates(rows, keys, quantiles, distinct)
        return rows.groupBy(*keys).agg(*aggregates, *ranked)

    def spread(rows: DataFrame) -> DataFrame:
        return spread_with_quantiles(rows, keys, [*aggregates, *[F.count_distinct(c).alias(name) for name, c in distinct.items()]], quantiles)

    return by_group_size(df, keys, gathered, spread)


def spread_with_quantiles(
    df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], quantiles: dict[str, tuple[str, float]]
) -> DataFrame:
    """``aggregate_with_quantiles`` for groups of any size."""
    keys = list(keys)
    base = df.groupBy(*keys).agg(*aggregates)
    found = quantiles_by_key(df, keys, quantiles)
    joined = base.alias("b").join(found.alias("q"), _same("b", "q", keys), "left")
    return joined.select(*[F.col(f"b.`{c}`") for c in base.columns], *[F.col(f"q.`{n}`") for n in quantiles])
