"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to ``bits`` bits: text by its hash, numbers by their
logarithm (sign, exponent and leading digits, so that any range fits). The Hilbert
index of the cell orders the rows, and the order is cut into runs of equal length.
Neighbouring cells of the curve are neighbours in every dimension, so a shard, and
every file of it, covers a small box, and readers skip files by the minimum and
maximum of the quantised columns written with them.

Everything is built-in DataFrame functions. Rows are sorted by range partitioning
on (curve index, id, row number), so a cell with a third of all rows is cut like
any other. Global positions come from positions inside the sorted partitions and
one total per partition. Only ids, sizes and checksums are moved, not the texts.

The law is ``rows``: row r of n goes to shard floor(r * shards / n), so counts are
at most one apart. A row's shard depends on all rows; nothing is kept when shards
are added, and ``grown_shard`` is null.

Defined results: null texts have size 1 and checksum 0; null dimensions are cell 0;
ties in the curve are ordered by id, null ids first, and equal rows in any order; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallwise.sources.staging import stage


def quantised(df: DataFrame, column: str, bits: int) -> Column:
    """A dimension as a whole number below 2^bits; null is 0."""
    cells = 1 << bits
    if isinstance(df.schema[column].dataType, T.NumericType):
        # Steps of the logarithm, negative numbers below the middle cell: the order stays.
        value = F.col(column).cast("double")
        steps = F.floor(F.log2(F.abs(value) + 1) * F.lit(cells / 64.0))
        cell = F.least(steps, F.lit(cells // 2 - 1)) * F.signum(value) + cells // 2
        return F.coalesce(F.nanvl(cell.cast("double"), F.lit(0.0)).cast("int"), F.lit(0))
    return F.when(F.col(column).isNull(), 0).otherwise(F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(cells)).cast("int"))


def with_curve(df: DataFrame, dims: Sequence[str], bits: int, name: str = "curve") -> DataFrame:
    """Adds the Hilbert index of whole-number columns ``dims`` below 2^bits.

    Skilling's transform (2004), one projection per exchange step: undo the
    rotations from the highest bit down, take the Gray code, interleave the bits.
    """
    n = len(dims)
    if n * bits > 62:
        raise ValueError("dimensions and bits do not fit a long")
    axes = [f"_x{i}" for i in range(n)]
    df = df.withColumns({a: F.col(d).cast("long") for a, d in zip(axes, dims)})
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(n):
            x0, xi = F.col(axes[0]), F.col(axes[i])
            is_set = xi.bitwiseAND(F.lit(bit)) != 0
            exchange = x0.bitwiseXOR(xi).bitwiseAND(F.lit(low))
            new = {axes[0]: F.when(is_set, x0.bitwiseXOR(F.lit(low))).otherwise(x0.bitwiseXOR(exchange))}
            if i:
                new[axes[i]] = F.when(is_set, xi).otherwise(xi.bitwiseXOR(exchange))
            df = df.withColumns(new)
    for i in range(1, n):
        df = df.withColumn(axes[i], F.col(axes[i]).bitwiseXOR(F.col(axes[i - 1])))
    flip = F.lit(0).cast("long")
    for level in range(bits - 1, 0, -1):
        flip = flip.bitwiseXOR(F.when(F.col(axes[-1]).bitwiseAND(F.lit(1 << level)) != 0, (1 << level) - 1).otherwise(0).cast("long"))
    df = df.withColumn("_flip", flip)
    index = F.lit(0).cast("long")
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            bit = F.shiftright(F.col(axis).bitwiseXOR(F.col("_flip")), level).bitwiseAND(F.lit(1))
            index = F.shiftleft(index, 1).bitwiseOR(bit)
    return df.withColumn(name, index).drop(*axes, "_flip")


def ranked(df: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """The rows with their position from 0 in a total order, staged; ties in any order."""
    placed = stage(
        df.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*order, "_row")
        .sortWithinPartitions(*order, "_row")
        .drop("_row")
        .withColumn("_at", F.monotonically_increasing_id()),
        "ordered",
    )
    # The identifier is partition number * 2^33 + position in the partition.
    part, position = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumns({"_part": part, "_position": position})
    sizes = placed.groupBy("_part").agg(F.expr("count(1) AS _n"))
    # One row per partition.
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_position")).drop(
        "_at", "_part", "_position", "_before"
    )


def assign_shards(
    docs: DataFrame, dims: Sequence[str], shards: int = 16, bits: int = 5, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id``, ``size``, ``text_crc32``, the cells ``q_<dim>``, ``curve``, ``shard``, ``slot``, ``law``, ``grown_shard``."""
    cells = {f"q_{d}": quantised(docs, d, bits) for d in dims}
    body = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    rows = docs.select(
        F.col(id).alias("id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        *[c.alias(n) for n, c in cells.items()],
    )
    order = ranked(with_curve(rows, list(cells), bits), ["curve", "id"])
    total = order.agg(F.expr("count(1) AS n")).scalar()
    # The first position of shard s is ceil(s * total / shards).
    return (
        order.withColumn("_total", total)
        .withColumn("shard", F.expr(f"(rank * {shards}) div _total"))
        .select(
            F.col("id").alias(id), "size", "text_crc32", *cells, "curve", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
            F.expr(f"rank - ((shard * _total + {shards - 1}) div {shards})").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def write_shards(docs: DataFrame, path: str, dims: Sequence[str], shards: int = 16, bits: int = 5, id: str = "doc_id", text: str = "text", files_per_shard: int = 1) -> None:
    """Write whole documents along the curve: folders ``shard=``, files that are runs of the curve.

    The quantised columns ``q_<dim>`` are written too; ``cell_filter`` uses their
    statistics to skip files. Documents that have a column ``shard`` or ``q_<dim>`` are
    an error; all other columns stay as they are, whatever their names.
    """
    cells = {f"q_{d}": quantised(docs, d, bits) for d in dims}
    if taken := sorted({"shard", *cells} & set(docs.columns)):
        raise ValueError(f"columns are written under these names: {taken}")
    names = {c: f"_d{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], *[c.alias(n) for n, c in cells.items()])
    order = ranked(with_curve(rows, list(cells), bits, "_curve"), ["_curve", names[id]], "_rank")
    runs = shards * files_per_shard
    out = order.withColumn("_total", order.agg(F.expr("count(1) AS n")).scalar())
    out = out.withColumn("_run", F.expr(f"(_rank * {runs}) div _total")).withColumn("shard", F.expr(f"CAST((_rank * {shards}) div _total AS INT)"))
    (
        out.repartitionByRange(runs, "_run").sortWithinPartitions("_run", "_rank")
        .select(*[F.col(n).alias(c) for c, n in names.items()], *cells, "shard").write.partitionBy("shard").parquet(path)
    )


def cell_filter(stored: DataFrame, dim: str, value, bits: int = 5) -> Column:
    """Condition on the quantised column that rows with ``value`` meet: it prunes files."""
    wanted = stored.sparkSession.createDataFrame([(value,)], T.StructType([stored.schema[dim]]))
    return F.col(f"q_{dim}") == wanted.select(quantised(wanted, dim, bits)).first()[0]
