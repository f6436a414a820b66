"""SimHash near-duplicates with multi-index hashing.

Fingerprints within ``max_distance`` bits agree, in at least one of ``segments``
equal slices, to within ``max_distance // segments`` bits. So every fingerprint is
stored once per slice under the slice's value and looks up, per slice, all values
of the small Hamming ball around its own. Whatever meets in a slice table is
verified on the complete fingerprints.

Scale: texts are reduced to 8 bytes in one map-side pass and equal fingerprints
are one class, so a text copied a million times is one entry. Lookups meet slice
values, not pairs: a lookup survives only if another fingerprint owns the value.
The members of a slice value are then compared in blocks of ``block`` fingerprints,
block against block in separate tasks, and each block returns a spanning forest of
its links, not the links: a group of n near copies costs comparisons, never n^2 rows.
Joins of fingerprints ask for a merge join: Spark takes exploded rows for as large as
what they come from, 64 times too small here, and would broadcast them.

Defined results: texts that are null or without words have fingerprint zero and
link like any other; repeated rows are separate rows of one class; a null id stays
null and is never a component id unless nothing else is in the component; an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm.components import connected_components
from stallwise.sources.staging import stage

BITS = 64
SEED = 42
# Shingles whose bits are counted at once: bounds memory for very long texts.
CHUNK = 100_000


def fingerprint_of(text: str | None, width: int = 3) -> int:
    """SimHash of the word shingles, repeats included, as an unsigned 64-bit number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[:-1]]]
    last = ends[width - 1 :] or ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(last), CHUNK):
        pairs = zip(starts[at : at + CHUNK], last[at : at + CHUNK])
        hashes = np.array([digest(line[a:b], SEED) for a, b in pairs], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(last), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, width: int = 3) -> Column:
    """The fingerprint as a long with the same bits."""

    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint_of(t.as_py(), width) for t in texts), np.uint64, len(texts))
        return pa.array(found.view(np.int64))

    return prints(text)


def _slices(segments: int) -> list[tuple[int, int]]:
    """(shift, width) of each slice."""
    edges = [BITS * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _ball(segments: int, radius: int) -> Column:
    """All (slice, mask) with one to ``radius`` bits set, as a literal array."""
    masks = []
    for i, (_, width) in enumerate(_slices(segments)):
        for size in range(1, radius + 1):
            masks += [(i, sum(1 << b for b in bits)) for bits in combinations(range(width), size)]
    return F.array(*[F.struct(F.lit(i).alias("slice"), F.lit(m).cast("long").alias("mask")) for i, m in masks])


def _value(segments: int) -> Column:
    """The value of slice ``slice`` of fingerprint ``fp``."""
    out = F.lit(None).cast("long")
    for i, (shift, width) in enumerate(_slices(segments)):
        part = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1 if width < BITS else -1).cast("long"))
        out = F.when(F.col("slice") == i, part).otherwise(out)
    return out


def spanning_links(fingerprints: DataFrame, max_distance: int = 3, segments: int = 2, block: int = 1024) -> DataFrame:
    """Links ``a``, ``b`` that connect exactly what links within ``max_distance`` bits connect.

    ``fingerprints`` has one column ``fp`` of distinct longs.
    """
    radius = max_distance // segments
    slices = F.array(*[F.lit(i) for i in range(segments)])
    stored = fingerprints.select("fp", F.explode(slices).alias("slice")).withColumn("value", _value(segments))
    owners = stored.groupBy("slice", "value").agg(F.expr("count(1) AS own"))

    keys = ["slice", "value"]
    if radius:
        probes = (
            fingerprints.select("fp", F.explode(_ball(segments, radius)).alias("probe"))
            .select("fp", "probe.slice", "probe.mask")
            .withColumn("value", _value(segments).bitwiseXOR(F.col("mask")))
            .drop("mask")
        )
        found = stage(probes.join(owners.hint("merge"), keys).select(*keys, "own", "fp"), "probes")
        extra = found.groupBy(*keys, "own").agg(F.expr("count(1) AS near"))
    else:
        found = None
        extra = owners.selectExpr(*keys, "own", "0L AS near").where("false")
    shared = owners.where("own > 1").selectExpr(*keys, "own", "0L AS near")
    sizes = shared.unionAll(extra).groupBy(*keys).agg(F.max("own").alias("own"), F.max("near").alias("near"))

    # Blocks: owners are cut into rows of the comparison, owners and probes into columns.
    members = stored.withColumn("owner", F.lit(True))
    if found is not None:
        members = members.unionByName(found.drop("own").withColumn("owner", F.lit(False)))
    cut = f"pmod(xxhash64(fp), CAST(ceil(%s / {block}) AS BIGINT))"
    placed = members.join(sizes.hint("merge"), keys).withColumns({
        "r": F.expr(cut % "own"), "c": F.expr(cut % "(own + near)"),
        "rows": F.expr(f"ceil(own / {block}) - 1"), "columns": F.expr(f"ceil((own + near) / {block}) - 1"),
    })
    as_row = placed.where("owner").select(*keys, "r", F.expr("explode(sequence(0L, columns)) AS c"), "fp", F.lit(True).alias("row"))
    as_column = placed.select(*keys, F.expr("explode(sequence(0L, rows)) AS r"), "c", "fp", F.lit(False).alias("row"))
    blocks = (
        as_row.unionByName(as_column)
        .groupBy(*keys, "r", "c")
        .agg(F.expr("collect_list(fp) FILTER (WHERE row) AS left"), F.expr("collect_list(fp) FILTER (WHERE NOT row) AS right"))
        .where("size(left) > 0 AND size(right) > 0 AND NOT (size(left) = 1 AND left = right)")
        .select("left", "right")
    )
    return blocks.mapInArrow(lambda batches: _forests(batches, max_distance), "a long, b long")


def _forests(batches: Iterator[pa.RecordBatch], max_distance: int) -> Iterator[pa.RecordBatch]:
    """Per block a spanning forest of the links between its rows and columns."""
    for batch in batches:
        starts, ends = [], []
        sides = [(c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False)) for c in batch.columns]
        for i in range(batch.num_rows):
            left, right = (values[offsets[i] : offsets[i + 1]].view(np.uint64) for offsets, values in sides)
            a, b = forest(left, right, max_distance)
            starts.append(a)
            ends.append(b)
        if starts:
            pair = [pa.array(np.concatenate(x).view(np.int64)) for x in (starts, ends)]
            yield pa.RecordBatch.from_arrays(pair, ["a", "b"])


def forest(left: np.ndarray, right: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what links from ``left`` to ``right`` connect: at most one per element."""
    near = np.bitwise_count(left[:, None] ^ right[None, :]) <= max_distance
    # Spread the smallest label over links until nothing changes; labels number the rows.
    labels = np.arange(len(left))
    none = len(left)
    while True:
        of_right = np.where(near, labels[:, None], none).min(0)
        of_left = np.minimum(labels, np.where(near, of_right[None, :], none).min(1))
        if (of_left == labels).all():
            break
        labels = of_left
    hit = of_right < none
    a = np.concatenate([left, right[hit]])
    b = np.concatenate([left[labels], left[of_right[hit]]])
    return a[a != b], b[a != b]


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, max_distance: int = 3, segments: int = 2
) -> DataFrame:
    """``id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable), one row per row."""
    prints = stage(docs.select(F.col(id).alias("id"), fingerprint(F.col(text), width).alias("fp")), "fingerprints")
    return components_of(prints, max_distance, segments).select(
        F.col("id").alias(id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def components_of(prints: DataFrame, max_distance: int = 3, segments: int = 2) -> DataFrame:
    """Adds ``component_id``, the smallest ``id`` reachable, to a staged table with ``id`` and ``fp``."""
    classes = stage(prints.groupBy("fp").agg(F.min("id").alias("first")), "classes")
    links = spanning_links(classes.select("fp"), max_distance, segments)
    roots = connected_components(links).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    rooted = classes.join(roots.hint("merge"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(rooted.join(smallest.hint("merge"), "root").select("fp", "component_id").hint("merge"), "fp")


def one_per_component(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, max_distance: int = 3, segments: int = 2
) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, of equal ids the first row. All columns stay."""
    names = {c: f"_d{i}" for i, c in enumerate(docs.columns)}
    table = stage(
        docs.select(
            *[F.col(c).alias(n) for c, n in names.items()], fingerprint(F.col(text), width).alias("fp"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "fingerprinted",
    )
    key = F.struct(F.col(names[id]).isNull().alias("none"), F.col(names[id]).alias("id"), "row")
    rooted = components_of(table.select(key.alias("id"), "fp"), max_distance, segments)
    kept = rooted.where("id = component_id").select(F.col("id.row").alias("row"))
    return table.join(kept.hint("merge"), "row", "left_semi").select(*[F.col(n).alias(c) for c, n in names.items()])
