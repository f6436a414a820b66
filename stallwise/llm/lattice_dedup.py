"""Embedding near-duplicates by hashing on the E8 lattice.

Unit vectors are turned by a random rotation and cut into blocks of 8 coordinates,
one lattice table per block. Vectors with cosine ``threshold`` or more are at most
sqrt(2 - 2 threshold) apart, so in at least one of the ``t`` tables their blocks are
at most r = sqrt((2 - 2 threshold) / t) apart. In each table a vector is stored under
its nearest E8 point and under every neighbouring point whose cell comes within r/2,
so the cell of the midpoint of such a pair holds both: no link is missed. Every point
is within 1 of its nearest lattice point, so neighbours up to 2 + r/2 away, in lattice
units, are looked at; a ``cell`` so small that this asks for norm 10 or more is an
error. What meets in a cell is verified by cosine in double precision.

Cells meet twice. First only 8 bytes per vector and cell do: its place in the cell, one
byte a coordinate. Vectors without another one within r of them, allowing for the
rounding of both places, or whose midpoints surely lie in other cells, are done there.
Only the rest meet again whole and are verified.

A pair may meet in several cells. It is counted where it must meet: in its first
table with blocks within r, in the cell of the midpoint. So links per vector are
exact sums, and pairs never leave the cell: a cell returns, per vector, its number
of links and one link of a spanning forest.

Scale: equal vectors are one class with a weight before anything else, so a vector
copied a million times is stored once. Cells with more than about ``block`` classes are
cut into blocks, compared block against block in separate tasks. How many blocks a cell
needs is told by a sixteenth of the classes, picked by hash; that moves work between
tasks and changes no result. Smaller ``cell`` means more cells per vector and fewer
comparisons; results do not depend on it either.

Defined results: a vector links only within its label and its length; null labels,
null, empty or zero vectors and vectors with null or non-finite components link with
nothing. Repeated rows are separate vectors, linked with each other. A null id stays
null; it counts as a link partner but is no component id unless nothing else is
there. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm.components import connected_components
from stallwise.sources.staging import stage

E8 = 8
# Rows decoded at once.
CHUNK = 4096
# Blocks with as many members are compared as a matrix, smaller ones together.
DENSE = 48
# One class of so many tells which cells are cut into blocks.
SAMPLE = 16
# Longest neighbours looked at; there are 17,520 of norm 8.
MAX_NORM = 8


@cache
def neighbours() -> tuple[np.ndarray, np.ndarray]:
    """The 240 shortest and the 2,160 next vectors of the lattice, norms 2 and 4."""
    short = []
    for i, j in combinations(range(E8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            short.append(np.eye(E8)[i] * a + np.eye(E8)[j] * b)
    short += [np.array(s) for s in product((0.5, -0.5), repeat=E8) if sum(x < 0 for x in s) % 2 == 0]
    near = np.array(short)
    sums = {tuple(s) for v in near for s in v + near if s @ s == 4}
    return near, np.array(sorted(sums))


@cache
def shell(norm: int) -> np.ndarray:
    """All lattice vectors of an even norm: each is one of the norm before plus a shortest one."""
    if norm <= 4:
        return neighbours()[norm // 2 - 1]
    before = shell(norm - 2)
    sums = {tuple(s) for v in neighbours()[0] for s in (before + v)[((before + v) ** 2).sum(1) == norm]}
    return np.array(sorted(sums))


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest whole-number point with an even sum: round, then mend the worst coordinate."""
    point = np.rint(x)
    row, worst = np.arange(len(x)), np.abs(x - point).argmax(1)
    step = np.where(x[row, worst] >= point[row, worst], 1.0, -1.0)
    point[row, worst] += np.where(point.sum(1) % 2 != 0, step, 0.0)
    return point


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point: the better of the whole and the half-shifted candidates."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


@cache
def _mixers() -> np.ndarray:
    return np.random.default_rng(8).integers(1, 2**63, E8, dtype=np.uint64) | np.uint64(1)


def cell_number(points: np.ndarray) -> np.ndarray:
    """64-bit number of lattice points; a collision only makes a cell larger."""
    mixed = ((points * 2).astype(np.int64).view(np.uint64) * _mixers()).sum(1, dtype=np.uint64)
    mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


@cache
def rotation(dims: int, seed: int) -> np.ndarray:
    """Random rotation of ``dims`` coordinates, padded by zeros to whole blocks."""
    size = -(-dims // E8) * E8
    return np.linalg.qr(np.random.default_rng(seed + dims).normal(size=(size, size)))[0][:dims]


def rotated(vectors: np.ndarray, seed: int) -> np.ndarray:
    """Unit vectors, rotated: (rows, tables, 8)."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(1, keepdims=True)
    unit = wide / np.sqrt((wide * wide).sum(1, keepdims=True))
    return (unit @ rotation(vectors.shape[1], seed)).reshape(len(vectors), -1, E8)


class Geometry:
    """Radius and cell size in lattice units for vectors of ``dims`` components."""

    def __init__(self, dims: int, threshold: float, cell: float, seed: int):
        self.tables = -(-dims // E8)
        self.size = cell / np.sqrt(self.tables * E8)
        self.seed = seed
        # A hair wider than the bound, so that rounding loses nothing.
        self.radius = np.sqrt((2 - 2 * threshold) / self.tables) * (1 + 1e-9) + 1e-12
        self.reach = self.radius / self.size / 2
        self.norms = [n for n in range(2, 12, 2) if n <= max(4, (2 + self.reach) ** 2)]
        if self.norms[-1] > MAX_NORM:
            least = cell * self.reach / (np.sqrt(MAX_NORM + 2) - 2)
            raise ValueError(f"cell {cell} is too small for threshold {threshold}: at least {least:.3f} is needed")

        # Longest way from a vector to the middle of a cell it is stored in.
        self.step = np.sqrt(1 + 2 * self.reach * np.sqrt(self.norms[-1])) / 127
        # How far a place in a cell may be off by rounding.
        self.off = np.sqrt(E8) * self.step / 2 + 1e-6

    def memberships(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, table, cell, place in the cell) for each cell within half the radius."""
        blocks = rotated(vectors, self.seed) / self.size
        shells = [shell(n) for n in self.norms]
        # Pieces no longer than the first two shells, so that the products stay small.
        offsets = [np.zeros((1, E8)), *(s[at : at + 2160] for s in shells for at in range(0, len(s), 2160))]
        rows, tables, cells, places = [], [], [], []
        for t in range(self.tables):
            home = decode(blocks[:, t])
            aside = blocks[:, t] - home
            for vectors_ in offsets:
                norm = np.sqrt((vectors_[0] ** 2).sum())
                # Distance to the plane halfway to the neighbour is at most the reach.
                row, other = np.nonzero(aside @ vectors_.T >= norm * norm / 2 - self.reach * norm)
                rows.append(row)
                tables.append(np.full(len(row), t, np.int32))
                cells.append(cell_number(home[row] + vectors_[other]))
                places.append(np.rint((aside[row] - vectors_[other]) / self.step).astype(np.int8).view(np.int64)[:, 0])
        return np.concatenate(rows), np.concatenate(tables), np.concatenate(cells), np.concatenate(places)


def cell_key(label: np.ndarray, dims: int, table: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """One number for a cell of a table, label and length; a collision only makes a cell larger."""
    mixed = cell.view(np.uint64) ^ (np.asarray(table, np.uint64) << np.uint64(32)) ^ np.uint64(dims)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * _mixers()[0] + label.view(np.uint64)
    return ((mixed ^ (mixed >> np.uint64(32))) * _mixers()[1]).view(np.int64)


def _vectors(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)


def _cells(batches: Iterator[pa.RecordBatch], threshold: float, cell: float, seed: int) -> Iterator[pa.RecordBatch]:
    """(class, label, vector) rows to (class, dims, table, key, place) rows."""
    for batch in batches:
        number, label = batch["class"].to_numpy(), batch["label"].to_numpy()
        offsets, values = _vectors(batch["vector"])
        lengths = np.diff(offsets)
        for dims in np.unique(lengths):
            shape = Geometry(int(dims), threshold, cell, seed)
            of = np.flatnonzero(lengths == dims)
            for at in range(0, len(of), CHUNK):
                some = of[at : at + CHUNK]
                row, table, cells, place = shape.memberships(values[offsets[some][:, None] + np.arange(dims)])
                key = cell_key(label[some][row], int(dims), table, cells)
                out = [number[some][row], np.full(len(row), dims, np.int32), table, key, place]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["class", "dims", "table", "key", "place"])


def _survivors(batches: Iterator[pa.RecordBatch], threshold: float, cell: float, seed: int) -> Iterator[pa.RecordBatch]:
    """Members of blocks of cells that may have a link there, one row each."""
    for batch in batches:
        members = batch["members"]
        sizes = np.diff(members.offsets.to_numpy())
        flat = members.flatten()
        place = np.ascontiguousarray(flat.field("place").to_numpy()).view(np.int8).reshape(-1, E8).astype(np.float32)
        part, dims = flat.field("part").to_numpy(), batch["dims"].to_numpy()
        crossing = batch["r"].to_numpy() != batch["c"].to_numpy()
        starts, keep = np.cumsum(sizes) - sizes, np.zeros(len(part), bool)
        for length in np.unique(dims):
            shape = Geometry(int(length), threshold, cell, seed)
            small = (dims == length) & (sizes < DENSE)
            for a, b in _side_by_side(starts[small], sizes[small]):
                apart = ((place[a] - place[b]) ** 2).sum(1) * shape.step**2 <= _widest(shape)
                _mark(keep, place, a[apart], b[apart], shape)
            for at, size in zip(starts[(dims == length) & ~small], sizes[(dims == length) & ~small]):
                here = place[at : at + size]
                square = (here * here).sum(1)
                # Whole numbers below 2^24: exact.
                apart = (square[:, None] + square[None, :] - 2 * here @ here.T) * shape.step**2 <= _widest(shape)
                a, b = np.nonzero(np.triu(apart, 1))
                _mark(keep, place, at + a, at + b, shape)
        # Blocks of one part are never parted; of two, both sides have to be there.
        block = np.repeat(np.arange(len(sizes)), sizes)
        for side in ("r", "c"):
            of_side = part == batch[side].to_numpy()[block]
            some = np.bincount(block[keep & of_side], minlength=len(sizes)) > 0
            keep &= some[block] | ~crossing[block]
        if keep.any():
            row = pa.array(block[keep])
            columns = [batch[n].take(row) for n in ("key", "dims", "table", "r", "c")]
            kept = [flat.field(n).filter(pa.array(keep)) for n in ("class", "part")]
            yield pa.RecordBatch.from_arrays(columns + kept, ["key", "dims", "table", "r", "c", "class", "part"])


def _widest(shape: Geometry) -> float:
    return (shape.radius / shape.size + 2 * shape.off) ** 2


def _side_by_side(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of members of the same small block: those one apart, then two apart, and so on."""
    at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    left = np.repeat(starts + sizes, sizes) - at
    for lag in range(1, DENSE - 1):
        at, left = at[left > lag], left[left > lag]
        if not len(at):
            return
        yield at, at + lag


def _mark(keep: np.ndarray, place: np.ndarray, a: np.ndarray, b: np.ndarray, shape: Geometry) -> None:
    """Keep pairs whose midpoint may be nearest to the middle of this cell."""
    middle = (place[a] + place[b]).astype(np.float64) * (shape.step / 2)
    aside = np.sqrt(((middle - decode(middle)) ** 2).sum(1))
    own = np.sqrt((middle * middle).sum(1)) <= aside + 2 * shape.off
    keep[a[own]] = keep[b[own]] = True


def _links(batches: Iterator[pa.RecordBatch], threshold: float, cell: float, seed: int) -> Iterator[pa.RecordBatch]:
    """Per block of a cell: (class, root, links) of the classes with links counted there."""
    for batch in batches:
        members = batch["members"]
        offsets, flat = members.offsets.to_numpy(), members.values
        number, weight, part = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("class", "weight", "part"))
        at, values = _vectors(flat.field("vector"))
        keys = {n: batch[n].to_numpy() for n in ("dims", "table", "key", "hash", "r", "c")}
        found = []
        for i in range(batch.num_rows):
            some = np.arange(offsets[i], offsets[i + 1])
            dims, table, home, label, r, c = (keys[n][i] for n in ("dims", "table", "key", "hash", "r", "c"))
            shape = Geometry(int(dims), threshold, cell, seed)
            vectors = values[at[some][:, None] + np.arange(dims)]
            same = (part[some][:, None] == r) & (part[some][None, :] == c) if r != c else np.tri(len(some), k=-1, dtype=bool)
            a, b = _pairs(vectors, shape, int(table), label, home, same, threshold)
            if len(a):
                found.append(_summary(number[some], weight[some], a, b))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["class", "root", "links"])


def _pairs(
    vectors: np.ndarray, shape: Geometry, table: int, label: int, home: int, asked: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs among the asked ones that are to be counted in this table and cell."""
    blocks = rotated(vectors, shape.seed)
    here = blocks[:, table]
    square = (here * here).sum(1)
    wide = (square[:, None] + square[None, :] - 2 * here @ here.T) <= shape.radius**2 * (1 + 1e-6) + 1e-12
    a, b = np.nonzero(wide & asked)
    apart = ((blocks[a] - blocks[b]) ** 2).sum(2) <= shape.radius**2
    first = apart.argmax(1) == table
    first &= apart[:, table]
    a, b = a[first], b[first]
    middle = decode((here[a] + here[b]) / 2 / shape.size)
    own = cell_key(np.full(len(a), label), vectors.shape[1], np.full(len(a), table), cell_number(middle)) == home
    a, b = a[own], b[own]
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    norm = np.sqrt((x * x).sum(1))
    close = (x[a] * x[b]).sum(1) / (norm[a] * norm[b]) >= threshold
    return a[close], b[close]


def _summary(number: np.ndarray, weight: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple:
    """Weighted link counts and a spanning forest of the pairs."""
    size = len(number)
    links = np.bincount(a, weight[b], size) + np.bincount(b, weight[a], size)
    labels = np.arange(size)
    while True:
        low = np.minimum(labels[a], labels[b])
        spread = labels.copy()
        np.minimum.at(spread, a, low)
        np.minimum.at(spread, b, low)
        spread = spread[spread]
        if (spread == labels).all():
            break
        labels = spread
    has = np.flatnonzero(links > 0)
    return number[has], number[labels[has]], links[has].astype(np.int64)


def near_duplicates(
    table: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
    threshold: float = 0.98, cell: float = 2.0, block: int = 512, seed: int = 8,
) -> DataFrame:
    """``id``, ``n_links``, ``component_id``, ``kept``: one row per vector.

    ``cell`` is the lattice scale in standard deviations of a coordinate; it must be
    at least about 1.72 * sqrt(1 - threshold).
    """
    Geometry(E8, threshold, cell, seed)
    usable = (
        f"CASE WHEN `{label}` IS NOT NULL AND size(`{vector}`) > 0"
        f" AND forall(`{vector}`, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
        f" AND exists(`{vector}`, x -> x <> 0) THEN `{vector}` END"
    )
    rows = table.select(F.col(id).alias("id"), F.col(label).alias("label"), F.expr(usable).alias("vector"))
    classes = stage(
        rows.where("vector IS NOT NULL").groupBy("label", "vector")
        .agg(F.min("id").alias("first"), F.expr("count(1) AS weight"))
        .withColumn("class", F.monotonically_increasing_id()),
        "vectors",
    )
    settings = (threshold, cell, seed)
    hashed = classes.selectExpr("class", "xxhash64(label) AS label", "vector")

    def cells_of(some: DataFrame) -> DataFrame:
        return some.mapInArrow(lambda batches: _cells(batches, *settings), "class long, dims int, table int, key long, place long")

    large = stage(
        cells_of(hashed.where(f"pmod(xxhash64(class), {SAMPLE}) = 0")).groupBy("key")
        .agg(F.expr(f"CAST(ceil(count(1) * {SAMPLE} / {block}) AS INT) AS parts")).where("parts > 1"),
        "large-cells",
    )
    meeting = (
        cells_of(hashed).join(large, "key", "left").withColumn("parts", F.expr("coalesce(parts, 1)"))
        .withColumn("part", F.expr("CAST(pmod(xxhash64(class, 1), parts) AS INT)"))
        .select("key", "dims", "table", "class", "place", "part", F.expr("explode(sequence(0, parts - 1)) AS other"))
        .select("key", "dims", "table", "class", "place", "part", F.expr("least(part, other) AS r"), F.expr("greatest(part, other) AS c"))
        # Also where the large cells were joined by key: a cell must not stay in one task.
        .repartition("key", "dims", "table", "r", "c")
        .groupBy("key", "dims", "table", "r", "c").agg(F.collect_list(F.struct("class", "part", "place")).alias("members"))
        .where("size(members) > 1")
    )
    close = stage(
        meeting.mapInArrow(lambda batches: _survivors(batches, *settings), "key long, dims int, table int, r int, c int, class long, part int"),
        "close",
    )
    keys = ["label", "dims", "table", "key", "r", "c"]
    blocks = (
        close.join(classes.select("class", "label", "weight", "vector"), "class")
        .groupBy(*keys).agg(F.collect_list(F.struct("class", "weight", "part", "vector")).alias("members"))
        .where("size(members) > 1")
        .select("dims", "table", "key", F.expr("xxhash64(label) AS hash"), "r", "c", "members")
    )
    found = stage(blocks.mapInArrow(lambda batches: _links(batches, *settings), "class long, root long, links long"), "found")
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    roots = connected_components(found.selectExpr("class AS a", "root AS b")).selectExpr("node AS class", "component AS root")
    known = (
        classes.join(counts, "class", "left").join(roots, "class", "left")
        .selectExpr("label", "vector", "first", "coalesce(root, class) AS root", "coalesce(links, 0L) + weight - 1 AS n_links")
    )
    smallest = known.groupBy("root").agg(F.min("first").alias("component_id"))
    per_class = known.join(smallest, "root").select("label", "vector", "n_links", "component_id")
    linked = rows.where("vector IS NOT NULL").join(per_class, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = rows.where("vector IS NULL").selectExpr("id", "0L AS n_links", "id AS component_id")
    return linked.unionByName(alone).select(
        F.col("id").alias(id), "n_links", "component_id", F.expr("id <=> component_id").alias("kept")
    )
