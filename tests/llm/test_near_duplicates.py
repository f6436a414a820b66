"""SimHash and lattice near-duplicates, and components, against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from stallwise.llm import components as components_module
from stallwise.llm import lattice_dedup, simhash
from stallwise.llm.components import connected_components


def components(n, linked):
    """Smallest number reachable, by plain search."""
    root = list(range(n))
    for a, b in linked:
        x, y = root[a], root[b]
        root = [min(x, y) if r in (x, y) else r for r in root]
    return root


def plain_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", "  \n", "One", "a b", "A b C", "a b c d a b c d", "É é x y\x0bz", "x " * 500])
def test_fingerprint_definition(text):
    assert simhash.fingerprint_of(text) == plain_fingerprint(text)


def test_fingerprint_in_chunks(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefgh", k=400))
    whole = simhash.fingerprint_of(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint_of(text) == whole


def test_simhash_components(spark):
    rng, texts = random.Random(3), [None, "", "one"]
    for _ in range(25):
        base = [f"w{rng.randrange(500)}" for _ in range(120)]
        for _ in range(rng.randrange(1, 6)):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = "new"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(0, None, "y"), (None, "one", "z")], "doc_id long, text string, fp string")
    found = simhash.near_duplicates(docs).collect()
    prints = [plain_fingerprint(t) for t in texts]
    linked = [(a, b) for a in range(len(texts)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    expected = components(len(texts), linked)
    assert len(found) == len(texts) + 2
    for row in found:
        if row.doc_id is not None:
            assert (int(row.fingerprint, 16), row.component_id) == (prints[row.doc_id], expected[row.doc_id])
        else:
            assert row.component_id == expected[2]
    kept = [r.doc_id for r in simhash.one_per_component(docs).collect()]
    assert sorted(kept) == sorted(set(expected))


@pytest.mark.parametrize(("distance", "segments", "block"), [(3, 2, 1024), (3, 2, 4), (3, 4, 8), (2, 2, 16), (0, 2, 1024)])
def test_links_connect_what_distances_connect(spark, distance, segments, block):
    rng = random.Random(distance)
    values = {0, (1 << 64) - 1}
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(8):
            value = base
            for _ in range(rng.randrange(5)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    values = sorted(values)
    table = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    links = simhash.spanning_links(table, distance, segments, block).collect()
    place = {v: i for i, v in enumerate(values)}
    mine = components(len(values), [(place[r.a % (1 << 64)], place[r.b % (1 << 64)]) for r in links])
    every = [(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= distance]
    assert mine == components(len(values), every)


def test_fingerprints_and_links_are_not_broadcast(spark, monkeypatch):
    """Spark takes the exploded probes for as small as the fingerprints and would broadcast them."""
    planned, stage = [], components_module.stage

    def watched(df, name):
        planned.append(df._jdf.queryExecution().sparkPlan().toString())
        return stage(df, name)

    for module in (simhash, components_module):
        monkeypatch.setattr(module, "stage", watched)
    docs = spark.range(40).selectExpr("id AS doc_id", "repeat(CAST(id DIV 2 AS STRING), 9) AS text")
    kept = simhash.one_per_component(docs)
    planned.append(kept._jdf.queryExecution().sparkPlan().toString())
    assert kept.count() == 20
    assert sum("SortMergeJoin" in plan for plan in planned) >= 4
    assert not [plan for plan in planned if "Broadcast" in plan]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (None, 3), (200, 201), (201, 200)], "a long, b long")
    found = {r.node: r.component for r in connected_components(links).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {201: 200}
    assert connected_components(links.where("false")).count() == 0


def plain_links(rows, threshold):
    usable = []
    for v, label in rows:
        fine = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        usable.append(np.array(v, np.float64) if fine else None)
    return [
        (a, b) for a in range(len(rows)) for b in range(a)
        if usable[a] is not None and usable[b] is not None and rows[a][1] == rows[b][1] and len(usable[a]) == len(usable[b])
        and usable[a] @ usable[b] / np.sqrt((usable[a] @ usable[a]) * (usable[b] @ usable[b])) >= threshold
    ]


@pytest.mark.parametrize(("dims", "cell", "block", "threshold"), [(64, 2.0, 512, 0.98), (64, 1.0, 4, 0.98), (20, 2.0, 8, 0.95), (3, 3.0, 512, 0.98)])
def test_lattice_links_are_complete(spark, dims, cell, block, threshold):
    rng = np.random.default_rng(dims)
    rows = []
    for group in range(20):
        base = rng.normal(size=dims)
        for _ in range(rng.integers(1, 9)):
            near = base + rng.normal(size=dims) * 0.14 * rng.random()
            rows.append((near.astype(np.float32).tolist(), int(group % 3)))
    rows += [rows[0], (rows[1][0], None), ([0.0] * dims, 1), (None, 1), ([], 1), ([None] * dims, 1), ([float("nan")] * dims, 1)]
    rows += [([float("inf")] * dims, 1), ([2 * x for x in rows[2][0]], rows[2][1]), (rows[3][0][:-1], rows[3][1])]
    schema = "vec_id long, embedding array<float>, label int, weight string"
    table = spark.createDataFrame([(i, v, label, "x") for i, (v, label) in enumerate(rows)], schema)
    found = {r.vec_id: r for r in lattice_dedup.near_duplicates(table, threshold=threshold, cell=cell, block=block).collect()}
    rounded = [([None if x is None else float(np.float32(x)) for x in v] if v is not None else None, label) for v, label in rows]
    links = plain_links(rounded, threshold)
    roots, degree = components(len(rows), links), np.bincount([x for p in links for x in p], minlength=len(rows))
    assert len(links) > 20
    assert [(found[i].n_links, found[i].component_id) for i in range(len(rows))] == list(zip(degree.tolist(), roots))
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    assert lattice_dedup.near_duplicates(table.where("false")).count() == 0


@pytest.mark.parametrize(("threshold", "cell"), [(0.9, 0.6), (0.98, 0.5)])
def test_lattice_of_small_cells_holds_both_of_a_pair(threshold, cell):
    """Both members of a pair are stored under the cell of their midpoint."""
    rng = np.random.default_rng(1)
    a = rng.normal(size=(6000, 8))
    a /= np.sqrt((a * a).sum(1, keepdims=True))
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.sqrt((side * side).sum(1, keepdims=True))
    b = a * (threshold + 1e-7) + side * np.sqrt(1 - (threshold + 1e-7) ** 2)
    shape = lattice_dedup.Geometry(8, threshold, cell, 8)
    middle = (lattice_dedup.rotated(a, 8) + lattice_dedup.rotated(b, 8))[:, 0] / 2
    asked = lattice_dedup.cell_number(lattice_dedup.decode(middle / shape.size))
    for side in (a, b):
        rows, _, cells, _ = shape.memberships(side)
        assert len(np.unique(rows[cells == asked[rows]])) == len(asked)


def test_places_in_cells_and_first_meeting(monkeypatch):
    """Rounded places lose no pair, and small and dense blocks keep the same members."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    vectors = np.repeat(base, 8, axis=0) + rng.normal(size=(320, 16)) * 0.03
    shape = lattice_dedup.Geometry(16, 0.98, 2.0, 8)
    row, table, cell, place = shape.memberships(vectors)
    blocks = lattice_dedup.rotated(vectors, 8)[row, table] / shape.size
    places = np.ascontiguousarray(place).view(np.int8).reshape(-1, 8) * shape.step
    # What is left is the lattice point of the cell.
    point = lattice_dedup.decode(blocks - places)
    assert np.sqrt(((blocks - places - point) ** 2).sum(1)).max() <= shape.off
    assert (lattice_dedup.cell_number(point) == cell).all()
    key = lattice_dedup.cell_key(np.zeros(len(cell), np.int64), 16, table, cell)
    names, block = np.unique(key, return_inverse=True)
    members = [[{"class": int(row[i]), "part": 0, "place": int(place[i])} for i in np.flatnonzero(block == n)] for n in range(len(names))]
    kind = pa.list_(pa.struct([("class", pa.int64()), ("part", pa.int32()), ("place", pa.int64())]))
    flat = pa.array(np.zeros(len(names), np.int32))
    of = pa.array([int(table[block == n][0]) for n in range(len(names))], pa.int32())
    batch = pa.RecordBatch.from_arrays(
        [pa.array(names), pa.array(np.full(len(names), 16, np.int32)), of, flat, flat, pa.array(members, kind)], ["key", "dims", "table", "r", "c", "members"]
    )
    found = []
    for dense in (2, 10_000):
        monkeypatch.setattr(lattice_dedup, "DENSE", dense)
        out = next(lattice_dedup._survivors(iter([batch]), 0.98, 2.0, 8))
        found.append(set(zip(out["key"].to_pylist(), out["class"].to_pylist())))
    assert found[0] == found[1] and 0 < len(found[0]) < len(row)
    unit = vectors / np.sqrt((vectors**2).sum(1, keepdims=True))
    linked = np.argwhere(np.triu(unit @ unit.T >= 0.98, 1))
    together = {}
    for k, c in found[0]:
        together.setdefault(c, set()).add(k)
    assert len(linked) and all(together.get(a, set()) & together.get(b, set()) for a, b in linked.tolist())


def test_equal_vectors_of_other_labels_stay_apart(spark):
    rows = [(i, [1.0, 0.5, 0.25 * (i % 3)], i % 4) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    plain = {r.vec_id: r for r in lattice_dedup.near_duplicates(table).collect()}
    assert all(plain[i].component_id % 4 == i % 4 for i in plain)


def test_lattice_shells_and_too_small_cells(spark):
    assert [len(lattice_dedup.shell(n)) for n in (2, 4, 6, 8)] == [240, 2160, 6720, 17520]
    assert lattice_dedup.Geometry(64, 0.98, 2.0, 8).norms == [2, 4]
    with pytest.raises(ValueError, match="too small"):
        lattice_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), cell=0.1)


def test_lattice_neighbours_and_decoding():
    near, far = lattice_dedup.neighbours()
    assert len(near) == 240 and len(far) == 2160 and (near**2).sum(1).max() == 2 and (far**2).sum(1).min() == 4
    x = np.random.default_rng(0).normal(size=(500, 8)) * 3
    home = lattice_dedup.decode(x)
    every = home[:, None, :] + np.concatenate([np.zeros((1, 8)), near, far])[None]
    assert np.allclose(((x - home) ** 2).sum(1), ((x[:, None, :] - every) ** 2).sum(2).min(1))
