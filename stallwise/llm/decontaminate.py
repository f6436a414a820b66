"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` turns documents into an index on disk. Each batch of documents is a
segment with its own postings: per term the gaps between its positions, which
number the words of the segment, with room between documents so that no phrase
crosses one. Segments are independent, so building needs no shuffle, and a segment
is rebuilt alone when an executor is lost.

``phrase_matches`` finds windows of consecutive benchmark words. Only postings of
benchmark terms leave the index, as numbers, and meet per segment. There each
window starts from its rarest term and keeps the positions at which the next terms
stand at the right distance, the rarest of them first; most windows end at a term
the segment does not hold. ``proximity_matches`` does the same with a distance bound
in place of fixed offsets.

Scale: the benchmark is read as a stream and processed in blocks of at most
``block_words`` words, each a distributed job; what is broadcast is one block.
A segment holds about ``SEGMENT`` bytes of text, or one longer text, so tasks are
even whatever terms, documents or copies are frequent. Matches are one row per
maximal run of an item's windows in a document, not one per window.

Defined results: null texts have no words and are never contaminated; items without
words match nothing; shorter items than a window are one window; repeated rows are
matched each; items with equal ids count once, items with a null id mark words but
are not listed; empty tables give an empty index or no matches. Columns to keep are
named by the caller, and all others are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stallwise.llm.word_cache import slices
from stallwise.sources.staging import new_path

# Everything between words: ASCII characters other than digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Unused positions between documents: longer than any window or distance asked for.
ROOM = 1024
# Bytes of text in a segment of the index.
SEGMENT = 8 << 20
TERMS_PER_BATCH = 50_000

MATCH = "segment long, place int, item long, first int, last int"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words, ASCII letters in lower case, and the number of words per text."""
    split = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), BETWEEN)
    parent = pc.list_parent_indices(split).to_numpy()
    flat = split.flatten()
    full = pc.not_equal(flat, "")
    return flat.filter(full), np.bincount(parent[full.to_numpy(zero_copy_only=False)], minlength=len(texts))


def _schema(docs: DataFrame, keep: list[str]) -> T.StructType:
    own = "segment long, place int, first int, n_words int, term string, gaps array<int>"
    kept = [T.StructField(c, docs.schema[c].dataType) for c in keep]
    return T.StructType([*T.StructType.fromDDL(own), T.StructField("kept", T.StructType(kept))])


def _segments(batches: Iterator[pa.RecordBatch], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Document rows and postings of each segment."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        done = 0
        for texts in slices(batch["text"], size):
            kept = batch["kept"].slice(done, len(texts))
            done += len(texts)
            words, counts = words_of(texts)
            first = counts.cumsum() - counts + ROOM * np.arange(len(counts))
            yield _batch(schema, len(counts), segment=np.full(len(counts), number), place=np.arange(len(counts)), first=first, n_words=counts, kept=kept)
            yield from _postings(schema, number, words, counts)
            number += 1


def _postings(schema: pa.Schema, number: int, words: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    coded = words.dictionary_encode()
    terms = coded.indices.to_numpy()
    order = np.argsort(terms, kind="stable").astype(np.int32)
    position = np.arange(len(terms)) + np.repeat(ROOM * np.arange(len(counts)), counts)
    gaps = np.diff(position[order], prepend=0)
    ends = np.bincount(terms, minlength=len(coded.dictionary)).cumsum()
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    gaps[starts] = position[order[starts]]
    for at in range(0, len(ends), TERMS_PER_BATCH):
        stop = min(at + TERMS_PER_BATCH, len(ends))
        low, high = starts[at], ends[stop - 1]
        offsets = np.concatenate([starts[at:stop], [high]]) - low
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(gaps[low:high].astype(np.int32)))
        yield _batch(schema, stop - at, segment=np.full(stop - at, number), term=coded.dictionary.slice(at, stop - at), gaps=lists)


def _batch(schema: pa.Schema, rows: int, **columns) -> pa.RecordBatch:
    """A batch with the given columns and nulls in the others."""
    arrays = []
    for field in schema:
        column = columns.get(field.name)
        if column is None:
            arrays.append(pa.nulls(rows, field.type))
        else:
            arrays.append(pa.array(column).cast(field.type) if isinstance(column, np.ndarray) else column.cast(field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def build_index(docs: DataFrame, path: str, text: str = "text", keep: list[str] = ("doc_id",)) -> None:
    """Write the index of whole texts to ``path``; columns ``keep`` stay with the documents."""
    schema = _schema(docs, list(keep))
    arrow, size = to_arrow_schema(schema), SEGMENT
    rows = docs.select(F.col(text).alias("text"), F.struct(*keep).alias("kept"))
    rows.mapInArrow(lambda batches: _segments(batches, arrow, size), schema).write.parquet(path)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents of an index: ``segment``, ``place``, ``first``, ``n_words``, ``kept``."""
    return spark.read.parquet(path).where("place IS NOT NULL").drop("term", "gaps")


class Block:
    """Windows of some benchmark items, with terms as numbers; without a width, whole items."""

    def __init__(self, texts: list[str | None], width: int | None):
        words, counts = words_of(pa.array(texts, pa.string()))
        coded = words.dictionary_encode()
        self.terms = coded.dictionary
        numbers, windows, at = coded.indices.to_pylist(), {}, 0
        for item, count in enumerate(counts.tolist()):
            own = numbers[at : at + count]
            at += count
            size = count if width is None else width
            for i in range(max(1, count - size + 1) if count else 0):
                windows.setdefault(tuple(own[i : i + size]), []).append(item)
        self.windows = list(windows.items())


def _wanted(batches: Iterator[pa.RecordBatch], terms: pa.Array) -> Iterator[pa.RecordBatch]:
    """Postings of the asked terms, with their numbers."""
    for batch in batches:
        number = pc.index_in(batch["term"], terms)
        hit = number.is_valid()
        yield pa.RecordBatch.from_arrays(
            [batch["segment"].filter(hit), number.filter(hit), batch["gaps"].filter(hit)], ["segment", "term", "gaps"]
        )


def exact_starts(postings: dict[int, np.ndarray], window: tuple[int, ...]) -> np.ndarray:
    """Positions at which the window's terms stand one after the other."""
    order = sorted(range(len(window)), key=lambda i: len(postings[window[i]]))
    found = postings[window[order[0]]] - order[0]
    for i in order[1:]:
        if not len(found):
            break
        found = found[_holds(postings[window[i]], found + i)]
    return found


def near_starts(postings: dict[int, np.ndarray], window: tuple[int, ...], distance: int) -> np.ndarray:
    """Positions of the rarest term with every term, as often as in the window, within ``distance`` words."""
    times = Counter(window)
    order = sorted(times, key=lambda t: len(postings[t]))
    found = postings[order[0]]
    for term in order:
        # The rarest term itself is one of its occurrences.
        others = np.append(postings[term], [np.iinfo(np.int64).max] * times[term])
        found = found[others[np.searchsorted(others, found - distance) + times[term] - 1] <= found + distance]
    return found


def _holds(ordered: np.ndarray, asked: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ordered, asked)
    return (at < len(ordered)) & (ordered[np.minimum(at, len(ordered) - 1)] == asked)


def _match(table: pa.Table, block: Block, distance: int | None) -> pa.Table:
    """Matches within one segment: postings and document rows in, runs out."""
    own = table.combine_chunks()
    segment = own["segment"][0].as_py()
    is_doc = pc.is_null(own["term"])
    docs = own.filter(is_doc).sort_by("place")
    terms = own.filter(pc.invert(is_doc))
    lists = terms["gaps"].combine_chunks()
    postings = {t.as_py(): g.values.to_numpy().cumsum() for t, g in zip(terms["term"], lists)}
    starts, items, sizes = [], [], []
    for window, owners in block.windows:
        if all(t in postings for t in window):
            found = exact_starts(postings, window) if distance is None else near_starts(postings, window, distance)
            for item in owners if len(found) else ():
                starts.append(found)
                items.append(np.full(len(found), item))
                sizes.append(np.full(len(found), len(window) if distance is None else 1))
    if not starts:
        return pa.table({"segment": [], "place": [], "item": [], "first": [], "last": []}, schema=MATCH_ARROW)
    start, item, size = np.concatenate(starts), np.concatenate(items), np.concatenate(sizes)
    order = np.lexsort([start, item])
    start, item, last = start[order], item[order], (start + size - 1)[order]
    # Overlapping or touching windows of an item are one run; the windows of an item are equally long.
    begins = np.concatenate([[True], (item[1:] != item[:-1]) | (start[1:] > last[:-1] + 1)])
    at = np.flatnonzero(begins)
    first, last, item = start[at], last[np.concatenate([at[1:] - 1, [len(last) - 1]])], item[at]
    doc_first = docs["first"].to_numpy()
    row = np.searchsorted(doc_first, first, "right") - 1
    found = [np.full(len(at), segment), docs["place"].to_numpy()[row], item, first - doc_first[row], last - doc_first[row]]
    return pa.table(dict(zip(MATCH_ARROW.names, found))).cast(MATCH_ARROW)


def _matcher(block: Block, distance: int | None):
    return lambda table: _match(table, block, distance)


MATCH_ARROW = pa.schema([("segment", pa.int64()), ("place", pa.int32()), ("item", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])


def _blocks(benchmark: DataFrame, id: str, text: str, block_words: int) -> Iterator[tuple[list, list[str]]]:
    """The benchmark in blocks: item ids and texts, read as a stream."""
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.col(id).alias("id"), F.col(text).alias("text")).toLocalIterator():
        ids.append(row["id"])
        texts.append(row["text"])
        size += len(row["text"] or "") // 2 + 1
        if size >= block_words:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def phrase_matches(
    spark: SparkSession, path: str, benchmark: DataFrame, width: int | None = 10, distance: int | None = None,
    id: str = "item_id", text: str = "text", block_words: int = 1_000_000,
) -> DataFrame:
    """Runs of benchmark windows in indexed documents: ``segment``, ``place``, ``item_id``, ``first``, ``last``.

    ``first`` and ``last`` number the words of the document from 0. Written to the
    shared folder block by block. With ``distance``, see ``proximity_matches``.
    """
    if width is None and distance is None:
        raise ValueError("exact matches need a width")
    if max(width or 0, distance or 0) >= ROOM:
        raise ValueError(f"windows and distances must be below {ROOM} words")
    out = new_path(spark, "matches")
    kind = benchmark.schema[id].dataType
    schema = T.StructType([*T.StructType.fromDDL("segment long, place int, first int, last int"), T.StructField("item_id", kind)])
    spark.createDataFrame([], schema).write.parquet(out)
    index = spark.read.parquet(path)
    for ids, texts in _blocks(benchmark, id, text, block_words):
        block = Block(texts, width)
        postings = (
            index.where("term IS NOT NULL").select("segment", "term", "gaps")
            .mapInArrow(partial(_wanted, terms=block.terms), "segment long, term int, gaps array<int>")
            .selectExpr("segment", "CAST(NULL AS INT) AS place", "CAST(NULL AS INT) AS first", "term", "gaps")
        )
        places = index.where("place IS NOT NULL").selectExpr("segment", "place", "first", "CAST(NULL AS INT) AS term", "CAST(NULL AS ARRAY<INT>) AS gaps")
        found = postings.unionAll(places).groupBy("segment").applyInArrow(_matcher(block, distance), MATCH)
        # One block's item ids: as bounded as the block.
        names = spark.createDataFrame(list(enumerate(ids)), T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", kind)]))
        found.join(F.broadcast(names), "item").select("segment", "place", "first", "last", "item_id").write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)


def proximity_matches(spark: SparkSession, path: str, phrases: DataFrame, distance: int, **names) -> DataFrame:
    """Where all words of a phrase stand within ``distance`` words of its rarest one, in any order.

    The rarest word is the one with the fewest positions in the segment; runs of
    such words are one match. A word that the phrase repeats must stand there as often.
    Phrases are matched whole, whatever their length.
    """
    return phrase_matches(spark, path, phrases, None, distance, **names)


def contamination(spark: SparkSession, path: str, matches: DataFrame) -> DataFrame:
    """Per indexed document: ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``, and ``kept``."""
    covered = """aggregate(array_sort(collect_list(struct(first, last))),
        named_struct('upto', -1, 'n', 0),
        (s, r) -> named_struct('upto', greatest(s.upto, r.last), 'n', s.n + greatest(0, r.last - greatest(s.upto, r.first - 1))),
        s -> CAST(s.n AS BIGINT))"""
    hits = matches.groupBy("segment", "place").agg(
        F.expr(covered).alias("n_hit"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    return (
        documents(spark, path).join(hits, ["segment", "place"], "left")
        .select(
            "kept.*", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        )
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """Index ``docs``, match the benchmark, and report per document; ``keep`` must not name columns of the report."""
    if taken := sorted({"n_words", "n_hit", "n_items", "items_sha256", "contaminated"} & set(keep)):
        raise ValueError(f"columns are reported under these names: {taken}")
    spark = docs.sparkSession
    path = new_path(spark, "index")
    build_index(docs, path, text, list(keep))
    return contamination(spark, path, phrase_matches(spark, path, benchmark, width))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text is contaminated; all columns stay.

    What is decided depends on the text alone, so rows are matched by its digest.
    """
    digest = F.md5(F.encode(F.col("text"), "UTF-8"))
    names = {c: f"_d{i}" for i, c in enumerate(docs.columns)}
    table = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.col(f"`{text}`").alias("text")).withColumn("key", digest)
    marked = table.select("text", "key")
    bad = decontaminate(marked, benchmark, width, "text", ["key"]).where("contaminated").select("key").distinct()
    return table.join(bad, "key", "left_anti").select(*[F.col(n).alias(c) for c, n in names.items()])
