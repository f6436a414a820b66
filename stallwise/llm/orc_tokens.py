"""Token ids as ORC: documents in id order, one row each, ids as a list of integers.

ORC stores the ids run-length encoded in stripes, with row indexes and Bloom
filters on the document id. Stripes are read in parallel, and a lookup by document
id reads only stripes and row groups whose statistics and filters allow it.

Every task writes one range of document ids and numbers its rows and ids from
zero. The totals of the ranges, one row each, turn these into global positions
when the files are read, so no task sees more than its range.

Defined results: null texts are empty and hold the end id alone; null document ids
come first; rows with equal ids are ordered by the text's digest, and equal rows in
any order; an empty table gives empty files; other columns are not written.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallwise.llm import word_cache
from stallwise.llm.tokenizer_pieces import load, piecewise
from stallwise.llm.word_cache import PieceCache

SCHEMA = "doc_id long, part int, place long, part_start long, n_tokens int, ids array<int>"
# Bytes of text encoded at once: a task does little else, and larger slices repeat more pieces.
SLICE = 8 << 20
_ENCODERS: dict[str, tuple] = {}


def encoder(file: str) -> tuple:
    """The worker's cache of pieces' 32-bit ids and the cuts for a tokenizer file."""
    if file not in _ENCODERS:
        cuts, encode_many = piecewise(load(file))
        _ENCODERS[file] = PieceCache(lambda parts: (array("i", ids).tobytes() for ids in encode_many(parts)), size=120_000), cuts
    return _ENCODERS[file]


def _encode(batches: Iterator[pa.RecordBatch], file: str, end_id: int) -> Iterator[pa.RecordBatch]:
    part, place, start = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        done = 0
        for ids, starts in word_cache.token_ids(batch["text"], *encoder(file), SLICE):
            lists = word_cache.framed(ids, starts, [], [end_id])
            rows, ends = len(lists), lists.offsets.to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].slice(done, rows), pa.array(np.full(rows, part, np.int32)),
                    pa.array(place + np.arange(rows)), pa.array(start + ends[:-1]),
                    pa.array(np.diff(ends).astype(np.int32)), lists,
                ],
                ["doc_id", "part", "place", "part_start", "n_tokens", "ids"],
            )
            done, place, start = done + rows, place + rows, start + int(ends[-1])


def write_tokens(
    docs: DataFrame, path: str, file: str, end_id: int, id: str = "doc_id", text: str = "text", stripe_bytes: int = 64 << 20
) -> None:
    """Encode whole texts and write them to ``path`` in ascending id order."""
    ordered = (
        docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
        # The row number only spreads equal rows over ranges.
        .repartitionByRange("doc_id", "tie", "row")
        .sortWithinPartitions("doc_id", "tie", "row")
        .select("doc_id", "text")
    )
    (
        ordered.mapInArrow(lambda batches: _encode(batches, file, end_id), SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", "10000")
        .option("orc.stripe.size", str(stripe_bytes))
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``part``, ``place``, ``start`` (ids of all rows before), ``n_tokens``, ``ids``."""
    stored = spark.read.schema(SCHEMA).orc(path)
    totals = stored.groupBy("part").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("total"))
    # One row per written file.
    before = totals.select(
        "part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before")
    )
    return stored.join(F.broadcast(before), "part").select(
        "doc_id", "part", "place", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids"
    )


def find_documents(spark: SparkSession, path: str, wanted: list[int]) -> DataFrame:
    """Rows of some documents: statistics and Bloom filters skip the other stripes."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").isin(wanted)).select("doc_id", "n_tokens", "ids")


def ids_crc32(ids: Column) -> Column:
    """Unsigned CRC-32 of the ids as little-endian 32-bit integers."""

    @F.arrow_udf("long")
    def crc(lists: pa.Array) -> pa.Array:
        offsets, values = lists.offsets.to_numpy(), np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")
        return pa.array([zlib.crc32(values[a:b]) for a, b in zip(offsets, offsets[1:])], pa.int64())

    return crc(ids)
