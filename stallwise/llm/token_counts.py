"""Token counts of whole texts through a digest cache.

A cache is a Parquet table (content digest, tokenizer digest, number of tokens) in
a folder all executors share. Counting joins the digests of the normalised texts
to the cache, encodes the distinct texts it does not hold, appends their counts,
and reads every count back from the cache. A changed tokenizer file or library
version has another digest, so its counts never mix with older ones.

Normalising a text must not change its count: null becomes empty, nothing else.

Scale: a text goes through one shuffle, where copies meet after being reduced to
one per task; texts the cache holds are dropped before they are encoded. What is
joined back to the rows is a digest and a number. Digests of more than one row in
``SHARE`` are fewer than ``SHARE``, so their counts are broadcast and their rows stay
where they are; the others join by a shuffle.
Repeated entries, as two runs at a time may write, are reduced when read.

Defined results: a null id stays null; repeated rows are each counted; an empty
table gives an empty result and appends nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm import word_cache
from stallwise.llm.tokenizer_pieces import load, piecewise
from stallwise.llm.word_cache import PieceCache
from stallwise.sources.staging import stage

# A digest that more than one in so many rows have is not shuffled to.
SHARE = 1000
CACHE_SCHEMA = "content_digest string, tokenizer_digest string, n_tokens long"
_COUNTERS: dict[str, tuple] = {}


def tokenizer_digest(file: str) -> str:
    """Digest of the vocabulary file and of the library version that reads it."""
    with open(file, "rb") as f:
        return hashlib.sha256(f.read() + f"tokenizers {tokenizers.__version__}".encode()).hexdigest()


def counter(file: str) -> tuple:
    """The worker's cache of counts and the cuts for a tokenizer file."""
    if file not in _COUNTERS:
        cuts, encode_many = piecewise(load(file))
        _COUNTERS[file] = PieceCache(lambda parts: map(len, encode_many(parts)), size=150_000), cuts
    return _COUNTERS[file]


def _count(batches: Iterator[pa.RecordBatch], file: str) -> Iterator[pa.RecordBatch]:
    count, cuts = counter(file)
    for batch in batches:
        numbers = word_cache.count_tokens(batch["text"], count, cuts)
        yield pa.RecordBatch.from_arrays([batch["content_digest"], pa.array(numbers)], ["content_digest", "n_tokens"])


def count_tokens(
    docs: DataFrame, file: str, cache: str, id: str = "doc_id", text: str = "text", limit: int = 512
) -> DataFrame:
    """``id``, ``n_bytes``, ``n_tokens``, ``over_limit``, one row per row; grows the table at ``cache``."""
    spark = docs.sparkSession
    version = tokenizer_digest(file)
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "content_digest", F.sha2(F.encode("text", "UTF-8"), 256)
    )

    def held() -> DataFrame:
        table = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer_digest") == version)
        return table.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))

    # The folder exists from here on, so that a first run reads an empty cache.
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)
    distinct = rows.groupBy("content_digest").agg(F.first("text").alias("text"))
    misses = distinct.join(held(), "content_digest", "left_anti")
    misses.mapInArrow(lambda batches: _count(batches, file), "content_digest string, n_tokens long").select(
        "content_digest", F.lit(version).alias("tokenizer_digest"), "n_tokens"
    ).write.mode("append").parquet(cache)
    marked = stage(rows.select("id", F.octet_length("text").cast("long").alias("n_bytes"), "content_digest"), "digests")
    total = marked.agg(F.expr("count(1) AS n")).scalar()
    often = marked.groupBy("content_digest").agg(F.expr("count(1) AS n")).where(F.col("n") * SHARE > total).select("content_digest")
    # Fewer than SHARE rows, whatever the table.
    heavy = F.broadcast(held().join(F.broadcast(often), "content_digest"))
    light = marked.join(heavy, "content_digest", "left_anti").join(held(), "content_digest", "left")
    return light.unionByName(marked.join(heavy, "content_digest")).select(
        F.col("id").alias(id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
