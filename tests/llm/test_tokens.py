"""Tokenizing operators against their libraries, token counts, ORC files."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stallwise.llm import orc_tokens, sentencepiece_bpe, token_counts, word_cache

PARTS = [
    "a", "b", " ", " ", "  ", "\n", "\n\n", "\t", "the", "▁", "é", "ñ", "日本", "😀", "\x00", "\x01", ".", ",", "ing", " ing", "<s>",
    "<0x0A>", "ßü", "'s", "...", "    ", "　", "é", "http://", "12345", "\r\n", "\x1c", "\x85", " ́", "<|endoftext|>",
    "<|startoftext|>", "<|ENDOFTEXT|>", "İ", "Σ", "ÀÉ", "×", "Word", "élève,", "K", "K.",
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    made = ["".join(rng.choices(PARTS, k=rng.randrange(25))) for _ in range(1500)]
    plain = ["".join(rng.choices(["a b", "the", " ", ".\n", "x,", " y", "é!", "\n", "Zoo"], k=rng.randrange(12))) for _ in range(1500)]
    return [*made, *plain, "", " ", "a" * 3000, "ab" * 1500, " " * 700, "▁", "word " * 4000]


def table(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")


def test_sentencepiece_equals_library(spark, texts):
    file = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=file)
    docs = table(spark, [*texts, None])
    found = {r.doc_id: r for r in sentencepiece_bpe.encoded_documents(docs, file).collect()}
    for i, text in enumerate([*texts, ""]):
        ids = [1, *library.encode(text), 2]
        assert found[i].ids == ids and found[i].decoded == library.decode(ids)
    digest = sentencepiece_bpe.encoded_documents(docs, file).select("doc_id", sentencepiece_bpe.ids_sha256(F.col("ids")).alias("d")).where("doc_id = 3").first()
    assert digest.d == hashlib.sha256(np.array(found[3].ids, "<u4").tobytes()).hexdigest()
    assert sentencepiece_bpe.encoded_documents(docs.where("false"), file).count() == 0
    for row in sentencepiece_bpe.encoded_digests(docs, file).collect():
        own = found[row.doc_id]
        assert row.n_tokens == len(own.ids) and row.ids_sha256 == hashlib.sha256(np.array(own.ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(own.decoded.encode()).hexdigest()


def test_merging_scores_a_pair_once(monkeypatch):
    encoder = sentencepiece_bpe.encoder(public_tokenizers.path("piece_bpe_32k.model"))

    class Counted(dict):
        asked = 0

        def get(self, *args):
            Counted.asked += 1
            return super().get(*args)

    monkeypatch.setattr(encoder, "scores", Counted(encoder.scores))
    word = "▁internationalization" * 6
    parts = encoder.merged(word)
    assert "".join(parts) == word and 1 < len(parts) < len(word)
    # Those at the start, and two for each merge.
    assert Counted.asked <= len(word) - 1 + 2 * (len(word) - len(parts))


def test_backtracking_equals_merging():
    one = sentencepiece_bpe.BpeEncoder(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(9)
    for _ in range(2000):
        text = "".join(rng.choices("etaoinshr▁", k=rng.randrange(1, 14)))
        assert one.split(text) == one.merged(text)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_equal_library(texts, name, monkeypatch):
    file = public_tokenizers.path(name)
    library = Tokenizer.from_file(file).encode_batch(texts, add_special_tokens=False)
    monkeypatch.setattr(word_cache, "SLICE", 5000)
    counts = word_cache.count_tokens(pa.array(texts), *token_counts.counter(file))
    assert counts.tolist() == [len(e.ids) for e in library]
    lists = [word_cache.framed(*part, [], [2]) for part in word_cache.token_ids(pa.array(texts), *orc_tokens.encoder(file))]
    assert pa.concat_arrays(lists).to_pylist() == [[*e.ids, 2] for e in library]


def test_cache_generations_do_not_change_results():
    made = []
    cache = word_cache.PieceCache(lambda parts: made.extend(parts) or [len(p) for p in parts], size=5)
    rng = random.Random(2)
    for _ in range(200):
        parts = list(dict.fromkeys("x" * rng.randrange(1, 40) for _ in range(6)))
        assert cache.of(parts) == [len(p) for p in parts]
    assert len(cache.young) + len(cache.old) <= 25


def test_token_counts_encode_only_what_is_missing(spark, tmp_path, texts):
    file, cache = public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "counts")
    library = Tokenizer.from_file(file)
    some = [*texts[:200], None, texts[5], texts[5]]
    expected = [len(library.encode(t or "", add_special_tokens=False).ids) for t in some]
    docs = table(spark, some)
    found = token_counts.count_tokens(docs, file, cache).orderBy("doc_id").collect()
    assert [r.n_tokens for r in found] == expected
    assert [r.n_bytes for r in found] == [len((t or "").encode()) for t in some]
    assert [r.over_limit for r in found] == [n > 512 for n in expected]
    held = spark.read.parquet(cache)
    assert held.count() == len({t or "" for t in some})
    more = token_counts.count_tokens(table(spark, [*some, "quite new"]), file, cache)
    assert more.count() == len(some) + 1 and spark.read.parquet(cache).count() == len({t or "" for t in some}) + 1
    # Counts come from the cache, of this tokenizer only, repeated entries once.
    held.withColumn("n_tokens", F.lit(7).cast("long")).withColumn("tokenizer_digest", F.lit("other")).write.mode("append").parquet(cache)
    held.write.mode("append").parquet(cache)
    again = token_counts.count_tokens(docs, file, cache).orderBy("doc_id").collect()
    assert [r.n_tokens for r in again] == expected
    assert token_counts.count_tokens(docs.where("false"), file, cache).count() == 0


def test_token_counts_of_a_digest_with_many_rows(spark, tmp_path):
    file = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(file)
    texts = ["the same text again"] * 1500 + [f"text number {i}" for i in range(2500)] + [f"text number {i}" for i in range(5)]
    found = token_counts.count_tokens(table(spark, texts).repartition(4), file, str(tmp_path / "counts")).collect()
    expected = {t: len(library.encode(t, add_special_tokens=False).ids) for t in set(texts)}
    assert sorted((r.doc_id, r.n_tokens) for r in found) == [(i, expected[t]) for i, t in enumerate(texts)]


def test_orc_positions(spark, tmp_path, texts):
    file, path = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "orc")
    library = Tokenizer.from_file(file)
    some = [*texts[:300], None, "", "word " * 3000]
    order = random.Random(4).sample(range(len(some)), len(some))
    docs = spark.createDataFrame([(i * 7 - 50, some[i], "x") for i in order], "doc_id long, text string, part string").repartition(6)
    orc_tokens.write_tokens(docs, path, file, end_id=2)
    found = orc_tokens.read_tokens(spark, path).withColumn("crc", orc_tokens.ids_crc32(F.col("ids"))).orderBy("start").collect()
    start = 0
    for i, row in enumerate(found):
        ids = [*library.encode(some[i] or "", add_special_tokens=False).ids, 2]
        assert (row.doc_id, row.start, row.n_tokens, row.ids) == (i * 7 - 50, start, len(ids), ids)
        assert row.crc == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    wanted = orc_tokens.find_documents(spark, path, [-50, 13])
    assert {r.doc_id for r in wanted.collect()} == {-50, 13}
    assert "PushedFilters: [In(doc_id" in wanted._jdf.queryExecution().toString()


def test_orc_repeated_null_and_no_rows(spark, tmp_path):
    file = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (None, "d"), (None, None)], "doc_id long, text string")
    orc_tokens.write_tokens(docs, str(tmp_path / "a"), file, end_id=2)
    found = orc_tokens.read_tokens(spark, str(tmp_path / "a")).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, None, 1, 1, 1] and found[-1].start + found[-1].n_tokens == 3 + 3 + 2 + 2 + 1
    orc_tokens.write_tokens(docs.where("false"), str(tmp_path / "b"), file, end_id=2)
    assert orc_tokens.read_tokens(spark, str(tmp_path / "b")).count() == 0
