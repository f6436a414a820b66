"""Toxicity, chat formatting, WARC, shards, decontamination and the pipeline."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from checks.compare import compare, duckdb_views
from stallwise.llm import chat_format, decontaminate, hilbert_shards, queries, toxicity, warc
from stallwise.sources import staging

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, name):
    outcome, _ = compare(spark, duckdb_views(SF), queries.QUERIES[name], queries.ORACLE[name], SF)
    assert outcome == "ok"


# --- Toxicity -------------------------------------------------------------------


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").withColumnRenamed("toxic", "grade")
    held = labels.where("pmod(xxhash64(doc_id), 2) = 0")
    model = toxicity.fit(docs, labels.join(held, "doc_id", "left_anti"), derive=True)
    assert (np.diff(model.thresholds) > 0).all()
    scored = toxicity.scored(docs, model).withColumnRenamed("grade", "likely")
    rows = scored.join(held, "doc_id").toPandas()
    toxic = rows["grade"] == 1
    assert rows["rejected"][toxic].mean() > 0.75 and rows["rejected"][~toxic].mean() < 0.01
    assert rows["severity"].between(0, 2).all()


def test_ordinal_gradient_and_order():
    rng = np.random.default_rng(1)
    grades = np.repeat([0, 1, 2], 60)
    lists = [np.unique(np.concatenate([rng.integers(0, 40, 5), np.arange(100, 100 + g)])) for g in grades]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    model = toxicity.fit_arrays(np.concatenate(lists), starts, grades, np.ones(len(grades)))
    scores = np.array([model.weights[x].sum() for x in lists])
    severity = model.above(scores).sum(1)
    assert severity[grades == 0].mean() < 0.4 < severity[grades == 1].mean() < 1.6 < severity[grades == 2].mean()


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, "you idiot"), (2, "fine day"), (None, "idiot"), (3, None), (3, ""), (4, "idiot " * 20000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (1, 0)], "doc_id long, grade int")
    model = toxicity.fit(docs, labels)
    found = toxicity.scored(docs, model).collect()
    assert len(found) == 6 and all(r.severity is not None for r in found)
    none = toxicity.fit(docs, labels.where("grade = 0"))
    assert {r.severity for r in toxicity.scored(docs, none).collect()} == {0.0}
    assert toxicity.scored(docs.where("false"), model).count() == 0
    clash = docs.withColumn("severity", F.lit("x"))
    assert toxicity.without_toxic(clash, none).columns == clash.columns and toxicity.without_toxic(clash, none).count() == 6


def test_features_do_not_depend_on_slices(monkeypatch):
    texts = pa.array(["One two", None, "", "ünï two; TWO", "one"])
    whole = [b[s[i] : s[i + 1]].tolist() for b, s in toxicity.features(texts) for i in range(len(s) - 1)]
    monkeypatch.setattr("stallwise.llm.word_cache.SLICE", 1)
    assert whole == [b[s[i] : s[i + 1]].tolist() for b, s in toxicity.features(texts) for i in range(len(s) - 1)]


# --- Chat -----------------------------------------------------------------------


@pytest.mark.parametrize("text", ["", "\\", "###", "####", "######", "</turn>", "\\### x </turn>\n", "a\\h\\e\\c", ":", "\\\\", "</tu</turn>rn>", "é😀"])
def test_turns_come_back(text):
    for role in (text, "assistant"):
        segment = chat_format.OPEN + chat_format.escape(role, chat_format.IN_ROLE) + chat_format.BETWEEN + chat_format.escape(text) + chat_format.CLOSE
        assert chat_format.parse(segment) == (role, text)
        assert segment.count("###") == 1 and segment.count("</turn>") == 1


def test_layouts(spark):
    records = [
        (1, {"prompt": "p", "completion": "c"}), (2, {"messages": [{"role": "user", "content": "a"}, {"content": None, "role": "assistant"}]}),
        (3, {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}), (4, {"unknown": 1}), (5, None),
        (6, {"instruction": "i", "input": "n", "output": "o"}), (7, [1]), (None, {"question": "q", "answer": "r"}),
    ]
    table = spark.createDataFrame([(i, None if r is None else json.dumps(r)) for i, r in records] + [(8, "{broken")], "id long, record string")
    turns = chat_format.canonical_turns(table, "id", "record")
    known = {}
    for r in turns.where("known").orderBy("turn").collect():
        known.setdefault(r.conv, []).append((r.role, r.text))
    assert known == {
        1: [("user", "p"), ("assistant", "c")], 2: [("user", "a"), ("assistant", "")], 3: [("user", "h"), ("assistant", "g")],
        6: [("user", "i"), ("user", "n"), ("assistant", "o")], None: [("user", "q"), ("assistant", "r")],
    }
    assert sum(r.records for r in chat_format.unknown_layouts(turns).collect()) == 4
    # Order of fields and length of lists do not change a layout.
    assert chat_format.fingerprint({"b": [1, 2], "a": {"x": 1}}) == chat_format.fingerprint({"a": {"x": 5}, "b": [3]})


def test_chat_ties_and_nulls(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, None, "user", "x"), (None, 1, "assistant", "y"), (1, 0, "assistant", "a###b")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    packed = table.select("conv_id", F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"}).alias("r"))
    found = {r.conv: r for r in chat_format.read_back(chat_format.formatted(chat_format.canonical_turns(packed, "conv_id", "r"))).collect()}
    assert found[1].n_turns == 4 and found[1].loss_chars == 5 and found[None].loss_chars == 1
    assert found[1].turns_sha256 == hashlib.sha256(b"user\nx\n" + b"\n\n" * 2 + b"assistant\na###b\n").hexdigest()
    assert chat_format.read_back(chat_format.formatted(chat_format.canonical_turns(packed.where("false"), "conv_id", "r"))).count() == 0


# --- WARC -----------------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    big, odd = "x" * 200_000 + "é", "WARC/1.1\r\n\r\n\r\n0\r\n\r\n" * 300
    rows = [(1, "http://a/ü\r\nb", big), (2, None, big), (3, "u", odd), (9, "u", odd), (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (None, "u", big), (3, "u", odd)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path, segment_bytes=10_000)
    records = warc.read_records(spark, path)
    kinds = Counter(r.type for r in records.collect())
    assert kinds["continuation"] >= 20 and kinds["revisit"] == 4
    found = sorted(tuple(r) for r in warc.page_records(spark, path).fillna(-1, ["page_id", "refers_to"]).collect())
    expected = []
    for page, _, html in rows:
        body = (html or "").encode()
        again = len(body) >= 1000 and not (page == (2 if html == big else 9))
        expected.append((-1 if page is None else page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", (2 if html == big else 9) if again else -1))
    assert found == sorted(expected)
    payloads = {r.page_id: bytes(r.payload).decode() for r in warc.responses(records).collect()}
    assert payloads[2] == big and payloads[9] == odd and payloads[4] == ""
    warc.write_archives(pages.where("false"), str(tmp_path / "none"))
    assert warc.page_records(spark, str(tmp_path / "none")).count() == 0


def test_warc_of_shuffled_pages(spark, tmp_path):
    """Equal pages keep one response when the pages come out of a shuffle."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        html = spark.range(4000).selectExpr("id AS page_id", "concat_ws('', transform(sequence(1, 50), i -> sha1(concat(id % 1000, ' ', i)))) AS html")
        urls = spark.range(4000).selectExpr("id AS page_id", "concat_ws('', transform(sequence(1, 50), i -> sha1(concat(id, ' ', i)))) AS url")
        path = str(tmp_path / "warc")
        warc.write_archives(html.join(urls, "page_id"), path)
        found = {r.page_id: r for r in warc.page_records(spark, path).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(found) == list(range(4000))
    for page, r in found.items():
        html = "".join(hashlib.sha1(f"{page % 1000} {i}".encode()).hexdigest() for i in range(1, 51))
        digest = hashlib.sha1(html.encode()).hexdigest()
        to = 3000 + page % 1000
        assert (r.payload_bytes, r.payload_digest) == (2000, digest)
        assert (r.record_type, r.refers_to) == (("response", None) if page == to else ("revisit", to))


def test_warc_stages_pages_as_zstd(spark, tmp_path, monkeypatch):
    folders = []
    monkeypatch.setattr(staging, "new_path", lambda spark, name: folders.append(str(tmp_path / name)) or folders[-1])
    pages = spark.createDataFrame([(1, "u", "<p>one</p>"), (2, "u", None)], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "warc"))
    files = [f.name for folder in folders for f in Path(folder).glob("*.parquet")]
    assert files and all(".zstd." in f for f in files)
    assert {r["page_id"] for r in warc.page_records(spark, str(tmp_path / "warc")).collect()} == {1, 2}


def test_warc_revisit_without_response_is_an_error(spark, tmp_path):
    lone = b"".join(warc.records_of(1, 0, "u", "0" * 40, None, (2, 5), 1000)) + warc.END
    (tmp_path / "a.gz").write_bytes(lone)
    for read in (lambda t: t.collect(), lambda t: t.count()):
        with pytest.raises(Exception, match="without its response"):
            read(warc.page_records(spark, str(tmp_path)))


def test_warc_framing_and_errors():
    for size in (0, 1, 8191, 8192, 8193, 50_000):
        data = random.Random(size).randbytes(size)
        assert warc.unchunked(warc.chunked(data)) == data
    assert warc.unchunked(b"3;x=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")
    one = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<a>")], b"abc") + warc.END
    assert [b for _, b in warc.parse_archive(one + one)] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(warc.parse_archive(one.replace(b"Length: 3", b"Length: 2")))


# --- Shards ---------------------------------------------------------------------


@pytest.mark.parametrize(("dims", "bits"), [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(spark, dims, bits):
    cells = spark.range(1 << dims * bits)
    names = [f"d{i}" for i in range(dims)]
    cells = cells.select(*[F.expr(f"shiftright(id, {i * bits}) & {(1 << bits) - 1}").alias(n) for i, n in enumerate(names)])
    rows = hilbert_shards.with_curve(cells, names, bits).orderBy("curve").collect()
    assert [r.curve for r in rows] == list(range(1 << dims * bits))
    assert all(sum(abs(a[n] - b[n]) for n in names) == 1 for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("count", [0, 1, 5, 16, 1003])
def test_shards_are_gapless_and_even(spark, count):
    rows = [(None if i % 50 == 7 else i // 3, None if i % 11 == 0 else "é" * (i % 40), None if i % 5 == 0 else f"s{i % 3}", i % 300, "x") for i in range(count)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, size string").repartition(5)
    found = hilbert_shards.assign_shards(docs, ["source", "n_chars"]).collect()
    assert len(found) == count
    sizes = Counter(r.shard for r in found)
    assert max(sizes.values(), default=0) - min((sizes.get(s, 0) for s in range(16)), default=0) <= 1
    for shard in sizes:
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(sizes[shard]))
    body = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == body
    ordered = sorted(found, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in ordered] == sorted(r.curve for r in found)


def test_written_shards_prune(spark, tmp_path):
    docs = spark.range(2000).selectExpr("id AS doc_id", "concat('t', id) AS text", "concat('s', id % 9) AS source", "id % 700 AS n_chars")
    path = str(tmp_path / "shards")
    hilbert_shards.write_shards(docs, path, ["source", "n_chars"], shards=4, files_per_shard=4)
    stored = spark.read.parquet(path)
    assert stored.count() == 2000 and [r["count"] for r in stored.groupBy("shard").count().collect()] == [500] * 4
    hit = stored.where(hilbert_shards.cell_filter(stored, "source", "s3"))
    assert hit.where("source = 's3'").count() == docs.where("source = 's3'").count()
    files = stored.withColumn("f", F.input_file_name()).groupBy("f").agg(F.min("q_source").alias("a"), F.max("q_source").alias("b")).collect()
    cell = hit.select("q_source").first()[0]
    assert sum(f.a <= cell <= f.b for f in files) < len(files)


# --- Decontamination --------------------------------------------------------------


def plain_contamination(docs, items, width):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: pattern.findall((t or "").translate(lower))
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for item, question in items:
            asked = words(question)
            size = min(width, len(asked))
            grams = {tuple(asked[i : i + size]) for i in range(len(asked) - size + 1)} if asked else set()
            for i in range(len(own) - size + 1):
                if tuple(own[i : i + size]) in grams:
                    hit |= set(range(i, i + size))
                    found.add(item)
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(own), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("segment", [8 << 20, 60])
def test_contamination_equals_brute_force(spark, segment, monkeypatch):
    monkeypatch.setattr("stallwise.llm.decontaminate.SEGMENT", segment)
    rng = random.Random(segment)
    vocabulary = ["The", "a", "É", "b2", "cat", "x-y"]
    make = lambda n: " ".join(rng.choices(vocabulary, k=n))
    docs = [(i, make(rng.randrange(40))) for i in range(60)] + [(60, None), (60, ""), (None, make(30)), (61, make(3000))]
    items = [(i, make(rng.choice([1, 2, 3, 4, 6, 9]))) for i in range(10, 25)] + [(30, None), (31, "!!"), (None, make(4)), (12, make(5)), (9, make(5))]
    table = spark.createDataFrame([(*d, "q") for d in docs], "doc_id long, text string, place string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = sorted(plain_contamination(docs, items, 4), key=repr)
    found = decontaminate.decontaminate(table, benchmark, width=4)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected
    path = decontaminate.new_path(spark, "index")
    decontaminate.build_index(table, path)
    blocks = decontaminate.phrase_matches(spark, path, benchmark, 4, block_words=10)
    assert sorted((tuple(r) for r in decontaminate.contamination(spark, path, blocks).collect()), key=repr) == expected
    assert decontaminate.decontaminate(table.where("false"), benchmark).count() == 0
    assert {r.contaminated for r in decontaminate.decontaminate(table, benchmark.where("false")).collect()} == {False}
    clean = Counter(r[0] for r in expected if not r[-1])
    assert Counter(r.doc_id for r in decontaminate.without_contaminated(table, benchmark, 4).collect()) == clean


def test_proximity_of_long_and_repeating_phrases(spark, tmp_path):
    long = [f"w{i}" for i in range(1500)]
    docs = [(1, " ".join(long)), (2, " ".join(long[:700] + long[750:])), (3, "x a b"), (4, "a x b a")]
    decontaminate.build_index(spark.createDataFrame(docs, "doc_id long, text string"), str(tmp_path / "index"))
    phrases = spark.createDataFrame([(1, " ".join(long[750:] + long[:750])), (2, "a a b"), (3, "b a")], "item_id long, text string")
    found = decontaminate.proximity_matches(spark, str(tmp_path / "index"), phrases, 1000)
    matched = decontaminate.documents(spark, str(tmp_path / "index")).select("segment", "place", "kept.doc_id").join(found, ["segment", "place"])
    assert {(r.doc_id, r.item_id) for r in matched.collect()} == {(1, 1), (4, 2), (3, 3), (4, 3)}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red one two blue"), (2, "blue " + "x " * 9 + "red"), (3, "red"), (4, "red blue")], "doc_id long, text string")
    path = decontaminate.new_path(spark, "index")
    decontaminate.build_index(docs, path)
    phrases = spark.createDataFrame([(1, "blue red")], "item_id long, text string")
    for distance, expected in ((1, {4}), (3, {1, 4}), (10, {1, 2, 4})):
        found = decontaminate.proximity_matches(spark, path, phrases, distance)
        rows = found.join(decontaminate.documents(spark, path), ["segment", "place"]).select("kept.doc_id").collect()
        assert {r.doc_id for r in rows} == expected


# --- Pipeline -------------------------------------------------------------------


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for (_, stage), check in zip(corpus_pipeline.STAGES[:3], ("toxic", "near", "clean")):
        before, kept = kept, stage(spark, kept, SF)
        assert kept.columns == docs.columns
        mine = {r.doc_id for r in kept.collect()}
        if check == "near":
            from stallwise.llm import simhash

            rows = simhash.near_duplicates(before).collect()
            assert mine == {r.component_id for r in rows}
        if check == "clean":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            rows = plain_contamination([(r.doc_id, r.text) for r in before.collect()], items, 10)
            assert mine == {r[0] for r in rows if not r[-1]}
    final = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in final} == mine
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in final:
        assert r.ids == library.encode(texts[r.doc_id], add_bos=True, add_eos=True) and r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4")).hexdigest()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stage = corpus_pipeline.remove_toxic(spark, docs, SF).select("doc_id")
    assert labels.where("toxic = 0").join(stage, "doc_id", "left_anti").count() == 0


def test_shards_keep_columns_with_clashing_names(spark, tmp_path):
    names = ["doc_id", "_rank", "_curve", "_total", "_run", "_at", "_part", "_flip", "_x0", "_d0", "_row"]
    docs = spark.createDataFrame([(i, *[f"{n}{i}" for n in names[1:]], "en", f"text {i}") for i in range(40)], [*names, "lang", "text"])
    path = f"{tmp_path}/shards"
    hilbert_shards.write_shards(docs, path, ["lang", "doc_id"], shards=4)
    stored = spark.read.parquet(path)
    assert sorted(map(tuple, stored.select(docs.columns).collect())) == sorted(map(tuple, docs.collect()))
    for taken in ("shard", "q_lang"):
        with pytest.raises(ValueError):
            hilbert_shards.write_shards(docs.withColumn(taken, docs["text"]), path, ["lang"])


def test_decontamination_with_clashing_names(spark):
    words = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, words, "a", "b", "c", "d"), (2, "other words", "e", "f", "g", "h"), (3, None, None, None, None, None)], ["doc_id", "body", "_bad", "key", "text", "n_words"])
    benchmark = spark.createDataFrame([("x", words)], ["item_id", "text"])
    kept = decontaminate.without_contaminated(docs, benchmark, text="body")
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect()))[0] == (2, "other words", "e", "f", "g", "h")
    assert kept.count() == 2
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, benchmark, text="body", keep=["n_words"])
