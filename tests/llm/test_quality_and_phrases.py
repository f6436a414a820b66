"""Quality ratio, collocations and spelling variants, against brute force."""

import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from stallwise.llm import collocations, quality_ratio, spelling

HARD_TEXTS = [None, "", " \t\n", "one", "\x0b\x0c", "é", "\U0001f600 x", "a" * 3000]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# Quality ratio


def plain_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(inside),
    )


def of_long(x, seed=42):
    h = xxhash.xxh64_intdigest(struct.pack("<q", x), seed)
    return h - (1 << 64) if h >> 63 else h


def plain_grams(text, buckets):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    single = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    single = [h - (1 << 64) if h >> 63 else h for h in single]
    return [h % buckets for h in [*single, *(of_long(b, of_long(a) % (1 << 64)) for a, b in zip(single, single[1:]))]]


def quality_texts():
    rng = random.Random(7)
    texts = list(HARD_TEXTS)
    for i in range(60):
        words = rng.choices([f"w{j}" for j in range(40)], k=rng.randrange(1, 120))
        if i % 3 == 0:
            words += words[: rng.randrange(len(words) + 1)]
        if i % 5 == 0:
            words = [w + rng.choice(["#", "$$", "|", ""]) for w in words]
        texts.append("".join(w + rng.choice([" ", "  ", "\n", "\t", "\r", " "]) for w in words))
    texts += ["same line\n" * 5 + " \n\n", "x " * 40, texts[10], texts[10]]
    return texts


def test_quality_against_brute_force(spark):
    texts = quality_texts()
    docs = spark.createDataFrame(
        [(i, t, "a", 1.0) for i, t in enumerate(texts)] + [(None, texts[12], "b", None)], "doc_id long, text string, words string, weights double"
    )
    labels = [(i, int(i % 4 != 1), int(i % 7 == 0) if i % 6 else None) for i in range(len(texts))]
    labels += [(12, 0, 0), (10**6, 1, 0), (None, 1, 0), (3, None, None)]
    found = quality_ratio.quality_verdicts(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), buckets=64).collect()
    assert len(found) == len(texts) + 1

    quality, toxic = defaultdict(list), defaultdict(list)
    for i, q, t in labels:
        quality[i].append(q or 0), toxic[i].append(t or 0)
    trusted = {i for i in quality if i is not None and max(quality[i]) == 1 and max(toxic[i]) == 0}
    held = {i for i in trusted if of_long(i) % quality_ratio.HELD_OUT == 0}
    raw, target = Counter(), Counter()
    for i, t in [*enumerate(texts), (None, texts[12])]:
        raw.update(plain_grams(t, 64))
        if i in trusted - held:
            target.update(plain_grams(t, 64))
    weight = [math.log((target[b] + 1) / (target.total() + 64)) - math.log((raw[b] + 1) / (raw.total() + 64)) for b in range(64)]
    scores, base, failed = {}, {}, {}
    for i, t in [*enumerate(texts), (None, texts[12])]:
        grams = plain_grams(t, 64)
        scores[i] = sum(weight[g] for g in grams) / len(grams) if grams else None
        base[i] = plain_base(t)
        failed[i] = base[i][0] < 20 or 100 * base[i][4] > 30 * base[i][0]
    calm = [scores[i] for i in held if i in scores and not failed[i]]
    assert len(calm) > 1
    mean = sum(calm) / len(calm)
    threshold = mean - quality_ratio.SPREAD * math.sqrt(sum((x - mean) ** 2 for x in calm) / len(calm))
    for row in found:
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == base[row.doc_id]
        assert row.base_failed == failed[row.doc_id]
        assert (row.score is None) == (scores[row.doc_id] is None)
        assert row.score is None or row.score == pytest.approx(scores[row.doc_id])
        assert row.threshold == pytest.approx(threshold)
        assert row.kept == (not row.base_failed and row.score >= threshold)


def test_quality_rejects_other_grams(spark):
    rng = random.Random(2)
    good = [" ".join(rng.choices([f"w{j}" for j in range(30)], k=60)) for _ in range(120)]
    junk = [" ".join(rng.choices([f"z{j}|" for j in range(30)], k=60)) for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(good + junk)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 120, 2)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in quality_ratio.quality_verdicts(docs, labels).collect() if not r.base_failed}
    assert all(kept[i] == (i < 120) for i in kept) and any(not kept[i] for i in kept)


def test_quality_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "w " + " ".join(f"v{i}" for i in range(30))), (1, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality_ratio.quality_verdicts(docs, none).collect()
    assert sorted((r.n_words, r.kept, r.threshold) for r in rows) == [(0, False, None), (31, True, None)]
    assert quality_ratio.quality_verdicts(docs.where("false"), none).count() == 0


def test_quality_window_sizes(spark):
    words = random.Random(5).choices("abc", k=400)
    rows = quality_ratio.with_grams(spark.createDataFrame([(words,)], "words array<string>"))
    for window in (2, 3, 5, 7, 8, 11):
        windows = Counter(tuple(words[i : i + window]) for i in range(len(words) - window + 1))
        inside = {i + j for i in range(len(words) - window + 1) if windows[tuple(words[i : i + window])] > 1 for j in range(window)}
        assert quality_ratio.with_repeat_words(rows, window).first().n_repeat_words == len(inside)


def test_quality_without_python(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    counts = quality_ratio.gram_counts(docs, spark.createDataFrame([(1, False)], "label_id long, held_out boolean"))
    plan = quality_ratio.features(docs, quality_ratio.weights(counts))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# Collocations


def plain_collocations(rows, support, top, percent=100):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                f[lang].update(" ".join(words[i : i + k]) for i in range(len(words) - k + 1))
    out = {}
    for lang, counts in f.items():
        good = {p.encode(): c for p, c in counts.items() if c >= support}
        scored = []
        for p, a in good.items():
            w = p.split(b" ")
            if len(w) == 1 or any(len(q.split(b" ")) > len(w) and 100 * b >= percent * a and b" " + p + b" " in b" " + q + b" " for q, b in good.items()):
                continue
            cut = min((1000 * a * n[lang] // (good[b" ".join(w[:j])] * good[b" ".join(w[j:])]), j) for j in range(1, len(w)))
            l, r = good[b" ".join(w[: cut[1]])], good[b" ".join(w[cut[1] :])]
            scored.append((-cut[0], -a, p, l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out[lang, rank] = (p.decode(), -a, l, r, n[lang], -s)
    return out


def phrase_rows():
    rng = random.Random(11)
    words = ["a", "b", "c", "New", "york", "É", "zü", "x\x00y"]
    rows = [(None, t) for t in HARD_TEXTS] + [("en", None), ("", "a b a b")]
    for _ in range(150):
        text = "".join(rng.choices(words, weights=[6, 5, 4, 3, 3, 2, 2, 1])[0] + rng.choices([" ", "  ", "\t", ". ", ",", "\n", "\r", "!"], weights=[30, 2, 2, 1, 1, 1, 1, 1])[0] for _ in range(rng.randrange(60)))
        rows.append((rng.choice(["en", "en", "de", None]), text))
    return rows + rows[20:40]


@pytest.mark.parametrize("support, top, shard, percent", [(5, 1000, 1 << 20, 100), (5, 7, 400, 100), (2, 1000, 50, 100), (9, 1000, 2000, 60), (1, 30, 300, 100)])
def test_collocations_against_brute_force(spark, support, top, shard, percent):
    rows = phrase_rows()
    docs = spark.createDataFrame([(x, t, 1) for x, t in rows], "lang string, text string, phrase int").repartition(3)
    found = collocations.collocations(docs, support=support, top=top, covered_percent=percent, shard_bytes=shard).collect()
    assert {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found} == plain_collocations(rows, support, top, percent)


def test_a_unit_reports_what_may_be_frequent_in_it():
    """Ten shards of a tenth of a unit that is half of everything: 50 of 100 occurrences are needed in it, 5 in a shard."""
    rng, unit = random.Random(3), collocations.Unit(100, 2000)
    counts = [{h: rng.choice([0, 1, 3, 4, 5, 6, 9]) if h > 20 else rng.choice([0, 1, 7]) for h in range(1, 60)} for _ in range(10)]
    for shard in counts:
        needed = unit.needed(100)
        found = [(h, n - (needed - 1)) for h, n in shard.items() if n >= needed]
        unit.add(100, [(np.array([h for h, _ in part], np.uint64), np.array([n for _, n in part], np.int64)) for part in (found[::2], found[1::2])])
    hidden, *rows = [r for batch in unit.reported() for r in batch.to_pylist()]
    assert hidden == {"hash": None, "above": 49}
    above = {r["hash"]: r["above"] for r in rows}
    assert len(above) == len(rows)
    for h in counts[0]:
        bound = sum(max(4, shard[h]) if shard[h] >= 5 else 4 for shard in counts)
        assert above.get(h, 0) == max(0, bound - 49)
        assert sum(shard[h] for shard in counts) < 50 or h in above
    assert len(above) < len({h for shard in counts for h, n in shard.items() if n >= 5})


@pytest.mark.parametrize("held", [0, 30, 10_000])
def test_units_hide_no_frequent_phrase(spark, held):
    rows = phrase_rows()
    docs = spark.createDataFrame([(x or "und", t) for x, t in rows], "lang string, text string").repartition(3)
    total = sum(len((t or "").encode()) for _, t in rows)
    every = np.full(1 << 10, 255, np.uint8)
    found = {r["hash"]: r["above"] for r in collocations.locally_frequent(docs, every, total, 9, 5, 300, held).collect()}
    hidden = found.pop(None)
    counted = collocations.counted(docs, every, 9, 5, 300).where("k > 1").collect()
    assert len(counted) > 20
    for r in counted:
        at = np.uint64(0)
        for i, word in enumerate(r.phrase.split(" ")):
            own = np.uint64(xxhash.xxh64_intdigest(word.encode(), 1))
            lang = np.uint64(xxhash.xxh64_intdigest(r.lang.encode(), 2))
            with np.errstate(over="ignore"):
                at = collocations._mixed(collocations._mixed(lang) ^ own) if i == 0 else collocations._mixed(at * collocations.MIX ^ own)
        assert found.get(int(at.astype(np.int64)), -hidden - 1) + hidden >= r.f


def test_reports_of_single_occurrences_are_small(spark, monkeypatch):
    """Where shards prune nothing, longer phrases are mined of frequent pairs, and a reported hash takes a few bytes."""
    rng = random.Random(5)
    letters = [chr(97 + i) for i in range(20)]
    docs = spark.createDataFrame([("en", " ".join(rng.choices(letters, k=400)) + ". new york city") for _ in range(40)], "lang string, text string")
    found, mine = [], collocations.locally_frequent
    monkeypatch.setattr(collocations, "locally_frequent", lambda *a, **b: found.append((b.get("pairs") is not None, mine(*a, **b))) or found[-1][1])
    phrases = {r.phrase: r.f for r in collocations.frequent_phrases(docs.repartition(2), support=38, longest=4, shard_bytes=400).collect()}
    assert phrases["new york city"] == 40 and "york city" in phrases
    assert [longer for longer, _ in found] == [False, True]
    assert found[1][1].where("hash IS NOT NULL").count() <= 60
    unit = collocations.Unit(1, 1)
    hashes = np.array([rng.getrandbits(64) for _ in range(50_000)], np.uint64)
    unit.add(1, [(hashes, np.ones(len(hashes), np.int64))])
    reports = list(collocations.packed(unit.reported(), 6))
    sent = [collocations._unpack(d.as_py()) for batch in reports for d in batch["data"] if d.is_valid]
    assert (np.concatenate([h for h, _ in sent]) == np.sort(hashes)).all() and (np.concatenate([n for _, n in sent]) == 1).all()
    assert sum(batch.nbytes for batch in reports) < 8 * len(hashes)


@pytest.mark.parametrize("held, most", [(10_000, 8), (5, 400), (9, 400)])
def test_a_task_adds_its_counts_before_they_leave_it(held, most):
    rows = [(lang, phrase, k, 1 + i) for i in range(50) for lang in ("en", "und") for phrase, k in (("", 0), ("a", 1), ("a b", 2), ("x\x00y", 1))]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("lang", "phrase", "k", "f"), r)) for r in rows[at : at + 3]]) for at in range(0, len(rows), 3)]
    out = [tuple(r.values()) for batch in collocations.added(iter(batches), held) for r in batch.to_pylist()]
    sums, expected = Counter(), Counter()
    for lang, phrase, k, f in out:
        sums[lang, phrase, k] += f
    for lang, phrase, k, f in rows:
        expected[lang, phrase, k] += f
    assert sums == expected and len(out) <= most
    assert list(collocations.added(iter([]), held)) == []


def test_collocations_with_full_bitmap(spark):
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "lang string, text string")
    found = collocations.collocations(docs, support=5, top=1000, filter_bits=64).collect()
    assert {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found} == plain_collocations(rows, 5, 1000)


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([(None, None), ("en", " \n.")], "lang string, text string")
    assert collocations.collocations(docs).count() == 0
    assert collocations.collocations(docs.where("false")).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 9 * 10**15
    found = spark.createDataFrame([("x", "", 0, big), ("x", "a", 1, big), ("x", "b", 1, 3), ("x", "a b", 2, 3)], "lang string, phrase string, k int, f long")
    row = collocations.scored(collocations.uncovered(found), found).first()
    assert row.score == 1000 * 3 * big // (big * 3)


# Spelling variants


def plain_variants(rows, one_in=97, at_least=3):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= at_least and len(w) >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_forms(n):
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]])
    return out


def as_dict(rows):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_runs_in_slices(monkeypatch):
    text = "Abc déf-ghi÷ ß😀xyz 12 " * 9
    whole = list(spelling.runs_of(text))
    for size in (1, 2, 3, 7, 50):
        monkeypatch.setattr(spelling, "SLICE", size)
        assert sum(spelling.runs_of(text), []) == whole[0]


@pytest.mark.parametrize("one_in, at_least", [(97, 3), (3, 1)])
def test_spelling_against_brute_force(spark, one_in, at_least):
    rng = random.Random(13)
    stems = ["colour", "theatre", "ünïcode", "aaaaa", "aaaaaa", "abababab", "straße", "running"]
    rows = [(i, t) for i, t in enumerate(HARD_TEXTS)] + [(None, "colour Colour COLOUR"), (1, "Ünïcode×÷ kKelvin")]
    for i in range(80):
        words = []
        for w in rng.choices(stems, weights=range(1, 9), k=40):
            if rng.random() < 0.3:
                at = rng.randrange(len(w) + 1)
                w = w[:at] + rng.choice(["", "e", "o", "À"]) + w[at + rng.randrange(2) :]
            words.append(w.upper() if rng.random() < 0.2 else w)
        rows.append((i, rng.choice([" ", "-", "1"]).join(words)))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, word string").repartition(3)
    expected = plain_forms(plain_variants(rows, one_in, at_least))
    assert len(expected) > 30
    assert as_dict(spelling.spelling_variants(docs, one_in=one_in, at_least=at_least).collect()) == expected


def test_spelling_in_many_tiles(spark, monkeypatch):
    rng = random.Random(17)
    words = {"".join(rng.choices("ab", k=rng.randrange(1, 9))): rng.randrange(1, 50) for _ in range(400)}
    words |= {"\U0001f600bcde": 4, "\U0001f600bcdf": 8, "x" * 5000: 3, "x" * 4999 + "y": 6}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    expected = plain_forms(words)
    for block in (1024, 16):
        monkeypatch.setattr(spelling, "BLOCK", block)
        assert as_dict(spelling.word_forms(table).collect()) == expected
    tiles = spelling._tiles(table).selectExpr("size(a) + size(b) AS size").agg({"size": "max"}).first()[0]
    assert tiles < 400


def test_spelling_chains_and_nothing(spark):
    chain = {"a" * i: 2 ** i for i in range(5, 40)}
    rows = as_dict(spelling.word_forms(spark.createDataFrame(list(chain.items()), "word string, n long")).collect())
    assert {r[1] for r in rows.values()} == {"a" * 39}
    docs = spark.createDataFrame([(1, None), (2, "a b")], "doc_id long, text string")
    assert spelling.spelling_variants(docs).count() == 0
    with pytest.raises(ValueError):
        spelling.word_forms(docs, ratio=1)
