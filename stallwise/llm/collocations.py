"""Phrase collocations by SON partitioning, scored by their lowest cut.

Texts are cut into shards of bounded size. Each shard is mined completely, level by
level, at a local support of the global one times the shard's share of all bytes: a
phrase that is frequent overall is frequent in one shard at least, whatever the
shards are. The shards of a task report together, as a unit: what a shard found counts
as found, and a phrase that it did not find stands in it at most one time less than its
support. Phrases whose bound stays below the unit's own local support are not reported.
The union of the reported phrases comes with what each unit found above its support; in
units that do not report a phrase it stands at most one time less than their support.
Phrases whose upper bound stays below the global
support leave the union, for certain. The rest are the candidates: every shard counts
them, and the counts are added up exactly, those of a task before they leave it.
Before all that, words are counted, so that shards look at phrases of frequent words
only; both passes prune by Apriori.

Candidates travel to the shards as a bitmap of 64-bit hashes. What gets in by a
collision is counted like any other phrase: collisions cost rows and change no result.

Scale: the bitmap has ``filter_bits`` bits, whatever the corpus (4 MB by default), and
is the only thing broadcast. With a fixed support and ever more shards the local
support falls to one; shards then report all phrases of frequent words, and the
union is a plain count combined per shard. So the support should grow with the corpus
where it can. Where it falls to one, phrases of two words are mined first, and longer ones
in a further pass, of those pairs only that reach the support everywhere; there are as many
tasks as shards. Else, and in the count, there is a task per core, and a phrase leaves a task
once, not once per shard, until there are more than a task holds (``held``). Reports leave a
task as sorted hashes by part of the hash range, their differences packed in a few bytes, and
are added up per part; a part's size is bounded by ``PART_BYTES`` of text. Nothing is cut off
either way. All shuffles are keyed by word or phrase, so a language or phrase that holds a third
of all words is shared by all tasks; the best phrases of a language are picked in slices
before its slices meet.

Defined results: null and empty texts have no words; a null language is ``none_as``;
repeated rows count again; ties of scores go by count, then phrase; texts longer than
a shard are shards of their own, since phrases do not cross texts; an empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.sources.staging import stage

# Bytes of text mined at once.
SHARD_BYTES = 32 << 20
# Bytes of text taken apart at once.
SLICE = 2 << 20
FILTER_BITS = 1 << 25
# Bits of a bitmap value of Spark's functions.
BUCKET = 1 << 15
# Rows passed on at once.
OUT_ROWS = 50_000
# Counts, and hashes of phrases, that a task holds before it passes them on.
HELD, HELD_HASHES = 1_000_000, 2_000_000
# Bytes of text for which reports have a part of their own, and parts passed on at once.
PART_BYTES, PARTS_PER_BATCH = 8 << 20, 256
CODEC = pa.Codec("zstd", 1)

# What a byte is to the words: part of one, a gap between two, or the end of a piece.
GAP, END = 1, 2
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t")] = GAP
KIND[list(b".,;:!?\n\x0b\x0c\r")] = END

MIX = np.uint64(0x9E3779B97F4A7C15)


class Shard:
    """The words of some texts as numbers, one per language and word. Texts are taken in slices and not kept."""

    def __init__(self):
        self.size = 0
        self.langs: list[str] = []
        self.numbers: dict[str, dict[bytes, int]] = {}
        self.known: list[bytes] = []
        self.lang_of: list[int] = []
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, texts: list[bytes], lang: str) -> None:
        data = np.frombuffer((b"\n".join(texts) + b"\n").lower(), np.uint8)
        self.size += len(data) - len(texts)
        kind = KIND[data]
        inside = np.zeros(len(data) + 1, np.int8)
        inside[:-1] = kind == 0
        edges = np.flatnonzero(np.diff(inside, prepend=np.int8(0)))
        starts, ends = edges[::2], edges[1::2]
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=offsets[1:])
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside[:-1] > 0])]
        ).dictionary_encode()
        piece = np.searchsorted(np.flatnonzero(kind == END), starts)
        followed = np.zeros(len(starts), bool)
        followed[:-1] = piece[1:] == piece[:-1]
        self.parts.append((self._numbered(words.dictionary, lang)[words.indices.to_numpy(zero_copy_only=False)], followed))

    def _numbered(self, words: pa.Array, lang: str) -> np.ndarray:
        if lang not in self.numbers:
            self.numbers[lang] = {}
            self.langs.append(lang)
        numbers, lang_at = self.numbers[lang], self.langs.index(lang)
        out = np.empty(len(words), np.int32)
        for i, word in enumerate(words.to_pylist()):
            number = numbers.get(word)
            if number is None:
                number = numbers[word] = len(self.known)
                self.known.append(word)
                self.lang_of.append(lang_at)
            out[i] = number
        return out

    def closed(self) -> Shard:
        """Ready to be mined: ``word`` and ``followed`` (in its piece) by place, hashes and languages by word."""
        self.word, self.followed = (np.concatenate(x) for x in zip(*self.parts))
        self.words = pa.array(self.known, pa.large_binary()).cast(pa.large_string())
        self.word_hash = np.array([xxhash.xxh64_intdigest(w, 1) for w in self.known], np.uint64)
        self.word_lang = np.array(self.lang_of, np.int32)
        self.lang_hash = np.array([xxhash.xxh64_intdigest(x.encode(), 2) for x in self.langs], np.uint64)
        self.parts, self.numbers, self.known, self.lang_of = [], {}, [], []
        return self

    def frequent(
        self, longest: int, kept: Callable[[np.ndarray, np.ndarray], np.ndarray], *chosen: Callable[[np.ndarray], np.ndarray]
    ) -> Iterator[tuple]:
        """Level by level ``(k, hashes, counts, lang, first)`` of the phrases that ``kept(hashes, counts)`` lets through.

        ``first`` is where a phrase first stands. Longer phrases are looked for where both their parts were kept.
        Of the functions of hashes ``chosen``, the first chooses the words, the second the phrases of two.
        """
        n = len(self.word)
        at, ids, distinct = np.arange(n, dtype=np.int32), self.word, len(self.words)
        number = hashes = None
        for k in range(1, longest + 1):
            first = np.empty(distinct, np.int32)
            first[ids[::-1]] = at[::-1]
            if k == 1:
                hashes = _mixed(_mixed(self.lang_hash[self.word_lang]) ^ self.word_hash)
            else:
                hashes = _mixed(hashes[number[first]] * MIX ^ self.word_hash[self.word[first + k - 1]])
            counts = np.bincount(ids, minlength=distinct)
            good = chosen[k - 1](hashes) if k <= len(chosen) else kept(hashes, counts)
            yield k, hashes[good], counts[good], self.word_lang[self.word[first[good]]], first[good]
            if k == longest or not good.any():
                return
            # The number of the phrase that starts at each place, or -1.
            number = np.full(n + 1, -1, np.int32)
            there = good[ids]
            at, ids = at[there], ids[there]
            number[at] = ids
            # Phrases that overlap are in one piece; of words that has to be seen.
            at = at[(number[at + 1] >= 0) & self.followed[at]] if k == 1 else at[number[at + 1] >= 0]
            key = number[at].astype(np.int64)
            key *= distinct
            key += number[at + 1]
            del there, ids
            ids, known = pd.factorize(key)
            del key
            ids, distinct = ids.astype(np.int32), len(known)
            del known

    def phrases(self, first: np.ndarray, k: int) -> pa.Array:
        columns = [self.words.take(pa.array(self.word[first + j])) for j in range(k)]
        return pc.binary_join_element_wise(*columns, pa.scalar(" ", pa.large_string())).cast(pa.string())


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64 (a fixed public function)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shards(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[Shard]:
    """The texts of a task in shards. Batches hold ``lang``, ``text``."""
    shard, texts, size = Shard(), defaultdict(list), 0

    def flush() -> None:
        for lang, bodies in texts.items():
            shard.add(bodies, lang)
        texts.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            body = text.as_buffer()
            if body is None or not len(body):
                continue
            texts[lang.as_py()].append(body.to_pybytes())
            size += len(body)
            if size >= min(SLICE, shard_bytes):
                flush()
                size = 0
            if shard.size >= shard_bytes:
                yield shard.closed()
                shard = Shard()
    flush()
    if shard.size:
        yield shard.closed()


def listed(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have both their bits set."""
    last = np.uint64(len(bitmap) * 8 - 1)
    out = np.ones(len(hashes), bool)
    for place in (hashes & last, (hashes >> np.uint64(32)) & last):
        out &= (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return out


def bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """Packed bits of the column ``hash``: at most ``bits`` / 8 bytes come to the driver."""
    places = hashes.selectExpr(f"explode(array(1 + (hash & {bits - 1}L), 1 + (shiftrightunsigned(hash, 32) & {bits - 1}L))) AS bit")
    parts = places.groupBy(F.expr("bitmap_bucket_number(bit) - 1").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("packed"))
    whole = np.zeros((-(-bits // BUCKET), BUCKET // 8), np.uint8)
    for row in parts.collect():
        whole[row.bucket] = np.frombuffer(row.packed, np.uint8)
    return whole.reshape(-1)[: bits // 8]


def frequent_words(texts: DataFrame, support: int, shard_bytes: int) -> DataFrame:
    """``hash`` of the words with at least ``support`` occurrences in their language."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, shard_bytes):
            for _, hashes, n, _, _ in shard.frequent(1, lambda hashes, counts: counts > 0):
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], ["hash", "n"])

    return texts.mapInArrow(words, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= support).select("hash")


def locally_frequent(
    texts: DataFrame, words: np.ndarray, total: int, support: int, longest: int, shard_bytes: int, held: int = HELD_HASHES,
    pairs: np.ndarray | None = None,
) -> DataFrame:
    """``hash``, ``above``: per phrase of two words or more how far its counts, or bounds of them, exceed what units may hide of it.

    A unit is what a task mines before it holds too many phrases. Only units where a phrase may be locally frequent
    add to ``above``. The null hash has the occurrences that all units may hide; phrases that with them stay
    below the support are left out. With ``pairs``, that bitmap chooses the phrases of two words, and longer ones are reported.
    """
    context = texts.sparkSession.sparkContext
    shared = context.broadcast((words, pairs))
    bits, least = part_bits(total), 2 if pairs is None else 3

    def mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = Unit(support, total)
        for shard in shards(batches, shard_bytes):
            needed = unit.needed(shard.size)
            words, *pairs = (partial(listed, x) for x in shared.value if x is not None)
            levels = shard.frequent(longest, lambda hashes, counts: counts >= needed, words, *pairs)
            found = ((hashes, n - (needed - 1)) for k, hashes, n, _, _ in levels if k >= least)
            # A shard that hides nothing may report level by level, in several units.
            for size, part in [(shard.size, list(found))] if needed > 1 else _sized(shard.size, found):
                if needed == 1 and len(unit.hashes) and len(unit.hashes) + sum(len(h) for h, _ in part) > held:
                    yield from packed(unit.reported(), bits)
                    unit = Unit(support, total)
                unit.add(size, part)
                if len(unit.hashes) > held:
                    yield from packed(unit.reported(), bits)
                    unit = Unit(support, total)
        if unit.size or len(unit.hashes):
            yield from packed(unit.reported(), bits)

    # Where shards hide nothing, nothing is gained by tasks of many shards.
    if support * shard_bytes > total:
        texts = texts.coalesce(context.defaultParallelism)
    reports = texts.mapInArrow(mined, "part int, hides long, data binary")
    return reports.groupBy("part").applyInArrow(lambda table: _summed(table, support), "hash long, above long")


def _sized(size: int, found: Iterator[tuple]) -> Iterator[tuple[int, list[tuple]]]:
    """Each level by itself; the first has the size."""
    yield size, []
    for level in found:
        yield 0, [level]


def part_bits(total: int) -> int:
    """Reports are dealt out by so many first bits of the hash: a part for each ``PART_BYTES`` of text."""
    return max(6, (total // PART_BYTES).bit_length())


def packed(report: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """A unit's report by part: what the unit hides once, and its phrases in order, a few bytes each."""
    hides = next(report)["above"][0].as_py()
    # The first part hears of every unit.
    every = np.arange(1 << bits if hides else 1, dtype=np.int32)
    yield _parts(every, np.full(len(every), hides), [None] * len(every))
    for batch in report:
        hashes = batch["hash"].to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        hashes, above = hashes[order], batch["above"].to_numpy()[order]
        edges = np.searchsorted(hashes >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        # Differences of neighbours; a part's first hash stands whole.
        gaps = np.diff(hashes, prepend=np.uint64(0))
        full = np.flatnonzero(np.diff(edges))
        gaps[edges[full]] = hashes[edges[full]]
        for at in range(0, len(full), PARTS_PER_BATCH):
            some = full[at : at + PARTS_PER_BATCH]
            yield _parts(some.astype(np.int32), np.zeros(len(some), np.int64), [_pack(gaps[edges[p] : edges[p + 1]], above[edges[p] : edges[p + 1]]) for p in some])


def _parts(part: np.ndarray, hides: np.ndarray, data: list[bytes | None]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part), pa.array(hides.astype(np.int64)), pa.array(data, pa.binary())], ["part", "hides", "data"])


def _pack(gaps: np.ndarray, above: np.ndarray) -> bytes:
    """Numbers byte by byte, highest bytes and all, so that the many zeros are next to each other."""
    both = np.concatenate([gaps, above.astype(np.uint64)]).view(np.uint8).reshape(2, -1, 8).transpose(0, 2, 1).tobytes()
    return len(gaps).to_bytes(8, "little") + CODEC.compress(both, asbytes=True)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    both = np.frombuffer(CODEC.decompress(data[8:], 16 * n, asbytes=True), np.uint8).reshape(2, 8, n)
    gaps, above = np.ascontiguousarray(both.transpose(0, 2, 1)).view(np.uint64)[..., 0]
    return gaps.cumsum(dtype=np.uint64), above.astype(np.int64)


def _summed(table: pa.Table, support: int) -> pa.Table:
    """A part's phrases that may be frequent, of all units; the first part adds what they all hide."""
    hidden = pc.sum(table["hides"]).as_py()
    reports = [_unpack(d.as_py()) for d in table["data"] if d.is_valid]
    hashes, above = (np.concatenate([np.empty(0, kind), *x]) for kind, x in zip((np.uint64, np.int64), zip(*reports) if reports else ((), ())))
    del reports
    order = np.argsort(hashes)
    hashes, above = hashes[order], above[order]
    first = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]))
    sums = np.add.reduceat(above, first) if len(first) else above
    good = sums + hidden >= support
    rows = pa.table({"hash": hashes[first][good].view(np.int64), "above": sums[good]})
    return rows if table["part"][0].as_py() else pa.concat_tables([pa.table({"hash": pa.array([None], pa.int64()), "above": [hidden]}), rows])


class Unit:
    """Shards of a task, mined one by one, that report together.

    What its shards found above their local support, and what they may hide, bounds a phrase's count in the unit.
    Where the bound stays below the unit's own local support, the phrase is not reported.
    """

    def __init__(self, support: int, total: int):
        self.support, self.total, self.size, self.hidden = support, total, 0, 0
        self.hashes, self.above = np.empty(0, np.uint64), np.empty(0, np.int64)

    def needed(self, size: int) -> int:
        """Smallest count that reaches support * size / total; phrases below it are not reported."""
        return -(-self.support * size // self.total)

    def add(self, size: int, found: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """A shard of ``size`` bytes with its hashes and counts above what it may hide."""
        self.size += size
        self.hidden += max(0, self.needed(size) - 1)
        parts = [(h, n) for h, n in [(self.hashes, self.above), *found] if len(h)]
        if len(parts) < 2:
            # Nothing to add up.
            self.hashes, self.above = parts[0] if parts else (self.hashes, self.above)
            return
        at, self.hashes = pd.factorize(np.concatenate([h for h, _ in parts]))
        sums = np.zeros(len(self.hashes), np.int64)
        np.add.at(sums, at, np.concatenate([n for _, n in parts]).astype(np.int64))
        self.above = sums

    def reported(self) -> Iterator[pa.RecordBatch]:
        """``hash``, ``above``, and by the null hash what the unit may hide."""
        hides = max(0, self.needed(self.size) - 1)
        above = self.above + (self.hidden - hides)
        good = above > 0
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([hides])], ["hash", "above"])
        for at in range(0, len(above), HELD_HASHES):
            cut = slice(at, at + HELD_HASHES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.hashes[cut][good[cut]].view(np.int64)), pa.array(above[cut][good[cut]])], ["hash", "above"]
            )


def counted(texts: DataFrame, union: np.ndarray, support: int, longest: int, shard_bytes: int, held: int = HELD) -> DataFrame:
    """``lang``, ``phrase``, ``k``, ``f`` of the phrases of the union with at least ``support`` occurrences,
    and of each language all its words as the phrase of no words."""
    context = texts.sparkSession.sparkContext
    shared = context.broadcast(union)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, shard_bytes):
            langs = pa.array(shard.langs, pa.string())
            words = np.bincount(shard.word_lang[shard.word], minlength=len(langs))
            yield _rows(langs, pa.array([""] * len(langs), pa.string()), 0, words)
            for k, _, n, lang, first in shard.frequent(longest, lambda hashes, _: listed(shared.value, hashes)):
                for at in range(0, len(first), OUT_ROWS):
                    cut = slice(at, at + OUT_ROWS)
                    yield _rows(langs.take(pa.array(lang[cut])), shard.phrases(first[cut], k), k, n[cut])

    return (
        # Tasks have added up their shards already: nothing is left to combine before the shuffle.
        texts.coalesce(context.defaultParallelism).mapInArrow(lambda batches: added(counts(batches), held), "lang string, phrase string, k int, f long")
        .repartition("lang", "phrase")
        .groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f")).where((F.col("f") >= support) | (F.col("k") == 0))
    )


def added(counts: Iterator[pa.RecordBatch], held: int) -> Iterator[pa.RecordBatch]:
    """Counts of the same phrase added up. What is held is passed on where that leaves more than half of ``held`` rows."""
    parts, rows = [], 0

    def summed() -> pa.Table:
        sums = pa.Table.from_batches(parts).group_by(["lang", "phrase", "k"], use_threads=False).aggregate([("f", "sum")])
        return sums.rename_columns([c.removesuffix("_sum") for c in sums.column_names]).select(["lang", "phrase", "k", "f"])

    for part in counts:
        parts.append(part)
        rows += len(part)
        if rows >= held:
            table = summed()
            if len(table) > held // 2:
                yield from table.to_batches(OUT_ROWS)
                table = table.slice(0, 0)
            parts, rows = table.to_batches(), len(table)
    if parts:
        yield from summed().to_batches(OUT_ROWS)


def _rows(langs: pa.Array, phrases: pa.Array, k: int, f: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [langs, phrases, pa.array(np.full(len(f), k, np.int32)), pa.array(f.astype(np.int64))], ["lang", "phrase", "k", "f"]
    )


def frequent_phrases(
    docs: DataFrame, lang: str = "lang", text: str = "text", support: int = 100, longest: int = 5,
    none_as: str = "und", filter_bits: int = FILTER_BITS, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``lang``, ``phrase``, ``k`` (words), ``f``: all phrases of up to ``longest`` words with at least
    ``support`` occurrences in their language, and per language its words as the phrase of no words."""
    if filter_bits & (filter_bits - 1) or not 8 <= filter_bits <= 1 << 32:
        raise ValueError("filter_bits must be a power of two from 8 to 2^32")
    texts = docs.select(F.coalesce(F.col(lang), F.lit(none_as)).alias("lang"), F.col(text).alias("text"))
    total = texts.agg(F.expr("coalesce(sum(octet_length(text)), 0)")).first()[0]
    # Partitions smaller than a shard are mined together: the same shards, however the input is dealt.
    texts = texts.coalesce(max(1, -(-total // shard_bytes)))
    words = bitmap(frequent_words(texts, support, shard_bytes), filter_bits)

    def mined(longest: int, size: int, pairs: np.ndarray | None = None) -> np.ndarray:
        found = locally_frequent(texts, words, max(total, 1), support, longest, size, pairs=pairs)
        return bitmap(found.where("hash IS NOT NULL").select("hash"), filter_bits)

    if support * shard_bytes > total:
        phrases = mined(longest, shard_bytes)
    else:
        # Shards prune nothing: phrases of two words are mined first, and in smaller shards, as all that is found is held.
        size = max(1, shard_bytes // 2)
        phrases = mined(min(2, longest), size)
        if longest > 2:
            phrases = phrases | mined(longest, size, phrases)
    # Smaller shards leave room for the counts that a task holds.
    return stage(counted(texts, words | phrases, support, longest, max(1, shard_bytes // 2)), "phrases")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", support: int = 100, longest: int = 5, top: int = 2000,
    covered_percent: int = 100, none_as: str = "und", filter_bits: int = FILTER_BITS, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    found = frequent_phrases(docs, lang, text, support, longest, none_as, filter_bits, shard_bytes)
    return ranked(scored(uncovered(found, covered_percent), found), top)


def uncovered(found: DataFrame, percent: int = 100) -> DataFrame:
    """Phrases of two words or more, without those inside a longer frequent one of at least ``percent`` of their count.

    One word more is enough to look at: if a longer phrase covers, so does every phrase between.
    """
    phrases = found.where("k > 1")
    inside = (
        phrases.where("k > 2")
        .selectExpr("lang", "explode(array(substring_index(phrase, ' ', k - 1), substring_index(phrase, ' ', 1 - k))) AS phrase", "f")
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    )
    return phrases.join(inside, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {percent} * f").drop("longer")


def scored(phrases: DataFrame, found: DataFrame) -> DataFrame:
    """Adds ``l``, ``r``, ``n`` and ``score`` of the lowest-scoring cut, ties to the earliest.

    Products are decimals of up to 38 digits: exact for counts below 10^17.
    """
    parts = found.where("k > 0")
    cuts = phrases.selectExpr("lang", "phrase", "k", "f AS a", "explode(sequence(1, k - 1)) AS cut").selectExpr(
        "lang", "phrase", "a", "cut", "substring_index(phrase, ' ', cut) AS first", "substring_index(phrase, ' ', cut - k) AS rest"
    )
    cuts = cuts.join(parts.selectExpr("lang", "phrase AS first", "f AS l"), ["lang", "first"])
    cuts = cuts.join(parts.selectExpr("lang", "phrase AS rest", "f AS r"), ["lang", "rest"])
    # One row per language; Spark chooses the join by the written size.
    cuts = cuts.join(found.where("k = 0").selectExpr("lang", "f AS n"), "lang")
    number = "CAST({} AS DECIMAL(17, 0))"
    score = f"(CAST(1000 AS DECIMAL(4, 0)) * ({number.format('a')} * {number.format('n')})) div ({number.format('l')} * {number.format('r')})"
    lowest = F.expr("min(struct(score, cut, l, r)) AS low")
    return (
        cuts.selectExpr("*", f"{score} AS score").groupBy("lang", "phrase", "a", "n").agg(lowest)
        .selectExpr("lang", "phrase", "a", "low.l", "low.r", "n", "low.score")
    )


def ranked(scores: DataFrame, top: int, slices: int = 64) -> DataFrame:
    """The best ``top`` per language, picked per slice of a language first."""
    order = "ORDER BY score DESC, a DESC, phrase"
    sliced = scores.selectExpr("*", f"pmod(xxhash64(phrase), {slices}) AS slice")
    best = sliced.selectExpr("*", f"row_number() OVER (PARTITION BY lang, slice {order}) AS place").where(f"place <= {top}")
    return best.selectExpr("lang", f"CAST(row_number() OVER (PARTITION BY lang {order}) AS BIGINT) AS rank", "phrase", "a", "l", "r", "n", "score").where(f"rank <= {top}")
