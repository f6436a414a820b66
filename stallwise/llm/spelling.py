"""Spelling variants: words one edit apart, and the common form each belongs to.

Words are compared by dense prefix-suffix tiling. A tile is a pair of blocks of
words, each a matrix of code points padded to one width: a loop over the columns
gives all common prefix lengths of the tile, the same on reversed words all common
suffix lengths. Two different words are one insertion, deletion or replacement
apart exactly if prefix plus suffix reach the longer length minus one.

Only blocks that can hold such pairs meet. Of two near words let ``m`` be the
shorter length: an edit at place ``m // 2`` or later leaves the first ``m // 2`` code
points alike, an earlier one the last ``m - m // 2``. So each word is filed under
its beginning and its end for ``m`` = its length and its length minus one, and
blocks are built within such a file. A pair filed under both counts where its
beginnings agree. A file of any size is cut into blocks by a hash of the word,
and each pair of blocks is one row, so files with very many words are shared by
all tasks. A tile returns one row per word with a near word in it, never the pairs.

Scale: occurrences are counted per task before they are shuffled; from there on
work depends on the vocabulary. Words below ``at_least`` occurrences meet nothing.

Defined results: null and empty texts have no words; a null id takes part in the
planted edits as an empty text; repeated rows count again; words of equal frequency
resolve to the smallest in code-point order; chains of forms end, since each step
at least multiplies the frequency by ``ratio`` (above 1); an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.sources.staging import stage

RUN = re.compile("[A-Za-zÀ-ÿ]+")
# Characters of a text looked at once, and words counted before they are passed on.
SLICE = 1 << 20
COUNTED = 200_000
# Words in a block, and code points in its matrix: long words come in smaller blocks.
BLOCK = 1024
CELLS = 1 << 20


def runs_of(text: str) -> Iterator[list[str]]:
    """Runs of letters, A to Z lower-cased, slice by slice; no run is cut."""
    text = text.encode().lower().decode()
    at = 0
    while at < len(text):
        end = min(at + SLICE, len(text))
        if end < len(text) and RUN.match(text, end - 1) and (more := RUN.match(text, end)):
            end = more.end()
        yield RUN.findall(text, at, end)
        at = end


def misspelt(run: str, hashed: int, one_in: int) -> str:
    """``run`` without one code point if its hash falls on ``one_in``."""
    if hashed % one_in:
        return run
    at = hashed % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(
    docs: DataFrame, id: str = "doc_id", text: str = "text", one_in: int = 97, shortest: int = 5, at_least: int = 3
) -> DataFrame:
    """``word``, ``n``: the words of all texts, with one in ``one_in`` (document, word) pairs misspelt."""
    rows = docs.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for key, whole in zip(*(c for c in batch.columns)):
                seed = zlib.crc32(f"{key.as_py()}:".encode())
                for runs in runs_of(whole.as_py() or ""):
                    for run, n in Counter(runs).items():
                        word = misspelt(run, zlib.crc32(run.encode(), seed), one_in)
                        if len(word) >= shortest:
                            counts[word] += n
                    if len(counts) >= COUNTED:
                        yield _table(counts)
                        counts = Counter()
        if counts:
            yield _table(counts)

    return (
        rows.mapInArrow(counted, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= at_least)
    )


def _table(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
    )


def _files(words: DataFrame) -> DataFrame:
    """Each word under its beginning and end, for its length and one less, as ``m`` and ``file``."""
    size = "char_length(word)"
    filed = [
        f"named_struct('m', {m}, 'file', concat('{side}', {part}(word, {keep})))"
        for m in (size, f"{size} - 1")
        for side, part, keep in (("<", "left", f"({m}) div 2"), (">", "right", f"({m}) - ({m}) div 2"))
    ]
    return words.selectExpr("word", "n", f"inline(array({', '.join(filed)}))")


def _tiles(words: DataFrame) -> DataFrame:
    """``m``, ``side`` and the two blocks of words of every tile; the right block of a
    diagonal tile is empty."""
    files = _files(words).where("m > 0")
    sizes = (
        files.groupBy("m", "file")
        .agg(F.expr("count(1) AS size"), F.expr("count_if(char_length(word) = m) AS short"))
        .where("size > 1 AND short > 0")
        .selectExpr("m", "file", f"ceil(size / greatest(16, least({BLOCK}, {CELLS} div (m + 1)))) AS blocks")
    )
    member = "named_struct('n', n, 'word', word)"
    placed = files.join(sizes, ["m", "file"]).selectExpr(
        "m", "file", f"{member} AS member", "blocks", "pmod(xxhash64(word), blocks) AS b"
    )
    left = placed.selectExpr("m", "file", "b AS i", "explode(sequence(b, blocks - 1)) AS j", "member", "true AS is_left")
    right = placed.where("b > 0").selectExpr("m", "file", "explode(sequence(0L, b - 1)) AS i", "b AS j", "member", "false AS is_left")
    return (
        left.unionByName(right)
        .groupBy("m", "file", "i", "j")
        .agg(F.expr("collect_list(member) FILTER (WHERE is_left) AS a"), F.expr("collect_list(member) FILTER (WHERE NOT is_left) AS b"))
        .where("size(a) > 0 AND (size(b) > 0 OR (i = j AND size(a) > 1))")
        .selectExpr("m", "startswith(file, '<') AS by_start", "a", "b", "i = j AS diagonal")
    )


class Block:
    """Words, most frequent first, as padded matrices of code points read from both ends."""

    def __init__(self, members: list[dict]):
        members = sorted(members, key=lambda x: (-x["n"], x["word"]))
        self.words = [x["word"] for x in members]
        self.n = [x["n"] for x in members]
        self.sizes = np.array([len(w) for w in self.words], np.int32)
        self.forward = _matrix(self.words)
        self.backward = _matrix([w[::-1] for w in self.words])


def _matrix(words: list[str]) -> np.ndarray:
    codes = np.array(words)
    matrix = codes.view(np.uint32).reshape(len(words), -1)
    return np.ascontiguousarray((matrix.astype(np.uint8) if matrix.max() < 256 else matrix).T)


def _common(a: np.ndarray, b: np.ndarray, m: int) -> np.ndarray:
    """How many of the first ``m`` code points each row of a tile shares with each column."""
    alike = a[0][:, None] == b[0][None, :]
    length = alike.astype(np.int32)
    for at in range(1, m):
        alike &= a[at][:, None] == b[at][None, :]
        if not alike.any():
            break
        length += alike
    return length


def near(a: Block, b: Block, m: int, by_start: bool) -> np.ndarray:
    """Which words of a tile are one edit apart, ``m`` being the shorter length."""
    prefix, suffix = _common(a.forward, b.forward, m), _common(a.backward, b.backward, m)
    longer = np.maximum(a.sizes[:, None], b.sizes[None, :])
    shorter = np.minimum(a.sizes[:, None], b.sizes[None, :])
    same = (longer == shorter) & (prefix == m)
    found = (shorter == m) & (prefix + suffix >= longer - 1) & ~same
    return found if by_start else found & (prefix < m // 2)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per tile and word with near words: how many, and the most frequent one."""
    for batch in batches:
        words, counts, best_n, best = [], [], [], []

        def found(block: Block, other: Block, hit: np.ndarray) -> None:
            n = hit.sum(1)
            first = hit.argmax(1)
            for row in np.flatnonzero(n):
                words.append(block.words[row])
                counts.append(int(n[row]))
                best_n.append(other.n[first[row]])
                best.append(other.words[first[row]])

        for i in range(batch.num_rows):
            m, by_start, a, b, diagonal = (c[i].as_py() for c in batch.columns)
            left = Block(a)
            right = left if diagonal else Block(b)
            hit = near(left, right, m, by_start)
            found(left, right, hit)
            if not diagonal:
                found(right, left, hit.T)
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(counts, pa.int64()), pa.array(best_n, pa.int64()), pa.array(best, pa.string())],
            ["word", "n_near", "best_n", "best"],
        )


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n_near`` and the most frequent near word ``best`` with its ``best_n``, for words that have one.

    ``words`` has distinct, non-empty strings ``word`` with their number ``n``.
    """
    per_tile = _tiles(words).mapInArrow(_compared, "word string, n_near long, best_n long, best string")
    return (
        per_tile.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("rank"), "best")).alias("top"))
        .select("word", "n_near", (-F.col("top.rank")).alias("best_n"), F.col("top.best").alias("best"))
    )


def word_forms(words: DataFrame, ratio: float = 2) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for every row of ``words`` (word, n)."""
    if ratio <= 1:
        raise ValueError("ratio must be above 1, or forms could go in circles")
    words = stage(words.select("word", "n"), "words")
    near = near_words(words.where("word <> ''"))
    is_form = F.col("best_n") >= F.lit(ratio) * F.col("n")
    formed = stage(
        words.join(near, "word", "left").select(
            "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.where("form IS NOT NULL").select("word", "form"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: the last of the forms that follow from ``word``, by doubling steps.

    After a round ``root`` is twice as many steps away, so a chain of n forms takes log2(n) rounds.
    """
    current = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        moved = stage(current.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "roots")
        current = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return current


def spelling_variants(docs: DataFrame, id: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """Words of all texts with their near words' number, their form and their root."""
    return word_forms(word_counts(docs, id, text, **options))
