"""Exact tokenizer output for whole texts through a cache of their pieces.

A tokenizer is slow per text and texts repeat their words. So texts are cut where
the tokenizer itself must cut, the different pieces of a batch are found by Arrow,
each piece is encoded once and remembered by the worker, and the results are put
together again with numpy. Every text is encoded whole, whatever its length.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Separates pieces inside marked texts; texts that hold it are cut in Python.
MARK = "\x01"
# Bytes of text handled at once: bounds what a worker holds beside its cache.
SLICE = 2 << 20
# Longer pieces are encoded each time: they hardly repeat.
LONGEST = 64


class BlankCuts:
    """Cuts before a space or newline that follows a character that is not blank,
    around single newlines, and between a Latin letter and a following mark.

    Splitting patterns of byte-level and word-level tokenizers end a piece there,
    whatever follows. Runs of blanks and other blanks take the careful way.
    """

    unusual = r"[ \n][ \n]|[\x01\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    careful = re.compile(r"(?<=\S)(?=[ \n])")

    def marked(self, texts: pa.Array) -> pa.Array:
        lines = pc.replace_substring(pc.replace_substring(texts, " ", MARK + " "), "\n", f"{MARK}\n{MARK}")
        return self.between_marks(lines)

    def between_marks(self, texts: pa.Array) -> pa.Array:
        return pc.replace_substring_regex(texts, "([A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?])", rf"\1{MARK}\2")

    def cut(self, text: str) -> list[str]:
        return self.careful.split(text)


class PieceCache:
    """What ``encode_many`` returns for each piece, kept in two generations.

    At most about ``2 * size`` pieces are held; when the young generation is full
    it becomes the old one, and pieces still in use move back on their next use.
    A piece is kept from its second appearance on, as far as a field of hashes
    remembers the first: most different pieces of a text collection appear once.
    """

    FIELD = 1 << 22

    def __init__(self, encode_many: Callable[[list[str]], Iterable], size: int = 250_000):
        self.encode_many, self.size = encode_many, size
        self.young: dict = {}
        self.old: dict = {}
        self.seen, self.marks = bytearray(self.FIELD), 0

    def _again(self, part: str) -> bool:
        """Whether a piece was met before; from now on it was."""
        at = hash(part) & (self.FIELD - 1)
        if self.seen[at]:
            return True
        if self.marks > self.FIELD // 3:
            self.seen, self.marks = bytearray(self.FIELD), 0
        self.seen[at] = 1
        self.marks += 1
        return False

    def of(self, parts: list[str]) -> list:
        """The results of different pieces, in order."""
        found = list(map(self.young.get, parts))
        asked = []
        for at, part in enumerate(parts):
            if found[at] is None:
                known = found[at] = self.old.get(part)
                if known is None:
                    asked.append(at)
                else:
                    self.young[part] = known
        for at, result in zip(asked, self.encode_many([parts[at] for at in asked])):
            found[at] = result
            part = parts[at]
            if len(part) <= LONGEST and self._again(part):
                self.young[part] = result
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        return found


def slices(texts: pa.Array, size: int | None = None) -> Iterator[pa.Array]:
    """Consecutive parts of about ``size`` bytes, by default ``SLICE``; nulls become empty texts."""
    size = SLICE if size is None else size
    texts = pc.fill_null(texts, "")
    ends = pc.binary_length(texts).to_numpy(zero_copy_only=False).cumsum()
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def _pieces(texts: pa.Array, cuts) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Different pieces, their numbers in text order, and where each text's numbers begin."""
    odd = pc.match_substring_regex(texts, cuts.unusual).to_numpy(zero_copy_only=False)
    plain = pc.split_pattern(cuts.marked(texts.filter(pa.array(~odd))), MARK)
    counts = np.zeros(len(texts), np.int64)
    counts[~odd] = pc.list_value_length(plain).to_numpy(zero_copy_only=False)
    by_hand = [cuts.cut(t.as_py()) for t in texts.filter(pa.array(odd))]
    counts[odd] = [len(p) for p in by_hand]
    flat = pa.concat_arrays([plain.flatten(), pa.array([p for part in by_hand for p in part], pa.string())])
    coded = flat.dictionary_encode()
    numbers = coded.indices.to_numpy()
    if by_hand:
        order = np.argsort(np.concatenate([np.repeat(np.flatnonzero(~odd), counts[~odd]), np.repeat(np.flatnonzero(odd), counts[odd])]), kind="stable")
        numbers = numbers[order]
    return coded.dictionary.to_pylist(), numbers, np.concatenate([[0], counts.cumsum()])


def count_tokens(texts: pa.Array, cache: PieceCache, cuts) -> np.ndarray:
    """Tokens per text; the cache holds the number of tokens of a piece."""
    out = []
    for part in slices(texts):
        words, numbers, starts = _pieces(part, cuts)
        sums = np.concatenate([[0], np.array(cache.of(words), np.int64)[numbers].cumsum()])
        out.append(np.diff(sums[starts]))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def token_ids(texts: pa.Array, cache: PieceCache, cuts, size: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per slice: all ids, and where each text's ids begin; the cache holds ids as 32-bit bytes."""
    for part in slices(texts, size):
        words, numbers, starts = _pieces(part, cuts)
        found = cache.of(words)
        sizes = np.array([len(f) for f in found], np.int64) // 4
        ids = np.frombuffer(b"".join(found), "<i4")
        each = sizes[numbers]
        sums = np.concatenate([[0], each.cumsum()])
        at = np.repeat((sizes.cumsum() - sizes)[numbers] - sums[:-1], each)
        yield ids[at + np.arange(len(at))], sums[starts]


def framed(ids: np.ndarray, starts: np.ndarray, before: list[int], after: list[int]) -> pa.ListArray:
    """Id lists with the same ids put before and after each."""
    extra = len(before) + len(after)
    new = starts + extra * np.arange(len(starts))
    out = np.empty(new[-1], np.int32)
    inside = np.ones(len(out), bool)
    for i, number in enumerate(before):
        out[new[:-1] + i] = number
        inside[new[:-1] + i] = False
    for i, number in enumerate(after):
        out[new[1:] - len(after) + i] = number
        inside[new[1:] - len(after) + i] = False
    out[inside] = ids
    return pa.ListArray.from_arrays(pa.array(new.astype(np.int32)), pa.array(out))
