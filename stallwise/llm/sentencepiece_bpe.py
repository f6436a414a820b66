"""Exact SentencePiece BPE encoding by backtracking, and decoding.

A token sequence is what merging yields if and only if each neighbouring pair of
tokens, merged on its own, yields that pair. So no merge queue is kept over the
text: at each position the longest vocabulary match is tried, found by an
Aho-Corasick automaton; it is accepted if it is compatible with the token before
it, which is checked by merging the two tokens' characters again (remembered per
pair); otherwise shorter matches follow. When none is left the last token is taken
back, and the position is marked in a field of failed positions, so no position
is tried twice.

No token of such a vocabulary has a space mark after another character, so texts
are cut before runs of space marks, exactly, and each worker remembers the ids of
pieces that repeat. Cuts around newlines and between letters and marks are made as
well where the vocabulary proves that no token bridges them.

Defined results: null texts are empty and have the begin and end ids alone; null
document ids stay null; repeated rows are each encoded; an empty table gives an
empty result. Encoding and decoding are per row, without a shuffle; a text of any
length is encoded whole, in time proportional to its length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm.word_cache import MARK, PieceCache, framed, token_ids

SPACE = "▁"
PAIRS_HELD = 200_000
# Score of neighbours that are no token.
NO_PAIR = float("-inf")


class SpaceCuts:
    """Cuts before runs of space marks, and wherever no token has both neighbours.

    ``bridged`` holds all neighbouring characters inside tokens. Cuts of the latter
    kind are made around newlines and between a letter and a following mark, which
    is where they make pieces repeat.
    """

    unusual = f"  |{SPACE}.*{SPACE}|{SPACE} | $|{MARK}"
    words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def __init__(self, bridged: set[str]):
        letters = [chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(0xDF, 0x100)) if chr(c).isalpha()]
        self.after = {m: "".join(a for a in letters if a + m not in bridged) for m in ".,;:!?"}
        self.lines = not any("\n" in b for b in bridged)

    def marked(self, texts: pa.Array) -> pa.Array:
        out = pc.replace_substring(texts, " ", MARK + SPACE)
        if self.lines:
            out = pc.replace_substring(out, "\n", f"{MARK}\n{MARK}")
        for mark, letters in self.after.items():
            if letters:
                out = pc.replace_substring_regex(out, rf"([{letters}])\{mark}", rf"\1{MARK}{mark}")
        return out

    def cut(self, text: str) -> list[str]:
        return self.words.findall(text.replace(" ", SPACE))


class BpeEncoder:
    """Encoder for a SentencePiece BPE model without normalisation rules."""

    def __init__(self, file: str, size: int = 60_000):
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=file)
        plain = [
            i for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.ids = {model.id_to_piece(i): i for i in plain}
        self.scores = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.plain = {p: np.array([i], "<u4").tobytes() for p, i in self.ids.items()}
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(model.get_piece_size()) if model.is_byte(i)}
        self.unknown = model.unk_id()
        self.bos, self.eos = model.bos_id(), model.eos_id()
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        bridged = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        if any(b[1] == SPACE and b[0] != SPACE for b in bridged):
            raise ValueError("the model has tokens across word borders")
        self.cuts = SpaceCuts(bridged)
        self.compatible: dict[tuple[str, str], bool] = {}
        self.cache = PieceCache(self._encode_pieces, size)

    def merged(self, text: str) -> list[str]:
        """Plain merging: the best-scored neighbouring pair first, the leftmost of equals."""
        parts, score = list(text), self.scores.get
        scores = [score(a + b, NO_PAIR) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == NO_PAIR:
                break
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            # Only the pairs beside the merged one are others now.
            del scores[at]
            if at:
                scores[at - 1] = score(parts[at - 1] + parts[at], NO_PAIR)
            if at < len(scores):
                scores[at] = score(parts[at] + parts[at + 1], NO_PAIR)
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether merging the characters of both tokens keeps the border between them.

        An empty left side asks whether the right one's characters merge into it at all.
        """
        if len(self.compatible) >= PAIRS_HELD:
            self.compatible.clear()
        answer = self.merged(left + right) == ([left, right] if left else [right])
        self.compatible[left, right] = answer
        return answer

    def split(self, text: str) -> list[str]:
        """The tokens of a piece; characters outside the vocabulary are tokens of their own."""
        size, known, vocabulary = len(text), self.compatible.get, self.ids
        longest = [1] * (size + 1)
        # Matches of one start come shortest first.
        for end, length in self.automaton.iter(text):
            longest[end - length + 1] = length
        tokens: list[str] = []
        failed = bytearray(size + 1)
        at, length, last = 0, longest[0], ""
        while at < size:
            while length:
                end = at + length
                if not failed[end]:
                    token = text[at:end]
                    answer = known((last, token))
                    if self.fits(last, token) if answer is None else answer:
                        break
                length -= 1
                while length > 1 and text[at : at + length] not in vocabulary:
                    length -= 1
            if length:
                tokens.append(token)
                at, length, last = end, longest[end], token
            else:
                failed[at] = 1
                length = len(tokens.pop())
                at -= length
                length -= 1
                while length > 1 and text[at : at + length] not in vocabulary:
                    length -= 1
                last = tokens[-1] if tokens else ""
        return tokens

    def _token_bytes(self, token: str) -> bytes:
        """Ids of one token: its own, or those of its bytes."""
        if token in self.ids:
            ids = [self.ids[token]]
        else:
            ids = [self.bytes[b] for b in token.encode()] if self.bytes else [self.unknown]
        return np.array(ids, "<u4").tobytes()

    def _ids(self, tokens: list[str]) -> bytes:
        return b"".join([self.plain.get(t) or self._token_bytes(t) for t in tokens])

    def _encode_pieces(self, parts: list[str]) -> Iterable[bytes]:
        return (self._ids(self.split(part)) for part in parts)

    def encode_slices(self, texts: pa.Array) -> Iterator[pa.ListArray]:
        """Ids of whole texts, begin and end included, some texts at a time."""
        marked = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(SPACE, texts, ""))
        for part in token_ids(marked, self.cache, self.cuts):
            yield framed(*part, [self.bos], [self.eos])

    def encode(self, texts: pa.Array) -> pa.ListArray:
        parts = list(self.encode_slices(texts))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    def decode(self, ids: np.ndarray) -> str:
        return self.model.decode(ids.tolist())


_ENCODERS: dict[str, BpeEncoder] = {}


def encoder(file: str) -> BpeEncoder:
    """The worker's encoder for a model file."""
    if file not in _ENCODERS:
        _ENCODERS[file] = BpeEncoder(file)
    return _ENCODERS[file]


def encode(text: Column, file: str) -> Column:
    """Ids of whole texts, begin and end included."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        return encoder(file).encode(pc.fill_null(texts, ""))

    return ids(text)


def decode(ids: Column, file: str) -> Column:
    """Texts of id lists; a null list gives null."""

    @F.arrow_udf("string")
    def texts(lists: pa.Array) -> pa.Array:
        one, offsets, values = encoder(file).decode, lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        found = [one(values[a:b]) for a, b in zip(offsets, offsets[1:])]
        return pa.array([None if n else t for t, n in zip(found, lists.is_null().to_pylist())], pa.string())

    return texts(ids)


def ids_sha256(ids: Column) -> Column:
    """Lower-case hex digest of the ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("string")
    def digest(lists: pa.Array) -> pa.Array:
        offsets, values = lists.offsets.to_numpy(), np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")
        return pa.array([hashlib.sha256(values[a:b]).hexdigest() for a, b in zip(offsets, offsets[1:])])

    return digest(ids)


def _coded(batches: Iterator[pa.RecordBatch], file: str) -> Iterator[pa.RecordBatch]:
    """Encode and decode in one pass, in small batches; a text's ids are made once."""
    one = encoder(file)
    for batch in batches:
        done = 0
        for ids in one.encode_slices(pc.fill_null(batch["text"], "")):
            offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy()
            decoded = pa.array([one.decode(values[a:b]) for a, b in zip(offsets, offsets[1:])], pa.string())
            yield pa.RecordBatch.from_arrays([batch["id"].slice(done, len(ids)), ids, decoded], ["id", "ids", "decoded"])
            done += len(ids)


def _digested(batches: Iterator[pa.RecordBatch], keep_ids: bool) -> Iterator[pa.RecordBatch]:
    """Counts and digests of encoded documents, and their ids if asked for."""
    for batch in batches:
        offsets, values = batch["ids"].offsets.to_numpy(), batch["ids"].values.to_numpy()
        ids = [hashlib.sha256(np.ascontiguousarray(values[a:b], "<i4")).hexdigest() for a, b in zip(offsets, offsets[1:])]
        texts = [hashlib.sha256(t.as_buffer()).hexdigest() for t in batch["decoded"]]
        columns = [batch["id"], pa.array(np.diff(offsets).astype(np.int64)), pa.array(ids, pa.string()), pa.array(texts, pa.string())]
        names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if keep_ids:
            columns, names = [*columns, batch["ids"]], [*names, "ids"]
        yield pa.RecordBatch.from_arrays(columns, names)


def encoded_documents(docs: DataFrame, file: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``ids``, ``decoded``: encoded whole and decoded again, one row per row."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = f"id {docs.schema[id].dataType.simpleString()}, ids array<int>, decoded string"
    return rows.mapInArrow(lambda batches: _coded(batches, file), schema).withColumnRenamed("id", id)


def encoded_digests(docs: DataFrame, file: str, id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """``id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of what ``encoded_documents`` gives, without moving it;
    with ``keep_ids`` also ``ids``."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = f"id {docs.schema[id].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if keep_ids else ""
    return rows.mapInArrow(lambda batches: _digested(_coded(batches, file), keep_ids), schema).withColumnRenamed("id", id)
