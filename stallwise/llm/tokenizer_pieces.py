"""Ids of pieces from the tokenizers library, the short way for plain words.

A piece of ASCII and Latin-1 letters, with at most one space before it, is a single
word to the byte-level splitting patterns, and neither normalising nor splitting
changes it beyond its case. Its bytes go to the library's model directly, which
costs a third of a full call; every other piece takes the full call.
"""

from __future__ import annotations

import json
import os
import re

import pyarrow as pa
import pyarrow.compute as pc
import tokenizers

from stallwise.llm.word_cache import MARK, BlankCuts

# Splitting pattern of the word-level tokenizer: fixed value.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")


def _byte_symbols() -> dict[int, int]:
    """Byte-level alphabet: printable Latin-1 stands for itself, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(others)}


SYMBOLS = _byte_symbols()


class WordCuts(BlankCuts):
    """Cuts for models that drop blanks and ignore case: pieces are lower-case words.

    Texts that may hold special tokens, whose case matters, are cut carefully.
    """

    unusual = BlankCuts.unusual + r"|<\|"

    def marked(self, texts: pa.Array) -> pa.Array:
        words = pc.replace_substring(pc.replace_substring(pc.ascii_lower(texts), " ", MARK), "\n", MARK)
        return self.between_marks(words)


def load(file: str) -> tokenizers.Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    model = tokenizers.Tokenizer.from_file(file)
    model.no_truncation()
    model.no_padding()
    return model


class WholeTexts:
    """No cuts: for tokenizers whose splitting is not known here."""

    unusual = ""

    def marked(self, texts: pa.Array) -> pa.Array:
        return texts

    def cut(self, text: str) -> list[str]:
        return [text]


def _kind(model: tokenizers.Tokenizer) -> str:
    """'bytes', 'words' or 'other', from the file's normalising and splitting steps."""
    spec = json.loads(model.to_str())

    def steps(part: dict | None, name: str) -> list[dict]:
        return part[name] if part and part["type"] == "Sequence" else [part] if part else []

    normal = [s["type"] for s in steps(spec["normalizer"], "normalizers")]
    split = steps(spec["pre_tokenizer"], "pretokenizers")
    if any(t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]) or not split:
        return "other"
    by_bytes = split[-1]["type"] == "ByteLevel" and not split[-1]["add_prefix_space"]
    if by_bytes and not normal and len(split) == 1 and split[0]["use_regex"]:
        return "bytes"
    if by_bytes and normal == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in split] == ["Split", "ByteLevel"]:
        if split[0]["pattern"] == {"Regex": WORD_PATTERN} and split[0]["invert"] and not split[1]["use_regex"]:
            return "words"
    return "other"


def piecewise(model: tokenizers.Tokenizer):
    """(cuts, function from pieces to their ids) that together give the library's ids."""
    kind = _kind(model)
    cuts = {"bytes": BlankCuts, "words": WordCuts, "other": WholeTexts}[kind]()
    tokenize, plain = model.model.tokenize, PLAIN.fullmatch

    def encode_many(parts: list[str]) -> list[list[int]]:
        found: list = [None] * len(parts)
        rest = []
        for at, part in enumerate(parts):
            if kind != "other" and plain(part):
                word = part.strip().lower() if kind == "words" else part
                found[at] = [t.id for t in tokenize(word.encode().decode("latin-1").translate(SYMBOLS))]
            else:
                rest.append(at)
        for at, encoding in zip(rest, model.encode_batch_fast([parts[at] for at in rest], add_special_tokens=False)):
            found[at] = encoding.ids
        return found

    return cuts, encode_many
