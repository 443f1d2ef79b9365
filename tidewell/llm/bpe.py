"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

A word is encoded from left to right: at each place the longest token that fits there is taken, unless it
is incompatible with the token before it; then the next shorter one is tried, and if none is left, the
token before is given up in turn. Two tokens are compatible if merging the symbols of both by rank gives
just these two. A chain of compatible tokens is what merging the whole word gives, and places that were
given up are not entered again, so the time is linear in the word's length. All tokens that start at a
place come from one Aho-Corasick pass over the word.

The compatibility table is filled as pairs turn up, and is shared by all words of a task, as are the
ids of words that were seen before. Both start anew beyond a size; that changes speed only.

Defined results: a null text is empty, with no ids and an empty decoded text; repeated rows and null ids
are kept; an empty table gives an empty result. Columns other than the two named ones are not read.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidewell.llm.common import Recent, runs_of, starts_of

#: Entries of each table that a task keeps.
MEMORY = 200_000
RUN_CHARS = 1 << 21
SPAN = 1 << 20

#: Control characters that ``str.split`` takes for white space and the tokenizer does not.
SEPARATORS = re.compile(r"[\x1c-\x1f]")
#: White space in Unicode.
SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in token names: itself, or the next free one."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    letters = {byte: chr(byte) for byte in shown} | {byte: chr(256 + i) for i, byte in enumerate(hidden)}
    return [letters[byte] for byte in range(256)]


class Merges:
    """Tokens and merge ranks over symbols: one per byte, and another per byte that ends a word."""

    def __init__(self, model: dict):
        suffix = model["end_of_word_suffix"] or ""
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}

        def symbols(name: str) -> str:
            ends = bool(suffix) and name.endswith(suffix) and name != suffix
            stem = name[: -len(suffix)] if ends else name
            codes = [byte_of[letter] for letter in stem]
            return "".join(map(chr, codes[:-1])) + chr(codes[-1] + 256 * ends)

        self.ids = {symbols(name): token for name, token in model["vocab"].items() if name[:2] != "<|"}
        self.rank: dict[tuple[str, str], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.rank.setdefault((symbols(left), symbols(right)), rank)
        self.finder = ahocorasick.Automaton()
        for name in self.ids:
            if self.merged(name) == [name]:  # others can't come out of merging
                self.finder.add_word(name, name)
        self.finder.make_automaton()
        self.fits: dict[tuple[str, str], bool] = {}

    def merged(self, word: str) -> list[str]:
        """The word's symbols, merged by rank, the leftmost of equals first."""
        parts = list(word)
        while len(parts) > 1:
            ranks = [self.rank.get(pair, 1 << 30) for pair in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 30:
                break
            place = ranks.index(best)
            parts[place : place + 2] = [parts[place] + parts[place + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        pair = (left, right)
        known = self.fits.get(pair)
        if known is None:
            if len(self.fits) > MEMORY:
                self.fits.clear()
            known = self.fits[pair] = self.merged(left + right) == [left, right]
        return known

    def encode(self, word: str) -> list[int]:
        """Token ids of one word, given as symbols."""
        options: list[list[str]] = [[] for _ in word]
        for end, name in self.finder.iter(word):
            options[end + 1 - len(name)].append(name)  # ends ascend, so the longest comes last
        chain: list[str] = []
        place = 0
        dead = bytearray(len(word) + 1)
        while place < len(word):
            here = options[place]
            while here:
                name = here[-1]
                if not dead[place + len(name)] and (not chain or self.compatible(chain[-1], name)):
                    break
                here.pop()
            if here:
                chain.append(here[-1])
                place += len(here[-1])
            else:
                dead[place] = 1
                place -= len(chain.pop())
                options[place].pop()
        return [self.ids[name] for name in chain]


class Codec:
    """Encodes and decodes texts as the tokenizer file describes: special tokens first, then composed and
    lower-cased words, cut into letters, single digits and other signs."""

    def __init__(self, path: str):
        config = json.loads(Path(path).read_text())
        self.special = {token["content"]: token["id"] for token in config["added_tokens"]}
        self.merges = Merges(config["model"])
        pattern = config["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        names = {**{token: name for name, token in config["model"]["vocab"].items()}}
        names |= {token: name for name, token in self.special.items()}
        shown = [(names.get(token, "") + " ").encode() for token in range(max(names) + 1)]
        #: All token names, each with a blank behind it, and where each one begins.
        self.letters = np.frombuffer(b"".join(shown), np.uint8)
        self.offsets = starts_of(np.array([len(name) for name in shown]))
        self.chunks = Recent(MEMORY)
        self.parts = Recent(MEMORY)

    def _encode_chunk(self, chunk: str) -> list[int]:
        """Ids of a text without white space."""
        ids = []
        for part in self.specials.split(chunk):
            if part in self.special:
                ids.append(self.special[part])
                continue
            # Letters are lower-cased one by one: no rule for the last letter of a word.
            plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            for word in self.words.findall(plain):
                known = self.parts.get(word)
                if known is None:
                    codes = word.encode()
                    known = self.merges.encode(codes[:-1].decode("latin-1") + chr(codes[-1] + 256))
                    self.parts.put(word, known)
                ids += known
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        chunks = [x for x in SPACE.split(text) if x] if SEPARATORS.search(text) else text.split()
        found = list(map(self.chunks.now.get, chunks))
        for place, ids in enumerate(found):
            if ids is None:
                chunk = chunks[place]
                ids = self.chunks.get(chunk)
                if ids is None:
                    new = self._encode_chunk(chunk)
                    ids = struct.pack(f"<{len(new)}I", *new)
                    self.chunks.put(chunk, ids)
                found[place] = ids
        return b"".join(found)

    def decode(self, ids: bytes) -> bytes:
        """Names of the tokens with a blank between them, in UTF-8."""
        tokens = np.frombuffer(ids, "<u4").astype(np.int64)
        parts = []
        for begin in range(0, len(tokens), SPAN):
            span = tokens[begin : begin + SPAN]
            lengths = self.offsets[span + 1] - self.offsets[span]
            shift = self.offsets[span] - (np.cumsum(lengths) - lengths)
            parts.append(self.letters[np.repeat(shift, lengths) + np.arange(lengths.sum())].tobytes())
        return b"".join(parts)[:-1]


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def encoded(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "word_bpe_49k.json"
) -> DataFrame:
    """``key``, ``n_tokens``, ``ids`` (little-endian 32-bit numbers) and ``decoded`` of every text."""
    schema = docs.select(key).schema.add("n_tokens", "long").add("ids", "binary").add("decoded", "string")

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(public_tokenizers.path(tokenizer))
        for batch in batches:
            for keys, texts in runs_of(batch, RUN_CHARS):
                ids = [tool.encode(text) for text in texts]
                decoded = pa.array([tool.decode(x) for x in ids], pa.binary()).cast(pa.string())
                count = pa.array([len(x) // 4 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [keys, count, pa.array(ids, pa.binary()), decoded], names=schema.names
                )

    return docs.select(key, text).mapInArrow(mapped, schema)
