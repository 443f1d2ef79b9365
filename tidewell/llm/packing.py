"""Order-preserving packing of tokenized documents by dynamic programming.

Documents follow each other in one stream of tokens, in the order of the rows. Sequences are windows of
the stream; where to cut is chosen so that the sum of padding, truncation penalties and a small cost per
sequence is least. Cuts lie at document ends (free) and sentence ends (a small penalty). A cut inside a
sentence has a larger penalty; such cuts are offered one full window after each boundary, and at evenly
spaced tokens where there is no boundary in reach. With best[j] for
the cost of all tokens before cut j, a window that is padded to ``width`` costs
``width - (at[j] - at[i])``, so best[j] needs the least best[i] + at[i] of the cuts in reach: the head of
a monotone queue. A window whose length is a power of two is not padded; those few are looked up.

A stream is a run of rows of one input partition, of about ``STREAM_CHARS`` characters: packing needs no
shuffle, and its memory is that of a stream or of the longest text. The end of a stream is cut into
powers of two if that is cheaper.

Defined results: a null text is empty and has only its end token; equal rows are packed one after the
other, each as a document of its own; a null id is kept; an empty table gives an empty result. Columns
other than the two named ones are not read.
"""

from __future__ import annotations

import base64
import re
import sys
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tidewell.llm.common import LONG_WORD, runs_of, starts_of

WIDTH = 1024
END = 0
SENTENCE_PENALTY = 2.0
#: For a cut inside a sentence.
TRUNCATION_PENALTY = 12.0
SEQUENCE_COST = 8.0
#: Distance of cuts where there is no boundary.
GRID = 64
STREAM_CHARS = 1 << 23
#: Words whose ids a task remembers, twice. A matter of speed only.
MEMORY = 200_000
#: New words that are encoded at a time.
JOINED = 4096

#: A single space between two characters that are not white space: a new piece begins there in any case.
SEAM = re.compile(r"(?<=\S) (?=\S)")
BLANKS = re.compile(r"\s\s")
NONE: list[int] = []
#: Words of characters before this one may be encoded from ranks.
PLAIN = "\u0250"
#: UTF-8 of earlier characters than U+0240 has no byte from this one on.
BEYOND = 0xC9
#: What ends a sentence, at the end of a word.
STOPS = (".", "!", "?", "\n")


def pack_ids(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


def rank_encoder(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The same vocabulary and pattern in a library that is faster on words, and the bytes of each token."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    sizes[list(ranks.values())] = list(map(len, ranks))
    pattern = public_tokenizers.PATTERN
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes


class WordTokens:
    """Token ids of texts, as the byte-level tokenizer gives them for the whole text.

    With ``ranks``, a file of the same vocabulary, texts of Latin letters are encoded whole by a faster library,
    which takes less time than to look up their words. Others are encoded word by word, as the two libraries need
    not agree on what a letter is in every version of Unicode: pieces never reach over a space between two visible
    characters, so the text can be cut before each such space, and equal words are encoded once, those of Latin
    letters by the faster library. New words that begin with a space and end with a visible character are encoded
    many at a time, one after the other as in a text.
    """

    def __init__(self, path: str, ranks: str | None = None):
        self.tokenizer = Tokenizer.from_file(path)
        self.faster, self.sizes = (None, None) if ranks is None else rank_encoder(ranks)
        self.forget()
        names = [self.tokenizer.decode([token]) for token in range(self.tokenizer.get_vocab_size())]
        #: Tokens that may end a sentence, and those that begin with white space.
        self.stops = np.array([name.endswith(STOPS) for name in names])
        self.blanks = np.array([name[:1].isspace() for name in names])

    def forget(self) -> None:
        """Drop the words; a worker process outlives its task."""
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.long: list[str] = []

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        for begin in range(0, len(texts), 256):
            block = texts[begin : begin + 256]
            cut = [None if self._whole(text) else self._words(text) for text in block]
            if len(self.now) > MEMORY:  # words that were not met since the last time are forgotten
                self.now, self.old = {}, self.now
            self._learn(set().union(*filter(None, cut)).difference(self.now))
            for text, words in zip(block, cut, strict=True):
                if words is None:
                    yield pack_ids(self.faster.encode_ordinary(text))
                else:
                    yield b"".join(map(self.now.__getitem__, words))
            for word in self.long:
                del self.now[word]
            self.long.clear()

    def _whole(self, text: str) -> bool:
        """Whether the faster library may encode the text."""
        if self.faster is None or "<|" in text:
            return False
        return text.isascii() or int(np.frombuffer(text.encode(), np.uint8).max()) < BEYOND

    def _learn(self, words: set[str]) -> None:
        unknown, plain = [], []
        for word in words:
            if len(word) > LONG_WORD:  # kept for this block only
                self.long.append(word)
            ids = self.old.get(word)
            if ids is not None:
                self.now[word] = ids
            elif self.faster is None or "<|" in word or not (word.isascii() or max(word) < PLAIN):
                unknown.append(word)
            elif word[:1] == " " and not word[1:2].isspace() and not word[-1].isspace():
                plain.append(word)
            else:
                self.now[word] = pack_ids(self.faster.encode_ordinary(word))
        for begin in range(0, len(plain), JOINED):
            self._learn_joined(plain[begin : begin + JOINED])
        encodings = self.tokenizer.encode_batch_fast(unknown, add_special_tokens=False)
        for word, encoding in zip(unknown, encodings, strict=True):
            self.now[word] = pack_ids(encoding.ids)

    def _learn_joined(self, words: list[str]) -> None:
        """Words that may follow each other: their tokens are told apart by their bytes."""
        ids = np.array(self.faster.encode_ordinary("".join(words)), "<u4")
        bytes_of = [len(word) if word.isascii() else len(word.encode()) for word in words]
        last = 4 * (np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(bytes_of)) + 1)
        blob, start = ids.tobytes(), 0
        for word, end in zip(words, last.tolist(), strict=True):
            self.now[word] = blob[start:end]
            start = end

    def sentence_ends(self, ids: bytes) -> np.ndarray:
        """Numbers of tokens after which a sentence may end."""
        tokens = np.frombuffer(ids, "<u4")
        after = np.append(self.blanks[tokens[1:]], True)
        return np.nonzero(self.stops[tokens] & after[: len(tokens)])[0] + 1

    @staticmethod
    def _words(text: str) -> list[str]:
        if not text:
            return []
        if BLANKS.search(text) or text[0] == " " or text[-1] == " ":
            first, *rest = SEAM.split(text)
        else:
            first, *rest = text.split(" ")
        return [first, *[" " + word for word in rest]]


@cache
def word_tokens(tokenizer: str, ranks: str | None) -> WordTokens:
    return WordTokens(public_tokenizers.path(tokenizer), ranks and public_tokenizers.path(ranks))


def cut_points(ends: np.ndarray, total: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where one document may be cut, with penalties; ``ends`` are those of sentences, ``total`` counts the
    document's end token.

    Its last point is its end. No two points, and not its start and its first point, are more than half
    a window apart.
    """
    at = ends[ends < total]
    penalty = np.full(len(at) + 1, SENTENCE_PENALTY)
    penalty[-1] = 0.0
    at = np.append(at, total)
    gaps = np.diff(at, prepend=0)
    wide = gaps > width // 2
    if not wide.any():
        return at, penalty
    step = max(1, min(GRID, width // 2))
    more = np.concatenate([np.arange(end - gap + step, end, step) for end, gap in zip(at[wide], gaps[wide], strict=True)])
    at, order = np.unique(np.concatenate([at, more]), return_index=True)
    penalty = np.concatenate([penalty, np.full(len(more), TRUNCATION_PENALTY)])[order]
    return at, penalty


def with_full_windows(at: np.ndarray, penalty: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The cuts, and those a full window after a cut or after the start."""
    full = np.append(0, at) + width
    full = full[full < at[-1]]
    every = np.concatenate([at, full])
    every, order = np.unique(every, return_index=True)  # of equal ones the first, which is a boundary
    return every, np.concatenate([penalty, np.full(len(full), TRUNCATION_PENALTY)])[order]


def best_cuts(at: np.ndarray, penalty: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The chosen ones of the cuts ``at`` (ascending, not 0, the last one is the end of the stream)."""
    where = np.append(0, at)
    short: list[list[int]] = [NONE] * len(where)
    for power in [1 << k for k in range(width.bit_length()) if 1 << k < width]:
        # Windows of a few tokens serve to end a stream only.
        first = 1 if power >= width // 16 else np.searchsorted(where, where[-1] - 2 * width, side="left")
        ends = np.arange(max(1, first), len(where))
        ends = ends[where[ends] >= power]
        place = np.searchsorted(where, where[ends] - power)
        hit = where[place] == where[ends] - power
        for j, i in zip(ends[hit].tolist(), place[hit].tolist(), strict=True):
            short[j] = [*short[j], i]
    position, cost = where.tolist(), np.append(0.0, penalty + SEQUENCE_COST + width).tolist()
    best, before = [0.0] * len(position), [0] * len(position)
    # The monotone queue: cuts in reach by place, and what they cost with their place, ascending.
    head, cuts, costs = 0, [0], [0.0]
    j = 0
    for here, extra, others in zip(position[1:], cost[1:], short[1:], strict=True):
        j += 1
        least = here - width
        while position[cuts[head]] < least:
            head += 1
        i = cuts[head]
        value = costs[head] - here
        for other in others:
            if best[other] - width < value:
                value, i = best[other] - width, other
        value += extra
        best[j] = value
        before[j] = i
        reach = value + here
        while len(costs) > head and costs[-1] >= reach:
            costs.pop()
            cuts.pop()
        costs.append(reach)
        cuts.append(j)
    chosen = []
    j = len(position) - 1
    while j:
        chosen.append(position[j])
        j = before[j]
    return np.array(chosen[::-1], np.int64)


def packed(texts: list[str], encoder: WordTokens, width: int = WIDTH, end: int = END):
    """Pieces of one stream: document, start in it, sequence, offset there, and ids, as arrays and bytes;
    and the tokens of each document."""
    blobs, points, penalties, lengths = [], [], [], []
    start = 0
    tail = pack_ids([end])
    for ids in encoder.encode(texts):
        total = len(ids) // 4 + 1
        at, penalty = cut_points(encoder.sentence_ends(ids), total, width)
        blobs.append(ids + tail)
        points.append(at + start)
        penalties.append(penalty)
        lengths.append(total)
        start += total
    cuts = best_cuts(*with_full_windows(np.concatenate(points), np.concatenate(penalties), width), width)
    doc_starts = starts_of(np.array(lengths))
    # A piece begins where a document or a sequence does.
    begins = np.unique(np.concatenate([doc_starts[:-1], cuts[:-1]]))
    stops = np.append(begins[1:], start)
    doc = np.searchsorted(doc_starts, begins, side="right") - 1
    sequence = np.searchsorted(cuts, begins, side="right")
    offset = begins - np.append(0, cuts)[sequence]
    inside = begins - doc_starts[doc]
    ids = [blobs[d][4 * a : 4 * (a + n)] for d, a, n in zip(doc.tolist(), inside.tolist(), (stops - begins).tolist(), strict=True)]
    return doc, inside, stops - begins, sequence, offset, ids, np.array(lengths)


PIECES = "start LONG, length LONG, ids BINARY, doc_tokens LONG, sequence_id LONG, offset LONG"


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    ranks: str | None = "byte_bpe_50k.tiktoken",
    width: int = WIDTH,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``width`` tokens, one row each.

    ``ranks`` is a file with the tokenizer's vocabulary as ranks, or None. ``ids`` holds the piece's token ids as little-endian 32-bit numbers. A sequence's number is that of
    its input partition, times 2^33, and of the sequence there.
    """
    schema = docs.select(key).schema
    pieces = docs.sparkSession.createDataFrame([], PIECES).schema
    for field in pieces:
        schema = schema.add(field)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokens(tokenizer, ranks)
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for keys, texts in runs_of(batch, STREAM_CHARS):
                doc, start, length, sequence, offset, ids, tokens = packed(texts, encoder, width)
                columns = [pa.array(start), pa.array(length), pa.array(ids, pa.binary()), pa.array(tokens[doc])]
                columns += [pa.array(sequence + number), pa.array(offset)]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(doc)), *columns], names=schema.names)
                number += int(sequence[-1]) + 1
        encoder.forget()

    return docs.select(key, text).mapInArrow(mapped, schema)
