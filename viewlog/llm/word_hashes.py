"""Texts as rows of word hashes, straight from the bytes of an Arrow column.

A word is a run of anything but the six ASCII white-space characters, A-Z as a-z. Its hash is that of
its length and of the sum of its bytes' values times powers of a constant; all such sums of a piece of
text are differences of one running total, so no word becomes an object. Words of more than ``LONG``
bytes are hashed one by one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from viewlog.llm.hash_arrays import hash_numbers

PIECE = 1 << 19  # bytes handled at once; a text may have several pieces
LONG = 1 << 12
BLOCK = 1 << 18  # words per block
BASE = 0x9DDFEA08EB382D69  # odd, so that its powers can be divided by

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = hash_numbers([np.arange(256)]).view(np.uint64)[_LOWER]
END, START = (int(hash_numbers([np.zeros(1, np.int64), np.array([length])])[0]) for length in (0, -1))  # no word has these lengths


def _powers(base: int, count: int) -> np.ndarray:
    factors = np.full(count + 1, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


_POWERS = _powers(BASE, 2 * PIECE)
_INVERSE = _powers(pow(BASE, -1, 1 << 64), 2 * PIECE)


@dataclass
class Block:
    """Words of several texts in a row, each text after ``order - 1`` places of context."""

    hashes: np.ndarray  # distinct ones, ascending
    local: np.ndarray  # which of them, place by place
    row: np.ndarray  # the text of every place, -1 for context


def _word_hashes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a piece; no word goes over an edge."""
    inside = ~_IS_WHITE[data]
    before, after = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    after[:-1] = inside[1:]
    edges = edges[edges < len(data)]
    before[edges] = False
    after[edges[edges > 0] - 1] = False
    starts, stops = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    sizes = stops - starts
    long = np.flatnonzero(sizes > LONG)
    if len(data) < len(_POWERS):
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_VALUE[data] * _POWERS[:len(data)], out=total[1:])
        sums = (total[stops] - total[starts]) * _INVERSE[starts]
    else:  # such a piece is one word alone
        sums = np.zeros(len(starts), dtype=np.uint64)
    for n in long:
        sums[n] = xxhash.xxh64_intdigest(_LOWER[data[starts[n]:stops[n]]].tobytes())
    return starts, hash_numbers([sums.view(np.int64), sizes])


def _cuts(data: np.ndarray, first: int, last: int) -> Iterator[tuple[int, int]]:
    """Pieces of one long text, cut at white space; a word too long for a piece is one by itself."""
    while last - first > PIECE:
        white = np.flatnonzero(_IS_WHITE[data[first:first + PIECE]])
        if len(white):
            yield first, first + int(white[-1]) + 1
            first += int(white[-1]) + 1
            continue
        stop = first
        while stop < last:  # the end of the word
            white = np.flatnonzero(_IS_WHITE[data[stop:stop + PIECE]])
            if len(white):
                stop += int(white[0])
                break
            stop = min(last, stop + PIECE)
        yield first, stop
        first = stop
    if first < last:
        yield first, last


def pieces(texts: pa.StringArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of words and, after each text's last word, of its end, with the number of their text."""
    if texts.type != pa.large_string():
        texts = texts.cast(pa.large_string())
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.empty(0, dtype=np.uint8)
    number = 0
    while number < len(texts):
        # As many whole texts as fit a piece.
        stop = int(np.searchsorted(offsets, offsets[number] + PIECE, side="right")) - 1
        if stop > number:
            edges = offsets[number:stop + 1] - offsets[number]
            starts, hashes = _word_hashes(data[offsets[number]:offsets[stop]], edges[:-1])
            owner = np.searchsorted(edges[1:], starts, side="right")
            out = np.full(len(hashes) + stop - number, END, dtype=np.int64)
            out[np.arange(len(hashes)) + owner] = hashes
            words = np.bincount(owner, minlength=stop - number)
            yield out, np.repeat(np.arange(number, stop), words + 1)
            number = stop
            continue
        for first, last in _cuts(data, int(offsets[number]), int(offsets[number + 1])):
            _, hashes = _word_hashes(data[first:last], np.zeros(1, dtype=np.int64))
            yield hashes, np.full(len(hashes), number)
        yield np.array([END]), np.array([number])
        number += 1


def blocks(batches: Iterable[pa.StringArray], order: int, limit: int = BLOCK) -> Iterator[Block]:
    """All words and ends of texts in blocks of at least ``limit``; a text may go on in the next block.

    Numbers of texts count on from batch to batch.
    """
    hashes: list[np.ndarray] = []
    rows: list[np.ndarray] = []
    held, context, going_on = 0, np.full(order - 1, START, dtype=np.int64), False

    def out() -> Block:
        """The block of what is held; ``context`` stands before its first word if a text is going on."""
        words, row = np.concatenate(hashes), np.concatenate(rows)
        if order > 1:
            fresh = np.flatnonzero(np.diff(row, prepend=row[0] if going_on else -1))
            places = np.repeat(fresh, order - 1)
            words, row = np.insert(words, places, START), np.insert(row, places, -1)
            if going_on:
                words, row = np.concatenate([context, words]), np.concatenate([np.full(order - 1, -1), row])
        distinct, local = np.unique(words, return_inverse=True)
        return Block(distinct, local, row)

    before = 0
    for texts in batches:
        for piece, row in pieces(texts):
            if not len(piece):
                continue
            hashes.append(piece)
            rows.append(row + before)
            held += len(piece)
            if held >= limit:
                block = out()
                yield block
                context = block.hashes[block.local[len(block.local) - (order - 1):]]
                going_on = hashes[-1][-1] != END
                hashes, rows, held = [], [], 0
        before += len(texts)
    if held:
        yield out()
