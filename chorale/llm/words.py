"""Words and word windows of whole texts as numpy arrays, for use inside tasks.

Texts are looked at as UTF-8 bytes. Both kinds of words end at ASCII characters
only, so that a table of 256 flags tells word bytes from the rest, whatever the
language. Texts go through in pieces of about a megabyte, cut between texts or,
in a text that is longer, between two words; so the memory beside the hashes
themselves does not depend on the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
# Odd multipliers of the two rolling hashes, and the seed of the byte table.
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93
_TABLE_SEED = 20240229


def _flags(separators: Iterable[int]) -> np.ndarray:
    flags = np.ones(256, dtype=bool)
    flags[list(separators)] = False
    return flags


#: Everything but blank, tab, line feed, vertical tab, form feed and carriage return.
SPACED = _flags([0x20, *range(0x09, 0x0E)])
#: Digits, lower-case ASCII letters (after lower-casing) and everything beyond ASCII.
PLAIN = _flags([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """Words of some texts in order: the text each is in, its bytes' place and its hash.

    ``bounds[i]:bounds[i + 1]`` are the words of text ``i``. ``starts`` and ``ends``
    count bytes from the begin of the word's own text.
    """

    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.hashes)


@cache
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse, modulo 2^64."""
    out = []
    for value in (base, pow(base, -1, 1 << 64)):
        row = np.full(n, value, dtype=np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


@cache
def _byte_values() -> np.ndarray:
    return np.random.default_rng(_TABLE_SEED).integers(1, 1 << 63, 256, dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """The values with their bits spread over all 64 (a bijection)."""
    out = values ^ (values >> np.uint64(32))
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


def _length(n: int) -> int:
    """Lengths of power tables are rounded up, so that only a few are kept."""
    return max(PIECE_BYTES + 1, 1 << int(n).bit_length())


def _spans(data: np.ndarray, cuts: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of words in ``data``, none of which crosses a place in ``cuts``."""
    inside = flags[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    at = cuts[(cuts > 0) & (cuts < len(data))]
    first[at] = inside[at]
    last[at - 1] = inside[at - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    powers, inverse = _powers(_BYTE_BASE, _length(len(data)))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_byte_values()[data] * powers[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts])


def _pieces(data: np.ndarray, offsets: np.ndarray, flags: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about PIECE_BYTES, cut at a text's end or after a separator."""
    begin, total = int(offsets[0]), int(offsets[-1])
    while begin < total:
        end = min(begin + PIECE_BYTES, total)
        if end < total:
            text_end = int(offsets[np.searchsorted(offsets, end, "right") - 1])
            if text_end > begin:
                end = text_end
            else:
                stop = int(offsets[np.searchsorted(offsets, begin, "right")])
                while end < stop and flags[data[end - 1]]:
                    gap = np.flatnonzero(~flags[data[end : end + PIECE_BYTES]])
                    end = end + int(gap[0]) + 1 if len(gap) else min(end + PIECE_BYTES, stop)
                end = min(end, stop)
        yield begin, end
        begin = end


def utf8_parts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column one after another, and where each text begins; null is empty."""
    texts = texts.cast(pa.large_binary()) if texts.type != pa.large_binary() else texts
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)), offsets


def words_of(texts: pa.Array, flags: np.ndarray, lower: bool) -> Words:
    """All words of the texts; with ``lower``, A-Z count as a-z."""
    data, offsets = utf8_parts(texts)
    found = []
    for begin, end in _pieces(data, offsets, flags):
        piece = data[begin:end]
        if lower:
            piece = _LOWER[piece]
        starts, ends = _spans(piece, offsets - begin, flags)
        found.append((starts + begin, ends + begin, _word_hashes(piece, starts, ends)))
    starts, ends, hashes = (
        (np.concatenate(parts) for parts in zip(*found, strict=True))
        if found
        else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    )
    text = np.searchsorted(offsets, starts, "right") - 1
    bounds = np.searchsorted(text, np.arange(len(texts) + 1), "left")
    return Words(text, starts - offsets[text], ends - offsets[text], hashes, bounds)


def coded_words(
    texts: pa.Array, flags: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Text, begin, end (bytes of the slice) and number of each word, and the words by number.

    A-Z are lower-cased before words are told apart; ``flags`` are for the bytes as they are.
    Words are compared as they are, not by hashes.
    """
    data, offsets = utf8_parts(texts)
    first_byte = int(offsets[0])
    data, offsets = data[first_byte : offsets[-1]], offsets - first_byte
    inside = flags[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = offsets[1:-1]
    at = at[at < len(data)]
    first[at] = inside[at]
    starts = np.flatnonzero(first)
    # Only bytes of words are kept, one word after another: the begins are then all there is to know.
    letters = _LOWER[data[inside]]
    edges = np.append(np.flatnonzero(first[inside]), len(letters)).astype(np.int64)
    found = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(letters))
    coded = found.dictionary_encode()
    text = np.searchsorted(offsets, starts, "right") - 1
    codes = coded.indices.to_numpy().astype(np.int64)
    return text, starts, starts + np.diff(edges), codes, coded.dictionary


def window_hashes(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``length`` words inside one text, and the number of their first word."""
    n = len(words)
    if n < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(words.text[: n - length + 1] == words.text[length - 1 :])
    return windows_at(words.hashes, at, length), at


def windows_at(hashes: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the runs of ``length`` values that begin at the places ``at``."""
    powers, inverse = _powers(_WORD_BASE, _length(len(hashes)))
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * powers[: len(hashes)], out=sums[1:])
    return mixed((sums[at + length] - sums[at]) * inverse[at] + np.uint64(length))


def slices(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts come to about ``limit`` bytes, or one text each."""
    _, offsets = utf8_parts(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end
