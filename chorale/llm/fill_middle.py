"""Fill-in-the-middle by a wavelet matrix over character classes.

The bytes of a slice of texts, one after another, are given one of eight classes each: line
ends, blanks, the ends of sentences and clauses, digits, continuation bytes of UTF-8 and all
else. A wavelet matrix keeps the classes as three bit rows with counts per word of 64 bits,
an eighth of the size of the texts a row. It answers for any place how many bytes of a class
stand before it (rank), and where the n-th of a class stands (select). From this come

* the number of units of a text: bytes that end a unit, by the ranks of their classes at both
  ends of the text, and one more for an unfinished unit at its end;
* the cut after so many units: by select where one class ends units, else by bisection on the
  sum of ranks;
* the length of a piece in characters: its bytes less the rank of continuation bytes.

All texts of a slice are asked at once, so no step runs per character in Python.

Where the two cuts are and in which form the pieces are written is decided by the digest of
seed and id, the same at any size of the table and in any order of its rows.

Defined results for odd input: a null or empty text has no units and is written as it is, as
is a text that holds one of the marks; a null id is an empty string for the digest; rows with
equal ids are cut alike as far as their texts are. Columns besides id and text are left out,
whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.llm.words import slices, utf8_parts
from chorale.session import ship_package

# The marks of the three pieces.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKS = f"{PREFIX}|{SUFFIX}|{MIDDLE}"
# Classes of bytes.
OTHER, LINE_END, BLANK, SENTENCE_END, CLAUSE_END, DIGIT, BRACKET, CONTINUATION = range(8)
BITS = 3


def _classes() -> np.ndarray:
    out = np.full(256, OTHER, dtype=np.uint8)
    for kind, held in (
        (LINE_END, b"\n"),
        (BLANK, b" \t\v\f\r"),
        (SENTENCE_END, b".!?"),
        (CLAUSE_END, b",;:"),
        (DIGIT, b"0123456789"),
        (BRACKET, b"()[]{}"),
        (CONTINUATION, bytes(range(0x80, 0xC0))),
    ):
        out[list(held)] = kind
    return out


CLASS = _classes()
#: The classes of bytes that end a unit.
UNITS: dict[str, tuple[int, ...]] = {
    "line": (LINE_END,),
    "sentence": (LINE_END, SENTENCE_END),
    "clause": (LINE_END, SENTENCE_END, CLAUSE_END),
    "blank": (LINE_END, BLANK),
}


class _Bits:
    """A row of bits with the number of ones before each word of 64."""

    def __init__(self, bits: np.ndarray) -> None:
        n = len(bits) // 64 + 1
        packed = np.zeros(n * 8, dtype=np.uint8)
        held = np.packbits(bits, bitorder="little")
        packed[: len(held)] = held
        self.words = packed.view("<u8")
        self.before = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)

    def place(self, number: np.ndarray, one: bool) -> np.ndarray:
        """Where the bit of that number, from 0, among the ones or the zeros is."""
        low = np.zeros(len(number), dtype=np.int64)
        high = np.full(len(number), len(self.words) * 64, dtype=np.int64)
        while (low < high).any():
            # The first place with more than `number` of the bit up to and with it.
            middle = (low + high) >> 1
            ones = self.ones(np.minimum(middle + 1, len(self.words) * 64 - 1))
            enough = (ones if one else middle + 1 - ones) > number
            high = np.where(enough, middle, high)
            low = np.where(enough, low, np.minimum(middle + 1, high))
        return low


class WaveletMatrix:
    """Rank and select over a row of numbers below 8."""

    def __init__(self, codes: np.ndarray) -> None:
        self.length = len(codes)
        self.rows: list[_Bits] = []
        self.zeros: list[int] = []
        for level in range(BITS):
            bit = (codes >> (BITS - 1 - level)) & 1
            self.rows.append(_Bits(bit))
            self.zeros.append(len(codes) - int(np.count_nonzero(bit)))
            codes = np.concatenate([codes[bit == 0], codes[bit == 1]])

    def rank(self, code: int, at: np.ndarray) -> np.ndarray:
        """How often ``code`` stands before each place."""
        low = np.zeros(1, dtype=np.int64)
        at = np.asarray(at, dtype=np.int64)
        for level, (row, zeros) in enumerate(zip(self.rows, self.zeros, strict=True)):
            if code >> (BITS - 1 - level) & 1:
                low, at = zeros + row.ones(low), zeros + row.ones(at)
            else:
                low, at = low - row.ones(low), at - row.ones(at)
        return at - low

    def select(self, code: int, number: np.ndarray) -> np.ndarray:
        """Where ``code`` stands for the time of that number, from 0; all must be there."""
        low = np.zeros(1, dtype=np.int64)
        for level, (row, zeros) in enumerate(zip(self.rows, self.zeros, strict=True)):
            ones = row.ones(low)
            low = zeros + ones if code >> (BITS - 1 - level) & 1 else low - ones
        at = low + np.asarray(number, dtype=np.int64)
        for level in reversed(range(BITS)):
            one = bool(code >> (BITS - 1 - level) & 1)
            at = self.rows[level].place(at - self.zeros[level] if one else at, one)
        return at

    def rank_of_any(self, codes: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        return sum((self.rank(code, at) for code in codes), np.zeros(len(at), dtype=np.int64))

    def after(self, codes: tuple[int, ...], number: np.ndarray) -> np.ndarray:
        """The place behind the byte of any of the classes that has that number, from 1."""
        if len(codes) == 1:
            return self.select(codes[0], number - 1) + 1
        low = np.zeros(len(number), dtype=np.int64)
        high = np.full(len(number), self.length, dtype=np.int64)
        while (low < high).any():
            middle = (low + high) >> 1
            enough = self.rank_of_any(codes, middle) >= number
            high = np.where(enough, middle, high)
            low = np.where(enough, low, np.minimum(middle + 1, high))
        return low


def unit_cuts(
    matrix: WaveletMatrix, codes: tuple[int, ...], begins: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For texts at ``begins`` to ``ends``: the numbers of units, and the unit ends before each."""
    before, until = matrix.rank_of_any(codes, begins), matrix.rank_of_any(codes, ends)
    last = matrix.rank_of_any(codes, np.maximum(ends - 1, begins))
    return until - before + ((ends > begins) & (last == until)), before


def _cut(
    matrix: WaveletMatrix,
    codes: tuple[int, ...],
    begins: np.ndarray,
    ends: np.ndarray,
    before: np.ndarray,
    counts: np.ndarray,
    units: np.ndarray,
) -> np.ndarray:
    """The place after so many units of each text."""
    out = np.where(units == 0, begins, ends)
    inner = np.flatnonzero((units > 0) & (units < counts))
    if len(inner):
        out[inner] = matrix.after(codes, before[inner] + units[inner])
    return out


def _drawn(seed: int, group: int) -> Column:
    """The group of that number, from 1, of eight hex digits of the digest of seed and id."""
    of = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digits = F.substring(F.sha2(of, 256), 8 * (group - 1) + 1, 8)
    return F.conv(digits, 16, 10).cast("long")


def transformed(
    docs: DataFrame, unit: str = "line", seed: int = 7, rate: int = 100, suffix_first: int = 50
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for each row of ``docs``.

    ``n`` is the number of units; of 100 texts about ``rate`` are cut, and of these
    ``suffix_first`` have the suffix in front (form ``spm``, else ``psm``).
    """
    ship_package(docs.sparkSession)
    codes = UNITS[unit]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                yield _written(part, codes, rate, suffix_first)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    drawn = [_drawn(seed, k).alias(f"h{k}") for k in range(1, 5)]
    return docs.select("doc_id", "text", *drawn).mapInArrow(
        cut,
        f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def _written(
    part: pa.RecordBatch, codes: tuple[int, ...], rate: int, suffix_first: int
) -> pa.RecordBatch:
    texts = part.column("text").fill_null("")
    data, offsets = utf8_parts(texts)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    begins, ends = offsets[:-1], offsets[1:]
    matrix = WaveletMatrix(CLASS[data])
    counts, before = unit_cuts(matrix, codes, begins, ends)
    h1, h2, h3, h4 = (part.column(f"h{k}").to_numpy(zero_copy_only=False) for k in range(1, 5))
    one, two = h1 % (counts + 1), h2 % (counts + 1)
    places = [
        _cut(matrix, codes, begins, ends, before, counts, units)
        for units in (np.minimum(one, two), np.maximum(one, two))
    ]
    chars = [b - matrix.rank(CONTINUATION, b) for b in (begins, *places)]
    marked = pc.match_substring_regex(texts, _MARKS).to_numpy(zero_copy_only=False)
    plain = (ends == begins) | marked | (h3 % 100 >= rate)
    spm = ~plain & (h4 % 100 < suffix_first)
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    out = []
    for k, (a, b, c, d) in enumerate(zip(begins, *places, ends, strict=True)):
        if plain[k]:
            out.append(data[a:d].tobytes())
            continue
        prefix, middle, suffix = (data[x:y].tobytes() for x, y in ((a, b), (b, c), (c, d)))
        pieces = (s, suffix, p, prefix) if spm[k] else (p, prefix, s, suffix)
        out.append(b"".join((*pieces, m, middle)))
    return pa.record_batch(
        [
            part.column("doc_id"),
            pa.array(counts, pa.int64()),
            pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")), pa.string()),
            pa.array(chars[1] - chars[0], pa.int64(), mask=plain),
            pa.array(chars[2] - chars[1], pa.int64(), mask=plain),
            pa.array(out, pa.binary()).cast(pa.string()),
        ],
        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
    )


def restored(output: Column, form: Column) -> Column:
    """The text, read back from what was written and its form.

    No mark can arise where a piece and a mark meet, as marks begin and end with characters
    that stand nowhere else in them; so the marks found are those that were written.
    """
    pieces = F.split(output, _MARKS, -1)
    first, second, middle = (pieces.getItem(k) for k in (1, 2, 3))
    return (
        F.when(form == "psm", F.concat(first, middle, second))
        .when(form == "spm", F.concat(second, middle, first))
        .otherwise(output)
    )
