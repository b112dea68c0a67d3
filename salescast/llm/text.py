"""Shared text helpers: word splitting, columnar byte scans, row annotation.

Everything that runs inside a task works on Arrow batches cut into pieces of a
couple of megabytes of text (a longer single text is a piece of its own), so memory
follows the longest text and never the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words of the scans over plain wording: digits, letters and all beyond ASCII.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words between ASCII white space.
SPACED_WORD = r"[^\x20\x09-\x0D]+"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_PLAIN = np.zeros(256, dtype=bool)
IS_PLAIN[48:58] = IS_PLAIN[97:123] = IS_PLAIN[128:] = True

PIECE_BYTES = 2 << 20


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only; null stays null."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def words(text: Column, pattern: str = SPACED_WORD) -> Column:
    """Array of words; null text has none."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.array().cast("array<string>"))


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def fresh(name: str, taken) -> str:
    """``name``, with underscores added until no column has it (case ignored)."""
    have = {c.lower() for c in taken}
    while name.lower() in have:
        name += "_"
    return name


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null reads as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]] if len(offsets) else raw[:0], offsets - offsets[:1]


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows of about ``most`` bytes of text."""
    if not batch.num_rows:
        return
    i = batch.schema.get_field_index(column)
    _, offsets = utf8(batch.column(i))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


class Words:
    """Word bounds of many texts at once: ``start`` and ``end`` in the bytes,
    and ``first[d]:first[d + 1]``, the words of text ``d``."""

    def __init__(self, column, is_word: np.ndarray = IS_PLAIN):
        raw, self.offsets = utf8(column)
        self.bytes = LOWER[raw]
        inside = is_word[self.bytes]
        n = len(inside)
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        if n:
            before[1:], after[:-1] = inside[:-1], inside[1:]
            cut = self.offsets[(self.offsets > 0) & (self.offsets < n)]
            before[cut] = False
            after[cut - 1] = False
        self.inside = inside
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, self.offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """Text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def word(self, i: int) -> bytes:
        return self.bytes[self.start[i]: self.end[i]].tobytes()

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word (a filter: hits are verified on the bytes)."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        inside = np.flatnonzero(self.inside)
        at = inside - np.repeat(self.start, length)
        with np.errstate(over="ignore"):
            value = MIX[self.bytes[inside]] * powers(int(length.max()))[at]
            total = np.add.reduceat(value, np.concatenate([[0], np.cumsum(length)[:-1]]))
            total ^= total >> np.uint64(29)
            return total * np.uint64(0xBF58476D1CE4E5B9)


MIX = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def powers(n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[1], np.full(max(0, n - 1), base)]).astype(np.uint64), dtype=np.uint64)


def struct_type(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


def annotate(df: DataFrame, text: str, kind: T.StructType,
             make: Callable[[], Callable[[pa.RecordBatch, int], list]], out: str = "_found") -> tuple[DataFrame, str]:
    """Adds one struct column computed from whole texts; all columns pass through.

    ``make`` runs once a task and returns ``f(piece, text position) -> arrays``,
    one array per field of ``kind``.  Returns the frame and the name of the
    column, which avoids the names that ``df`` has.
    """
    name = fresh(out, df.columns)
    at = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, T.StructField(name, kind)])
    fields = [f.name for f in kind.fields]

    def run(batches):
        work = make()
        for batch in batches:
            for piece in pieces(batch, batch.schema.names[at]):
                arrays = [x if isinstance(x, pa.Array) else pa.array(x) for x in work(piece, at)]
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.StructArray.from_arrays(arrays, names=fields)],
                                                 names=[*piece.schema.names, name])

    return df.mapInArrow(run, schema), name
