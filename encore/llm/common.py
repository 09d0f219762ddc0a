"""Shared pieces of the training-data operators: text batches, hashing, checkpoints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from ..sources.tables import read_table

CHUNK_BYTES = 1 << 20      # text bytes handled by one numpy pass
CHUNK_ROWS = 1000          # rows converted at a time
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, with the package shipped to the executors."""
    ship_package(spark)
    return read_table(spark, sf_dir, name)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder; cuts the lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def among(ids: DataFrame, column: Column, bits: int = 1 << 26) -> Column:
    """True for every value of ``column`` that is among ``ids`` (one bigint column), and for a few others.

    A bitmap of ``bits`` bits over hashes of the ids is merged by Spark and
    broadcast (8 MB at most by default), so a join that needs few rows shuffles
    few. Beyond some ``bits / 2`` ids it lets most rows through; a join must follow.
    """
    place = F.pmod(F.xxhash64(ids.columns[0]), F.lit(bits))
    words = (ids.select(place.alias("b")).groupBy(F.expr("b div 64").alias("w"))
                .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("b") % 64).cast("int")))
                     .alias("bits")).toArrow())
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[words.column(0).to_numpy()] = words.column(1).to_numpy()
    shared = ids.sparkSession.sparkContext.broadcast(bitmap)

    @F.arrow_udf("boolean")
    def known(at: pa.Array) -> pa.Array:
        at = at.to_numpy(zero_copy_only=False)
        return pa.array((shared.value[at >> 6] >> (at & 63)) & 1 == 1)

    return known(F.pmod(F.xxhash64(column), F.lit(bits)))


def hashable(df: DataFrame, name: str) -> Column:
    """A column as Spark can hash it: types that hold maps as JSON."""
    kind = df.schema[name].dataType.simpleString()
    return F.to_json(F.col(name)) if "map<" in kind else F.col(name)


def row_key(df: DataFrame, *cols: str) -> tuple[Column, Column]:
    """128-bit key of a row's content: equal rows share it, so results never mix
    rows that only share an id, and null ids are ordinary values."""
    parts = [c for name in cols for c in (hashable(df, name), F.col(name).isNull())]
    return F.xxhash64(*parts).alias("r1"), F.xxhash64(F.lit(7), *reversed(parts)).alias("r2")


# --- numpy text passes ------------------------------------------------------

def text_chunks(column: pa.Array | pa.ChunkedArray,
                limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of whole texts of about ``limit`` bytes.

    Yields ``(first, end, data, offsets)``: rows ``first..end`` as UTF-8 bytes
    and their offsets into ``data``. Null texts are empty; a text longer than
    the limit forms a run of its own, so memory follows the longest text.
    """
    for base in range(0, len(column), CHUNK_ROWS):
        part = column.slice(base, CHUNK_ROWS)
        if isinstance(part, pa.ChunkedArray):
            part = part.combine_chunks()
        part = pc.fill_null(part.cast(pa.large_string()), "")
        n = len(part)
        _, off, buf = part.buffers()
        offsets = np.frombuffer(off, np.int64)[part.offset: part.offset + n + 1]
        data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
        first = 0
        while first < n:
            end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            end = min(max(end, first + 1), n)
            lo = int(offsets[first])
            yield base + first, base + end, data[lo:int(offsets[end])], offsets[first:end + 1] - lo
            first = end


_U = np.uint64


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit finalizer (xor-shift-multiply), element-wise."""
    x = x + _U(0x9E3779B97F4A7C15 * (salt + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Rolling:
    """Polynomial hashes modulo 2**64 of any slice, from one prefix sum.

    Fast, but a Thue-Morse sequence of 1,024 values and its complement share them
    whatever the base. Fit for marks, for keys that contents are compared under,
    and for slices of few values; where it tells contents apart it stands beside
    ``PrimeRolling``.
    """

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, values: np.ndarray, base: int):
        n = len(values)
        up, down = self._table(base, n + 1)
        self.down = down
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(values * up[:n], out=self.prefix[1:])

    @classmethod
    def _table(cls, base: int, n: int):
        got = cls._powers.get(base)
        if got is None or len(got[0]) < n:
            size = max(n, 1 << 16)
            inverse = pow(base, -1, 1 << 64)
            up = np.full(size, base, np.uint64)
            down = np.full(size, inverse, np.uint64)
            up[0] = down[0] = 1
            got = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
            if size <= 4 * CHUNK_BYTES:
                cls._powers[base] = got
        return got

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.down[start]


_PRIME = (1 << 61) - 1
_P, _LOW31, _LOW30, _LOW32 = _U(_PRIME), _U((1 << 31) - 1), _U((1 << 30) - 1), _U((1 << 32) - 1)


def _folded(x: np.ndarray) -> np.ndarray:
    """Values below 2**64 modulo 2**61 - 1."""
    x = (x & _P) + (x >> _U(61))
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2**61 - 1 of values below it."""
    ah, al, bh, bl = a >> _U(31), a & _LOW31, b >> _U(31), b & _LOW31
    mid = al * bh + ah * bl
    return _folded(ah * bh * _U(2) + (mid >> _U(30)) + ((mid & _LOW30) << _U(31)) + al * bl)


class PrimeRolling:
    """Polynomial hashes modulo the prime 2**61 - 1 of any slice of ``values``.

    The terms' upper and lower halves are summed apart and joined by a rotation
    (2**61 is 1), a run of ``_RUN`` values at a time, which stays in the cache.
    """

    _BASE = 0x1F3D5B79A2C4E687 % _PRIME
    _RUN = 1 << 14
    _powers: tuple[np.ndarray, ...] | None = None

    def __init__(self, values: np.ndarray):
        n = len(values)
        up, high_up, low_up, self.down = self._table(n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        carry = _U(0)
        for at in range(0, n, self._RUN):
            end = min(at + self._RUN, n)
            if values.dtype == np.uint8:        # terms of a byte need no reduction
                v = values[at:end] + _U(1)
                high, low = high_up[at:end] * v, low_up[at:end] * v
            else:
                term = _times(values[at:end] >> _U(3), up[at:end])
                high, low = term >> _U(32), term & _LOW32
            np.cumsum(high, out=high)
            np.cumsum(low, out=low)
            low += ((high << _U(32)) & _P) | (high >> _U(29))
            low += carry
            self.prefix[at + 1:end + 1] = low = _folded(low)
            carry = low[-1]

    @classmethod
    def _table(cls, n: int):
        got = cls._powers
        if got is None or len(got[0]) < n:
            size = max(n, 1 << 16)
            up, down = (cls._series(base, size) for base in (cls._BASE, pow(cls._BASE, -1, _PRIME)))
            got = up, up >> _U(32), up & _LOW32, down
            if size <= 4 * CHUNK_BYTES:
                cls._powers = got
        return got

    @staticmethod
    def _series(base: int, size: int) -> np.ndarray:
        """Powers of ``base``, doubling the known part each time."""
        out = np.ones(size, np.uint64)
        known, step = 1, base
        while known < size:
            more = min(known, size - known)
            out[known:known + more] = _times(out[:more], np.full(more, step, np.uint64))
            known, step = known + more, step * step % _PRIME
        return out

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        gap = self.prefix[end] + (_P - self.prefix[start])
        return _times(np.where(gap >= _P, gap - _P, gap), self.down[start])


BASE_A = 0x2545F4914F6CDD1D
BYTE_VALUE = mix(np.arange(256, dtype=np.uint64), 99)


_PLACES = 64
_SPAN_RUN = 1 << 15
_SPAN_TABLES: dict[int, np.ndarray] = {}


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, *salts: int) -> list[np.ndarray]:
    """64-bit hashes of non-empty spans in ascending order, one array per salt.

    A span's hash is the sum of one random value per place and byte, so no base
    and no power is shared between places; salts are independent of each other.
    Spans are taken in runs of about ``_SPAN_RUN`` bytes, which stay in the cache.
    """
    out = [np.empty(len(start), np.uint64) for _ in salts]
    at = 0
    while at < len(start):
        stop = max(at + 1, int(np.searchsorted(end, start[at] + _SPAN_RUN, "right")))
        low, high = int(start[at]), int(end[stop - 1])
        first = (start[at:stop] - low).astype(np.int32)
        edges = np.empty(2 * len(first), np.int32)          # of spans and, between them, of gaps
        edges[::2], edges[1::2] = first, end[at:stop] - low
        until = np.append(first[1:], np.int32(high - low))
        place = np.arange(high - low, dtype=np.int32) - np.repeat(first, until - first)
        row = (place & np.int32(_PLACES - 1)) << np.int32(8)
        row |= data[low:high]
        far = np.flatnonzero(place >= _PLACES)
        turn = mix((place[far] // _PLACES).astype(np.uint64), 91)
        for number, salt in enumerate(salts):
            table = _SPAN_TABLES.get(salt)
            if table is None:
                table = _SPAN_TABLES[salt] = mix(np.arange(_PLACES * 256, dtype=np.uint64), 1000 + salt)
            value = np.empty(high - low + 1, np.uint64)
            np.take(table, row, out=value[:-1], mode="clip")
            value[far] = mix(value[far] + turn, salt)
            out[number][at:stop] = np.add.reduceat(value, edges)[::2]
        at = stop
    size = (end - start).astype(np.uint64)
    return [mix(total + size, salt) for total, salt in zip(out, salts)]


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False, salts: tuple[int, ...] = (5,)):
    """Words of concatenated texts: ``(doc, start, end, hash...)`` arrays, one hash per salt.

    A word is a run of bytes other than space and \\x09-\\x0D that stays inside
    one text. ``lower`` folds A-Z for the hashes.
    """
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    n = len(data)
    begin = solid.copy()
    stop = solid.copy()
    if n:
        begin[1:] &= ~solid[:-1]
        stop[:-1] &= ~solid[1:]
        inner = offsets[(offsets > 0) & (offsets < n)]
        begin[inner] = solid[inner]
        stop[inner - 1] = solid[inner - 1]
    start = np.flatnonzero(begin)
    end = np.flatnonzero(stop) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    return doc, start, end, *span_hashes(data, start, end, *salts)


def ranges(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(first[i], first[i] + length[i])``."""
    total = int(length.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(length)
    return np.arange(total) + np.repeat(first - (ends - length), length)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
