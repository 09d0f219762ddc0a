"""Removal of repeated byte strings by prefix-free parsing.

Every byte covered by a string of ``width`` bytes that also starts anywhere else
(inside one document, the same one included) is removed.

Prefix-free parsing: a rolling hash of ``trigger`` bytes marks phrase ends where
it falls below 1/``period`` of its range. The marks depend on those bytes alone,
so equal strings are cut at equal places: a string that starts inside a phrase
is the phrase's suffix up to the next mark (a suffix of the dictionary) followed
by the parse from there (a suffix of the parse). Strings that start in one phrase
at about the same distance from its mark form a block: they share a core (phrase
suffix from the last start, parse up to the end of the first string), and the
block's content runs from the first start to the end of the last string. Highly
repetitive text has few distinct blocks, however many copies.

No phrase dictionary, parse or suffix array is built, and nothing is put in
corpus order. Suffix arrays would serve one purpose here, to bring equal strings
together; grouping the blocks by 128-bit hashes of their contents does that
without an order, and without one family of near copies in one sorted range.
Steps (``repeats.py``): blocks whose core is seen once are passed over, blocks
whose whole content repeats are settled as one row, and the starts of the
remaining blocks are compared one by one. Starts with no mark near (low-entropy bytes)
are compared directly.

Results: null, empty and short texts lose nothing. Repeated rows are documents
of their own. ``kept`` is binary: removal may cut a character. Null ids are
ordinary values; columns outside ``keep`` are not read. A very long text is cut in
one run, held whole by its task; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BASE_A, BYTE_VALUE, Rolling, mix, row_key, text_chunks
from .repeats import Cut, covered, repeated_windows

_FACTORS = mix(np.arange(4, dtype=np.uint64), 17) | np.uint64(1)


@dataclass(frozen=True)
class Phrases:
    """Strings of ``width`` bytes, in blocks by the phrase they start in.

    ``head``: bytes of the parse suffix that every block's gram covers; a start
    whose next mark is further than ``width - head`` bytes away is free.
    ``steps``: distances from the mark at which a phrase is divided into blocks.
    """

    width: int
    trigger: int = 16
    period: int = 48
    head: int = 112
    steps: tuple[int, ...] = (32, 96)

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> Cut:
        out = Cut()
        docs = len(offsets) - 1
        out.a, out.units_b = Rolling(BYTE_VALUE[data], BASE_A), lambda: data
        out.first = offsets
        marks = self._marks(data, offsets)
        # each mark's document, and the starts whose first mark it is
        doc = np.searchsorted(offsets, marks, "right") - 1
        before = np.full(len(marks), -1, np.int64)
        before[1:] = marks[:-1]
        low = np.maximum(np.maximum(before + 1, offsets[doc]), marks - (self.width - self.head))
        high = np.minimum(marks, offsets[doc + 1] - self.width)
        some = high >= low
        marks, doc, low, high = marks[some], doc[some], low[some], high[some]
        # starts that no mark serves: the gaps between those ranges
        per = np.maximum(np.diff(offsets) - self.width + 1, 0)
        whole = np.flatnonzero(per > 0)
        edge_low = np.concatenate([high + 1, offsets[whole]])
        edge_high = np.concatenate([low, offsets[whole] + per[whole]])
        edge_doc = np.concatenate([doc, whole])
        begin = np.argsort(edge_low, kind="stable")
        finish = np.argsort(edge_high, kind="stable")
        g_low, g_high, g_doc = edge_low[begin], edge_high[finish], edge_doc[begin]
        gap = g_high > g_low
        parts = [(g_low[gap], (g_high - g_low)[gap], g_doc[gap], np.zeros(int(gap.sum()), np.uint64))]
        far = self.width - self.head + 1
        edges = [0, *[s for s in self.steps if s < far], far]
        for salt, (near, beyond) in enumerate(zip(edges, edges[1:])):
            one, last = np.maximum(low, marks - beyond + 1), np.minimum(high, marks - near)
            some = last >= one
            core = out.a.slices(marks[some] - near, marks[some] - beyond + 1 + self.width)
            parts.append((one[some], (last - one + 1)[some], doc[some], mix(core, 80 + salt)))
        out.at, out.size, out.doc, out.gram = map(np.concatenate, zip(*parts))
        out.free = np.arange(len(out.at)) < len(parts[0][0])
        return out

    def _marks(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Places whose next ``trigger`` bytes, inside one document, hash low."""
        n = len(data) - self.trigger + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        # the bytes as overlapping 64-bit numbers, one beginning at every place
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        eights = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
        h = np.zeros(n, np.uint64)
        for number, at in enumerate(sorted({*range(0, self.trigger - 7, 8), max(self.trigger - 8, 0)})):
            some = eights[at:at + n]
            if self.trigger < 8:
                some = some & np.uint64((1 << 8 * self.trigger) - 1)
            h += some * _FACTORS[number % len(_FACTORS)]
            h ^= h >> np.uint64(29)
        h *= _FACTORS[-1]
        at = np.flatnonzero(h < np.uint64((1 << 64) // self.period))
        doc = np.searchsorted(offsets, at, "right") - 1
        return at[at + self.trigger <= offsets[doc + 1]]


def remove_repeated_strings(df: DataFrame, text: str = "text", width: int = 400, rows: int = 1,
                            cells: int = 1 << 28, keep: list[str] | None = None, digest: bool = False,
                            phrases: Phrases | None = None) -> DataFrame:
    """Remove the bytes of repeated strings.

    Returns the ``keep`` columns (default: all but the text), ``n_bytes``,
    ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept`` (the other
    bytes, binary), or with ``digest`` their SHA-256 as ``kept_sha256``.
    """
    phrases = phrases or Phrases(width)
    if phrases.width != width or not phrases.trigger <= phrases.head < width:
        raise ValueError("a phrase's head lies between the trigger and the width")
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256" if digest else "kept"]
    keep = [c for c in (df.columns if keep is None else keep) if c != text and c not in added]
    docs = df.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(keep)], F.col(text).alias("_t"),
                     *row_key(df, *keep, text))
    runs = repeated_windows(docs, "_t", phrases, rows, cells)
    joined = docs.join(runs.hint("shuffle_hash"), ["r1", "r2"], "left")
    schema = T.StructType([*[T.StructField(c, df.schema[c].dataType) for c in keep],
                           *[T.StructField(c, T.LongType()) for c in added[:3]],
                           T.StructField(added[3], T.StringType() if digest else T.BinaryType())])

    def run(batches):
        for batch in batches:
            found = batch.column(len(keep) + 1)
            made = [[], [], [], []]
            for lo, hi, data, offsets in text_chunks(batch.column(len(keep))):
                gone = covered(found.slice(lo, hi - lo), offsets, len(data), width)
                opens = gone.copy()
                opens[1:] &= ~gone[:-1]
                inner = offsets[1:-1][offsets[1:-1] < len(data)]
                opens[inner] = gone[inner]
                lost = np.concatenate([[0], np.cumsum(gone)])[offsets]
                spans = np.concatenate([[0], np.cumsum(opens)])[offsets]
                body = data[~gone]
                cut = offsets - lost
                made[0] += np.diff(offsets).tolist()
                made[1] += np.diff(lost).tolist()
                made[2] += np.diff(spans).tolist()
                for x, y in zip(cut[:-1].tolist(), cut[1:].tolist()):
                    made[3].append(hashlib.sha256(body[x:y]).hexdigest() if digest else body[x:y].tobytes())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(keep))], *[pa.array(m, pa.int64()) for m in made[:3]],
                 pa.array(made[3], pa.string() if digest else pa.binary())], names=schema.names)

    return joined.select(*[f"_c{i}" for i in range(len(keep))], "_t", "runs").mapInArrow(run, schema)
