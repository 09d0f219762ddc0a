"""Substring dedup with a count-min prefilter.

A window is ``width`` consecutive words of one document; every word covered by
a window whose words also start anywhere else is removed. Counting all windows
exactly would move one row per word, so:

1. Every window is represented by its least-hashed gram of ``gram`` words
   (equal windows pick the same gram at the same offset, and different starts
   pick different places, so a gram occurs at least as often as any window it
   represents). Each task counts the picked grams in a count-min sketch, kept
   sparse; Spark merges the sketches of all partitions by adding cells.
2. The cells that reached two are packed into bitmaps of a fixed size
   (``rows * cells / 8`` bytes, 32 MB by default) and broadcast. A window can
   only repeat if all cells of its gram reached two: the estimate never
   undercounts, so nothing is lost.
3. Windows estimated repeated are grouped exactly (``repeats.py``): windows in a
   row with the same gram form a block, blocks are grouped by all their words,
   and only where a gram has several contents are windows grouped one by one.

Results: null, empty and short texts have no windows and lose nothing. Repeated
rows are documents of their own (all their windows repeat). Null ids are
ordinary values. A very long text is cut in one run, held whole by its task; an
empty table gives an empty result. Columns outside ``keep`` are not read. A sketch filled far
beyond its cells passes more windows to step 3; results stay exact.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BASE_A, Rolling, mix, ranges, row_key, span_hashes, text_chunks, words
from .repeats import CELLS, ROWS, Cut, covered, repeated_windows


@dataclass(frozen=True)
class WordWindows:
    """Windows of ``width`` words; a block is a run of windows with the same least gram."""

    width: int
    gram: int

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> Cut:
        out = Cut()
        doc, start, end, h = words(data, offsets)
        out.units_b = lambda: span_hashes(data, start, end, 6)[0]
        n, docs = len(h), len(offsets) - 1
        out.a = Rolling(h, BASE_A)
        out.first = np.searchsorted(doc, np.arange(docs + 1))
        per = np.maximum(np.diff(out.first) - self.width + 1, 0)
        at = ranges(out.first[:-1], per)                # window starts
        g = pick = np.zeros(0, np.int64)
        if len(at):
            g = mix(out.a.slices(np.arange(n - self.gram + 1), np.arange(self.gram, n + 1)), 13)
            view = np.lib.stride_tricks.sliding_window_view(g, self.width - self.gram + 1)
            pick = view.argmin(axis=1)[at] + at
        new = np.ones(len(at), bool)
        new[1:] = pick[1:] != pick[:-1]
        block = np.flatnonzero(new)
        out.at, out.size = at[block], np.diff(np.append(block, len(at)))
        out.doc = np.repeat(np.arange(docs), per)[block]
        out.gram = g[pick[block]].astype(np.uint64)
        out.free = np.zeros(len(block), bool)
        return out


def remove_repeats(df: DataFrame, text: str = "text", width: int = 35, gram: int = 20,
                   rows: int = ROWS, cells: int = CELLS, keep: list[str] | None = None,
                   digest: bool = False) -> DataFrame:
    """Remove the words of repeated windows.

    Returns the ``keep`` columns (default: all but the text), ``n_words``,
    ``n_removed`` and ``kept`` (the other words joined by one space), or with
    ``digest`` its SHA-256 as ``kept_sha256``.
    """
    if not 0 < gram <= width:
        raise ValueError("a gram has between one word and the width of a window")
    added = ["n_words", "n_removed", "kept_sha256" if digest else "kept"]
    keep = [c for c in (df.columns if keep is None else keep) if c != text and c not in added]
    docs = df.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(keep)], F.col(text).alias("_t"),
                     *row_key(df, *keep, text))
    runs = repeated_windows(docs, "_t", WordWindows(width, gram), rows, cells)
    joined = docs.join(runs.hint("shuffle_hash"), ["r1", "r2"], "left")
    schema = T.StructType([*[T.StructField(c, df.schema[c].dataType) for c in keep],
                           T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField(added[2], T.StringType())])

    def run(batches):
        for batch in batches:
            found = batch.column(len(keep) + 1)
            n_words, n_removed, kept = [], [], []
            for lo, hi, data, offsets in text_chunks(batch.column(len(keep))):
                doc, start, end = words(data, offsets, salts=())
                first = np.searchsorted(doc, np.arange(hi - lo + 1))
                gone = covered(found.slice(lo, hi - lo), first, len(start), width)
                raw = data.tobytes()
                left = np.flatnonzero(~gone)
                cut = np.searchsorted(left, first)
                pieces = [raw[x:y] for x, y in zip(start[left].tolist(), end[left].tolist())]
                for d in range(hi - lo):
                    body = b" ".join(pieces[cut[d]:cut[d + 1]])
                    n_words.append(first[d + 1] - first[d])
                    n_removed.append(first[d + 1] - first[d] - (cut[d + 1] - cut[d]))
                    kept.append(hashlib.sha256(body).hexdigest() if digest else body.decode())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(keep))], pa.array(n_words, pa.int64()),
                 pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=schema.names)

    return joined.select(*[f"_c{i}" for i in range(len(keep))], "_t", "runs").mapInArrow(run, schema)
