"""Quality scores by Bradley-Terry pairwise ranking.

A document's score is a weighted sum of surface features of its text. The
weights are learnt from preference pairs (a document labelled good is preferred
to one labelled bad): the logistic loss on the difference of the two feature
vectors, minimised by Newton steps with a small ridge. The bad share of the
training rows picks a quantile of their scores; the threshold lies halfway
between the scores around it, and the reported score is the logistic function
of the distance from the threshold, so 0.5 separates the two verdicts.

Training uses at most ``max_labelled`` labelled rows (least hashes first) and
``max_pairs`` pairs; both are parameters and bound what reaches the driver.
Scoring covers every row and every whole text in one pass without a shuffle.
Neither label, language, source nor id enters a score.

Results: null and empty texts have features of 0 and are scored like any other.
Without labels of both sorts all scores are 0.5 (accepted). Repeated rows get
equal scores; equal scores get equal verdicts. Rows without an id take no part
in the training; of a repeated id one row does, the text of least hash. Very long
texts are scored whole; an empty table gives an empty result. Other columns pass through; ``score`` and ``predicted`` are
replaced.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_chunks

MAX_LABELLED = 20_000
MAX_PAIRS = 200_000
RIDGE = 1e-3
FEATURES = ("length", "upper", "exclaim", "symbol", "bar", "digit", "space", "stop", "quote", "other",
            "distinct_words", "echo", "word_length", "repeated_lines", "top_word", "single_words")


def _groups() -> np.ndarray:
    """Feature group of every byte, 10 where none."""
    of = np.full(256, 10)
    for group, chars in ((1, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (2, b"!?"), (3, b"#$%&*<>@^~=+\\_{}[]"),
                         (4, b"|"), (5, b"0123456789"), (6, b" \t\n\x0b\x0c\r"), (7, b".,;:"), (8, b"\"'()`/-")):
        for c in chars:
            of[c] = group
    of[128:] = 9
    return of


_GROUP = _groups()


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Feature rows of a run of texts."""
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    out = np.zeros((n, len(FEATURES)))
    doc = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.bincount(doc * 11 + _GROUP[data], minlength=n * 11).reshape(n, 11)
    out[:, 0] = np.log1p(np.diff(offsets)) / 10
    out[:, 1:10] = np.sqrt(counts[:, 1:10] / size[:, None])
    raw = data.tobytes()
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        body = raw[a:b]
        words = body.split()
        if not words:
            continue
        total = len(words)
        seen: dict[bytes, int] = {}
        for w in words:
            seen[w] = seen.get(w, 0) + 1
        out[i, 10] = len(seen) / total
        out[i, 11] = sum(map(operator.eq, words, words[1:])) / total
        out[i, 12] = min((b - a) / total, 40) / 40
        lines = body.split(b"\n")
        out[i, 13] = 1 - len(set(lines)) / len(lines)
        out[i, 14] = max(seen.values()) / total
        out[i, 15] = sum(v == 1 for v in seen.values()) / total
    return out


@dataclass(frozen=True)
class Ranking:
    """Weights of a fitted ranking, with the threshold folded into ``bias``."""

    weights: tuple[float, ...]
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        # row by row, so that a text's score does not depend on the batch around it
        z = np.einsum("ij,j->i", x, np.array(self.weights)) + self.bias
        return np.round(1 / (1 + np.exp(-np.clip(z, -30, 30))), 12)


def fit(x: np.ndarray, good: np.ndarray, max_pairs: int = MAX_PAIRS, steps: int = 30) -> Ranking:
    """Fit on feature rows and labels (True: good)."""
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(up) or not len(down):
        return Ranking((0.0,) * len(FEATURES), 0.0)
    spread = x.std(axis=0)
    spread[spread < 1e-9] = 1.0
    z = x / spread
    rng = np.random.default_rng(7)
    if len(up) * len(down) <= max_pairs:
        better, worse = np.repeat(up, len(down)), np.tile(down, len(up))
    else:
        better, worse = rng.choice(up, max_pairs), rng.choice(down, max_pairs)
    d = z[better] - z[worse]
    w = np.zeros(d.shape[1])
    eye = np.eye(len(w))
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))        # chance that the worse one wins
        gradient = RIDGE * w - d.T @ p / len(d)
        hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * eye
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    ranked = np.sort(z @ w)
    cut = len(down)                                           # quantile: the share of bad rows
    threshold = (ranked[cut - 1] + ranked[min(cut, len(ranked) - 1)]) / 2
    return Ranking(tuple(w / spread), float(-threshold))


def _feature_rows(df: DataFrame, text: str) -> DataFrame:
    """``(good, x)`` of labelled texts."""
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column(0)):
                x = features(data, offsets)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo), lists], names=["good", "x"])

    return df.select(text, "good").mapInArrow(run, "good boolean, x array<double>")


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          quality: str = "quality", max_labelled: int = MAX_LABELLED, max_pairs: int = MAX_PAIRS) -> Ranking:
    """Fit on the labelled rows (labels: id and 1 for good, 0 for bad; others are ignored)."""
    sample = (labels.filter(F.col(quality).isin(0, 1) & F.col(doc_id).isNotNull())
                    .select(F.col(doc_id).alias("_id"), (F.col(quality) == 1).alias("good"))
                    .dropDuplicates(["_id"]).orderBy(F.xxhash64("_id"), "_id").limit(max_labelled))
    # at most max_labelled ids: the broadcast has a fixed bound
    some = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t")).join(F.broadcast(sample), "_id")
    some = some.groupBy("_id", "good").agg(F.min_by("_t", F.xxhash64("_t")).alias("text"))
    rows = _feature_rows(some, "text").toPandas()
    if not len(rows):
        return Ranking((0.0,) * len(FEATURES), 0.0)
    x, good = np.stack(rows["x"].to_numpy()), rows["good"].to_numpy().astype(bool)
    order = np.lexsort((*x.T, good))            # whatever order the tasks finished in
    return fit(x[order], good[order], max_pairs)


def score_texts(df: DataFrame, ranking: Ranking, text: str = "text") -> DataFrame:
    """The input with ``score`` (0 to 1) and ``predicted`` (1 if the score is 0.5 or more)."""
    keep = [c for c in df.columns if c not in ("score", "predicted")]
    at = keep.index(text)
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])

    def run(batches):
        for batch in batches:
            parts = [ranking.score(features(data, offsets)) for _, _, data, offsets in text_chunks(batch.column(at))]
            score = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=schema.names)

    return df.select(*keep).mapInArrow(run, schema)
