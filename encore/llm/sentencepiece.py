"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

The text is normalised as the model asks (identity rules: a dummy prefix and
spaces written as U+2581), cut where no vocabulary piece can cross, and every
distinct part is merged with a score-ordered agenda of adjacent symbol pairs:
the best-scored pair (ties: leftmost) is merged and its two new neighbour pairs
enter the agenda. Characters outside the vocabulary become byte pieces.
Parts repeat heavily, so each Python worker keeps a bounded table of parts with
their ids, looked up by hash for a whole Arrow batch at once and compared byte by
byte; the parts of a batch that are not in it go through the agenda, are also
encoded by the sentencepiece library (a difference fails the job) and enter the
table.

Results: a null or empty text has no ids and decodes to the empty text. A very
long text is one run of the batch, held whole; an empty table gives an empty
result. Repeated
rows give repeated results; columns other than the text pass through unread.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import ranges, span_hashes, text_chunks

SPACE = "\u2581"
TABLE_PARTS = 600_000       # parts kept per Python worker (about 60 bytes each)
TABLE_BYTES = 32 << 20      # and their text
RUN_BYTES = 1 << 19         # text bytes handled by one numpy pass


class MergeModel:
    """A merge-type vocabulary: pieces, scores, byte pieces, and the library's processor."""

    def __init__(self, proto: bytes):
        import sentencepiece as spm
        from sentencepiece import sentencepiece_model_pb2 as pb2
        model = pb2.ModelProto.FromString(proto)
        norm, trainer = model.normalizer_spec, model.trainer_spec
        kinds = pb2.ModelProto.SentencePiece
        if trainer.model_type != pb2.TrainerSpec.BPE:
            raise ValueError("not a merge-type (BPE) model")
        if (norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces
                or not norm.add_dummy_prefix or trainer.treat_whitespace_as_suffix):
            raise ValueError("only identity normalisation with a dummy prefix is supported")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.library = spm.SentencePieceProcessor(model_proto=proto)
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.cost = {p.piece: -p.score for p in model.pieces
                     if p.type == kinds.NORMAL and len(p.piece) > 1}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces)
                      if p.type == kinds.BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
        digits = [f"{i},".encode() for i in range(len(model.pieces))]
        self.digits = np.frombuffer(b"".join(digits), np.uint8)
        self.digit_length = np.array([len(d) for d in digits])
        self.digit_start = np.cumsum(self.digit_length) - self.digit_length
        inside = set(chain.from_iterable(self.cost))
        # where no piece can cross: before a space mark that follows something else,
        # and around a line feed if no longer piece holds one
        self.line_feed_alone = "\n" not in inside
        self.cuts_at_space = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.cost)
        if not self.cuts_at_space:
            self.part = re.compile(r"(?s).+")
        elif self.line_feed_alone:
            self.part = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
        else:
            self.part = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def merge(self, part: str) -> list[str]:
        """Pieces of one part, by the agenda."""
        symbol = list(part)
        n = len(symbol)
        cost = self.cost.get
        pairs = list(map(str.__add__, symbol, symbol[1:]))
        agenda = [(c, i, i + 1, pairs[i]) for i, c in enumerate(map(cost, pairs)) if c is not None]
        if not agenda:
            return symbol
        heapq.heapify(agenda)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        pop, push = heapq.heappop, heapq.heappush
        while agenda:
            _, i, j, pair = pop(agenda)
            left, right = symbol[i], symbol[j]
            if not left or not right or len(left) + len(right) != len(pair):
                continue            # one of the two was merged meanwhile
            symbol[i], symbol[j] = pair, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                joined = pair + symbol[k]
                c = cost(joined)
                if c is not None:
                    push(agenda, (c, i, k, joined))
            h = before[i]
            if h >= 0:
                joined = symbol[h] + pair
                c = cost(joined)
                if c is not None:
                    push(agenda, (c, h, i, joined))
        return list(filter(None, symbol))

    def part_ids(self, part: str) -> tuple[int, ...]:
        pieces = self.merge(part)
        out = list(map(self.ids.get, pieces))
        if None not in out:
            return tuple(out)
        out = []
        for piece in pieces:
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out.extend(self.bytes[b] for b in piece.encode())
            else:
                out.append(self.unknown)
        return tuple(out)

    def parts(self, text: str) -> list[str]:
        return self.part.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, without the table of known parts."""
        return list(chain.from_iterable(map(self.part_ids, self.parts(text))))

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)

    def compare(self, fresh: dict[str, tuple[int, ...]]) -> None:
        """Check newly encoded parts against the library; raises on a difference."""
        probes, wanted = [], []
        for part, ids in fresh.items():
            if part[0] == SPACE:
                if part.strip(SPACE):       # the library drops a text of nothing but the prefix
                    probes.append(part[1:])
                    wanted.append(ids)
            elif self.line_feed_alone and part != "\n":
                probes.append("\n" + part)
                wanted.append(self.part_ids(SPACE) + self.part_ids("\n") + ids)
        for probe, ids, got in zip(probes, wanted, self.library.encode(probes, num_threads=1)):
            if tuple(got) != ids:
                raise ValueError(f"agenda and library differ on {probe!r}: {ids} and {tuple(got)}")


class _Parts:
    """Known parts by hash, with their bytes and ids; when full, the parts unused longest go.

    ``key`` is sorted and ``slot`` names where a part's facts are; facts, ids and
    bytes are only appended, in arrays that grow by a quarter.
    """

    _FACTS = {"start": np.int64, "length": np.int32, "from_": np.int64, "size": np.int32, "used": np.int32}

    def __init__(self):
        self.key, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        for name, kind in self._FACTS.items():
            setattr(self, name, np.zeros(0, kind))
        self.ids, self.bytes = np.zeros(0, np.int32), np.zeros(0, np.uint8)
        self.n_ids = self.n_bytes = self.clock = 0

    def find(self, key: np.ndarray) -> np.ndarray:
        """Slot of every hash, -1 where it is not in the table."""
        if not len(self.key):
            return np.full(len(key), -1)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.slot[at], -1)

    def add(self, key: np.ndarray, parts: list[bytes], ids: list[tuple[int, ...]]) -> None:
        """New parts, their hashes ascending."""
        if len(self.key) and (len(self.key) + len(key) > TABLE_PARTS or self.n_bytes > TABLE_BYTES):
            used = self.used[self.slot]
            half = np.partition(used, len(used) // 2)[len(used) // 2]
            self._rebuild((used > half) | (used == self.clock))
        length, size = (np.fromiter(map(len, x), np.int64, len(x)) for x in (ids, parts))
        n = len(self.key)
        for name, new in (("start", self.n_ids + np.cumsum(length) - length), ("length", length), ("size", size),
                          ("from_", self.n_bytes + np.cumsum(size) - size), ("used", np.full(len(key), self.clock))):
            setattr(self, name, _appended(getattr(self, name), n, new))
        self.ids = _appended(self.ids, self.n_ids, np.fromiter(chain.from_iterable(ids), np.int32))
        self.bytes = _appended(self.bytes, self.n_bytes, np.frombuffer(b"".join(parts), np.uint8))
        self.n_ids, self.n_bytes = self.n_ids + int(length.sum()), self.n_bytes + int(size.sum())
        at = np.searchsorted(self.key, key)
        self.key = np.insert(self.key, at, key)
        self.slot = np.insert(self.slot, at, np.arange(n, n + len(key), dtype=np.int32))

    def _rebuild(self, keep: np.ndarray) -> None:
        slot = self.slot[keep]
        self.key, self.slot = self.key[keep], np.arange(len(slot), dtype=np.int32)
        for name in self._FACTS:
            setattr(self, name, getattr(self, name)[slot])
        self.ids = self.ids[ranges(self.start, self.length.astype(np.int64))]
        self.bytes = self.bytes[ranges(self.from_, self.size.astype(np.int64))]
        self.n_ids, self.n_bytes = len(self.ids), len(self.bytes)
        self.start = np.cumsum(self.length, dtype=np.int64) - self.length
        self.from_ = np.cumsum(self.size, dtype=np.int64) - self.size


def _appended(old: np.ndarray, n: int, new: np.ndarray) -> np.ndarray:
    """``new`` behind the first ``n`` values of ``old``, which has room or is made larger."""
    if n + len(new) > len(old):
        grown = np.empty(n + len(new) + n // 4, old.dtype)
        grown[:n] = old[:n]
        old = grown
    old[n:n + len(new)] = new
    return old


def _same_bytes(a: np.ndarray, a_start: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_start: np.ndarray,
                b_size: np.ndarray) -> bool:
    """Whether spans of ``a`` and ``b`` are equal, one by one."""
    return bool((a_size == b_size).all()) and np.array_equal(a[ranges(a_start, a_size)], b[ranges(b_start, b_size)])


_MODELS: dict[bytes, tuple[MergeModel, _Parts]] = {}


def _model(proto: bytes) -> tuple[MergeModel, _Parts]:
    key = hashlib.sha256(proto).digest()
    if key not in _MODELS:
        _MODELS[key] = MergeModel(proto), _Parts()
    return _MODELS[key]


def _marked(texts: pa.Array) -> pa.Array:
    """Texts with the dummy prefix, space marks as spaces; empty texts stay empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pc.replace_substring(texts, SPACE, " ")
    none, mark = (pa.scalar(x, pa.large_string()) for x in ("", " "))
    return pc.if_else(pc.equal(texts, none), none, pc.binary_join_element_wise(none, texts, mark))


def _part_starts(model: MergeModel, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where parts begin; every non-empty text begins one. (MergeModel.parts, on bytes.)"""
    begin = np.zeros(len(data), bool)
    if model.cuts_at_space:
        space = data == 32
        begin[1:] = space[1:] & ~space[:-1]
    if model.cuts_at_space and model.line_feed_alone:
        feed = data == 10
        begin |= feed
        begin[1:] |= feed[:-1]
    begin[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    return np.flatnonzero(begin)


def encode_column(texts: pa.Array, model: MergeModel, table: _Parts):
    """Yields (ids, offsets) for runs of texts: flat int32 ids and each text's offsets.

    Parts are looked up by hash and compared byte by byte; a run in which two
    parts share a hash is encoded text by text.
    """
    for _, _, data, offsets in text_chunks(_marked(texts), RUN_BYTES):
        start = _part_starts(model, data, offsets)
        size = np.append(start[1:], len(data)) - start
        key, first, which = np.unique(span_hashes(data, start, start + size, 1)[0], return_index=True,
                                      return_inverse=True)
        one = first[which]
        table.clock += 1
        row = table.find(key)
        hit, new = np.flatnonzero(row >= 0), np.flatnonzero(row < 0)
        stored = row[hit]
        if not (_same_bytes(data, start, size, data, start[one], size[one])
                and _same_bytes(data, start[first[hit]], size[first[hit]], table.bytes, table.from_[stored],
                                table.size[stored])):
            yield _one_by_one(data, offsets, model)
            continue
        table.used[stored] = table.clock
        if len(new):
            raw = data.tobytes()
            parts = [raw[start[i]:start[i] + size[i]] for i in first[new]]
            fresh = {}
            for part in parts:
                part = part.decode().replace(" ", SPACE)
                fresh[part] = model.part_ids(part)
            model.compare(fresh)
            table.add(key[new], parts, list(fresh.values()))
            row = table.find(key)
        row = row[which]
        length = table.length[row]
        ids = table.ids[ranges(table.start[row], length)]
        before = np.concatenate([[0], np.cumsum(length)])
        yield ids, before[np.searchsorted(start, offsets)]


def _one_by_one(data: np.ndarray, offsets: np.ndarray, model: MergeModel):
    raw = data.tobytes()
    lists = [list(chain.from_iterable(map(model.part_ids, model.part.findall(raw[a:b].decode().replace(" ", SPACE)))))
             for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    flat = np.fromiter(chain.from_iterable(lists), np.int32)
    return flat, np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)


def _schema(df: DataFrame, keep: list[str], outputs: list[str]) -> T.StructType:
    kinds = {"ids": T.ArrayType(T.IntegerType()), "n_tokens": T.LongType(),
             "ids_sha256": T.StringType(), "decoded": T.StringType(), "decoded_sha256": T.StringType()}
    return T.StructType([*[df.schema[c] for c in keep],
                         *[T.StructField(o, kinds[o]) for o in outputs]])


def encode_texts(df: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None,
                 outputs: tuple[str, ...] = ("ids", "n_tokens")) -> DataFrame:
    """Encode (and decode back) one text column.

    ``keep``: columns passed through (default: all but the text). ``outputs``:
    any of ``ids``, ``n_tokens``, ``ids_sha256``, ``decoded``,
    ``decoded_sha256``; an output replaces a kept column of the same name.
    The model file (under 1 MB) is read once on the driver and broadcast.
    """
    outputs = list(outputs)
    keep = [c for c in (keep if keep is not None else [c for c in df.columns if c != text])
            if c not in outputs]
    with open(model_path, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())
    schema = _schema(df, keep, outputs)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = _model(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                made: dict[str, list] = {o: [] for o in outputs}
                for ids, offsets in encode_column(batch.column(len(keep)), model, known):
                    _outputs(model, ids, offsets, made)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i) for i in range(len(keep))], *[_array(o, made[o]) for o in outputs]],
                    names=[*keep, *outputs])

    return df.select(*[df[c] for c in keep], df[text].alias("__text")).mapInArrow(run, schema)


def _outputs(model: MergeModel, ids: np.ndarray, offsets: np.ndarray, made: dict[str, list]) -> None:
    bounds = list(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
    if "ids" in made:
        made["ids"] += [ids[a:b] for a, b in bounds]
    if "n_tokens" in made:
        made["n_tokens"] += [b - a for a, b in bounds]
    if "ids_sha256" in made:
        length = model.digit_length[ids]
        digits = model.digits[ranges(model.digit_start[ids], length)]
        cut = np.concatenate([[0], np.cumsum(length)])[offsets]
        made["ids_sha256"] += [hashlib.sha256(digits[a:max(a, b - 1)]).hexdigest()
                               for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
    if "decoded" in made or "decoded_sha256" in made:
        texts = [model.decode(ids[a:b].tolist()) if b > a else "" for a, b in bounds]
        if "decoded" in made:
            made["decoded"] += texts
        if "decoded_sha256" in made:
            made["decoded_sha256"] += [hashlib.sha256(t.encode()).hexdigest() for t in texts]


def _array(output: str, values: list) -> pa.Array:
    if output == "ids":
        offsets = np.zeros(len(values) + 1, np.int32)
        np.cumsum([len(v) for v in values], out=offsets[1:])
        flat = np.concatenate(values) if values else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
    return pa.array(values, pa.int64() if output == "n_tokens" else pa.string())


def decode_ids(df: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of an id column (null ids: empty text)."""
    with open(model_path, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())
    keep = [c for c in df.columns if c != out]
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(out, T.StringType())])

    def run(batches):
        model, _ = _model(shared.value)
        for batch in batches:
            texts = [model.decode(x) if x else "" for x in batch.column(keep.index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*keep, out])

    return df.select(*[df[c] for c in keep]).mapInArrow(run, schema)
