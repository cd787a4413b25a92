"""Merge-type SentencePiece encoding by a prefix table, and decoding.

Every prefix of a text has one encoding, so it has one last token. A token that ends a prefix is that
last token exactly when it is compatible with the last token of what stands before it: the merges
leave the two apart. An automaton gives all pieces that end at each character; the first compatible
one goes into the table, and the ids are read from the table backwards. No choice is ever taken back,
so the work is linear in the text for pieces of bounded length.

Merges run by score, best first, and from left to right among equal scores.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from arealoom.llm.words import release, slices

#: The sign that stands for a space, and the kinds of pieces of a model file.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
#: Bytes of text that a worker encodes at a time, and what its two memos may hold.
SLICE_BYTES = 1 << 20
MEMO_BYTES = 96 << 20
PAIR_ENTRIES = 400_000
_ENTRY_BYTES = 200
_NONE = -1


class Model(NamedTuple):
    """Pieces by id, the kind of each, and whether a space is put before a text; characters that stand
    only inside pieces, numbered on from the pieces; of every token the place of its score among the
    scores (best first, 0 for a character) and the two tokens that its last merge joins: itself twice
    for a character, none for a piece that merges never make."""

    pieces: list[str]
    kinds: list[int]
    dummy_prefix: bool
    inner: list[str]
    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Number and value of each field of a serialised message; fixed-width values as bytes."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value, at, shift = value | (byte & 127) << shift, at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def load_model(path: str) -> Model:
    """Read a model file. Raises for models that are not of merge type with bytes as fallback, or that
    change texts before encoding by more than the spaces."""
    pieces, scores, kinds = [], [], []
    trainer, normaliser = {}, {}
    with open(path, "rb") as file:
        for number, value in _fields(file.read()):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
    # Field numbers of the format, with the value where a field is absent.
    if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0):
        raise ValueError("only merge-type models with bytes as fallback are encoded")
    if normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(5, 1):
        raise ValueError("only models that leave the text as it is are encoded")
    if USER_DEFINED in kinds or UNUSED in kinds or kinds.count(BYTE) != 256:
        raise ValueError("user-defined and unused pieces are not encoded")
    return Model(pieces, kinds, bool(normaliser.get(3, 1)), *_merges(pieces, scores, kinds))


def _merges(pieces: list[str], scores: list[float], kinds: list[int]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    normal = {p: i for i, (p, kind) in enumerate(zip(pieces, kinds, strict=True)) if kind == NORMAL}
    inner = sorted({c for p in normal for c in p if len(p) > 1} - normal.keys())
    tokens = normal | {c: len(pieces) + k for k, c in enumerate(inner)}
    order = {s: r for r, s in enumerate(sorted({scores[i] for i in normal.values()}, reverse=True), 1)}
    rank, left, right = (np.full(len(pieces) + len(inner), fill) for fill in (0, _NONE, _NONE))
    ranks = {p: order[scores[i]] for p, i in normal.items() if len(p) > 1}
    for piece, token in tokens.items():
        if len(piece) == 1:
            left[token] = right[token] = token
            continue
        rank[token] = ranks[piece]
        parts = list(piece)
        while len(parts) > 2:
            joins = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
            if not joins:
                break
            i = min(joins)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) == 2:
            # What merges early may not need what merges late: else time is not told by the score.
            if max(ranks.get(p, 0) for p in parts) > ranks[piece]:
                raise ValueError(f"piece {piece!r} has a better score than its parts")
            left[token], right[token] = (tokens[p] for p in parts)
    return inner, rank, left, right


class _ChunkMemo(dict):
    """Chunk of text -> its ids as little-endian bytes; emptied when its bytes reach the bound."""

    def __init__(self, encode_chunk, limit: int):
        super().__init__()
        self.encode_chunk, self.limit, self.held = encode_chunk, limit, 0

    def __missing__(self, chunk: str) -> bytes:
        ids = array("I", self.encode_chunk(chunk)).tobytes()
        if len(chunk) <= 64:
            self.held += _ENTRY_BYTES + 2 * len(chunk) + len(ids)
            if self.held > self.limit:
                self.clear()
                self.held = 0
            self[chunk] = ids
        return ids


class Codec:
    """Encoder and decoder of one model, built once in each task."""

    def __init__(self, model: Model, memo_bytes: int = MEMO_BYTES):
        self.size = len(model.pieces)
        self.dummy_prefix = model.dummy_prefix
        normal = {p: i for i, (p, kind) in enumerate(zip(model.pieces, model.kinds, strict=True)) if kind == NORMAL}
        byte_ids = [i for i, kind in enumerate(model.kinds) if kind == BYTE]
        self.byte_id = {int(model.pieces[i][3:5], 16): i for i in byte_ids}
        # Characters that only stand inside pieces are tokens too while merges run; they end as bytes.
        tokens = normal | {c: self.size + k for k, c in enumerate(model.inner)}
        self.rest = [b""] * self.size + [c.encode() for c in model.inner]
        self.rank, self.left, self.right = model.rank.tolist(), model.left.tolist(), model.right.tolist()
        self.length = [0] * len(self.rank)
        self.pairs: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for piece, token in tokens.items():
            self.length[token] = len(piece)
            if self.left[token] != _NONE:
                self.automaton.add_word(piece, token)
                if len(piece) > 1:
                    self.pairs[self.left[token] << 32 | self.right[token]] = self.rank[token]
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}
        self.chunks = self._cutter(normal)
        self.memo = _ChunkMemo(self.encode_chunk, memo_bytes)
        self._surfaces(model)

    def _cutter(self, normal: dict[str, int]):
        """Cuts a text where no piece reaches across: before runs of spaces, around line ends, and
        between a word and the mark after it."""
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in normal):
            return re.compile(r"(?s).+").findall
        alone = "".join(c for c in "\n\r\t" if not any(c in p for p in normal))
        marks = ".,;:!?"
        joined = {p[i - 1] for p in normal for i in range(1, len(p)) if p[i] in marks} - {SPACE, *marks}
        inside, mark = f"[^{SPACE}{alone}]", re.escape(marks)
        tail = f"(?:(?<=[{re.escape(''.join(sorted(joined)))}])[{mark}]{inside}*)?" if joined else ""
        cut = f"[{alone}]+|" if alone else ""
        return re.compile(f"{cut}{SPACE}*(?:[^{SPACE}{alone}{mark}]+{tail}|[{mark}]{inside}*)|{SPACE}+").findall

    def _surfaces(self, model: Model) -> None:
        """What each id gives in a decoded text."""
        self.surface = []
        for i, (piece, kind) in enumerate(zip(model.pieces, model.kinds, strict=True)):
            if kind == BYTE:
                self.surface.append(bytes([int(model.pieces[i][3:5], 16)]))
            elif kind == UNKNOWN:
                self.surface.append(" ⁇ ".encode())  # fixed value: how the unknown id reads
            else:
                self.surface.append(b"" if kind == CONTROL else piece.replace(SPACE, " ").encode())
        self.is_byte = [kind == BYTE for kind in model.kinds]
        self.spaced = [kind == NORMAL and p.startswith(SPACE) for p, kind in zip(model.pieces, model.kinds, strict=True)]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave ``a`` and ``b`` apart where they stand side by side."""
        if len(self.fits) >= PAIR_ENTRIES:
            self.fits.clear()
        known = self.fits[a << 32 | b] = self._stay_apart(a, b)
        return known

    def _stay_apart(self, a: int, b: int) -> bool:
        # Take back the merges of both, the last first, and look for one across that came earlier.
        before = len(self.rank) + 1
        while True:
            across = self.pairs.get(a << 32 | b)
            if across is not None and across < before:
                return False
            if self.left[a] == a and self.left[b] == b:
                return True
            if self.left[b] == b or (self.left[a] != a and self.rank[a] > self.rank[b]):
                before, a = self.rank[a], self.right[a]
            else:
                before, b = self.rank[b] + 1, self.left[b]

    def encode_chunk(self, chunk: str) -> list[int]:
        last = [_NONE] * (len(chunk) + 1)
        length, fits, compatible = self.length, self.fits.get, self.compatible
        settled = -1
        for end, token in self.automaton.iter(chunk):
            if end == settled:
                continue
            before = last[end + 1 - length[token]]
            if before >= 0:
                fit = fits(before << 32 | token)
                if not (compatible(before, token) if fit is None else fit):
                    continue
            # nothing stands before it, or a character of no piece, which no merge reaches across
            last[end + 1] = token
            settled = end
        out: list[int] = []
        at = len(chunk)
        while at:
            token = last[at]
            if 0 <= token < self.size:
                out.append(token)
                at -= length[token]
            else:
                raw = self.rest[token] if token >= 0 else chunk[at - 1].encode()
                out.extend(self.byte_id[x] for x in reversed(raw))
                at -= 1
        out.reverse()
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        spaced = (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)
        return b"".join(map(self.memo.__getitem__, self.chunks(spaced)))

    def decode(self, ids: list[int]) -> str:
        """The text of ids. Bytes that are no character become U+FFFD one by one."""
        if self.dummy_prefix:
            skip = 0
            while skip < len(ids) and not self.is_byte[ids[skip]] and not self.surface[ids[skip]]:
                skip += 1
            if skip < len(ids) and self.spaced[ids[skip]]:
                return self._joined(ids, skip, 1)
        return self._joined(ids, 0, 0)

    def _joined(self, ids: list[int], start: int, drop: int) -> str:
        whole = b"".join(map(self.surface.__getitem__, ids[start:]))[drop:]
        try:
            return whole.decode()
        except UnicodeDecodeError:
            pass
        out, run = [], bytearray()
        for i in ids[start:]:
            if self.is_byte[i]:
                run += self.surface[i]
                continue
            out.append(_characters(run))
            run.clear()
            out.append(self.surface[i].decode())
        return ("".join(out) + _characters(run))[drop:]


def _characters(data: bytearray) -> str:
    out, at = [], 0
    while at < len(data):
        size = 1 + (data[at] >= 0xC0) + (data[at] >= 0xE0) + (data[at] >= 0xF0)
        try:
            out.append(bytes(data[at : at + size]).decode())
            at += size
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


_CODECS: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    """The worker's codec, kept from task to task with its memos of bounded bytes."""
    key = hash((len(shared.value.pieces), *shared.value.pieces[-64:], shared.value.rank.tobytes(), shared.value.left.tobytes()))
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(shared.value)
    return _CODECS[key]


def _lists(parts: list[bytes]) -> pa.Array:
    bounds = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in parts], out=bounds[1:])
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def _with_columns(df: DataFrame, model: Model, column: str, made: list[T.StructField], work) -> DataFrame:
    names = [f.name for f in made]
    kept = [f for f in df.schema.fields if f.name not in names]
    keep, at = [df.columns.index(f.name) for f in kept], df.columns.index(column)
    schema = T.StructType([*kept, *made])
    shared = df.sparkSession.sparkContext.broadcast(model)  # of the size of the model file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            values = batch.column(at)
            ends = _ends(values)
            for low, high in zip([0, *ends[:-1]], ends, strict=True):
                part = batch.slice(low, high - low)
                new = work(codec, values.slice(low, high - low))
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in keep], *new], schema.names)
        release()

    return df.mapInArrow(run, schema)


def _ends(values: pa.Array) -> list[int]:
    """The ends of runs of rows of bounded bytes; a list counts by its entries."""
    if not pa.types.is_list(values.type):
        return [high for _, high, _, _ in slices(values, SLICE_BYTES)]
    sizes = np.cumsum([len(x) if x.is_valid else 0 for x in values])
    cut = np.flatnonzero(np.diff(sizes // (SLICE_BYTES // 4))) + 1 if len(sizes) else []
    return [*map(int, cut), len(values)] if len(values) else []


_IDS = T.ArrayType(T.IntegerType())


def encode(df: DataFrame, model: Model, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of every whole text as a list, without ids for begin and end.

    Null and empty texts have an empty list. Other columns pass unchanged; one named like the new
    column is replaced. Rows are handled one by one, so repeated rows, ties and null keys need no rule,
    and an empty table gives an empty table. Texts may be as long as an Arrow batch holds.
    """
    return _with_columns(
        df, model, text, [T.StructField(ids, _IDS)], lambda codec, values: [_lists([codec.encode(x or "") for x in values.to_pylist()])]
    )


def decode(df: DataFrame, model: Model, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the text that lists of ids stand for; a null list gives an empty text, null ids in a list are
    left out."""

    def work(codec: Codec, values: pa.Array) -> list[pa.Array]:
        return [pa.array([codec.decode([i for i in x or [] if i is not None]) for x in values.to_pylist()], pa.string())]

    return _with_columns(df, model, ids, [T.StructField(decoded, T.StringType())], work)


def round_trip(df: DataFrame, model: Model, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass over the rows."""

    def work(codec: Codec, values: pa.Array) -> list[pa.Array]:
        parts = [codec.encode(x or "") for x in values.to_pylist()]
        texts = [codec.decode(np.frombuffer(p, "<u4").tolist()) for p in parts]
        return [_lists(parts), pa.array(texts, pa.string())]

    return _with_columns(df, model, text, [T.StructField(ids, _IDS), T.StructField(decoded, T.StringType())], work)
