"""Byte-level BPE by backtracking from longest matches.

A token sequence is what the merges give exactly when every two neighbours are compatible: taken
apart merge by merge, no earlier merge joins them across their border. So the encoder walks from
longest match to longest match, takes shorter prefixes where a neighbour does not fit, and goes
back where none does; positions from which no rest can be encoded are remembered, so the work is
linear in the text. Vocabulary strings are bytes seen as Latin-1 characters.
"""

from __future__ import annotations

import base64
import weakref
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from arealoom.llm.words import release, slices

#: Bytes of the memo of pieces, and entries of the memo of compatible pairs, in each worker.
MEMO_BYTES = 96 << 20
PAIR_ENTRIES = 400_000
_ENTRY_BYTES = 200
#: Bytes of text that a worker encodes at a time.
SLICE_BYTES = 1 << 20


class Vocabulary(NamedTuple):
    """Tokens by rank, and for each the two tokens that its last merge joins (itself twice for a
    single byte; -1 where no merges give it, so that it only stands for a whole piece)."""

    tokens: list[bytes]
    left: np.ndarray
    right: np.ndarray


def load_vocabulary(path: str) -> Vocabulary:
    """Read a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as file:
        return vocabulary({base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())})


def vocabulary(ranks: dict[bytes, int]) -> Vocabulary:
    """Find the last merge of every token by running the merges of lower rank on it."""
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be 0 to n - 1")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every single byte must be a token")
    tokens = sorted(ranks, key=ranks.__getitem__)
    left, right = np.full(len(tokens), -1), np.full(len(tokens), -1)
    for rank, token in enumerate(tokens):
        if len(token) == 1:
            left[rank] = right[rank] = rank
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            joined = [ranks.get(a + b, rank) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(joined)
            if best >= rank:
                break
            i = joined.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) == 2:
            left[rank], right[rank] = ranks[parts[0]], ranks[parts[1]]
    return Vocabulary(tokens, left, right)


class _PieceMemo(dict):
    """Piece of text -> its ids as little-endian bytes; emptied when its bytes reach the bound."""

    def __init__(self, codec: Codec, limit: int):
        super().__init__()
        self.codec = weakref.proxy(codec)  # else the pair would wait for the cycle collector
        self.limit, self.held = limit, 0

    def __missing__(self, piece: str) -> bytes:
        codec = self.codec
        ids = b"".join([codec.packed[token] for token in codec.encode_piece(piece.encode())])
        if len(piece) <= 64:
            self.held += _ENTRY_BYTES + 2 * len(piece) + len(ids)
            if self.held > self.limit:
                self.clear()
                self.held = 0
            self[piece] = ids
        return ids


class Codec:
    """Encoder and decoder of one vocabulary, built once in each task."""

    def __init__(self, vocab: Vocabulary, pattern: str, memo_bytes: int = MEMO_BYTES):
        self.tokens, self.pattern = vocab.tokens, regex.compile(pattern)
        self.ranks = {token: rank for rank, token in enumerate(vocab.tokens)}
        self.left, self.right = vocab.left.tolist(), vocab.right.tolist()
        self.lengths = [len(t) for t in vocab.tokens]
        self.packed = [rank.to_bytes(4, "little") for rank in range(len(vocab.tokens))]
        merged = [rank for rank, part in enumerate(self.left) if part >= 0]
        self.pairs = {(self.left[r], self.right[r]): r for r in merged if self.lengths[r] > 1}
        reachable = {self.tokens[r] for r in merged}
        self.shorter = [
            next((self.ranks[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in reachable), -1) for t in self.tokens
        ]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for rank in merged:
            self.automaton.add_word(self.tokens[rank].decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}
        self.pair_entries = max(min(PAIR_ENTRIES, memo_bytes // _ENTRY_BYTES), 1)
        self.memo = _PieceMemo(self, memo_bytes)

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave ``a`` and ``b`` apart where they stand side by side."""
        if len(self.fits) >= self.pair_entries:
            self.fits.clear()
        known = self.fits[a << 32 | b] = self._stay_apart(a, b)
        return known

    def _stay_apart(self, a: int, b: int) -> bool:
        # Undo the later of the two last merges again and again. A merge across the border
        # happens if it comes before the merge that was undone last.
        undone = len(self.tokens)
        while True:
            across = self.pairs.get((a, b))
            if across is not None and across < undone:
                return False
            whole_a, whole_b = self.lengths[a] == 1, self.lengths[b] == 1
            if whole_a and whole_b:
                return True
            if whole_b or (not whole_a and a > b):
                undone, a = a, self.right[a]
            else:
                # equal ranks: of two merges of one rank, the left one runs first
                undone, b = b + 1, self.left[b]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, lengths, shorter = len(piece), self.lengths, self.shorter
        fits, compatible = self.fits.get, self.compatible
        longest = [0] * (n + 1)
        for end, rank in self.automaton.iter(piece.decode("latin-1")):
            # matches come in the order of their ends, so the last one of a start is its longest
            longest[end + 1 - lengths[rank]] = rank
        alive = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < n:
            while token >= 0:
                if alive[at + lengths[token]]:
                    if last < 0:
                        break
                    fit = fits(last << 32 | token)
                    if compatible(last, token) if fit is None else fit:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += lengths[token]
                last, token = token, longest[at]
            else:
                if not out:
                    raise ValueError("no encoding")
                alive[at] = 0
                token = out.pop()
                at -= lengths[token]
                last = out[-1] if out else -1
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, self.pattern.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[tuple, Codec] = {}


def _codec(shared, pattern: str, memo_bytes: int = MEMO_BYTES) -> Codec:
    key = (shared.value[0], pattern, memo_bytes)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(shared.value[1], pattern, memo_bytes)
    return _CODECS[key]


def _forget() -> None:
    """A worker lives on between tasks: it keeps neither codec nor memos. Building takes a third of a second."""
    _CODECS.clear()
    release()


def _share(df: DataFrame, vocab: Vocabulary):
    """The vocabulary as a broadcast: its size does not depend on the data."""
    return df.sparkSession.sparkContext.broadcast((hash((len(vocab.tokens), vocab.tokens[-1])), vocab))


def _with_columns(df: DataFrame, column: str, added: list[T.StructField], work, drop: bool = False) -> DataFrame:
    """Add columns made by ``work`` from ``column``, slice by slice; columns of these names are replaced,
    and with ``drop`` the column itself is left out."""
    names = [f.name for f in added] + [column] * drop
    keep = [i for i, f in enumerate(df.schema.fields) if f.name not in names]
    schema = T.StructType([*[df.schema.fields[i] for i in keep], *added])
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(at)
            for low, high, _, _ in slices(values, SLICE_BYTES):
                part = batch.slice(low, high - low)
                made = work(values.slice(low, high - low))
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in keep], *made], schema.names)
        _forget()

    return df.mapInArrow(run, schema)


def _binary(name: str) -> T.StructField:
    return T.StructField(name, T.BinaryType())


def encode(df: DataFrame, vocab: Vocabulary, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of every whole text as packed little-endian unsigned 32-bit integers.

    Null and empty texts have no ids (an empty binary). Other columns pass unchanged; one named like
    the new column is replaced. Rows are handled one by one, so repeated rows, ties and null keys need
    no rule, and an empty table gives an empty table.
    """
    shared = _share(df, vocab)

    def work(values: pa.Array) -> list[pa.Array]:
        codec = _codec(shared, pattern)
        return [pa.array([codec.encode(x) if x else b"" for x in values.to_pylist()], pa.binary())]

    return _with_columns(df, text, [_binary(ids)], work)


def decode(df: DataFrame, vocab: Vocabulary, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the bytes that packed ids stand for; null ids give no bytes (an empty binary)."""
    shared = _share(df, vocab)

    def work(values: pa.Array) -> list[pa.Array]:
        tokens = shared.value[1].tokens
        return [
            pa.array([b"".join(map(tokens.__getitem__, np.frombuffer(x or b"", "<u4").tolist())) for x in values.to_pylist()], pa.binary())
        ]

    return _with_columns(df, ids, [_binary(decoded)], work)


def round_trip(df: DataFrame, vocab: Vocabulary, pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass over the rows."""
    shared = _share(df, vocab)

    def work(values: pa.Array) -> list[pa.Array]:
        codec = _codec(shared, pattern)
        made = [codec.encode(x) if x else b"" for x in values.to_pylist()]
        return [pa.array(made, pa.binary()), pa.array(map(codec.decode, made), pa.binary())]

    return _with_columns(df, text, [_binary(ids), _binary(decoded)], work)


def checked(
    df: DataFrame, vocab: Vocabulary, pattern: str, text: str = "text", ids: str = "ids", intact: str = "intact", memo_bytes: int = MEMO_BYTES
) -> DataFrame:
    """``encode``, with ``intact`` telling whether the ids decode to the text again (true for null and
    empty texts). The text itself is left out: neither it nor what was decoded leaves the worker."""
    shared = _share(df, vocab)

    def work(values: pa.Array) -> list[pa.Array]:
        codec = _codec(shared, pattern, memo_bytes)
        made, same = [], []
        for x in values:
            whole = x.as_py() or ""
            made.append(codec.encode(whole) if whole else b"")
            same.append(codec.decode(made[-1]) == whole.encode())
        return [pa.array(made, pa.binary()), pa.array(same, pa.bool_())]

    return _with_columns(df, text, [_binary(ids), T.StructField(intact, T.BooleanType())], work, drop=True)
