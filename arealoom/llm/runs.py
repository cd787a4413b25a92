"""Periodic runs of words, found through a grammar.

A run is a stretch of consecutive words that keeps a smallest period at least three times over and
that no neighbour extends. Re-Pair writes the words as a grammar: pairs of symbols that repeat become
nonterminals, round by round. A run has a lowest nonterminal whose expansion holds it, and crosses the
border between that one's two parts; so runs are looked for once at the border of every nonterminal,
in its first expansion, and carried to all places where it is derived. Where an expansion cuts a run
off, the whole one is found higher up; of intervals of one period those within another go.

Comparisons go by names of blocks of 1, 2, 4, ... words (equal names, equal words), so nothing rests on
hashes. Words with no repeated block of eight words around them cannot be in a run and are left out
before: every eight words of a run stand in it a second time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from arealoom.llm.words import WHITE_SPACE, Words, find_words, gather, mix, release, slices, strings, window_hashes

#: Bytes of text that a worker looks at together; a longer text is looked at alone, and whole.
SLICE_BYTES = 1 << 20
#: A run holds its period this often, and so many words.
REPEATS, LEAST_WORDS = 3, 24
#: Every block of so many words of a run repeats in it; at each border of a run so many repeat at its period.
_BLOCK, _GRAM = 8, 4
_CANDIDATES = 1 << 20
_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_ADDED = [
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(_RUN)),
    T.StructField("strongest", _RUN),
    T.StructField("collapsed", T.StringType()),
]


class _Names:
    """Names of all blocks of 2**k words, for comparing stretches of any length."""

    def __init__(self, w: np.ndarray, longest: int):
        self.n, self.levels = len(w), [w]
        while len(self.levels) < 3 or 2 << len(self.levels) - 1 <= longest:
            size = 1 << len(self.levels) - 1
            top = self.levels[-1].astype(np.int64)
            keys = top[: self.n - 2 * size + 1] * (top.max(initial=0) + 1) + top[size : self.n - size + 1]
            values, names = np.unique(keys, return_inverse=True)
            # the blocks that the end cuts off are like no other
            tail = np.arange(len(values), len(values) + self.n - len(names))
            self.levels.append(np.concatenate([names, tail]).astype(np.int32))
            if len(values) == len(keys) and len(self.levels) > 2:
                break
        self.grams = self.levels[_GRAM.bit_length() - 1].astype(np.int64)
        self.key = np.sort(self.grams * (self.n + 1) + np.arange(self.n))

    def forward(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many words from ``i`` and ``j`` on are equal, up to ``limit``."""
        k = np.zeros(len(i), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            name, size = self.levels[level], 1 << level
            open_ = np.ones(len(i), bool)
            while True:
                # only the highest level can match twice
                open_ &= k + size <= limit
                at = np.flatnonzero(open_)
                at = at[name[i[at] + k[at]] == name[j[at] + k[at]]]
                k[at] += size
                if level < len(self.levels) - 1 or not len(at):
                    break
                open_[:] = False
                open_[at] = True
        return k

    def backward(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many words before ``i`` and ``j`` are equal, up to ``limit``."""
        k = np.zeros(len(i), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            name, size = self.levels[level], 1 << level
            open_ = np.ones(len(i), bool)
            while True:
                open_ &= k + size <= limit
                at = np.flatnonzero(open_)
                at = at[name[i[at] - k[at] - size] == name[j[at] - k[at] - size]]
                k[at] += size
                if level < len(self.levels) - 1 or not len(at):
                    break
                open_[:] = False
                open_[at] = True
        return k

    def same_gram(self, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """In portions: index into ``at``, and a place from ``low`` to ``high`` of the same gram."""
        base = self.grams[at] * (self.n + 1)
        first = np.searchsorted(self.key, base + low)
        count = np.maximum(np.searchsorted(self.key, base + np.maximum(high, low - 1), side="right") - first, 0)
        total = np.cumsum(count)
        begin = 0
        while begin < len(at):
            done = total[begin - 1] if begin else 0
            end = max(int(np.searchsorted(total, done + _CANDIDATES, side="right")), begin + 1)
            part = count[begin:end]
            who = np.repeat(np.arange(begin, end), part)
            step = np.arange(len(who)) - np.repeat(np.cumsum(part) - part, part)
            yield who, self.key[first[who] + step] % (self.n + 1)
            begin = end


def _crossing(names: _Names, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs that cross the border between the two parts of the expansions at ``at``: whose, start, end,
    period. Either the part after the border or the one before it holds half of the run, so that
    ``_GRAM`` words at the border repeat at its period."""
    middle, end = at + left, at + left + right
    found = []
    whole = np.flatnonzero(right > _GRAM)
    for index, other in names.same_gram(middle[whole], middle[whole] + 1, end[whole] - _GRAM):
        who = whole[index]
        start = middle[who] - names.backward(middle[who], other, left[who])
        stop = other + names.forward(middle[who], other, end[who] - other)
        found.append((who, start, stop, other - middle[who]))
    whole = np.flatnonzero(left > _GRAM)
    for index, other in names.same_gram(middle[whole] - _GRAM, at[whole], middle[whole] - _GRAM - 1):
        who = whole[index]
        back = other + _GRAM
        start = back - names.backward(back, middle[who], back - at[who])
        stop = middle[who] + names.forward(back, middle[who], right[who])
        found.append((who, start, stop, middle[who] - back))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    who, start, stop, period = (np.concatenate(x) for x in zip(*found, strict=True))
    keep = stop - start >= np.maximum(LEAST_WORDS, REPEATS * period)
    who, start, stop, period = who[keep], start[keep], stop[keep], period[keep]
    # multiples of the smallest period give the same stretch
    order = np.lexsort((period, stop, start, who))
    who, start, stop, period = who[order], start[order], stop[order], period[order]
    new = np.ones(len(who), bool)
    new[1:] = (who[1:] != who[:-1]) | (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    return who[new], start[new], stop[new], period[new]


def _grouped(group: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of (index into ``wanted``, index into ``group``) of equal values."""
    order = np.argsort(group, kind="stable")
    low, high = (np.searchsorted(group[order], wanted, side=s) for s in ("left", "right"))
    count = high - low
    left = np.repeat(np.arange(len(wanted)), count)
    return left, order[low[left] + np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)]


def grammar_runs(w: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs of the word ids ``w``; the stretches between ``bounds`` are
    apart (their last ids stand nowhere else)."""
    names = _Names(w.astype(np.int32), int(np.diff(bounds).max(initial=0)))
    symbols, at, size = w.astype(np.int64), np.arange(len(w)), np.ones(len(w), np.int64)
    fresh = int(w.max(initial=0)) + 1
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(symbols) > 1:
        pairs, which, count = np.unique(symbols[:-1] * fresh + symbols[1:], return_inverse=True, return_counts=True)
        if count.max() < 2:
            break
        # Of pairs that overlap, the one of the higher frequency class goes first, then by hash: so a
        # round replaces a good part of all repeated pairs.
        rank = np.floor(np.log2(count)).astype(np.uint64) << np.uint64(57) | mix(pairs.astype(np.uint64)) >> np.uint64(7)
        rank[count < 2] = 0
        mine = rank[which]
        chosen = mine > 0
        chosen[1:] &= mine[1:] >= mine[:-1]
        chosen[:-1] &= mine[:-1] >= mine[1:]
        i = np.flatnonzero(chosen)
        head = np.ones(len(i), bool)
        head[1:] = i[1:] != i[:-1] + 1
        i = i[(i - i[head][np.cumsum(head) - 1]) % 2 == 0]  # of equal neighbours every other one
        made, first, rule = np.unique(which[i], return_index=True, return_inverse=True)
        place = at[i]
        who, start, stop, period = _crossing(names, place[first], size[i[first]], size[i[first] + 1])
        run, derived = _grouped(rule, who)
        shift = place[derived] - place[first][who[run]]
        out.append((start[run] + shift, stop[run] + shift, period[run]))
        symbols[i], size[i] = fresh + rule, size[i] + size[i + 1]
        fresh += len(made)
        rest = np.ones(len(symbols), bool)
        rest[i + 1] = False
        symbols, at, size = symbols[rest], at[rest], size[rest]
    # What is left repeats nowhere: joined in halves, stretch by stretch.
    stretch = np.searchsorted(bounds, at, side="right")
    while len(at) > 1:
        head = np.ones(len(at), bool)
        head[1:] = stretch[1:] != stretch[:-1]
        odd = (np.arange(len(at)) - np.flatnonzero(head)[np.cumsum(head) - 1]) % 2
        i = np.flatnonzero((odd[:-1] == 0) & (odd[1:] == 1))
        if not len(i):
            break
        out.append(_crossing(names, at[i], size[i], size[i + 1])[1:])
        size[i] += size[i + 1]
        rest = np.ones(len(at), bool)
        rest[i + 1] = False
        at, size, stretch = at[rest], size[rest], stretch[rest]
    if not out:
        return (np.zeros(0, np.int64),) * 3
    start, stop, period = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((-stop, start, period))
    start, stop, period = start[order], stop[order], period[order]
    reach = stop + period * (len(w) + 1)  # periods apart, so that one running maximum serves all
    whole = np.ones(len(start), bool)
    whole[1:] = reach[1:] > np.maximum.accumulate(reach)[:-1]
    start, stop, period = start[whole], stop[whole], period[whole]
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


def _stretches(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """From and to of the stretches of words whose blocks of eight all repeat in their row."""
    inside = words.window_ok(_BLOCK)
    if not inside.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    window = np.flatnonzero(inside)
    keys = window_hashes(words.hashes, _BLOCK)[window] ^ mix(words.rows()[window].astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), bool)
    again[order[1:]] = same
    again[order[:-1]] |= same
    window = window[again]
    if not len(window):
        return window, window
    head = np.ones(len(window), bool)
    head[1:] = window[1:] != window[:-1] + 1  # the last windows of a row are never whole, so rows stay apart
    low = window[head]
    high = window[np.append(np.flatnonzero(head)[1:] - 1, len(window) - 1)] + _BLOCK
    long = high - low >= LEAST_WORDS
    return low[long], high[long]


def _ids(data: np.ndarray, words: Words, index: np.ndarray) -> np.ndarray:
    """Ids of the words at ``index``, equal exactly for equal words."""
    starts, ends = words.starts[index], words.ends[index]
    _, first, ids = np.unique(words.hashes[index], return_index=True, return_inverse=True)
    other = first[ids]
    equal = np.array_equal(ends - starts, (ends - starts)[other])
    if equal:
        equal = np.array_equal(gather(data, starts, ends - starts)[0], gather(data, starts[other], ends - starts)[0])
    if not equal:  # two words of one hash
        known: dict[bytes, int] = {}
        ids = np.array([known.setdefault(data[a:b].tobytes(), len(known)) for a, b in zip(starts, ends, strict=True)])
    return ids


def word_runs(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (numbers of words of the slice) and period of every run, in that order."""
    low, high = _stretches(words)
    none = np.zeros(0, np.int64)
    if not len(low):
        return none, none, none
    size = high - low
    from_ = np.cumsum(size + 1) - size - 1
    index = np.arange(size.sum()) + np.repeat(low - np.cumsum(size) + size, size)
    put = np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)
    w = np.empty(int(size.sum()) + len(size), np.int64)
    w[put] = ids = _ids(data, words, index)
    w[from_ + size] = ids.max() + 1 + np.arange(len(size))  # one of its own after each stretch
    start, stop, period = grammar_runs(w, np.append(from_[1:], len(w)))
    move = low - from_
    part = np.searchsorted(from_, start, side="right") - 1
    start, stop = start + move[part], stop + move[part]
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


def _strongest(start: np.ndarray, length: np.ndarray, period: np.ndarray) -> int:
    """The run of the greatest length over period, exactly; ties to the smaller start, then period."""
    ratio = length / period
    best = -1
    for k in np.flatnonzero(ratio >= ratio.max() * (1 - 1e-9)).tolist():
        if best < 0 or int(length[k]) * int(period[best]) > int(length[best]) * int(period[k]):
            best = k
    return best


def _collapsed(data: np.ndarray, words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each row, joined by one space."""
    index = np.flatnonzero(kept)
    row_first = np.searchsorted(index, words.first)
    padded = np.append(data, np.uint8(0x20))
    out, ends = gather(padded, words.starts[index], words.ends[index] - words.starts[index] + 1)
    out[ends[1:] - 1] = 0x20
    filled = row_first[1:] > row_first[:-1]
    last = ends[row_first[1:][filled]] - 1
    sizes = ends[row_first[1:]] - ends[row_first[:-1]] - filled
    return strings(np.delete(out, last), np.concatenate([[0], np.cumsum(sizes)]))


def _row_arrays(data: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    words = find_words(data, bounds, WHITE_SPACE)
    start, stop, period = word_runs(data, words)
    change = np.zeros(len(words.starts) + 1, np.int32)
    np.add.at(change, start + period, 1)
    np.add.at(change, stop, -1)
    collapsed = _collapsed(data, words, np.cumsum(change[:-1]) <= 0)
    row = np.searchsorted(words.first, start, side="right") - 1
    own, length = start - words.first[row], stop - start
    edge = np.searchsorted(row, np.arange(len(bounds)))
    best = np.full(len(bounds) - 1, -1)
    for r in np.flatnonzero(np.diff(edge)):
        a, b = edge[r], edge[r + 1]
        best[r] = a + _strongest(own[a:b], length[a:b], period[a:b])
    names = [f.name for f in _RUN.fields]
    runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (own, length, period)], names)
    absent = pa.array(best < 0)
    strongest = pa.StructArray.from_arrays(
        [pa.array(x[best] if len(x) else np.zeros(len(best), np.int64), pa.int64()) for x in (own, length, period)], names, mask=absent
    )
    return [pa.array(np.diff(words.first), pa.int64()), pa.ListArray.from_arrays(pa.array(edge, pa.int32()), runs), strongest, collapsed]


def periodic_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """Add to each row ``n_words``, its ``runs`` by start and period (``start`` counts words from 0), the
    ``strongest`` of them (greatest length over period; ties to the smaller start, then period; null
    where there is none) and the ``collapsed`` text: words joined by one space, less those that some run
    contains after its first period.

    Words are what stands between white space, unchanged. A run is at least 24 words and three periods
    long. Null, empty and blank texts have no words, no runs and an empty collapsed text. Rows are
    judged one by one, so ties, repeated rows and null keys need no rule; an empty table gives an empty
    table. Other columns pass unchanged; columns named like the new ones are replaced. A text is never
    cut: a very long one is looked at alone, in memory of some hundred bytes for each word that repeats.
    """
    added = {f.name for f in _ADDED}
    kept = [f for f in df.schema.fields if f.name not in added]
    keep, at = [df.columns.index(f.name) for f in kept], df.columns.index(text)
    schema = T.StructType([*kept, *_ADDED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in slices(batch.column(at), SLICE_BYTES):
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in keep], *_row_arrays(data, bounds)], schema.names)
        release()

    return df.mapInArrow(run, schema)
