"""Removal of repeated byte strings with suffix arrays built by induced sorting.

Documents are cut into pieces around the least hash of each window (its minimiser), and pieces with
one minimiser go to one shard: equal windows always meet. A shard sorts the suffixes of its distinct
pieces by induced sorting and takes their common prefixes in text order; suffixes that share a
window's length stand side by side, and all but the earliest are repeats. The windows under a
minimiser with more bytes than one sort takes are dealt one by one by their own hash instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from arealoom.llm import blocks
from arealoom.llm.words import _BYTE_POWERS, _BYTE_VALUES, gather, mix, release, slices, strings

#: Windows of one piece; a longer run under one minimiser (a periodic text) is cut.
PIECE_WINDOWS = 4096
#: Symbols up to which a level of induced sorting works bucket by bucket on arrays.
SMALL_ALPHABET = 512
#: Bytes of pieces that are sorted at once; a minimiser with more is busy.
SHARD_BYTES = 1 << 20
#: Bytes of documents that are hashed at once.
SLICE_BYTES = 1 << 20
_COUNT = (1 << 31) - 1


# ---------------------------------------------------------------------------------------------
# suffix arrays


def suffix_types(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one; the last one is larger than the end."""
    n = len(text)
    smaller = np.zeros(n, bool)
    if n > 1:
        change = np.flatnonzero(text[1:] != text[:-1])
        rising = text[change] < text[change + 1]
        lengths = np.diff(np.concatenate([[-1], change]))
        smaller[: len(lengths) and change[-1] + 1] = np.repeat(rising, lengths)
    return smaller


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Starts of all suffixes in order, by induced sorting; ``text`` holds numbers below ``symbols``."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    smaller = suffix_types(text)
    least = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1  # leftmost smaller places
    small = symbols <= SMALL_ALPHABET
    induce = _induce_arrays if small else _induce_lists
    if len(least) < 2:
        return induce(text, symbols, smaller, least)
    if small:
        first = induce(text, symbols, smaller, least)
        is_least = np.zeros(n, bool)
        is_least[least] = True
        names = _names(text, least, first[is_least[first]])
    else:
        names = _substring_ranks(text, smaller, least)
    highest = int(names.max()) + 1
    if highest < len(least):
        in_order = least[suffix_array(names, highest)]
    else:
        in_order = np.empty_like(least)
        in_order[names] = least
    return induce(text, symbols, smaller, in_order)


def _names(text: np.ndarray, least: np.ndarray, in_order: np.ndarray) -> np.ndarray:
    """Ranks of the leftmost-smaller substrings, in text order; equal substrings share a rank."""
    ends = np.append(least[1:], len(text) - 1)  # the last one runs to the end and equals no other
    which = np.searchsorted(least, in_order)
    lengths = (ends - least)[which]
    differ = np.ones(len(in_order), bool)
    same = np.flatnonzero(lengths[1:] == lengths[:-1]) + 1
    last = len(least) - 1
    same = same[(which[same] != last) & (which[same - 1] != last)]
    step = 0
    while len(same):
        same = same[text[in_order[same] + step] == text[in_order[same - 1] + step]]
        done = lengths[same] == step
        differ[same[done]] = False
        same = same[~done]
        step += 1
    names = np.empty(len(least), np.int64)
    names[which] = np.cumsum(differ) - 1
    return names


def _substring_ranks(text: np.ndarray, smaller: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The same ranks by sorting symbol after symbol, a larger suffix before a smaller one of equal
    symbol; only substrings that are not alone in their rank go on."""
    code = np.append(text.astype(np.int64) * 2 + smaller + 1, 0)
    ends = np.append(least[1:], len(text))  # the last one runs over the end
    rank = np.zeros(len(least), np.int64)
    active, step = np.arange(len(least)), 0
    while len(active):
        at = least[active] + step
        key = np.where(at <= ends[active], code[np.minimum(at, len(text))], 0)
        order = np.lexsort((key, rank[active]))
        old, new = rank[active][order], key[order]
        lead = np.ones(len(order), bool)
        same_old = old[1:] == old[:-1]
        lead[1:] = ~same_old | (new[1:] != new[:-1])
        # a rank is the number of substrings before its group
        start = np.flatnonzero(np.concatenate([[True], ~same_old]))
        group_start = np.repeat(start, np.diff(np.append(start, len(order))))
        lead_at = np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))
        rank[active[order]] = old + lead_at - group_start
        sizes = np.diff(np.append(np.flatnonzero(lead), len(order)))
        more = np.repeat(sizes > 1, sizes) & (new > 0)
        active = np.sort(active[order][more])
        step += 1
    return np.unique(rank, return_inverse=True)[1]


def _induce_arrays(text: np.ndarray, symbols: int, smaller: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Order all suffixes from the leftmost-smaller ones, bucket by bucket.

    ``least`` is in the order that these suffixes shall have within a bucket.
    """
    n = len(text)
    counts = np.bincount(text, minlength=symbols)
    ends = np.cumsum(counts)
    starts = ends - counts
    out = np.full(n, -1, np.int64)
    order = np.argsort(text[least], kind="stable")
    by_symbol = least[order]
    seeds = np.searchsorted(text[by_symbol], np.arange(symbols + 1))
    larger = ~smaller

    def put(places: np.ndarray, heads: np.ndarray, step: int) -> None:
        chars = text[places]
        order = np.argsort(chars, kind="stable")
        chars, places = chars[order].astype(np.int64), places[order]
        lead = np.flatnonzero(np.concatenate([[True], chars[1:] != chars[:-1]]))
        sizes = np.diff(np.append(lead, len(chars)))
        at = heads[chars] + step * (np.arange(len(chars)) - np.repeat(lead, sizes))
        out[at] = places
        heads[chars[lead]] += step * sizes

    heads = starts.copy()
    put(np.array([n - 1]), heads, 1)
    for c in np.flatnonzero(counts):
        done = starts[c]
        while done < heads[c]:
            from_, done = done, heads[c]
            before = out[from_:done] - 1
            before = before[before >= 0]
            before = before[larger[before]]
            if len(before):
                put(before, heads, 1)
        before = by_symbol[seeds[c] : seeds[c + 1]] - 1
        before = before[larger[before]]
        if len(before):
            put(before, heads, 1)
    large_ends = heads  # past the larger suffixes of each bucket
    tails = ends - 1
    for c in np.flatnonzero(counts)[::-1]:
        done = ends[c] - 1
        while done > tails[c]:
            from_, done = done, tails[c]
            before = out[done + 1 : from_ + 1][::-1] - 1
            before = before[before >= 0]
            before = before[smaller[before]]
            if len(before):
                put(before, tails, -1)
        before = out[starts[c] : large_ends[c]][::-1] - 1
        before = before[before >= 0]
        before = before[smaller[before]]
        if len(before):
            put(before, tails, -1)
    return out


def _induce_lists(text: np.ndarray, symbols: int, smaller: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The same in one scan in each direction, for alphabets of many symbols."""
    n = len(text)
    counts = np.bincount(text, minlength=symbols)
    ends = np.cumsum(counts)
    out = [-1] * n
    tails = (ends - 1).tolist()
    t, small = text.tolist(), smaller.tolist()
    for place in reversed(least.tolist()):
        c = t[place]
        out[tails[c]] = place
        tails[c] -= 1
    heads = (ends - counts).tolist()
    c = t[n - 1]
    out[heads[c]] = n - 1
    heads[c] += 1
    for i in range(n):
        place = out[i] - 1
        if place >= 0 and not small[place]:
            c = t[place]
            out[heads[c]] = place
            heads[c] += 1
    tails = (ends - 1).tolist()
    for i in range(n - 1, -1, -1):
        place = out[i] - 1
        if place >= 0 and small[place]:
            c = t[place]
            out[tails[c]] = place
            tails[c] -= 1
    return np.array(out, np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, rest: np.ndarray | None = None) -> np.ndarray:
    """For each place, in text order, the common prefix of its suffix and the one before it in the
    suffix array (0 for the first). Only places whose left neighbours differ are compared; every
    other value is one less than the value to its left. ``rest`` is the length from each place to
    the end of its piece, where prefixes end too."""
    n = len(text)
    if rest is None:
        rest = n - np.arange(n)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    left = np.concatenate([[-1], text[:-1].astype(np.int64)])
    begins = np.concatenate([[True], rest[:-1] <= 1])  # of pieces
    compare = np.flatnonzero((before >= 0) & (begins | begins[before] | (left != left[before])))
    most = np.minimum(rest[compare], rest[before[compare]])
    wide = np.zeros(n + 8, np.uint64)
    padded = np.concatenate([text.astype(np.uint64), np.zeros(16, np.uint64)])
    for i in range(4):  # four symbols of 16 bits at a time
        wide |= padded[i : i + n + 8] << np.uint64(48 - 16 * i)
    length = np.zeros(n, np.int64)
    active, a, b, ends = compare, compare.copy(), before[compare], compare + most
    while len(active):
        x = wide[np.minimum(a, n + 4)] ^ wide[np.minimum(b, n + 4)]
        same = x == 0
        rest = x[~same]
        length[active[~same]] += (rest < np.uint64(1 << 48)).astype(np.int64) + (rest < np.uint64(1 << 32)) + (rest < np.uint64(1 << 16))
        active, a, b, ends = active[same], a[same] + 4, b[same] + 4, ends[same]
        length[active] += 4
        inside = a < ends
        active, a, b, ends = active[inside], a[inside], b[inside], ends[inside]
    start = np.zeros(n, np.int64)
    start[compare] = np.minimum(length[compare], most) + compare
    np.maximum.accumulate(start, out=start)
    return np.maximum(start - np.arange(n), 0)


def earliest_windows(pieces: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the pieces in the order of their content, and the group of each: places in the
    text of all pieces, and a number that equal windows share."""
    sizes = np.diff(bounds)
    n = int(bounds[-1]) + len(sizes)
    text = np.zeros(n, np.uint16)  # stable sorts of 16 bits are radix sorts
    start = bounds[:-1] + np.arange(len(sizes))  # after each piece stands the symbol 0
    index = np.arange(bounds[-1]) + np.repeat(np.arange(len(sizes)), sizes)
    text[index] = pieces.astype(np.uint16) + 1
    rest = np.zeros(n, np.int64)
    rest[index] = np.repeat(start + sizes, sizes) - index
    order = suffix_array(text, 257)
    shared = common_prefixes(text, order, rest)
    # a window lies in its piece; equal ones are neighbours, and no suffix without a window stands between
    whole = rest[order] >= width
    windows = order[whole]
    joined = (shared[order] >= width)[whole]
    place = np.zeros(n, np.int64)
    place[index] = np.arange(len(index))
    return place[windows], np.cumsum(~joined)


# ---------------------------------------------------------------------------------------------
# pieces


def _slide(values: np.ndarray, span: int, choose: np.ufunc) -> np.ndarray:
    """The least or greatest of each ``span`` neighbours."""
    reach = 1
    while reach < span:
        step = min(reach, span - reach)
        values = choose(values[: len(values) - step], values[step:])
        reach += step
    return values


def _minimisers(data: np.ndarray, bounds: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The places of all windows within rows, for each the least hash of its ``gram``-byte runs, and
    the places and hashes of all runs that are the least of some window."""
    n = len(data)
    starts = np.arange(n)
    ok = starts + width <= np.repeat(bounds[1:], np.diff(bounds))
    if not ok.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = _BYTE_POWERS.get(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[:n], out=sums[1:])
    grams = mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    span = width - gram + 1
    least = _slide(grams, span, np.minimum)
    inside = np.zeros(len(least) + 2 * (span - 1), np.uint64)
    inside[span - 1 : span - 1 + len(least)] = np.where(ok[: len(least)], least, np.uint64(0))
    chosen = np.flatnonzero(_slide(inside, span, np.maximum) == grams)
    starts = np.flatnonzero(ok)
    return starts, least[starts], chosen, grams[chosen]


class _Part(NamedTuple):
    """A slice of a block: its runs of windows under one minimiser."""

    low: int  # first row
    data: np.ndarray
    bounds: np.ndarray
    at: np.ndarray  # first window of each run
    count: np.ndarray  # windows of each run
    keys: np.ndarray  # minimiser of each run
    chosen: np.ndarray  # places that are the least of some window
    hashes: np.ndarray
    base: int  # bytes of the block before the slice


def _parts(rows: pa.Table, width: int, gram: int) -> Iterator[_Part]:
    base = 0
    for low, _, data, bounds in slices(blocks.text_column(rows), SLICE_BYTES):
        starts, least, chosen, hashes = _minimisers(data, bounds, width, gram)
        lead = _runs(starts, least)
        yield _Part(low, data, bounds, starts[lead], np.diff(np.append(lead, len(starts))), least[lead], chosen, hashes, base)
        base += len(data)


def _runs(starts: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Indices at which a run of adjacent windows under one minimiser begins, long runs cut."""
    if not len(starts):
        return np.zeros(0, np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] != starts[:-1] + 1) | (least[1:] != least[:-1])
    lead = np.flatnonzero(new)
    within = np.arange(len(starts)) - np.repeat(lead, np.diff(np.append(lead, len(starts))))
    return np.flatnonzero(within % PIECE_WINDOWS == 0)


def _repeating(starts: np.ndarray, counts: np.ndarray, keys: np.ndarray, span: int, chosen: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which runs hold their minimiser at two places at least, so that they may repeat themselves."""
    low, high = np.searchsorted(chosen, starts), np.searchsorted(chosen, starts + counts - 1 + span)
    run = np.repeat(np.arange(len(starts)), high - low)
    at = np.arange(len(run)) + np.repeat(low - np.concatenate([[0], np.cumsum(high - low)[:-1]]), high - low)
    return np.bincount(run[hashes[at] == keys[run]], minlength=len(starts)) > 1


def _content(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of the bytes and the length of each span."""
    up, down = _BYTE_POWERS.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[starts + lengths] - sums[starts]) * down[starts] + lengths.astype(np.uint64))


def _repeats(width: int, own, texts, ids, contents, keys, offsets, windows):
    """Runs of windows (block, place, count) of a shard that also start earlier."""
    repeating, windows, offsets = windows >> 31 > 0, (windows & _COUNT).astype(np.int64), offsets.astype(np.int64)
    lengths = windows + width - 1
    ends = np.cumsum(lengths)
    first = blocks.firsts(ids, own, offsets, contents)
    # equal pieces: every window of a later one is a repeat
    spans = [(own[~first], offsets[~first], windows[~first])]
    # a minimiser of one content that holds it once has no two equal windows left
    _, which, counts = np.unique(keys[first], return_inverse=True, return_counts=True)
    chosen = np.flatnonzero(first)[(counts[which] > 1) | repeating[first]]
    # in the order of documents, so that the place in the text of all pieces tells who is earlier
    chosen = chosen[np.lexsort((offsets[chosen], own[chosen], ids[chosen]))]
    parts = max(1, -(-int(lengths[chosen].sum()) // SHARD_BYTES))
    shard = (keys[chosen] >> np.uint64(8)) % np.uint64(parts)
    for part in range(parts):
        mine = chosen[shard == part]
        body, bounds = gather(texts, ends[mine] - lengths[mine], lengths[mine])
        place, group = earliest_windows(body, bounds, width)
        lead = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
        least = np.minimum.reduceat(place, lead) if len(lead) else place
        later = np.sort(place[place != np.repeat(least, np.diff(np.append(lead, len(place))))])
        piece = np.searchsorted(bounds, later, side="right") - 1
        run = np.ones(len(later), bool)
        run[1:] = (later[1:] != later[:-1] + 1) | (piece[1:] != piece[:-1])
        lead = np.flatnonzero(run)
        at = mine[piece[lead]]
        spans.append((own[at], offsets[at] + later[lead] - bounds[piece[lead]], np.diff(np.append(lead, len(later)))))
    return spans


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 100, carry: bool = False, as_text: bool = False) -> DataFrame:
    """Remove every byte in a string of ``width`` bytes that also starts earlier.

    Texts are UTF-8 bytes; matches never cross documents; earlier is at a smaller id or, in one
    document, at a smaller place, overlaps included; strings are judged on the input. Returns one row
    per document row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and
    ``kept`` (the remaining bytes, binary: a cut may fall inside a character).

    A null text is empty. A null id comes after all others. Rows that share an id are documents one
    after another in a fixed order (by text hash, then by place), so of rows repeated whole the first
    is kept. Texts shorter than a window are kept. An empty table gives an empty table; other
    columns, whatever their names, are not read, or with ``carry`` come back with the id in a struct
    ``row``. With ``as_text`` what is kept is a string, without bytes that are no whole character.
    """
    n = blocks.partitions(docs.sparkSession)
    gram = max(1, (width * 3) // 8)
    dealt = blocks.deal(docs, doc_id, text, carry)

    def minimiser_sizes(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        # the bytes of a minimiser's distinct pieces
        found, keys, contents, sizes = ([np.zeros(0, np.uint64)] for _ in range(4))
        for part in _parts(rows, width, gram):
            found.append(np.unique(part.hashes))
            keys.append(part.keys)
            contents.append(_content(part.data, part.at, part.count + width - 1))
            sizes.append((part.count + width - 1).astype(np.uint64))
        found, keys, contents, sizes = np.unique(np.concatenate(found)), *map(np.concatenate, (keys, contents, sizes))
        _, lead = np.unique(contents, return_index=True)
        return found, np.bincount(np.searchsorted(found, keys[lead]), sizes[lead], minlength=len(found)).astype(np.int64)

    def pieces(rows: pa.Table, replies: pa.Table) -> pa.Table:
        # kind 0: pieces for a shard; kind 1: runs of windows that the block itself decides;
        # kind 2: windows under busy minimisers
        if not rows.num_rows:
            return blocks.message_table([])
        block = rows.column("block")[0].as_py()
        ids = rows.column("first").to_numpy()
        parts = list(_parts(rows, width, gram))
        # a hash at two places of one run, as in a periodic text, counts twice
        hashes, counts = np.unique(np.concatenate([part.hashes for part in parts]), return_counts=True)
        shared = np.union1d(blocks.shared_hashes(hashes, replies, n), hashes[counts > 1])
        busy = blocks.shared_hashes(hashes, replies, n, "extra")
        keys, contents, offsets, windows, owners, texts, sizes = [], [], [], [], [], [], []
        single, places, holders = [], [], []
        for part in parts:
            wanted, hot = np.isin(part.keys, shared), np.isin(part.keys, busy)
            count = part.count[hot]
            at = np.repeat(part.at[hot] - np.cumsum(count) + count, count) + np.arange(count.sum())
            single.append(_content(part.data, at, np.full(len(at), width)))
            places.append(at + part.base)
            holders.append(part.low + np.searchsorted(part.bounds, at, side="right") - 1)
            wanted &= ~hot
            at, count, key = part.at[wanted], part.count[wanted], part.keys[wanted]
            length = count + width - 1
            keys.append(key)
            contents.append(_content(part.data, at, length))
            offsets.append(at + part.base)
            twice = _repeating(at, count, key, width - gram + 1, part.chosen, part.hashes)
            windows.append(count | twice.astype(np.int64) << 31)
            owners.append(ids[part.low + np.searchsorted(part.bounds, at, side="right") - 1])
            body, _ = gather(part.data, at, length)
            texts.append(body)
            sizes.append(length)
        keys, contents, offsets, windows, owners, texts, sizes = map(np.concatenate, (keys, contents, offsets, windows, owners, texts, sizes))
        _, lead = np.unique(contents, return_index=True)
        mask = np.zeros(len(keys), bool)
        mask[lead] = True
        out = [blocks.message(block, block % n, 1, np.stack([offsets[~mask], windows[~mask] & _COUNT]).astype(np.uint32))]
        ends = np.cumsum(sizes)
        chosen = np.flatnonzero(mask)
        for b, index in blocks.by_bucket(blocks.buckets(keys[chosen], n), n):
            index = chosen[index]
            body, _ = gather(texts, ends[index] - sizes[index], sizes[index])
            head = np.stack([offsets[index], windows[index]]).astype(np.uint32)
            out.append(blocks.message(block, b, 0, body, owners[index].tobytes() + contents[index].tobytes() + keys[index].tobytes() + head.tobytes()))
        if len(busy):
            single, places, holders = map(np.concatenate, (single, places, holders))
            _, lead = np.unique(single, return_index=True)
            mask = np.ones(len(single), bool)
            mask[lead] = False
            later, holder = places[mask], holders[mask]
            run = np.flatnonzero(np.concatenate([[True], (later[1:] != later[:-1] + 1) | (holder[1:] != holder[:-1])])[: len(later)])
            out.append(blocks.message(block, block % n, 1, np.stack([later[run], np.diff(np.append(run, len(later)))]).astype(np.uint32)))
            for b, index in blocks.by_bucket(blocks.buckets(single[lead], n), n):
                index = lead[index]
                out.append(blocks.message(block, b, 2, single[index], ids[holders[index]].tobytes() + places[index].astype(np.uint32).tobytes()))
        return blocks.message_table(out)

    def sort_shard(rows: pa.Table) -> pa.Table:
        release()
        out, own, texts, ids, contents, keys, offsets, windows = [], [], [], [], [], [], [], []
        spans, single = [], []
        for row in rows.to_pylist():
            if row["kind"] == 1:
                out.append(row)
                continue
            if row["kind"] == 2:
                found = np.frombuffer(row["body"], np.uint64)
                held = np.frombuffer(row["extra"], np.int64, len(found)), np.full(len(found), row["block"])
                single.append((*held, np.frombuffer(row["extra"], np.uint32, offset=8 * len(found)), found))
                continue
            count = len(row["extra"]) // 32
            own.append(np.full(count, row["block"]))
            texts.append(np.frombuffer(row["body"], np.uint8))
            ids.append(np.frombuffer(row["extra"], np.int64, count))
            contents.append(np.frombuffer(row["extra"], np.uint64, count, 8 * count))
            keys.append(np.frombuffer(row["extra"], np.uint64, count, 16 * count))
            offsets.append(np.frombuffer(row["extra"], np.uint32, count, 24 * count))
            windows.append(np.frombuffer(row["extra"], np.uint32, count, 28 * count))
        if single:
            holder, block, place, found = (np.concatenate(x) for x in zip(*single, strict=True))
            later = ~blocks.firsts(holder, block, place, found)
            spans.append((block[later], place[later], np.ones(later.sum(), np.int64)))
        if own:
            spans += _repeats(width, *map(np.concatenate, (own, texts, ids, contents, keys, offsets, windows)))
        if spans:
            owner, offset, count = (np.concatenate(x) for x in zip(*spans, strict=True))
            order = np.argsort(owner, kind="stable")
            cuts = np.flatnonzero(np.diff(owner[order])) + 1
            for index in np.split(order, cuts):
                if len(index):
                    out.append(blocks.message(owner[index[0]], 0, 1, np.stack([offset[index], count[index]]).astype(np.uint32)))
        return blocks.message_table(out)

    def cut(rows: pa.Table, marks: pa.Table) -> pa.Table:
        bodies = [np.frombuffer(x, np.uint32).reshape(2, -1) for x in marks.column("body").to_pylist()]
        starts, counts = np.concatenate(bodies or [np.zeros((2, 0), np.uint32)], axis=1).astype(np.int64)
        order = np.argsort(starts)
        starts, counts = starts[order], counts[order]
        out, base = [], 0
        for low, _, data, bounds in slices(blocks.text_column(rows), SLICE_BYTES):
            mine = slice(*np.searchsorted(starts, [base, base + len(data)]))
            removed = blocks.covered(len(data), starts[mine] - base, counts[mine] + width - 1)
            begins = removed.copy()
            begins[1:] &= ~removed[:-1]
            inner = bounds[(bounds > 0) & (bounds < len(data))]
            begins[inner] = removed[inner]
            gone = np.concatenate([[0], np.cumsum(removed)])[bounds]
            spans = np.concatenate([[0], np.cumsum(begins)])[bounds]
            part = rows.slice(low, len(bounds) - 1)
            kept = strings(data[~removed], bounds - gone, pa.binary())
            if as_text:
                kept = pa.array([b.decode("utf-8", "ignore") for b in kept.to_pylist()], pa.string())
            made = [np.diff(bounds), np.diff(gone), np.diff(spans), kept]
            extra = {"row": part.column("row")} if carry else {}
            out.append(pa.table({"doc_id": part.column("doc_id")} | dict(zip(_COUNTS, made, strict=True)) | extra))
            base += len(data)
        return pa.concat_tables(out) if out else _empty(rows, carry, as_text)

    asked = blocks.ask(dealt, minimiser_sizes, SHARD_BYTES)
    found = blocks.with_replies(dealt, asked, pieces, blocks.MESSAGE).groupBy("bucket").applyInArrow(sort_shard, blocks.MESSAGE)
    fields = [T.StructField(name, T.LongType()) for name in ("doc_id", *_COUNTS[:3])]
    fields += [T.StructField("kept", T.StringType() if as_text else T.BinaryType())] + ([dealt.schema["row"]] if carry else [])
    return blocks.with_replies(dealt, found, cut, T.StructType(fields))


_COUNTS = ("n_bytes", "n_removed", "n_spans", "kept")


def _empty(rows: pa.Table, carry: bool, as_text: bool) -> pa.Table:
    kinds = {"doc_id": pa.int64()} | dict.fromkeys(_COUNTS[:3], pa.int64()) | {"kept": pa.string() if as_text else pa.binary()}
    kinds |= {"row": rows.schema.field("row").type} if carry else {}
    return pa.table({name: pa.array([], kind) for name, kind in kinds.items()})
