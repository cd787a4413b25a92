"""Removal of repeated word windows with difference-cover anchors.

Modulo a period, a difference cover holds two places at any distance from each other. So if one
window of words stands at two places, whatever their distance, some pair of cover places at one and
the same shift into both windows starts the same shorter run of words. Only those anchor runs are
hashed and exchanged; where an anchor is shared, it is extended to the full windows around it, and
the earliest window of each kind stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from arealoom.llm import blocks
from arealoom.llm.words import WHITE_SPACE, Words, find_words, gather, release, slices, strings, window_hashes

#: Perfect difference sets, every distance modulo the period is a difference of two.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}


def period_for(width: int) -> int:
    """The largest period that leaves anchors of at least a third of the window."""
    return max(p for p in COVERS if width - p + 1 >= max(1, width // 3))


def _block_words(rows: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray, Words]]:
    """(row, bytes, bounds, words) of the slices of a block."""
    return [(low, data, bounds, find_words(data, bounds, WHITE_SPACE)) for low, _, data, bounds in slices(blocks.text_column(rows))]


def _anchors(words: Words, width: int, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Words at cover places with a whole anchor in their document, and the anchor hashes."""
    length = width - period + 1
    at = np.flatnonzero(words.window_ok(length))
    place = at - np.repeat(words.first[:-1], np.diff(words.first))[at]
    in_cover = np.zeros(period, bool)
    in_cover[list(COVERS[period])] = True
    at = at[in_cover[place % period]]
    return at, window_hashes(words.hashes, length)[at] if len(at) else np.zeros(0, np.uint64)


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 20) -> DataFrame:
    """Remove every word in a window of ``width`` words whose sequence also starts earlier.

    Earlier is at a smaller id or, in one document, at a smaller place; windows are judged on the
    input. Words are runs of anything but ASCII white space, compared byte by byte through 64-bit
    hashes of a window. Returns one row per document row: ``doc_id``, ``n_words``, ``n_removed``,
    ``kept_text`` (the kept words joined by single spaces).

    A null text has no words. A null id comes after all others. Rows that share an id are documents
    one after another in a fixed order (by text hash, then by place), so of rows repeated whole the
    first keeps its words. Texts of fewer words than a window are kept. An empty table gives an empty
    table; other columns, whatever their names, are not read.
    """
    n = blocks.partitions(docs.sparkSession)
    period = period_for(width)
    dealt = blocks.deal(docs, doc_id, text)

    def anchor_hashes(rows: pa.Table) -> np.ndarray:
        parts = [_anchors(words, width, period)[1] for _, _, _, words in _block_words(rows)]
        return np.unique(np.concatenate(parts or [np.zeros(0, np.uint64)]))

    def windows(rows: pa.Table, replies: pa.Table) -> pa.Table:
        # kind 0: windows for a bucket (hashes; ids, places); kind 1: places that the block itself decides
        if not rows.num_rows:
            return blocks.message_table([])
        block = rows.column("block")[0].as_py()
        ids = rows.column("first").to_numpy()
        parts = _block_words(rows)
        anchors = [_anchors(words, width, period) for _, _, _, words in parts]
        hashes, counts = np.unique(np.concatenate([h for _, h in anchors]), return_counts=True)
        shared = np.union1d(blocks.shared_hashes(hashes, replies, n), hashes[counts > 1])
        found, places, owners, base = [], [], [], 0
        for (low, _, _, words), (at, own) in zip(parts, anchors, strict=True):
            size = len(words.starts)
            at = at[np.isin(own, shared)]
            row_start = np.repeat(words.first[:-1], np.diff(words.first))
            from_ = np.maximum(at - period + 1, row_start[at])
            start = np.flatnonzero(blocks.covered(size, from_, at + 1 - from_) & words.window_ok(width))
            found.append(window_hashes(words.hashes, width)[start] if len(start) else np.zeros(0, np.uint64))
            places.append(start + base)
            owners.append(ids[low + words.rows()[start]])
            base += size
        found, places, owners = (np.concatenate(x) for x in (found, places, owners))
        _, lead = np.unique(found, return_index=True)
        mask = np.zeros(len(found), bool)
        mask[lead] = True
        out = [blocks.message(block, block % n, 1, places[~mask].astype(np.uint32))]
        found, places, owners = found[mask], places[mask].astype(np.uint32), owners[mask]
        for b, index in blocks.by_bucket(blocks.buckets(found, n), n):
            out.append(blocks.message(block, b, 0, found[index], owners[index].tobytes() + places[index].tobytes()))
        return blocks.message_table(out)

    def repeats(rows: pa.Table) -> pa.Table:
        release()
        out, own, hashes, ids, places = [], [], [], [], []
        for row in rows.to_pylist():
            if row["kind"] == 1:
                out.append(row)
                continue
            found = np.frombuffer(row["body"], np.uint64)
            own.append(row["block"])
            hashes.append(found)
            ids.append(np.frombuffer(row["extra"], np.int64, len(found)))
            places.append(np.frombuffer(row["extra"], np.uint32, offset=8 * len(found)))
        if own:
            sizes = [len(x) for x in hashes]
            later = ~blocks.firsts(np.concatenate(ids), np.repeat(own, sizes), np.concatenate(places), np.concatenate(hashes))
            for block, place, mask in zip(own, places, np.split(later, np.cumsum(sizes)[:-1]), strict=True):
                if mask.any():
                    out.append(blocks.message(block, 0, 1, place[mask]))
        return blocks.message_table(out)

    def cut(rows: pa.Table, marks: pa.Table) -> pa.Table:
        bodies = [np.frombuffer(x, np.uint32) for x in marks.column("body").to_pylist()]
        marked = np.sort(np.concatenate(bodies or [np.zeros(0, np.uint32)])).astype(np.int64)
        out, base = [], 0
        for low, data, bounds, words in _block_words(rows):
            size = len(words.starts)
            mine = marked[np.searchsorted(marked, base) : np.searchsorted(marked, base + size)] - base
            removed = blocks.covered(size, mine, np.full(len(mine), width))
            out.append(_kept(rows.slice(low, len(bounds) - 1), data, words, removed))
            base += size
        return pa.Table.from_batches(out, _RESULT)

    asked = blocks.ask(dealt, anchor_hashes)
    found = blocks.with_replies(dealt, asked, windows, blocks.MESSAGE).groupBy("bucket").applyInArrow(repeats, blocks.MESSAGE)
    return blocks.with_replies(dealt, found, cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])


def _kept(rows: pa.Table, data: np.ndarray, words: Words, removed: np.ndarray) -> pa.RecordBatch:
    before = np.concatenate([[0], np.cumsum(removed)])[words.first]
    kept = np.flatnonzero(~removed)
    text, ends = gather(np.append(data, np.uint8(0x20)), words.starts[kept], words.ends[kept] - words.starts[kept] + 1)
    text[ends[1:] - 1] = 0x20
    bounds = ends[words.first - before]  # each document's words, each followed by a space
    some = np.diff(bounds) > 0
    drop = bounds[1:][some] - 1
    mask = np.ones(len(text), bool)
    mask[drop] = False
    bounds = bounds - np.concatenate([[0], np.cumsum(some)])
    ids = rows.column("doc_id").combine_chunks()
    ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
    return pa.RecordBatch.from_arrays([ids, pa.array(np.diff(words.first)), pa.array(np.diff(before)), strings(text[mask], bounds)], schema=_RESULT)
