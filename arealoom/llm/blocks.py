"""Documents dealt into blocks, and packed questions between blocks.

A block is a bounded set of documents that one task sees at a time. Blocks ask each other which of
their hashes others have too: a message holds all hashes of one block for one bucket, each once, so
a passage that stands in every document is one entry per block, not one per document. Replies go
back to the block. All steps read the documents from one and the same exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealoom.llm.words import release

#: Blocks for each shuffle partition.
BLOCKS_PER_PARTITION = 2
MESSAGE = "block int, bucket int, kind int, body binary, extra binary"
_MESSAGE_SCHEMA = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32()), ("body", pa.binary()), ("extra", pa.binary())])
#: Bytes that a hash of a block counts at least; only larger sizes travel with a question.
LIGHT_BYTES = 256
_LAST = (1 << 63) - 1


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def deal(docs: DataFrame, doc_id: str, text: str, carry: bool = False) -> DataFrame:
    """``doc_id`` (integer), ``text``, the order of documents and their block; with ``carry`` all other
    columns and the id as a struct ``row``.

    Documents are ordered by id, null last; rows of one id by the hash of their text, by block and by
    place in it. The block depends on the input split too, so rows repeated without end are spread.
    """
    n = partitions(docs.sparkSession)
    ordered = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_LAST)).alias("first"),
        F.xxhash64(F.col(f"`{text}`")).alias("second"),
        F.col(f"`{text}`").alias("text"),
        F.spark_partition_id().alias("split"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row")] if carry else []),
    )
    block = F.pmod(F.xxhash64("first", "second", "split"), F.lit(n * BLOCKS_PER_PARTITION)).cast("int")
    return ordered.withColumn("block", block).drop("split").repartition(n, "block")


def ordered_block(rows: pa.Table) -> pa.Table:
    """A block's documents in their order, as one chunk."""
    order = pc.sort_indices(rows, [("first", "ascending"), ("second", "ascending")])
    return rows.take(order).combine_chunks()


def text_column(rows: pa.Table) -> pa.Array:
    column = rows.column("text")
    if column.num_chunks > 1:
        raise ValueError("a block holds over 2 GiB of text: raise spark.sql.shuffle.partitions")
    return column.chunk(0) if column.num_chunks else pa.array([], pa.string())


def message(block: int, bucket: int, kind: int, body: np.ndarray | bytes, extra: np.ndarray | bytes = b"") -> dict:
    as_bytes = lambda x: x if isinstance(x, bytes) else x.tobytes()
    return {"block": int(block), "bucket": int(bucket), "kind": kind, "body": as_bytes(body), "extra": as_bytes(extra)}


def message_table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, _MESSAGE_SCHEMA)


def buckets(hashes: np.ndarray, n: int) -> np.ndarray:
    """The bucket of each hash, from its upper half."""
    return ((hashes >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def by_bucket(bucket: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """The indices of the entries of each bucket that has some, in their order."""
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(n + 1))
    for b in np.flatnonzero(np.diff(bounds)):
        yield int(b), order[bounds[b] : bounds[b + 1]]


def ask(dealt: DataFrame, hashes_of: Callable[[pa.Table], np.ndarray | tuple[np.ndarray, np.ndarray]], heavy: int | None = None) -> DataFrame:
    """Which of its distinct hashes each block shares with another block.

    ``hashes_of`` gives the sorted distinct 64-bit hashes of an ordered block. The reply to a block and
    bucket is a bit mask over its hashes of that bucket in their order. Only 32 bits of a hash travel:
    a chance match makes a hash count as shared, never the reverse.

    With ``heavy``, ``hashes_of`` gives the bytes of each hash too, and a second mask (``extra``) tells
    the hashes with more bytes than that in all blocks together, each block's taken as
    ``LIGHT_BYTES`` at least. All blocks that have a hash are told the same.
    """
    n = partitions(dealt.sparkSession)

    def questions(rows: pa.Table) -> pa.Table:
        release()
        hashes = hashes_of(ordered_block(rows))
        hashes, sizes = hashes if heavy is not None else (hashes, np.zeros(len(hashes), np.int64))
        block = rows.column("block")[0].as_py()
        low = hashes.astype(np.uint32)
        sizes = np.minimum(sizes, (1 << 32) - 1)
        out = []
        for b, index in by_bucket(buckets(hashes, n), n):
            large = np.flatnonzero(sizes[index] > LIGHT_BYTES)
            out.append(message(block, b, 0, low[index], np.stack([large, sizes[index[large]]]).astype(np.uint32)))
        return message_table(out)

    def answers(rows: pa.Table) -> pa.Table:
        bodies = [np.frombuffer(x, np.uint32) for x in rows.column("body").to_pylist()]
        values, counts = np.unique(np.concatenate([np.unique(x) for x in bodies]), return_counts=True)
        shared, busy = values[counts > 1], values[:0]
        if heavy is not None:
            total = counts * LIGHT_BYTES
            for body, extra in zip(bodies, rows.column("extra").to_pylist(), strict=True):
                at, size = np.frombuffer(extra, np.uint32).reshape(2, -1).astype(np.int64)
                np.add.at(total, np.searchsorted(values, body[at]), size - LIGHT_BYTES)
            busy = values[total > heavy]
        out = []
        for block, bucket, body in zip(rows.column("block").to_pylist(), rows.column("bucket").to_pylist(), bodies, strict=True):
            mask, hot = np.isin(body, shared), np.isin(body, busy)
            if mask.any() or hot.any():
                out.append(message(block, bucket, 0, np.packbits(mask), np.packbits(hot) if hot.any() else b""))
        return message_table(out)

    return dealt.groupBy("block").applyInArrow(questions, MESSAGE).groupBy("bucket").applyInArrow(answers, MESSAGE)


def shared_hashes(hashes: np.ndarray, replies: pa.Table, n: int, mask: str = "body") -> np.ndarray:
    """Those of a block's sorted distinct hashes that another block has, or with the mask ``extra``
    those that are heavy."""
    masks = dict(zip(replies.column("bucket").to_pylist(), replies.column(mask).to_pylist(), strict=True))
    told = np.zeros(len(hashes), bool)
    for b, index in by_bucket(buckets(hashes, n), n):
        if masks.get(b):
            told[index] = np.unpackbits(np.frombuffer(masks[b], np.uint8), count=len(index)).astype(bool)
    return hashes[told]


def with_replies(dealt: DataFrame, replies: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema) -> DataFrame:
    """``work`` on each ordered block and the messages to it."""

    def run(rows: pa.Table, messages: pa.Table) -> pa.Table:
        release()
        return work(ordered_block(rows), messages)

    return dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)


def firsts(id_: np.ndarray, block: np.ndarray, offset: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A mask of the entries that are the earliest of their key in the order of documents."""
    order = np.lexsort((offset, block, id_, key))
    sorted_key = key[order]
    lead = np.ones(len(order), bool)
    lead[1:] = sorted_key[1:] != sorted_key[:-1]
    out = np.zeros(len(order), bool)
    out[order[lead]] = True
    return out


def covered(n: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A mask of the places 0 to n - 1 that some span covers."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0
