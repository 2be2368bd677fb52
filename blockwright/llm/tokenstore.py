"""Token ids in directly addressable codes (DACs; Brisaboa, Ladra and Navarro): any token can be read without decoding its neighbours.

A block holds the ids of consecutive documents. Each id is cut into chunks of a few bits; level k holds the k-th chunk of
the ids that have one, a bitmap tells which of them go on, and a directory of ranks every 512 bits gives the place on the
next level. The blocks are rows of a Parquet table in the shared folder, so Spark's writer commits them and any executor reads them.

Layout of a block, little-endian: magic "DAC1", bits a chunk (u8), levels (u8), documents (u32), ids (u64); then for each
document its doc_id (i64), number of ids (u32) and whether it has a doc_id (u8); then for each level: entries (u64), chunks (u8 or u16 each), bitmap (u64 words), ranks (u64 each).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockwright.llm.bpe import LibraryPieces, encoder, forget_encoders
from blockwright.llm.shared import with_text, written

CHUNK_BITS = 8
BLOCK_IDS = 1 << 19
RANGE_BYTES = 16 << 20
MOST_RANGES = 20_000  # beyond that ranges grow; a range is sorted with spilling and written block by block
NO_ID = -(1 << 63)
BROADCAST_BLOCKS = 200_000
_HEAD = struct.Struct("<4sBBIQ")


def _bitmap(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit words of the flags, and the ones before every 8 words."""
    bits = np.packbits(flags, bitorder="little")
    words = np.zeros(-(-len(flags) // 512) * 8, "<u8")
    words.view(np.uint8)[: len(bits)] = bits
    ones = np.bitwise_count(words).astype(np.uint64)
    return words, np.concatenate([[0], np.cumsum(ones.reshape(-1, 8).sum(1))]).astype("<u8")


def pack(doc_ids: list[int], ids: list[np.ndarray], bits: int = CHUNK_BITS) -> bytes:
    """A block of these documents' ids."""
    left = (np.concatenate(ids) if ids else np.zeros(0)).astype(np.uint64)
    total, levels, body = len(left), 0, []
    while levels == 0 or len(left):
        more = left >> np.uint64(bits)
        words, ranks = _bitmap(more > 0)
        chunk = (left & np.uint64((1 << bits) - 1)).astype("<u1" if bits <= 8 else "<u2")
        body += [struct.pack("<Q", len(left)), chunk.tobytes(), words.tobytes(), ranks.tobytes()]
        left, levels = more[more > 0], levels + 1
    head = _HEAD.pack(b"DAC1", bits, levels, len(doc_ids), total)
    return b"".join([head, np.array([NO_ID if d is None else d for d in doc_ids], "<i8").tobytes(), np.array([len(x) for x in ids], "<u4").tobytes(), np.array([d is not None for d in doc_ids], "u1").tobytes(), *body])


class Block:
    """A packed block: arrays over the bytes, nothing is decoded until asked for."""

    def __init__(self, raw: bytes):
        magic, self.bits, levels, docs, self.total = _HEAD.unpack_from(raw)
        if magic != b"DAC1":
            raise ValueError("not a block of token ids")
        at = _HEAD.size
        self.doc_ids = np.frombuffer(raw, "<i8", docs, at)
        self.sizes = np.frombuffer(raw, "<u4", docs, at := at + 8 * docs).astype(np.int64)
        self.with_id = np.frombuffer(raw, "u1", docs, at := at + 4 * docs).astype(bool)
        at += docs
        self.levels = []
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", raw, at)
            kind = "<u1" if self.bits <= 8 else "<u2"
            chunk = np.frombuffer(raw, kind, n, at := at + 8)
            words = np.frombuffer(raw, "<u8", -(-n // 512) * 8, at := at + chunk.nbytes)
            ranks = np.frombuffer(raw, "<u8", -(-n // 512) + 1, at := at + words.nbytes)
            at += ranks.nbytes
            self.levels.append((chunk, words, ranks))

    def get(self, places: np.ndarray) -> np.ndarray:
        """The ids at any places, by rank on each level."""
        at = np.asarray(places, np.int64)
        out, live = np.zeros(len(at), np.uint64), np.arange(len(at))
        for k, (chunk, words, ranks) in enumerate(self.levels):
            if not len(at):
                break
            out[live] |= chunk[at].astype(np.uint64) << np.uint64(self.bits * k)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            more = (words[word] >> bit) & np.uint64(1) == 1
            at, live, word, bit = at[more], live[more], word[more], bit[more]
            rank = ranks[at >> 9].astype(np.int64) + np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            for step in range(7):  # whole words of the same directory entry before this one
                before = (word & 7) > step
                rank[before] += np.bitwise_count(words[(word & ~7)[before] + step]).astype(np.int64)
            at = rank
        return out

    def all(self) -> np.ndarray:
        """All ids in order, level by level."""
        below = np.zeros(0, np.uint64)
        for chunk, words, _ in reversed(self.levels):
            here = chunk.astype(np.uint64)
            goes_on = np.unpackbits(words.view(np.uint8), bitorder="little", count=len(chunk)).view(bool)
            here[goes_on] |= below << np.uint64(self.bits)
            below = here
        return below


def _encoded(path: str, end_id: int, cuts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(path, LibraryPieces)
        end = np.array([end_id], "<u4")
        for batch in batches:
            for i, j, flat, at in library.encode_column(batch.column("text")):
                part = batch.slice(i, j - i)
                ids, h = part.column("doc_id").fill_null(NO_ID).to_numpy(), part.column("h").to_numpy()
                first = np.searchsorted(cuts, ids, "left")
                spans = np.maximum(np.searchsorted(cuts, ids, "right") - first, 1)  # a doc_id that fills several ranges is dealt to them by its texts' hash
                found = [_narrow(np.append(flat[a:b], end)) for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "h": part.column("h"), "range": pa.array(first + (h * spans >> 31), pa.int32()), "ids": pa.array(found, pa.binary())})

    return run


def _narrow(ids: np.ndarray) -> bytes:
    """A document's ids on their way to its range: two bytes each where all fit."""
    return b"2" + ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else b"4" + ids.tobytes()


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if raw[:1] == b"2" else "<u4", offset=1).astype("<u4")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted documents to blocks of about BLOCK_IDS ids; a block never spans two ranges."""
    forget_encoders()
    place, docs, ids, size, block = None, [], [], 0, 0

    def full() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"range": pa.array([place], pa.int32()), "block": pa.array([block], pa.int64()), "n_ids": pa.array([size], pa.int64()), "content": pa.array([pack(docs, ids)], pa.binary())})

    for batch in batches:
        for doc_id, rng, raw in zip(batch.column("doc_id").to_pylist(), batch.column("range").to_pylist(), batch.column("ids"), strict=True):
            if docs and (rng != place or size >= BLOCK_IDS):
                yield full()
                docs, ids, size, block = [], [], 0, block + 1 if rng == place else 0
            place = rng
            docs.append(doc_id)
            ids.append(_wide(raw.as_py()))
            size += len(ids[-1])
    if docs:
        yield full()


def write_token_blocks(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Encode every text with the tokenizers library, append ``end_id``, and write blocks in ascending doc_id order.

    Returns the table of blocks read back from the shared folder: range, block, n_ids, content. Ranges of doc_ids are
    bounded by quantiles of that column, about RANGE_BYTES of text each; each range is one partition, sorted by itself. Rows without doc_id
    come first; rows that share a doc_id are ordered by a hash of their text and may fill several ranges.
    """
    src = with_text(docs).withColumn("h", F.shiftrightunsigned(F.xxhash64("text"), 33))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(min(max(1, size // RANGE_BYTES), MOST_RANGES))
    found = src.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id")).approxQuantile("doc_id", [k / n for k in range(1, n)], 0.1 / n) if n > 1 else []
    cuts = np.array([int(min(max(x, NO_ID), (1 << 63) - 1)) for x in found], np.int64)
    encoded = src.mapInArrow(_encoded(path, end_id, cuts), "doc_id long, h long, range int, ids binary")
    sorted_ = encoded.repartitionById(n, "range").sortWithinPartitions("range", F.asc_nulls_first("doc_id"), "h", "ids").drop("h")
    return written(sorted_.mapInArrow(_blocks, "range int, block long, n_ids long, content binary"), "token-blocks")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, raw in zip(batch.column("start").to_pylist(), batch.column("content"), strict=True):
            block = Block(raw.as_py())
            ids, at = block.all().astype("<u4"), np.concatenate([[0], np.cumsum(block.sizes)])
            ends = np.concatenate([at[:-1], at[1:] - 1])  # each document's first and last id, by direct access
            if (block.get(ends) != ids[ends]).any():
                raise ValueError("a block's bitmaps and ranks do not agree")
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(block.doc_ids, mask=~block.with_id), "start": pa.array(start + at[:-1]), "n_tokens": pa.array(block.sizes), "ids_crc32": pa.array(crc, pa.int64())})


def read_token_blocks(blocks: DataFrame) -> DataFrame:
    """One row a document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Null texts count as empty and hold the end id alone; rows without doc_id come first. The ids before a range are
    summed over one number a range, those before a block over the blocks of its range.
    """
    spans = Window.partitionBy("range").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = blocks.select("range", "block", F.coalesce(F.sum("n_ids").over(spans), F.lit(0)).alias("inside"))
    totals = blocks.groupBy("range").agg(F.sum("n_ids").alias("total"))
    before = totals.select("range", F.coalesce(F.sum("total").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    starts = inside.join(before, "range").select("range", "block", (F.col("before") + F.col("inside")).alias("start"))
    if blocks.limit(BROADCAST_BLOCKS + 1).count() <= BROADCAST_BLOCKS:  # three numbers a block; beyond that the blocks are joined by a shuffle
        starts = F.broadcast(starts)
    return blocks.select("range", "block", "content").join(starts, ["range", "block"]).select("start", "content").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
