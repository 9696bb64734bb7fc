"""A Bloom filter of bounded size as a table of segments: built in tasks, merged by segment, looked up by built-in functions.

Each 64-bit hash sets two bits of one segment. The filter keeps the bits set at least once or, on request, by more than one row.
It has ``BITS_PER_ROW`` bits a row up to ``MAX_FILTER_BYTES``, which is all that is ever broadcast; beyond that many rows it
says "maybe" more often.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.tables import free_name
from tenura.session import stage

BITS_PER_ROW = 16
MAX_FILTER_BYTES = 32 << 20
SEGMENT_BITS = 1 << 17
# Rows of a task whose bits are gathered before they are sent on.
_GATHERED = 1 << 20


def positions(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, two bit positions in it) of 64-bit hashes."""
    h = hashes.view(np.uint64)
    segment = (h >> np.uint64(36)) % np.uint64(segments)
    first, second = h & np.uint64(SEGMENT_BITS - 1), (h >> np.uint64(17)) & np.uint64(SEGMENT_BITS - 1)
    return segment.astype(np.int32), np.stack([first, second], 1).astype(np.uint32)


def _set_bits(segments: int):
    """Task step: hashes to one row for each segment touched: positions set, each once, with those set twice marked."""

    def rows(parts):
        hashes = np.concatenate(parts)
        segment, places = positions(hashes, segments)
        key = (segment.astype(np.uint64)[:, None] * np.uint64(SEGMENT_BITS) + places).ravel()
        key, count = np.unique(key, return_counts=True)
        value = ((key % np.uint64(SEGMENT_BITS)) * np.uint64(2) + (count > 1)).astype("<u4")
        own = (key // np.uint64(SEGMENT_BITS)).astype(np.int32)
        cuts = np.flatnonzero(np.diff(own, prepend=-1))
        ends = np.append(cuts[1:], len(own))
        bits = [value[a:b].tobytes() for a, b in zip(cuts, ends)]
        return pa.RecordBatch.from_arrays([pa.array(own[cuts], pa.int32()), pa.array(bits, pa.binary())], ["segment", "bits"])

    def step(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            n += len(held[-1])
            if n >= _GATHERED:
                yield rows(held)
                held, n = [], 0
        if n:
            yield rows(held)

    return step


def _merge(least: int):
    """Group step: all parts of one segment to the bits set by ``least`` rows (1 or 2), as 64-bit words."""

    def merge(key, table):
        value = np.concatenate([np.frombuffer(b, "<u4") for b in table.column("bits").to_pylist()])
        kept = np.zeros(SEGMENT_BITS, bool)
        position, parts = np.unique(value >> 1, return_counts=True)
        kept[position[parts >= least]] = True
        kept[value[(value & 1) == 1] >> 1] = True
        words = np.packbits(kept, bitorder="little").view("<i8")
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "words": pa.array([words.tolist()], pa.list_(pa.int64()))})

    return merge


def build(hashes: DataFrame, rows: int, least: int) -> tuple[DataFrame, int]:
    """(segment, words) of all segments with a bit that counts, staged, and the number of segments. ``hashes`` has one bigint column."""
    bits = min(max(rows, 1) * BITS_PER_ROW, MAX_FILTER_BYTES * 8)
    segments = -(-bits // SEGMENT_BITS)
    parts = hashes.mapInArrow(_set_bits(segments), "segment int, bits binary")
    return stage(parts.groupBy("segment").applyInArrow(_merge(least), "segment int, words array<bigint>"), "filter"), segments


def marked(df: DataFrame, h: Column, filter_: DataFrame, segments: int, name: str) -> DataFrame:
    """``df`` with the boolean ``name``: whether both bits of hash ``h`` are in the filter. The positions are those of ``positions``."""
    hash_, own, at, words = (free_name(df, n) for n in ("__hash", "__own", "__at", "__words"))
    located = df.withColumn(hash_, h).withColumn(own, F.shiftrightunsigned(hash_, 36).cast("bigint") % F.lit(segments))
    low = F.col(hash_).bitwiseAND(F.lit(SEGMENT_BITS - 1))
    high = F.shiftrightunsigned(hash_, 17).bitwiseAND(F.lit(SEGMENT_BITS - 1))

    def is_set(position):
        word = F.element_at(words, (F.shiftright(position, 6) + 1).cast("int"))
        return F.getbit(word, position.bitwiseAND(F.lit(63)).cast("int")) == 1

    held = F.broadcast(filter_.select(F.col("segment").cast("bigint").alias(at), F.col("words").alias(words)))
    looked = located.join(held, F.col(own) == F.col(at), "left")
    return looked.withColumn(name, F.coalesce(is_set(low) & is_set(high), F.lit(False))).drop(hash_, own, at, words)


def joined(df: DataFrame, few: DataFrame, key: Column, few_key: str, match: Column) -> DataFrame:
    """The left join of ``df`` with ``few``, a staged table whose column ``few_key`` is what ``key`` is in ``df``. They share no column names.

    Rows of ``df`` whose key cannot be in ``few`` pass straight through, with nulls for its columns.
    """
    maybe = free_name(df, "__maybe")
    filter_, segments = build(few.select(F.xxhash64(few_key).alias("hash")), few.count(), 1)
    asked = marked(df, F.xxhash64(key), filter_, segments, maybe)
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in few.schema]
    alone = asked.where(~F.col(maybe)).select(*df.columns, *empty)
    return alone.unionByName(asked.where(maybe).drop(maybe).join(few, match, "left"))


def without(
    df: DataFrame, gone: DataFrame, key: Column, gone_key: str, match: Column, also: Callable[[DataFrame], DataFrame] = lambda asked: asked
) -> DataFrame:
    """``df`` less the rows that ``match`` a row of ``gone``, a staged table whose column ``gone_key`` is what ``key`` is in ``df``.

    Rows whose key cannot be in ``gone`` pass straight through; only the others, which are about those that go, are joined.
    ``also`` adds columns that ``match`` needs to these others.
    """
    maybe = free_name(df, "__maybe")
    filter_, segments = build(gone.select(F.xxhash64(gone_key).alias("hash")), gone.count(), 1)
    asked = marked(df, F.xxhash64(key), filter_, segments, maybe)
    stays = asked.where(~F.col(maybe)).select(df.columns)
    return stays.unionByName(also(asked.where(maybe)).join(gone, match, "left_anti").select(df.columns))
