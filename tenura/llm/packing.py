"""Best-fit packing of documents into sequences by linear grouping.

Pieces are dealt at random into buckets of about ``BUCKET_PIECES``, and each bucket is packed in one task; what that loses is
a few sequences a bucket. In a bucket the large pieces, sorted by length, are cut into groups of equal numbers and every
length is rounded up to its group's largest. For those few sizes the best mix of configurations (which sizes share a
sequence) is found by a linear program with columns made as needed. The actual pieces then take the places, which
leaves gaps; the rest of the large pieces and the small ones go, longest first, where they fit best.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm.tables import pieces
from tenura.llm.token_grammar import with_ends
from tenura.llm.words import coder
from tenura.session import stage

CAPACITY = 2048
BUCKET_PIECES = 60_000
GROUPS = 64
# Pieces up to this share of a sequence are small: they fill gaps and take no part in configurations.
SMALL_SHARE = 1 / 4
# Sequences that the configurations leave emptier than this are taken apart, and their pieces placed by best fit.
FULL_ENOUGH = 0.98


def _best_mix(sizes: np.ndarray, wanted: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Configurations (how many of each size) and how often each is used: the optimum of the linear program.

    Simplex with column generation. The new column is the most valuable filling of one sequence under the current prices,
    found by dynamic programming over the number of pieces in it.
    """
    g = len(sizes)
    columns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1 / np.diag(columns))
    amount = inverse @ wanted
    most = int(capacity // sizes.min())
    width = capacity + 1
    for _ in range(30 * g + 200):
        price = inverse.sum(0)
        worth, choice = np.zeros(width), []
        for _ in range(most):
            best, pick = worth, np.full(width, -1, np.int32)
            for s in range(g):
                if price[s] <= 1e-12:
                    continue
                size = sizes[s]
                value = worth[: width - size] + price[s]
                better = value > best[size:] + 1e-12
                if better.any():
                    if best is worth:
                        best = worth.copy()
                    best[size:][better] = value[better]
                    pick[size:][better] = s
            choice.append(pick)
            if best is worth:
                break
            worth = best
        if worth[-1] <= 1 + 1e-9:
            break
        column, room = np.zeros(g), capacity
        for pick in reversed(choice):
            if pick[room] >= 0:
                column[pick[room]] += 1
                room -= sizes[pick[room]]
        step = inverse @ column
        ok = step > 1e-9
        if not ok.any():
            break
        ratio = np.full(g, np.inf)
        ratio[ok] = amount[ok] / step[ok]
        out = int(ratio.argmin())
        move = ratio[out]
        amount = np.maximum(amount - move * step, 0)
        amount[out] = move
        inverse[out] /= step[out]
        others = np.arange(g) != out
        inverse[others] -= np.outer(step[others], inverse[out])
        columns[:, out] = column
    return [(columns[:, i].astype(int), float(amount[i])) for i in range(g)]


def _stock(items: np.ndarray, lengths: np.ndarray) -> tuple[list[list[int]], int]:
    """Items by length, and the lengths that occur as a bit set."""
    stock: list[list[int]] = [[] for _ in range(int(lengths[items].max()) + 1)]
    held = 0
    for i in items.tolist():
        stock[lengths[i]].append(i)
        held |= 1 << int(lengths[i])
    return stock, held


def _take(stock: list[list[int]], held: int, most: int) -> tuple[int, int]:
    """The longest item of at most this length, -1 if there is none, and the lengths that remain."""
    size = (held & ((1 << (most + 1)) - 1)).bit_length() - 1
    if size < 0:
        return -1, held
    i = stock[size].pop()
    return i, held if stock[size] else held & ~(1 << size)


def _take_apart(large: np.ndarray, sequence: np.ndarray, used: list[int], first: int, capacity: int) -> tuple[np.ndarray, list[int]]:
    """Only the sequences that are full enough stay, renumbered; pieces of the others are without a place again."""
    stays = np.array(used) >= FULL_ENOUGH * capacity
    number = np.where(stays, np.cumsum(stays) - 1 + first, -1)
    placed = large[sequence[large] >= 0]
    sequence[placed] = number[sequence[placed] - first]
    return sequence, [u for u, s in zip(used, stays) if s]


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) for each length, all between 1 and ``capacity``. Gapless; equal lengths are packed alike."""
    n = len(lengths)
    sequence, offset = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    full = np.flatnonzero(lengths == capacity)
    sequence[full] = np.arange(len(full))
    used: list[int] = []
    first = len(full)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] < capacity]
    large = order[lengths[order] > capacity * SMALL_SHARE]
    small = order[lengths[order] <= capacity * SMALL_SHARE]
    left: list[int] = []
    if len(large):
        groups = np.array_split(large, min(GROUPS, len(large)))
        # Neighbouring groups whose largest lengths are equal are one size.
        sizes = np.array([lengths[x[0]] for x in groups])
        kind = np.cumsum(np.diff(sizes, prepend=sizes[0]) != 0)
        sizes = sizes[np.flatnonzero(np.diff(kind, prepend=-1))]
        wanted = np.bincount(kind, weights=[len(x) for x in groups])
        stock, held = _stock(large, lengths)
        mix = [(c, int(n + 1e-6)) for c, n in _best_mix(sizes, wanted, capacity)]
        for column, times in sorted(mix, key=lambda x: int(np.flatnonzero(x[0])[0])):
            places = [int(sizes[s]) for s in np.flatnonzero(column) for _ in range(column[s])]
            for _ in range(times):
                at = 0
                for place in places[:-1]:
                    i, held = _take(stock, held, place)
                    if i >= 0:
                        sequence[i], offset[i] = first + len(used), at
                        at += int(lengths[i])
                # What rounding left over helps the last place: it takes the longest piece that fits.
                i, held = _take(stock, held, capacity - at)
                if i >= 0:
                    sequence[i], offset[i] = first + len(used), at
                    at += int(lengths[i])
                if at:
                    used.append(at)
        sequence, used = _take_apart(large, sequence, used, first, capacity)
        left = [i for i in large.tolist() if sequence[i] < 0]
    # Best fit: the fullest sequence that still has room, by a bit set of the gaps that occur.
    gaps: list[list[int]] = [[] for _ in range(capacity + 1)]
    there = 0
    for b, at in enumerate(used):
        gaps[capacity - at].append(b)
        there |= 1 << (capacity - at)
    for i in [*left, *small.tolist()]:
        size = int(lengths[i])
        fits = there >> size
        if fits:
            gap = (fits & -fits).bit_length() - 1 + size
            b = gaps[gap].pop()
            if not gaps[gap]:
                there &= ~(1 << gap)
        else:
            b, gap = len(used), capacity
            used.append(0)
        sequence[i], offset[i] = first + b, used[b]
        used[b] += size
        gaps[gap - size].append(b)
        there |= 1 << (gap - size)
    return sequence, offset


def pieces_of(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``(id_col, piece, start, length, ids_crc32[, ids])``: whole texts as ids with ``end_id`` behind, cut at ``capacity``.

    A null text is empty: one piece that holds the end id. Null and repeated ids are kept as they are.
    """
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType())])
    for name in ("start", "length", "ids_crc32"):
        schema = schema.add(name, "long")
    if with_ids:
        schema = schema.add("ids", "binary")

    def step(batches):
        code = coder(vocabulary)
        for batch in pieces(batches, "text"):
            flat, cuts = with_ends(*code.encode(batch.column("text")), end_id)
            raw = memoryview(flat.astype("<u4")).cast("B")
            sizes = np.diff(cuts)
            parts = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), parts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * capacity
            length = np.minimum(sizes[row] - start, capacity)
            at = cuts[row] + start
            cut = [raw[4 * a : 4 * b] for a, b in zip(at, at + length)]
            out = [batch.column("id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64())]
            out.append(pa.array(list(map(zlib.crc32, cut)), pa.int64()))
            if with_ids:
                out.append(pa.array([bytes(c) for c in cut], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, schema.fieldNames())

    asked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return asked.mapInArrow(step, schema).withColumnRenamed("id", id_col)


def pack_pieces(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (written once before) with ``sequence_id`` and ``offset``. Sequence ids are unique, not consecutive. No pieces: no rows.

    Pieces are dealt to buckets by a hash of ``_deal``, a number of each row, where ``cut`` has it; else by their own values.
    """
    buckets = max(1, -(-cut.count() // BUCKET_PIECES))
    held = cut.drop("_deal")
    schema = T.StructType([*held.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def pack(key, table):
        sequence, offset = pack_lengths(table.column("length").to_numpy(), capacity)
        own = table.drop_columns(["_bucket"])
        own = own.append_column("sequence_id", pa.array(sequence + (key[0].as_py() << 32), pa.int64()))
        return own.append_column("offset", pa.array(offset, pa.int64()))

    by = ["_deal"] if "_deal" in cut.columns else [c for c in cut.columns if c != "ids"]
    dealt = cut.withColumn("_bucket", F.pmod(F.xxhash64(*by), F.lit(buckets))).drop("_deal")
    return dealt.groupBy("_bucket").applyInArrow(pack, schema)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset)`` of all documents; no documents, no rows.

    Rows that repeat, also those without an id, are documents of their own. Other columns are not read.
    """
    cut = pieces_of(docs, vocabulary, end_id, capacity, with_ids=with_ids)
    # A number of its own deals each piece, so that equal rows do not meet in one bucket; it is fixed by this copy.
    return pack_pieces(stage(cut.withColumn("_deal", F.monotonically_increasing_id()), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the ids of each sequence in place, little-endian 32-bit; one group is one sequence at most."""
    placed = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    joined = F.aggregate("p", F.lit("").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return placed.select("sequence_id", joined.alias("ids"))
