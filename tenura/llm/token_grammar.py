"""Token ids on disk as Re-Pair grammars: one grammar a shard, with expansion lengths for decoding any range of ids.

A shard holds the ids of consecutive documents. Again and again the pairs of neighbouring symbols that occur most are
replaced by new symbols, many pairs a pass, until no pair occurs often enough. Stored are the rules, how many ids each rule stands
for, and the sequence that is left. A range of ids is found by a binary search in the running lengths of that sequence, and
only the symbols it meets are expanded.

Shards are rows of a Parquet table in the shared folder, so Spark's commit of task output guards against lost executors.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm.tables import pieces
from tenura.llm.words import coder
from tenura.session import new_folder, small_table

SHARD_IDS = 1 << 18
# Bytes of text that a task sorts: the less of them while parts are few, the more beyond, as every reader takes a block from every writer.
PART_BYTES, MOST_PART_BYTES, MANY_PARTS = 16 << 20, 32 << 20, 2000
# A pair is worth a rule from this many uses on; after a pass that saves less than this share of the sequence pairs are counted exactly.
LEAST_USES = 4
LEAST_GAIN = 0.03
SLOT_BITS = 20
# Ids below this are looked up in a table when a shard is decoded.
TABLE_IDS = 1 << 20
_SLOTS = 1 << SLOT_BITS
_HEAD = struct.Struct("<4sIIII")


def _counts(pair: np.ndarray) -> np.ndarray:
    """For each pair how often it occurs at most, by hashed slots; 0 where that is not enough."""
    slot = ((pair * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    score = np.bincount(slot, minlength=_SLOTS)[slot]
    score[score < LEAST_USES] = 0
    return score


def _ranks(pair: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each pair, at places ``at``, its rank by uses that do not overlap, no two pairs alike; 0 for pairs of too few uses.

    All uses of the highest rank win against their neighbours, so as long as a pair has enough uses one is replaced.
    """
    out = np.zeros(len(pair), np.int64)
    found = np.flatnonzero(_counts(pair))  # a pair has no more uses than its slot
    if len(found):
        own, place = pair[found], at[found]
        fresh = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (np.diff(place) > 1)]))
        run = np.diff(np.append(fresh, len(own)))
        kinds, kind = np.unique(own[fresh], return_inverse=True)
        uses = np.bincount(kind, weights=(run + 1) // 2, minlength=len(kinds)).astype(np.int64)
        rank = np.empty(len(kinds), np.int64)
        rank[np.argsort(uses, kind="stable")] = np.arange(1, len(kinds) + 1)
        rank[uses < LEAST_USES] = 0
        out[found] = np.repeat(rank[kind], run)
    return out


def _winners(score: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the pairs at places ``at`` are replaced: of overlapping ones the more frequent; in a run of equal ones every second."""
    beside = np.diff(at) == 1
    before = np.append(0, np.where(beside, score[:-1], 0))
    after = np.append(np.where(beside, score[1:], 0), 0)
    fresh = np.flatnonzero(score != before)
    run = np.diff(np.append(fresh, len(score)))
    place = np.arange(len(score)) - np.repeat(fresh, run)
    late = np.repeat(before[fresh] > score[fresh], run)
    return (score >= after) & (place % 2 == late)


def compress(ids: np.ndarray) -> bytes:
    """One grammar for ``ids`` (unsigned 32-bit, any values that leave room for new symbols). No ids: an empty grammar.

    A pair of too few uses never gets more of them, as only pairs with a new symbol are new. So a pass looks at the places that had
    enough uses in the pass before and at those beside its replacements, which soon are few.
    """
    seq = ids.astype(np.uint32)
    base = int(seq.max()) + 1 if len(seq) else 0
    left, right, rules = [], [], 0
    exact = False
    live = np.arange(max(len(seq) - 1, 0))
    while len(live):
        pair = (seq[live].astype(np.uint64) << np.uint64(32)) | seq[live + 1]
        score = _ranks(pair, live) if exact else _counts(pair)
        enough = score > 0
        live, pair, score = live[enough], pair[enough], score[enough]
        if not len(live):
            if exact:
                break
            exact = True
            continue
        won = _winners(score, live)
        kinds, kind, uses = np.unique(pair[won], return_inverse=True, return_counts=True)
        worth = uses >= LEAST_USES
        at, kind = live[won][worth[kind]], kind[worth[kind]]
        if exact and not len(at):
            break
        # Counts by slot mix pairs; late passes, of few pairs, count each pair for itself, and so find the last one.
        exact = exact or len(at) < LEAST_GAIN * len(seq)
        if not len(at):
            continue
        symbol = np.cumsum(worth) - 1 + base + rules
        seq[at] = symbol[kind]
        touched = np.zeros(len(seq), bool)
        touched[live] = True
        touched[at[at > 0] - 1] = touched[at] = True
        # The place that goes is that of the right half; what follows it moves up beside the new symbol.
        touched[at + 1] = False
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, touched = seq[keep], touched[keep]
        live = np.flatnonzero(touched[:-1])
        left.append((kinds[worth] >> np.uint64(32)).astype(np.uint32))
        right.append(kinds[worth].astype(np.uint32))
        rules += int(worth.sum())
    pairs = np.stack([np.concatenate(left), np.concatenate(right)], 1) if left else np.zeros((0, 2), np.uint32)
    lengths = np.ones(rules, np.uint32)
    done = 0
    for part in left:  # the rules of one pass stand on those of the passes before
        own = slice(done, done + len(part))
        lengths[own] = sum(np.where(side >= base, lengths[np.maximum(side.astype(np.int64) - base, 0)], 1) for side in pairs[own].T)
        done += len(part)
    wide = base + rules > 0xFFFF
    body = seq.astype("<u4" if wide else "<u2").tobytes()
    return _HEAD.pack(b"RPG1", base, rules, len(seq), wide) + pairs.astype("<u4").tobytes() + lengths.astype("<u4").tobytes() + body


def _read(blob: bytes):
    magic, base, rules, n, wide = _HEAD.unpack_from(blob)
    if magic != b"RPG1":
        raise ValueError("not a shard of token ids")
    at = _HEAD.size
    pairs = np.frombuffer(blob, "<u4", 2 * rules, at).reshape(-1, 2)
    lengths = np.frombuffer(blob, "<u4", rules, at + 8 * rules)
    seq = np.frombuffer(blob, "<u4" if wide else "<u2", n, at + 12 * rules).astype(np.uint32)
    return base, pairs, lengths, seq


def _flat(base: int, pairs: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, start, length): what each symbol stands for, one after the other. Rules stand on rules before them, so they are laid out in turns."""
    rules = len(pairs)
    size = np.ones(base + rules, np.int64)
    size[base:] = lengths
    start = np.zeros(base + rules, np.int64)
    start[:base] = np.arange(base)
    start[base:] = base + np.cumsum(lengths, dtype=np.int64) - lengths
    ids = np.empty(base + int(lengths.sum(dtype=np.int64)), np.uint32)
    ids[:base] = np.arange(base)
    todo, halves = np.arange(rules), pairs.astype(np.int64)
    done = np.ones(base + rules, bool)
    done[base:] = False
    while len(todo):
        ready = done[halves[todo]].all(1)
        own, todo = todo[ready], todo[~ready]
        for side, shift in ((0, 0), (1, size[halves[own, 0]])):
            part = halves[own, side]
            ids[_stretches(start[base + own] + shift, size[part])] = ids[_stretches(start[part], size[part])]
        done[base + own] = True
    return ids, start, size


def _stretches(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ..., then start[1], ...: ``size`` of each."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)


def _expand(seq: np.ndarray, base: int, pairs: np.ndarray) -> np.ndarray:
    """What a few symbols stand for, level by level."""
    while True:
        new = seq >= base
        if not new.any():
            return seq
        place = np.arange(len(seq)) + np.cumsum(new) - new
        out = np.empty(len(seq) + int(new.sum()), np.uint32)
        rule = pairs[seq[new] - base]
        out[place[~new]] = seq[~new]
        out[place[new]], out[place[new] + 1] = rule[:, 0], rule[:, 1]
        seq = out


def decompress(blob: bytes) -> np.ndarray:
    """All ids of a shard, in one gather from what its symbols stand for."""
    base, pairs, lengths, seq = _read(blob)
    if base > TABLE_IDS:
        return _expand(seq, base, pairs)
    ids, start, size = _flat(base, pairs, lengths)
    return ids[_stretches(start[seq], size[seq])]


def decode_range(blob: bytes, start: int, stop: int) -> np.ndarray:
    """ids[start:stop] of a shard; only the symbols that reach into the range are expanded."""
    base, pairs, lengths, seq = _read(blob)
    each = np.ones(len(seq), np.int64)
    new = seq >= base
    each[new] = lengths[seq[new] - base]
    ends = np.cumsum(each)
    stop = min(stop, int(ends[-1]) if len(ends) else 0)
    if start >= stop:
        return np.zeros(0, np.uint32)
    a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
    skipped = int(ends[a] - each[a])
    return _expand(seq[a:b], base, pairs)[start - skipped : stop - skipped]


def _parts(size: int) -> int:
    """Range partitions for so many bytes of text."""
    return max(1, min(-(-size // PART_BYTES), max(MANY_PARTS, -(-size // MOST_PART_BYTES))))


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, end it with ``end_id``, and write the ids in ascending order of ``id_col``.

    Null texts are empty and hold the end id only. Null ids come first. Rows with one id follow each other in the order of
    their texts' hashes. No rows: a table without shards.
    """
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    spread = max(_parts(size), min(docs.sparkSession.sparkContext.defaultParallelism, -(-size // (4 << 20)) or 1))

    def step(batches):
        code = coder(vocabulary)
        part, seq, offset = TaskContext.get().partitionId(), 0, 0
        ids, counts, names, held = [], [], [], 0

        def shard():
            nonlocal ids, counts, names, held, seq, offset
            n = int(np.concatenate(counts).sum())
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([offset], pa.int64()), pa.array([n], pa.int64()),
                    pa.array([[x for c in names for x in c]], pa.list_(pa.int64())), pa.array([np.concatenate(counts).tolist()], pa.list_(pa.int64())),
                    pa.array([compress(np.concatenate(ids))], pa.binary()),
                ],
                ["part", "seq", "part_offset", "n_ids", "doc_ids", "doc_counts", "grammar"],
            )
            ids, counts, names, held, seq, offset = [], [], [], 0, seq + 1, offset + n
            return row

        for piece in pieces(batches, "text"):
            flat, cuts = with_ends(*code.encode(piece.column("text")), end_id)
            known = piece.column("id").to_pylist()
            # Shards end between documents; a document larger than a shard has one of its own size.
            a = 0
            while a < len(known):
                b = int(np.searchsorted(cuts, cuts[a] + SHARD_IDS - held, "left"))
                b = min(max(b, a + 1), len(known))
                ids.append(flat[cuts[a] : cuts[b]])
                counts.append(np.diff(cuts[a : b + 1]))
                names.append(known[a:b])
                held += int(cuts[b] - cuts[a])
                a = b
                if held >= SHARD_IDS:
                    yield shard()
        if names:
            yield shard()

    ordered = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keys = [F.col("id"), F.xxhash64("text")]
    ordered = ordered.repartitionByRange(spread, *keys).sortWithinPartitions(*keys)
    schema = "part int, seq int, part_offset bigint, n_ids bigint, doc_ids array<bigint>, doc_counts array<bigint>, grammar binary"
    ordered.mapInArrow(step, schema).write.parquet(folder)


def with_ends(flat: np.ndarray, cuts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts with ``end_id`` behind each, and the new offsets."""
    n = len(cuts) - 1
    out = np.full(len(flat) + n, end_id, np.uint32)
    out[np.arange(len(flat)) + np.repeat(np.arange(n), np.diff(cuts))] = flat
    return out, cuts + np.arange(n + 1)


def _shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shards with ``first``: how many ids stand before each. One number a written partition goes through the driver."""
    shards = spark.read.parquet(folder)
    totals = sorted((r[0], r[1]) for r in shards.groupBy("part").agg(F.sum("n_ids")).collect())
    starts, at = [], 0
    for part, n in totals:
        starts.append((part, at))
        at += n
    bases = small_table(spark, starts, "part int, base bigint")
    return shards.join(F.broadcast(bases), "part").withColumn("first", F.col("base") + F.col("part_offset"))


def read_documents(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document, from the files: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``."""

    def step(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pydict()
                ids = decompress(one["grammar"][0]).astype("<u4")
                cuts = np.concatenate([[0], np.cumsum(one["doc_counts"][0])]).astype(np.int64)
                raw = memoryview(ids).cast("B") if len(ids) else b""
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cuts, cuts[1:])]
                out = [pa.array(one["doc_ids"][0], pa.int64()), pa.array(cuts[:-1] + one["first"][0]), pa.array(np.diff(cuts)), pa.array(sums, pa.int64())]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(out, names)

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    return _shards(spark, folder).select("first", "doc_ids", "doc_counts", "grammar").mapInArrow(step, schema)


def read_ids(spark: SparkSession, folder: str, start: int, stop: int) -> list[int]:
    """ids[start:stop] of the whole stream: only shards that reach into the range are read, and only in that range."""

    def step(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_range(row["grammar"], max(0, start - row["first"]), stop - row["first"])
                yield pa.RecordBatch.from_arrays([pa.array([row["first"]], pa.int64()), pa.array([ids.astype(np.int64).tolist()], pa.list_(pa.int64()))], ["first", "ids"])

    met = _shards(spark, folder).where((F.col("first") < stop) & (F.col("first") + F.col("n_ids") > start))
    rows = met.select("first", "grammar").mapInArrow(step, "first bigint, ids array<bigint>").collect()
    return [i for r in sorted(rows) for i in r["ids"]]


def token_table(docs: DataFrame, vocabulary: str, end_id: int = 1) -> DataFrame:
    """Write the ids of ``docs`` to a new folder in the shared place and read them back, a row a document."""
    folder = new_folder(docs.sparkSession, "tokens")
    write_tokens(docs, folder, vocabulary, end_id)
    return read_documents(docs.sparkSession, folder)
