"""Benchmark decontamination by Wu-Manber search over words.

The search strings are runs of ``WINDOW`` consecutive words of the items; an item of fewer words is one string. A block is
two neighbouring words. The shift table says how far the end of the window may move on from a block: past every place where
a string could still end. Where it may not move, the block's bucket holds the strings that end in it, and they are
compared word by word. Strings of one length share their tables.

The items are few against the documents; they are broadcast in parts of at most ``PART_BYTES`` of text, one reading of the texts a part.
"""

from __future__ import annotations

import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm import bloom
from tenura.llm.tables import free_name, pieces
from tenura.session import stage

WINDOW = 13
PART_BYTES = 4 << 20
# A document is contaminated when one word in this many, or more, is hit.
ONE_WORD_IN = 20
# What a search adds to its documents.
MADE = ["n_words", "n_hit", "spans", "items", "items_sha256", "contaminated"]
# Over UTF-8 bytes, A-Z lowered: digits, letters, and every byte of a character beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower())


class Strings:
    """Search strings of one length, with the tables for them. A bucket holds each string once, with the items that have it."""

    def __init__(self, length: int, places: list[tuple]):
        self.length, self.block = length, min(2, length)
        self.default = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for words, start, item in places:
            own = tuple(words[start : start + length])
            last = self._block(words, start + length)
            held = self.buckets.setdefault(last, {})
            if own in held:
                held[own].add(item)
                continue
            held[own] = {item}
            for end in range(start + self.block, start + length + 1):
                block = self._block(words, end)
                far = start + length - end
                if far < self.shift.get(block, self.default):
                    self.shift[block] = far

    def _block(self, words: list[bytes], end: int):
        return (words[end - 2], words[end - 1]) if self.block == 2 else words[end - 1]

    def ends(self, words: list[bytes]):
        """(end, items) of every place where a string ends: it is words[end - length:end]. Ends rise."""
        length, default, shift, pairs = self.length, self.default, self.shift.get, self.block == 2
        end, n = length, len(words)
        while end <= n:
            block = (words[end - 2], words[end - 1]) if pairs else words[end - 1]
            far = shift(block, default)
            if far:
                end += far
                continue
            items = self.buckets[block].get(tuple(words[end - length : end]))
            if items:
                yield end, items
            end += 1


def tables_of(items: list[tuple], window: int = WINDOW) -> list[Strings]:
    """Tables for (item id, text) pairs; a null text and a text without words give none."""
    by_length: dict[int, list[tuple]] = {}
    for item, text in items:
        words = words_of(text or "")
        size = min(window, len(words))
        if size:
            by_length.setdefault(size, []).extend((words, at, item) for at in range(len(words) - size + 1))
    return [Strings(size, places) for size, places in sorted(by_length.items())]


def spans_in(words: list[bytes], tables: list[Strings]) -> tuple[list[tuple[int, int]], set]:
    """Disjoint runs of words that occurrences cover, in order, and the items that occur. Runs are merged as they are found."""
    found: list[tuple[int, int]] = []
    items: set = set()
    for table in tables:
        own: list[list[int]] = []
        last = None
        for end, names in table.ends(words):
            if own and end - table.length <= own[-1][1]:
                own[-1][1] = end
            else:
                own.append([end - table.length, end])
            if names is not last:
                items |= names
                last = names
        found += own
    return merged(found), items


def merged(spans: list) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(tuple(s) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _parts(benchmark: DataFrame, item_col: str, text_col: str):
    """The items in parts of bounded size, streamed to the driver one partition at a time."""
    part, size = [], 0
    for row in benchmark.select(item_col, text_col).distinct().toLocalIterator():
        part.append((row[0], row[1]))
        size += len(row[1] or "")
        if size >= PART_BYTES:
            yield part
            part, size = [], 0
    yield part


def _search(text_col: str):
    """What a search gives of a batch: number of words, spans and items of each text."""
    cell = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def search(tables, batch):
        counts, spans, items = [], [], []
        for text in batch.column(text_col).to_pylist():
            words = words_of(text or "")
            own, names = spans_in(words, tables)
            counts.append(len(words))
            spans.append([{"start": a, "stop": b} for a, b in own])
            items.append(sorted({str(x) for x in names if x is not None}))
        return [pa.array(counts, pa.int64()), pa.array(spans, cell), pa.array(items, pa.list_(pa.string()))]

    return search


def find_items(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``spans`` (word ranges), ``items`` (ids that occur, sorted as strings),
    ``items_sha256`` and ``contaminated``.

    A null text has no words: nothing is hit. Items without words never occur; windows of an item without id mark words, but
    such an item is neither listed nor counted. Items with one id are one item. Columns of these names in ``docs`` are replaced. No
    documents: no rows; no items: nothing is hit.

    The first part of the items is searched as the documents are read. With more parts, what this gives is written once, each further
    part reads the texts alone and gives a row for each document that it hits, and only these documents are joined.
    """
    spark = docs.sparkSession
    df = docs.select(*[c for c in docs.columns if c not in MADE])
    parts = _parts(benchmark, item_col, item_text)
    search = _search(text_col)
    made = T.StructType.fromDDL("n_words bigint, spans array<struct<start:bigint,stop:bigint>>, items array<string>")

    def over(frame: DataFrame, kept: list[str], part: list[tuple]) -> DataFrame:
        tables = spark.sparkContext.broadcast(tables_of(part, window))
        schema = T.StructType([*(frame.schema[c] for c in kept), *made.fields])

        def step(batches):
            for batch in pieces(batches, text_col):
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *search(tables.value, batch)], names=schema.names)

        return frame.mapInArrow(step, schema)

    found = over(df, df.columns, next(parts))
    following = next(parts, None)
    if following is not None:
        found = _with_parts(found, df, text_col, following, parts, over)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    found = found.withColumn("n_hit", hit).withColumn("items_sha256", F.sha2(F.concat_ws(",", "items"), 256))
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * ONE_WORD_IN >= F.col("n_words")))


def _with_parts(found: DataFrame, df: DataFrame, text_col: str, part: list[tuple], parts, over) -> DataFrame:
    """``found`` with what the further parts find."""
    row, key, spans, items = (free_name(found, n) for n in ("row", "key", "all_spans", "all_items"))
    base = stage(found.withColumn(row, F.monotonically_increasing_id()), "searched")
    hits = [base.select(row, "spans", "items")]
    while part is not None:
        more = over(base.select(row, text_col), [row], part).where(F.size("spans") > 0)
        hits.append(stage(more.select(row, "spans", "items"), "hits"))
        part = next(parts, None)
    every = reduce(DataFrame.unionByName, hits).where(F.size("spans") > 0)
    # A document's spans of all parts: at most as many as it has words, times the parts.
    each = every.groupBy(row).agg(F.count(F.lit(1)).alias("n"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def merge(batches):
        for batch in batches:
            joined = [[{"start": a, "stop": b} for a, b in merged([(s["start"], s["stop"]) for s in own])] for own in batch.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(row), pa.array(joined, batch.column("spans").type), batch.column("items")], names=[row, "spans", "items"])

    few = each.select(row, "spans", "items")
    few = few.mapInArrow(merge, few.schema).select(F.col(row).alias(key), F.col("spans").alias(spans), F.col("items").alias(items))
    met = bloom.joined(base, stage(few, "hits"), F.col(row), key, F.col(row) == F.col(key))
    cells = {"spans": F.coalesce(spans, "spans"), "items": F.coalesce(items, "items")}
    return met.select(*[cells.get(c, F.col(c)).alias(c) for c in found.columns])


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with the columns of ``docs``; no row is moved."""
    held = {c: f"_kept_{c}" for c in docs.columns if c in MADE}
    found = find_items(docs.withColumnsRenamed(held), benchmark, window)
    return found.where(~F.col("contaminated")).select(*[F.col(held.get(c, c)).alias(c) for c in docs.columns])
