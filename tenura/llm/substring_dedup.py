"""Repeated passages by super-k-mers: runs of windows that share a minimiser travel as one packed string to its bucket.

A window is ``window`` consecutive words; its minimiser is the least hash of its runs of ``_MINI`` words. Neighbouring windows mostly
share it, so a document is cut into few runs of windows, and each run is sent once, as the words it spans. Equal windows have equal
minimisers and meet in one bucket. There the windows are sorted by a rolling hash, windows of equal hash are compared word by word,
and each distinct window gets the least document id that holds it.

- A first pass counts (minimiser, least id, greatest id). Only runs whose minimiser occurs under two ids may hold a repeat; a Bloom
  filter of bounded size names these minimisers, and other runs are not sent at all.
- A minimiser of more than ``HOT_RUNS`` runs would make one large bucket. Which ones these are is told by a second filter, so that all
  runs of a minimiser take the same way. Their windows travel alone, as SHA-256 digests that are aggregated before the shuffle; the
  few digests with a thousandth of the rows or more are broadcast, the others joined.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm import bloom
from tenura.llm.tables import free_name, pieces
from tenura.session import stage

WINDOW = 50
# Words of a minimiser; windows of fewer words take all of theirs.
_MINI = 8
# Runs of one minimiser beyond which its windows go by digest.
HOT_RUNS = 4096
# Windows of one run at most, so that a text of one repeated word makes rows of bounded size.
_RUN_WINDOWS = 512
# Windows that a bucket task sorts at once (whole buckets).
_SORTED = 1 << 18
# A digest with one occurrence in so many, or more, is broadcast; there are at most as many of them.
_ONE_IN = 1000

# Bytes of text hashed at once.
_HASHED = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of stretches of a sequence of 64-bit values, by prefix sums of value times power."""

    _up, _down = _powers(_MULTIPLIER, 1 << 16), _powers(_INVERSE, 1 << 16)

    @classmethod
    def _grow(cls, n: int) -> None:
        if n > len(cls._up):
            size = 1 << (n - 1).bit_length()
            cls._up, cls._down = _powers(_MULTIPLIER, size), _powers(_INVERSE, size)

    def __init__(self, values: np.ndarray):
        self._grow(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self._up[: len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[stop] - self.sums[start]) * self._down[start])


class Words:
    """The words of several texts at once: places in one buffer, the row that each belongs to, and a hash of each."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and len(column) else np.empty(0, np.uint8)
        at = ends - ends[0]
        inside = ~_SPACE[raw]
        # A word also ends where its text ends.
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        edges = at[:-1][at[:-1] < len(raw)]
        first[edges] = inside[edges]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        shut = at[1:][at[1:] > 0] - 1
        last[shut] = inside[shut]
        self.raw, self.start, self.stop = raw, np.flatnonzero(first), np.flatnonzero(last) + 1
        # Words before each text; ``row`` of a word follows from it.
        self.before = np.searchsorted(self.start, at)
        self.n = len(self.start)

    def hashes(self) -> np.ndarray:
        """A hash of each word, some ``_HASHED`` bytes at a time."""
        out = np.empty(self.n, np.uint64)
        cuts = np.append(np.flatnonzero(np.diff(self.start // _HASHED, prepend=-1)), self.n)
        for i, j in zip(cuts[:-1], cuts[1:]):
            start, stop = self.start[i:j] - self.start[i], self.stop[i:j] - self.start[i]
            # One added, so that a zero byte counts, and the length, so that no word is the beginning of another in value.
            rolled = Rolling(self.raw[self.start[i] : self.stop[j - 1]].astype(np.uint64) + np.uint64(1)).of(start, stop)
            out[i:j] = _mixed(rolled + (stop - start).astype(np.uint64))
        return out

    def joined(self) -> tuple[bytes, np.ndarray]:
        """All words with one blank after each, and where each word starts in that (with the end as last entry)."""
        size = self.stop - self.start + 1
        at = np.zeros(self.n + 1, np.int64)
        np.cumsum(size, out=at[1:])
        out = np.full(int(at[-1]), 32, np.uint8)
        if self.n:
            # The buffer without white space is the words in order; they are laid out with a gap after each.
            keep = np.ones(len(out), bool)
            keep[at[1:] - 1] = False
            out[keep] = self.raw[~_SPACE[self.raw]]
        return out.tobytes(), at


def _least_over(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    have, span = values, 1
    while 2 * span <= width:
        have = np.minimum(have[:-span], have[span:])
        span *= 2
    rest = width - span
    return np.minimum(have[: len(have) - rest], have[rest:]) if rest else have


def runs_of(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, row, first window, number of windows) of all runs; windows are numbered by the word that they start with, over all rows."""
    none = np.empty(0, np.int64)
    if words.n < window:
        return none.astype(np.uint64), none, none, none
    mini = min(_MINI, window)
    at = np.arange(words.n - mini + 1)
    least = _least_over(Rolling(words.hashes()).of(at, at + mini), window - mini + 1)
    # Windows that cross from one text into the next are none.
    row = np.repeat(np.arange(len(words.before) - 1), np.diff(words.before))
    start = np.arange(len(least))
    start = start[row[start] == row[start + window - 1]]
    if not len(start):
        return none.astype(np.uint64), none, none, none
    least, own = least[start], row[start]
    new = np.ones(len(start), bool)
    new[1:] = (least[1:] != least[:-1]) | (own[1:] != own[:-1])
    # Long runs are cut at multiples of a fixed number of words of their text.
    new |= (start - words.before[own]) % _RUN_WINDOWS == 0
    cut = np.flatnonzero(new)
    # Least hashes are small numbers; mixed again, they spread over buckets and filters.
    return _mixed(least[cut]), own[cut], start[cut], np.diff(cut, append=len(start))


def _described(window: int):
    """Task step: (o, text) to (m, o) of each run."""

    def step(batches):
        for batch in pieces(batches, "text"):
            least, row, _, _ = runs_of(Words(batch.column("text")), window)
            yield pa.RecordBatch.from_arrays([pa.array(least.view(np.int64)), batch.column("o").take(pa.array(row))], ["m", "o"])

    return step


class Filter:
    """A Bloom filter on the driver, to be sent to the tasks."""

    def __init__(self, hashes: DataFrame):
        table, self.segments = bloom.build(hashes, hashes.count(), 1)
        self.words = np.zeros((self.segments, bloom.SEGMENT_BITS // 64), np.uint64)
        for part in table.toLocalIterator():
            self.words[part["segment"]] = np.array(part["words"], np.int64).view(np.uint64)

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        segment, positions = bloom.positions(hashes.view(np.int64), self.segments)
        found = np.ones(len(hashes), bool)
        for p in positions.T:
            found &= (self.words[segment, p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) == 1
        return found


def _packed(window: int, filters, hot: bool):
    """Task step: (key, o, text) to the runs that may repeat, (m, key, o, at, words) each; the hot ones or the others."""

    def step(batches):
        repeated, large = filters.value
        for batch in pieces(batches, "text"):
            words = Words(batch.column("text"))
            least, row, start, count = runs_of(words, window)
            if not len(least):
                continue
            want = repeated.maybe(least)
            want[want] = large.maybe(least[want]) == hot
            least, row, start, count = least[want], row[want], start[want], count[want]
            if not len(least):
                continue
            joined, at = words.joined()
            a, b = at[start].tolist(), (at[start + count + window - 1] - 1).tolist()
            text = pa.array([joined[i:j] for i, j in zip(a, b)], pa.binary())
            own = pa.array(row)
            columns = [pa.array(least.view(np.int64)), batch.column("key").take(own), batch.column("o").take(own), pa.array(start - words.before[row]), text]
            yield pa.RecordBatch.from_arrays(columns, ["m", "key", "o", "at", "words"])

    return step


def first_ids(texts: pa.Array, least: np.ndarray, window: int, weaken: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """For distinct packed runs with the least id of each: the least id of every window, run after run, and where each run starts.

    Windows are sorted by rolling hash; of equal hashes the words are compared. ``weaken`` drops bits of the hash, for tests.
    """
    words = Words(texts)
    count = np.diff(words.before) - window + 1
    first = np.zeros(len(count) + 1, np.int64)
    np.cumsum(count, out=first[1:])
    run = np.repeat(np.arange(len(count)), count)
    start = np.arange(first[-1]) + (words.before[:-1] - first[:-1])[run]
    hashes = Rolling(words.hashes()).of(start, start + window) >> np.uint64(weaken)
    out = least[run]
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    twin = ordered[1:] == ordered[:-1]
    held = np.zeros(len(order), bool)
    held[1:] |= twin
    held[:-1] |= twin
    order, ordered = order[held], ordered[held]
    if not len(order):
        return out, first
    # Words by value: equal numbers are equal words.
    size, places = (words.stop - words.start).tolist(), words.start.tolist()
    raw, numbers = words.raw.tobytes(), {}
    number = np.array([numbers.setdefault(raw[a : a + n], len(numbers)) for a, n in zip(places, size)], np.int32)
    group = np.cumsum(np.append(True, ordered[1:] != ordered[:-1])) - 1
    lead = order[np.append(True, ordered[1:] != ordered[:-1])][group]
    equal = np.ones(len(order), bool)
    for j in range(window):
        equal &= number[start[order] + j] == number[start[lead] + j]
    if not equal.all():
        # Different windows of one hash: those groups are sorted by their words.
        wrong = np.isin(group, group[~equal])
        rows = number[start[order[wrong]][:, None] + np.arange(window)]
        _, inner = np.unique(rows, axis=0, return_inverse=True)
        group[wrong] = group[-1] + 1 + inner.ravel()
        by = np.argsort(group, kind="stable")
        order, group = order[by], group[by]
    cut = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    low = np.minimum.reduceat(out[order], cut)
    out[order] = np.repeat(low, np.diff(cut, append=len(order)))
    return out, first


def _spans(gone: np.ndarray, first: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, stop) of covered words, where ``gone`` marks windows, row after row, and ``at`` is a row's first word."""
    new = gone.copy()
    new[1:] &= ~gone[:-1]
    new[first[:-1]] = gone[first[:-1]]
    last = gone.copy()
    last[:-1] &= ~gone[1:]
    last[first[1:] - 1] = gone[first[1:] - 1]
    a, b = np.flatnonzero(new), np.flatnonzero(last)
    row = np.searchsorted(first, a, side="right") - 1
    base = at[row] - first[row]
    return row, a + base, b + base + window


def _sorted_buckets(window: int):
    """Task step over runs ordered by minimiser: whole buckets at a time, to (key, start, stop) of the words that go."""

    def found(table):
        texts = table.column("words").combine_chunks().dictionary_encode()
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        which, ids = texts.indices.to_numpy(), table.column("o").to_numpy()
        least = np.full(len(texts.dictionary), np.iinfo(np.int64).max)
        np.minimum.at(least, which, ids)
        low, first = first_ids(texts.dictionary, least, window)
        count = np.diff(first)[which]
        ends = np.zeros(len(which) + 1, np.int64)
        np.cumsum(count, out=ends[1:])
        flat = np.arange(ends[-1]) + np.repeat(first[which] - ends[:-1], count)
        gone = low[flat] < np.repeat(ids, count)
        row, start, stop = _spans(gone, ends, table.column("at").to_numpy(), window)
        key = table.column("key").take(pa.array(row)).combine_chunks()
        key = key if isinstance(key, pa.Array) else pa.concat_arrays(key.chunks)
        return pa.RecordBatch.from_arrays([key, pa.array(start), pa.array(stop)], ["key", "start", "stop"])

    def several(table):
        """Rows of buckets with more than one id."""
        m, o = table.column("m").to_numpy(), table.column("o").to_numpy()
        cut = np.flatnonzero(np.append(True, m[1:] != m[:-1]))
        mixed = np.minimum.reduceat(o, cut) != np.maximum.reduceat(o, cut)
        return table.filter(pa.array(np.repeat(mixed, np.diff(cut, append=len(m)))))

    def whole(held):
        table = several(pa.Table.from_batches(held))
        if table.num_rows:
            yield found(table)

    def step(batches):
        held, size, last = [], 0, None
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                m = batch.column("m").to_numpy()
                if size >= _SORTED and m[at] != last:
                    yield from whole(held)
                    held, size = [], 0
                # As far as the buckets that are begun reach, or to the row that fills the measure.
                weight = np.cumsum(pc.binary_length(batch.column("words").slice(at)).to_numpy(zero_copy_only=False) // 6)
                over = int(np.searchsorted(weight, max(_SORTED - size, 1)))
                stop = min(at + over + 1, batch.num_rows)
                same_m = np.flatnonzero(m[stop:] != m[stop - 1])
                stop = stop + int(same_m[0]) if len(same_m) else batch.num_rows
                held.append(batch.slice(at, stop - at))
                size += int(weight[stop - at - 1])
                last, at = m[stop - 1], stop
        if held:
            yield from whole(held)

    return step


def _digests(window: int):
    """Task step: hot runs to one row for each window: its SHA-256, key, o, and the word it starts at."""

    def step(batches):
        for batch in pieces(batches, "words"):
            words = Words(batch.column("words"))
            joined, at = words.joined()
            count = np.diff(words.before) - window + 1
            row = np.repeat(np.arange(len(count)), count)
            number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = words.before[:-1][row] + number
            a, b = at[start].tolist(), (at[start + window] - 1).tolist()
            digest = pa.array([hashlib.sha256(joined[i:j]).digest() for i, j in zip(a, b)], pa.binary())
            own = pa.array(row)
            columns = [digest, batch.column("key").take(own), batch.column("o").take(own), pa.array(batch.column("at").to_numpy()[row] + number)]
            yield pa.RecordBatch.from_arrays(columns, ["digest", "key", "o", "at"])

    return step


def _hot_spans(hot: DataFrame, window: int) -> DataFrame:
    """(key, start, stop) of the windows of hot minimisers that go."""
    each = stage(hot.mapInArrow(_digests(window), "digest binary, key binary, o bigint, at bigint"), "digests")
    ids = each.groupBy("digest").agg(F.min("o").alias("low"), F.max("o").alias("high"), F.count(F.lit(1)).alias("n"))
    ids = stage(ids.where("low <> high").select(F.col("digest").alias("d"), "low", "n"), "repeats")
    often = F.col("n") * _ONE_IN >= F.lit(each.count())
    wide = each.join(F.broadcast(ids.where(often)), F.col("digest") == F.col("d"))
    rest = each.join(F.broadcast(ids.where(often).select("d")), F.col("digest") == F.col("d"), "left_anti")
    rest = rest.join(ids.where(~often), F.col("digest") == F.col("d"))
    gone = wide.unionByName(rest).where("low < o")
    return gone.select("key", F.col("at").alias("start"), (F.col("at") + window).alias("stop"))


def _cut(texts, spans) -> tuple[list, list, list]:
    """(words, words that go, SHA-256 of the rest) of each text, given the spans of words that go."""
    total, gone, shas = [], [], []
    for text, own in zip(texts, spans):
        words = text.split()
        total.append(len(words))
        if own:
            kept, at, n = [], 0, 0
            for a, b in sorted((s["start"], s["stop"]) for s in own):
                kept += words[at:a]
                n += max(0, b - max(a, at))
                at = max(at, b)
            words = kept + words[at:]
            gone.append(n)
        else:
            gone.append(0)
        shas.append(words)
    return total, gone, shas


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, hot_runs: int = HOT_RUNS) -> DataFrame:
    """``(key, spans)``: the words that go of each text under each id, staged; ``key`` is ``row_key`` of id and text.

    Nothing is returned for rows that lose no word. Spans are word ranges, in no order, and may overlap.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    order = F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63)))
    read = docs.select(row_key(id_col, text_col).alias("key"), order.alias("o"), text.alias("text"))
    described = read.select("o", "text").mapInArrow(_described(window), "m bigint, o bigint")
    counted = described.groupBy("m").agg(F.count(F.lit(1)).alias("n"), F.min("o").alias("low"), F.max("o").alias("high"))
    counted = stage(counted.where("low <> high").select("m", "n"), "minimisers")
    filters = spark.sparkContext.broadcast((Filter(counted.select("m")), Filter(counted.where(F.col("n") > hot_runs).select("m"))))
    schema = "m bigint, key binary, o bigint, at bigint, words binary"
    spread = read.mapInArrow(_packed(window, filters, False), schema).repartition("m").sortWithinPartitions("m")
    found = spread.mapInArrow(_sorted_buckets(window), "key binary, start bigint, stop bigint")
    if counted.where(F.col("n") > hot_runs).limit(1).count():
        found = found.unionByName(_hot_spans(read.mapInArrow(_packed(window, filters, True), schema), window))
    # Rows that repeat id and text give the same spans.
    return stage(found.distinct().groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "spans")


def row_key(id_col: str, text_col: str):
    """Names a text under an id; rows with one key lose the same words."""
    own = F.coalesce(F.col(id_col).cast("bigint").cast("string"), F.lit("null"))
    return F.unhex(F.md5(F.concat(own, F.lit(" "), F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("binary")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, hot_runs: int = HOT_RUNS) -> DataFrame:
    """``docs`` with the text less the words of repeated windows, and ``n_words``, ``n_removed`` and ``kept_sha256``.

    A word goes if a window that covers it also starts in a document with a smaller id; what an id's own texts repeat among
    themselves stays. Kept words are joined by one blank. A null text has no words and becomes empty. A null id is the smallest;
    ids are whole numbers. Columns of ``docs`` with the names of the added ones are replaced. No rows: no rows.
    """
    added = ["n_words", "n_removed", "kept_sha256"]
    df = docs.select(*[c for c in docs.columns if c not in added or c in (id_col, text_col)])
    spans = repeated_spans(docs, id_col, text_col, window, hot_runs)
    name, mark = free_name(df, "key"), free_name(df, "spans")
    few = spans.select(F.col("key").alias(name), F.col("spans").alias(mark))
    key = row_key(id_col, text_col)
    met = bloom.joined(df, few, key, name, key == F.col(name)).drop(name)
    others = [c for c in df.columns if c != text_col]
    schema = df.select(*others).withColumn(text_col, F.lit("")).withColumns(
        {"n_words": F.lit(0).cast("bigint"), "n_removed": F.lit(0).cast("bigint"), "kept_sha256": F.lit("")}
    ).schema
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias(text_col)

    def step(batches):
        for batch in pieces(batches, text_col):
            total, gone, kept = _cut(batch.column(text_col).to_pylist(), batch.column(mark).to_pylist())
            texts = [b" ".join(w) for w in kept]
            columns = [batch.column(c) for c in others]
            columns += [pa.array(texts, pa.binary()).cast(pa.string(), safe=False), pa.array(total, pa.int64()), pa.array(gone, pa.int64())]
            columns.append(pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return met.select(*others, body, mark).mapInArrow(step, schema).select(*df.columns, *added)
