"""Toxicity: a convolutional text classifier in numpy over hashed words, with thresholds calibrated by language.

Words and word beginnings are hashed into embedding tables; filters of several widths slide over a text, each keeps its
largest response, and a logistic layer reads those. Embeddings, filters and weights are trained together by gradient descent;
the first embedding dimension starts as the log-odds of a bucket over the training documents. The language is told from the
text alone, by its function words. On training documents a threshold is chosen for each language, and scores
are shifted so that this threshold is at 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm.tables import pieces
from tenura.session import small_table, stage

BUCKETS = 1 << 18
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 6
# Bounds of the training sample: documents, and bytes of text; the sample is the rows of least hash that fit, a row that does not being passed over.
TRAIN_DOCS = 8_000
TRAIN_BYTES = 32 << 20
# Steps of gradient descent, on batches of so many documents; small samples are gone through more often.
STEPS = 500
BATCH = 64
# Rows of each label that a threshold is chosen on at least, and parts for fitting on some and choosing on others.
ENOUGH = 20
FOLDS = 5
RATE = 0.02
# Documents with the common rate of labels that a bucket is counted with besides its own.
PRIOR = 8
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_SPAN = 1 << 16
# Bytes of text hashed at a time.
_BLOCK = 1 << 19

# Function words that tell languages apart.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with as was on are by this be at from or an have not which",
    "de": "der die und das ist nicht mit von den zu ein eine auf dem sich auch im für als wie werden",
    "fr": "le la les et des est un une dans que qui pour par sur pas du au avec ce il sont plus",
    "es": "el los las y de que en un una por con para es se del no su al lo como más",
}


# --- words as numbers ------------------------------------------------------------------------------------------------


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte whether it belongs to a word, and what it counts as; powers of the multiplier and of its inverse."""
    byte = np.arange(256)
    word = ((byte >= 48) & (byte <= 57)) | ((byte >= 65) & (byte <= 90)) | ((byte >= 97) & (byte <= 122)) | (byte >= 128)
    value = np.where((byte >= 65) & (byte <= 90), byte + 32, byte).astype(np.uint64) + np.uint64(1)
    inverse = pow(_MULTIPLIER, -1, 1 << 64)
    powers = [np.empty(_SPAN, np.uint64), np.empty(_SPAN, np.uint64)]
    for table, factor in zip(powers, (_MULTIPLIER, inverse)):
        table[0] = 1
        table[1:] = np.uint64(factor)
        np.multiply.accumulate(table, out=table)
    return word, value, np.stack(powers)


_IN_WORD, _VALUE, _POWERS = _tables()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _hash_runs(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of raw[start:end] for each run, by differences of one running sum; equal runs hash alike wherever they stand."""
    place = np.arange(len(raw)) % _SPAN
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[raw] * _POWERS[0][place], dtype=np.uint64)])
    # A power is counted anew every _SPAN bytes; a run over such a border is put together from its parts.
    h = (sums[ends] - sums[starts]) * _POWERS[1][starts % _SPAN]
    for i in np.flatnonzero((ends - 1) // _SPAN != starts // _SPAN).tolist():
        run, total = raw[starts[i] : ends[i]], 0
        for at in range(0, len(run), _SPAN):
            part = _VALUE[run[at : at + _SPAN]]
            total += int((part * _POWERS[0][: len(part)]).sum(dtype=np.uint64)) * pow(_MULTIPLIER, at, 1 << 64)
        h[i] = total & 0xFFFFFFFFFFFFFFFF
    return _mixed(h)


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, hash of its first five bytes, offsets): text i has words[offsets[i]:offsets[i + 1]].

    Words are runs of ASCII letters and digits and of characters beyond ASCII; A-Z count as a-z. Null counts as empty.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    base, end = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[base:end] if end > base else np.zeros(0, np.uint8)
    cuts = offsets - base
    inside = _IN_WORD[raw]
    begins = np.zeros(len(raw) + 1, bool)
    begins[cuts] = True
    starts = np.flatnonzero(inside & (~np.concatenate([[False], inside[:-1]]) | begins[:-1])) if len(raw) else np.zeros(0, np.int64)
    ends = np.flatnonzero(inside & (~np.concatenate([inside[1:], [False]]) | begins[1:])) + 1 if len(raw) else np.zeros(0, np.int64)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return none, none, np.zeros(len(cuts), np.int64)
    whole, head = np.empty(len(starts), np.uint64), np.empty(len(starts), np.uint64)
    blocks = np.flatnonzero(np.diff(starts // _BLOCK, prepend=-1))
    for a, b in zip(blocks, np.append(blocks[1:], len(starts))):
        own, at = raw[starts[a] : ends[b - 1]], starts[a]
        whole[a:b] = _hash_runs(own, starts[a:b] - at, ends[a:b] - at)
        head[a:b] = _hash_runs(own, starts[a:b] - at, np.minimum(ends[a:b], starts[a:b] + 5) - at)
    return whole, head, np.searchsorted(starts, cuts)


def _function_table() -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all function words, sorted, and in which languages each is one."""
    hashes = [hashed_words(pa.array([v]))[0] for v in FUNCTION_WORDS.values()]
    every = np.unique(np.concatenate(hashes))
    return every, np.stack([np.isin(every, h) for h in hashes])


def languages(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of the language with the most function words in each text (as in ``FUNCTION_WORDS``), the last number + 1 for none."""
    every, member = _function_table()
    place = np.minimum(np.searchsorted(every, words), len(every) - 1)
    hit = np.flatnonzero(every[place] == words)
    text = np.searchsorted(offsets, hit, "right") - 1
    n = len(offsets) - 1
    counts = np.stack([np.bincount(text, weights=m[place[hit]], minlength=n) for m in member])
    return np.where(counts.max(0, initial=0) > 0, counts.argmax(0), len(counts))


# --- the network -------------------------------------------------------------------------------------------------------


@dataclass
class Network:
    """Embeddings (two tables, added), filters by width, the logistic layer, and the shift of each language."""

    words: np.ndarray
    starts: np.ndarray
    filters: list[np.ndarray]
    weights: np.ndarray
    bias: float
    shifts: np.ndarray

    def logits(self, ids: np.ndarray, heads: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Every word goes through the tables once per filter and place; long texts are taken a span at a time."""
        pooled = self._pool(ids, heads, offsets)
        return pooled @ self.weights + self.bias

    def _pool(self, ids, heads, offsets):
        n = len(offsets) - 1
        out = np.zeros((n, sum(f.shape[2] for f in self.filters)))
        step = 1 << 18
        for at in range(0, len(ids), step):
            stop = min(len(ids), at + step + max(WIDTHS) - 1)
            row = self.words[ids[at:stop]] + self.starts[heads[at:stop]]
            last = min(len(ids), at + step)
            done = 0
            for f in self.filters:
                width = f.shape[0]
                m = min(last - at, len(row) - width + 1)
                if m > 0:
                    response = sum(row[k : k + m] @ f[k] for k in range(width))
                    self._maxima(response, at, offsets, width, out[:, done : done + f.shape[2]])
                done += f.shape[2]
        return out

    @staticmethod
    def _maxima(response, at, offsets, width, out):
        """Largest response of each text, over the windows that end within it."""
        first = np.maximum(offsets[:-1] - at, 0)
        stop = np.minimum(offsets[1:] - width + 1 - at, len(response))
        own = np.flatnonzero(stop > first)
        if len(own):
            edges = np.stack([first[own], stop[own]], 1).ravel()
            padded = np.concatenate([response, np.full((1, response.shape[1]), -np.inf, response.dtype)])
            out[own] = np.maximum(out[own], np.maximum.reduceat(padded, edges, axis=0)[::2])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int32)


def _encoded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word buckets, buckets of word beginnings, offsets, languages) of all texts."""
    ids, heads, sizes, language = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(texts), 256):
        words, starts, offsets = hashed_words(texts[at : at + 256])
        ids.append(_buckets(words))
        heads.append(_buckets(starts))
        sizes.append(np.diff(offsets))
        language.append(languages(words, offsets))
    return np.concatenate(ids), np.concatenate(heads), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), np.concatenate(language)


def _log_odds(ids: np.ndarray, document: np.ndarray, label: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of each bucket, from the documents that hold it: log-odds of label 1 against all documents, drawn to 0 where few do."""
    one, all_ = np.zeros(BUCKETS), np.zeros(BUCKETS)
    borders = np.searchsorted(document, np.arange(0, len(label) + 200, 200))
    for a, b in zip(borders, borders[1:]):  # a few documents at a time
        seen = np.unique(document[a:b].astype(np.int64) * BUCKETS + ids[a:b])
        one += np.bincount(seen % BUCKETS, weights=label[seen // BUCKETS], minlength=BUCKETS)
        all_ += np.bincount(seen % BUCKETS, minlength=BUCKETS)
    rate = label[rows].mean()
    return np.log((one + PRIOR * rate) / (all_ + PRIOR) / rate) - np.log((all_ - one + PRIOR * (1 - rate)) / (all_ + PRIOR) / (1 - rate))


def _fit(ids, heads, offsets, label, rows, seed: int) -> Network:
    """The network fitted to some of the rows, not calibrated yet. With one label only, every score is that label's share."""
    rng = np.random.default_rng(seed)
    rate = float(np.clip(label[rows].mean() if len(rows) else 0.0, 1e-3, 1 - 1e-3))
    table = [rng.normal(0, 0.05, (BUCKETS, DIMENSIONS)).astype(np.float32) for _ in range(2)]
    filters = [rng.normal(0, 0.1, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
    n = sum(f.shape[2] for f in filters)
    net = Network(table[0], table[1], filters, np.full(n, 0.1), float(np.log(rate / (1 - rate))), np.zeros(len(FUNCTION_WORDS) + 1))
    if len(np.unique(label[rows])) < 2:
        net.weights = np.zeros(n)
        return net
    chosen = np.zeros(len(label), bool)
    chosen[rows] = True
    document = np.repeat(np.arange(len(label), dtype=np.int32), np.diff(offsets))
    own = chosen[document]
    table[0][:, 0] = _log_odds(ids[own], document[own], label, rows) * 0.7
    table[1][:, 0] = _log_odds(heads[own], document[own], label, rows) * 0.3
    for f in filters:
        f[:, 0, :] += 0.5 / f.shape[0]
    for epoch in range(max(2, min(30, -(-STEPS * BATCH // max(1, len(rows)))))):
        for batch in np.array_split(rng.permutation(rows), max(1, len(rows) // BATCH)):
            _descend(net, ids, heads, offsets, batch, label, RATE / (1 + epoch / 2))
    return net


def train(texts: pa.Array, label: np.ndarray, seed: int = 7) -> Network:
    """Fit the network to whole texts with labels 0 and 1, and calibrate it on texts that it was not fitted to.

    A fifth of the rows is kept for that; where that holds few rows of either label, each of ``FOLDS`` parts of the rows
    is scored by a network fitted to the others, and the last network is fitted to all.
    """
    ids, heads, offsets, language = _encoded(texts)
    part = np.random.default_rng(seed).permutation(len(label)) % FOLDS
    held = np.flatnonzero(part == 0)
    if min(label[held].sum(), (1 - label[held]).sum()) >= ENOUGH:
        net = _fit(ids, heads, offsets, label, np.flatnonzero(part), seed)
        net.shifts = _calibrate(net.logits(ids, heads, offsets)[held], language[held], label[held])
        return net
    net = _fit(ids, heads, offsets, label, np.arange(len(label)), seed)
    if len(np.unique(label)) == 2:
        logit = np.zeros(len(label))
        for fold in range(FOLDS):
            other = _fit(ids, heads, offsets, label, np.flatnonzero(part != fold), seed)
            logit[part == fold] = other.logits(ids, heads, offsets)[part == fold]
        net.shifts = _calibrate(logit, language, label)
    return net


def _descend(net, ids, heads, offsets, batch, label, rate):
    """One step of stochastic gradient descent; of each text and filter only the window of the largest response matters."""
    size = offsets[batch + 1] - offsets[batch]
    cut = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(cut[-1]) - np.repeat(cut[:-1] - offsets[batch], size)
    own, head = ids[place], heads[place]
    row = net.words[own] + net.starts[head]
    pooled, where = [], []
    for f in net.filters:
        width, n = f.shape[0], f.shape[2]
        best, at = np.zeros((len(batch), n), np.float32), np.full((len(batch), n), -1)
        if len(row) >= width:
            response = sum(row[k : len(row) - width + 1 + k] @ f[k] for k in range(width))
            for i in range(len(batch)):
                a, b = cut[i], cut[i + 1] - width + 1
                if b > a:
                    top = response[a:b].argmax(0)
                    value = response[a:b][top, np.arange(n)]
                    best[i], at[i] = np.maximum(value, 0), np.where(value > 0, top + a, -1)
        pooled.append(best)
        where.append(at)
    features = np.concatenate(pooled, 1)
    error = _sigmoid(features @ net.weights + net.bias) - label[batch]
    back = error[:, None] * net.weights[None, :]
    net.weights -= rate * (features.T @ error) / len(batch)
    net.bias -= rate * float(error.mean())
    done = 0
    for f, at in zip(net.filters, where):
        i, j = np.nonzero(at >= 0)
        slope = back[i, done + j].astype(np.float32)
        done += f.shape[2]
        for k in range(f.shape[0]):
            p = at[i, j] + k
            step = np.zeros_like(f[k].T)
            np.add.at(step, j, slope[:, None] * row[p])
            grown = slope[:, None] * f[k].T[j]
            f[k] -= rate * step.T / len(batch)
            np.add.at(net.words, own[p], -rate * grown)
            np.add.at(net.starts, head[p], -rate * 0.3 * grown)


def _calibrate(logit: np.ndarray, language: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The threshold of each language: that of the best F1, over all languages where one has few rows of a label."""

    def best(rows):
        order = rows[np.argsort(-logit[rows], kind="stable")]
        hits = np.cumsum(label[order])
        f1 = 2 * hits / (np.arange(1, len(order) + 1) + label[order].sum())
        k = int(f1.argmax())
        below = logit[order[k + 1]] if k + 1 < len(order) else logit[order[k]] - 1
        return (logit[order[k]] + below) / 2

    out = np.full(len(FUNCTION_WORDS) + 1, best(np.arange(len(label))))
    for k in range(len(out)):
        rows = np.flatnonzero(language == k)
        if min(label[rows].sum(), (1 - label[rows]).sum()) >= ENOUGH:
            out[k] = best(rows)
    return out


def score_texts(net: Network, texts: pa.Array) -> np.ndarray:
    ids, heads, offsets, language = _encoded(texts)
    return _sigmoid(net.logits(ids, heads, offsets) - net.shifts[language])


# --- tables ----------------------------------------------------------------------------------------------------------------


def held_out(doc_id):
    """Rows whose label is never learnt from: crc32 of the id as text leaves no remainder by five. A null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _fitting(sizes: DataFrame) -> list[tuple]:
    """(id, label) of the rows of ``sizes`` (_id, _toxic, _bytes, _place) that the sample takes, in the order of ``_place``.

    As many rows at a time as are still wanted come to the driver, and only such as fit by themselves, so the first of them is
    always taken.
    """
    chosen: list[tuple] = []
    left, after = TRAIN_BYTES, None
    while len(chosen) < TRAIN_DOCS:
        rest = sizes.where(F.col("_bytes") <= left)
        if after:
            rest = rest.where((F.col("_place") > after[0]) | ((F.col("_place") == after[0]) & (F.col("_id") > F.lit(after[1]))))
        found = rest.orderBy("_place", "_id").limit(TRAIN_DOCS - len(chosen)).collect()
        if not found:
            break
        for r in found:
            if r["_bytes"] <= left:
                chosen.append((r["_id"], r["_toxic"]))
                left -= r["_bytes"]
        after = (found[-1]["_place"], found[-1]["_id"])
    return chosen


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    """Train on a bounded sample of labelled rows of ``docs`` that are not held out.

    The sample is at most ``TRAIN_DOCS`` rows and ``TRAIN_BYTES`` of whole texts, taken in the order of a hash of the id. A text
    that does not fit is passed over and costs only itself; of texts with one id the shortest counts. Rows
    without id or label, and labels other than 0 and 1, are passed over. Without any labelled row every score is near 0.
    """
    known = labels.where(F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("_toxic"))
    known = known.where(~held_out(F.col("_id")))
    rows = docs.select(F.col("doc_id").alias("_own"), F.col("text").alias("_text"), F.octet_length("text").alias("_bytes"))
    least = rows.groupBy("_own").agg(F.coalesce(F.min("_bytes"), F.lit(0)).alias("_bytes"))
    sizes = known.join(least, F.col("_own") == F.col("_id")).select("_id", "_toxic", "_bytes", F.xxhash64("_id").alias("_place"))
    sizes = stage(sizes, "labelled")
    chosen = small_table(docs.sparkSession, _fitting(sizes), ", ".join(f"{c} {t}" for c, t in sizes.select("_id", "_toxic").dtypes))
    rows = rows.join(F.broadcast(chosen), F.col("_own") == F.col("_id"))
    shortest = F.min(F.when(F.col("_text").isNotNull(), F.struct("_bytes", "_text")))
    sample = rows.groupBy("_id").agg(shortest["_text"].alias("_text"), F.max("_toxic").alias("_toxic")).toArrow()
    sample = sample.take(pc.sort_indices(sample, sort_keys=[("_id", "ascending"), ("_text", "ascending")]))
    texts = sample.column("_text").combine_chunks() if sample.num_rows else pa.array([], pa.string())
    return train(texts, sample.column("_toxic").to_numpy().astype(np.float64))


def score(docs: DataFrame, net: Network, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``; null and empty texts are scored too. Such columns are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    held = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")])

    def step(batches):
        for batch in pieces(batches, text_col):
            values = score_texts(shared.value, batch.column(text_col))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], names=[*batch.schema.names, "score"])

    out = held.mapInArrow(step, T.StructType([*held.schema.fields, T.StructField("score", T.DoubleType())]))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean(docs: DataFrame, net: Network) -> DataFrame:
    """The documents that are not predicted to be toxic, with the columns of ``docs``; no row is moved."""
    held = {c: f"__{c}" for c in docs.columns if c in ("score", "predicted")}
    scored = score(docs.withColumnsRenamed(held), net)
    return scored.where(F.col("predicted") == 0).select(*[F.col(held.get(c, c)).alias(c) for c in docs.columns])
