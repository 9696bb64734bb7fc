"""How far the sources of each language differ in their terms, by a cube of (source block, source block, term block) cells.

Sources are dealt into blocks by hash and so are terms. A cell holds the counts of two source blocks for one term block; its slices
are replicated, one copy to each block that they are compared with. A cell gives a partial divergence for each of its pairs, and
the partial ones are summed along the term axis. Terms that neither source of a pair has are not shipped: their share is the
same for all of them, and the first term block accounts for it.

All arithmetic is on whole numbers. Counts may reach 10 ** 15.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenura.llm.tables import pieces
from tenura.session import stage

# A language keeps the terms that so many of its documents hold.
LEAST_DOCS = 10
# Terms listed for a source.
TOP_TERMS = 10
# Expected sources and terms of a block; a cell's matrices have twice as many rows as a block has sources.
GROUP_BLOCK = 64
TERM_BLOCK = 4096
# Entries that a task counts before it sends them on.
_HELD = 200_000

# Over UTF-8 bytes: A-Z lowered, a-z and all beyond ASCII kept, the rest blank.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def _counted(batches):
    """Task step: (lang, source, text) to partial (lang, source, term, count, docs)."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def rows():
        for (lang, source), (counts, docs) in held.items():
            n = len(counts)
            terms = pa.array(counts.keys(), pa.binary()).cast(pa.string(), safe=False)
            columns = [pa.repeat(pa.scalar(lang, pa.string()), n), pa.repeat(pa.scalar(source, pa.string()), n), terms]
            columns += [pa.array(counts.values(), pa.int64()), pa.array([docs[t] for t in counts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "count", "docs"])

    new = 0
    for batch in pieces(batches, "text"):
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, batch.column("text").to_pylist()):
            counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
            words, before = terms_of(text), len(counts)
            counts.update(words)
            docs.update(set(words))
            new += len(counts) - before
        if new >= _HELD:
            yield from rows()
            held, new = {}, 0
    yield from rows()


def _cell(key, table):
    """Group step: the partial divergences of one cell; rows without a term name the cell's sources."""
    a, b, t = (k.as_py() for k in key[1:])
    named = table.filter(pc.is_null(table["term"])).sort_by("source")
    names, block = named["source"].to_pylist(), named["block"].to_numpy()
    zero, kept = named["p"].to_numpy().astype(np.int64), named["kept"].to_numpy()
    held = table.filter(pc.is_valid(table["term"]))
    at = pc.index_in(held["source"], pa.array(names, pa.string())).to_numpy()
    terms = held["term"].combine_chunks().dictionary_encode()
    if isinstance(terms, pa.ChunkedArray):
        terms = terms.combine_chunks()
    width = len(terms.dictionary)
    p = np.repeat(zero[:, None], width, axis=1)
    p[at, terms.indices.to_numpy()] = held["p"].to_numpy()
    left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
    first, second, value = [], [], []
    for i in left.tolist():
        others = right[right > i] if a == b else right
        if not len(others):
            continue
        bare = (zero[i] - zero[others]) ** 2 // (zero[i] + zero[others])
        found = ((p[i] - p[others]) ** 2 // (p[i] + p[others])).sum(axis=1) - width * bare
        if t == 0:
            found = found + kept[i] * bare
        first += [names[i]] * len(others)
        second += [names[j] for j in others.tolist()]
        value.append(found)
    values = np.concatenate(value) if value else np.empty(0, np.int64)
    return pa.table({"first": pa.array(first, pa.string()), "second": pa.array(second, pa.string()), "value": pa.array(values, pa.int64())})


def _p(count: str, base: str) -> str:
    """1 + floor(10**9 * (count + 2) / base), exact."""
    return f"CAST(1 + (CAST(1000000000 AS DECIMAL(10,0)) * CAST({count} + 2 AS DECIMAL(18,0))) div CAST({base} AS DECIMAL(19,0)) AS BIGINT)"


def _f(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def _ranked(df: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    return df.withColumn("rank", F.row_number().over(order))


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_docs: int = LEAST_DOCS,
    top_terms: int = TOP_TERMS,
    group_block: int = GROUP_BLOCK,
    term_block: int = TERM_BLOCK,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: for every source the divergence from each other source of its language, and the
    terms that set it apart from the language.

    A null text, language or source is empty, and empty ones are languages and sources like others. A row is a document: rows that
    repeat count again. A language without kept terms has pairs of value 0 and no terms; a source that is alone has no pairs. Equal
    values rank by the bytes of the item. Other columns are not read. No rows: no rows.
    """
    own = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))]
    read = docs.select(*own, F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    parts = read.mapInArrow(_counted, "lang string, source string, term string, count bigint, docs bigint")
    counts = stage(parts.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs")), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("total"))
    kept = stage(kept.where(F.col("docs") >= least_docs).select("lang", "term", "total"), "kept")
    held = stage(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "count", "total"), "held")

    groups = read.select("lang", "source").distinct().join(held.groupBy("lang", "source").agg(F.sum("count").alias("n")), ["lang", "source"], "left")
    groups = stage(groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n")), "groups")
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.sum("n").alias("lang_n"))
    sizes = langs.join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept")), "lang", "left")
    sizes = sizes.withColumn("kept", F.coalesce("kept", F.lit(0)))
    blocks = {"group_blocks": F.ceil(F.col("sources") / group_block), "term_blocks": F.greatest(F.ceil(F.col("kept") / term_block), F.lit(1))}
    sized = stage(groups.join(sizes.withColumns(blocks), "lang"), "sized")
    zero = F.when(F.col("kept") > 0, F.expr(_p("0", "n + 2 * kept"))).otherwise(F.lit(1))
    named = sized.select("*", F.pmod(F.xxhash64("source"), "group_blocks").alias("block"), zero.alias("zero"))
    priced = held.join(named, ["lang", "source"])
    priced = priced.select("*", F.expr(_p("count", "n + 2 * kept")).alias("p"), F.expr(_p("total", "lang_n + 2 * kept")).alias("q"))

    apart = priced.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_f("p", "q")).alias("value"))
    terms = _ranked(apart).where(F.col("rank") <= top_terms)

    facing = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("group_blocks") - 1)).alias("other")
    cell = ["lang", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "t", "source", "block", "term", "p", "kept"]
    in_block = F.pmod(F.xxhash64("term"), "term_blocks").alias("t")
    slices = priced.select("lang", in_block, "source", "block", "term", "p", "kept", facing).select(*cell)
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("term_blocks") - 1)).alias("t")
    marks = named.select("lang", every, "source", "block", F.lit(None).cast("string").alias("term"), F.col("zero").alias("p"), "kept", "group_blocks")
    marks = marks.select("*", facing).select(*cell)
    found = slices.unionByName(marks).groupBy("lang", "a", "b", "t").applyInArrow(_with_lang, "lang string, first string, second string, value bigint")
    summed = found.groupBy("lang", "first", "second").agg(F.sum("value").alias("value"))
    both = F.array(*[F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (("first", "second"), ("second", "first"))])
    pairs = summed.select("lang", F.inline(both), "value").select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return _ranked(pairs).unionByName(terms)


def _with_lang(key, table):
    found = _cell(key, table)
    return found.add_column(0, "lang", pa.repeat(pa.scalar(key[0].as_py(), pa.string()), found.num_rows))
