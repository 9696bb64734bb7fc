"""Removal of repeated passages against a plain version."""

import hashlib
from collections import Counter

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tenura.llm import substring_dedup as sub

SCHEMA = "doc_id bigint, text string"


def held(df):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.text, r.kept_sha256) for r in df.collect())


def want(rows, window):
    return Counter((i, n, g, t, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in plain.cut_repeats(rows, window))


@pytest.mark.parametrize("window, hot", [(3, 4096), (3, 1), (50, 4096), (50, 0), (9, 2), (1, 4096)])
def test_edges(edge, window, hot):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert held(sub.remove_repeats(edge, window=window, hot_runs=hot)) == want(rows, window)


def test_extra_columns_with_the_names_used_inside(edge):
    odd = edge.select("doc_id", "text", *[F.lit(7).alias(c) for c in ("key", "_key", "spans", "words", "o", "at", "m", "n_words", "__maybe", "__hash")])
    out = sub.remove_repeats(odd, window=4)
    assert out.columns == ["doc_id", "text", "key", "_key", "spans", "words", "o", "at", "m", "__maybe", "__hash", "n_words", "n_removed", "kept_sha256"]
    assert held(out) == want([(r.doc_id, r.text) for r in edge.collect()], 4)


def test_no_rows(empty):
    assert sub.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("hot", [4096, 20])
def test_a_passage_in_a_third_of_all_rows(spark, hot):
    """Copies, a shared passage in changing surroundings, one repeated word, repeated rows, and passages that end at the edges of a text."""
    rng = np.random.default_rng(3)
    passage = " ".join(f"p{i}" for i in range(70))
    rows = []
    for i in range(240):
        own = [f"w{x}" for x in rng.integers(0, 400, int(rng.integers(0, 150)))]
        at = int(rng.integers(0, len(own) + 1))
        if i % 3 == 0:
            own[at:at] = passage.split()
        rows.append((i, "\n\t"[i % 2].join(own)))
    rows += [(1000, rows[5][1]), (1000, rows[5][1]), (1001, "same " * 1500), (1002, "same " * 70 + "other"), (None, rows[9][1]), (-1, passage), (7, passage)]
    rows += [(1003, " ".join(f"q{i}" for i in range(49))), (1004, " ".join(f"q{i}" for i in range(50))), (1005, " ".join(f"q{i}" for i in range(50)))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = held(sub.remove_repeats(df, hot_runs=hot))
    assert got == want(rows, 50)
    assert sum(k[2] > 0 for k in got) > 80


def test_different_windows_of_one_hash_are_told_apart():
    rng = np.random.default_rng(4)
    texts = [" ".join("abc"[x] for x in rng.integers(0, 3, 40)) for _ in range(12)]
    least = np.arange(12)[::-1].copy()
    strong, first = sub.first_ids(pa.array(texts, pa.binary()), least, 4)
    for weaken in (58, 63):
        weak, _ = sub.first_ids(pa.array(texts, pa.binary()), least, 4, weaken=weaken)
        assert (weak == strong).all()
    split = [t.split() for t in texts]
    plainly = {}
    for o, w in zip(least.tolist(), split):
        for a in range(37):
            plainly[tuple(w[a : a + 4])] = min(o, plainly.get(tuple(w[a : a + 4]), o))
    assert strong.tolist() == [plainly[tuple(w[a : a + 4])] for w in split for a in range(37)]


def test_runs_cover_each_window_once():
    rng = np.random.default_rng(5)
    texts = [" ".join(str(x) for x in rng.integers(0, 50, n)) for n in (0, 3, 49, 50, 51, 700, 60)] + ["x " * 1200]
    least, row, start, count = sub.runs_of(sub.Words(pa.array(texts, pa.binary())), 50)
    words = [len(t.split()) for t in texts]
    assert Counter(np.repeat(row, count).tolist()) == Counter({i: n - 49 for i, n in enumerate(words) if n >= 50})
    assert len(set(np.concatenate([np.arange(a, a + n) for a, n in zip(start, count)]).tolist())) == count.sum()
    assert count.max() <= 512 and count[:-3].mean() > 10


def test_whole_table(spark, sf, pair_ids):
    got = held(sub.remove_repeats(spark.read.parquet(f"{sf}/documents.parquet")))
    assert got == want(pair_ids, 50)
