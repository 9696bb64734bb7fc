"""The divergence audit against a plain version."""

from collections import Counter

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from tenura.llm import divergence

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def held(df):
    return Counter(tuple(r) for r in df.select(COLUMNS).collect())


@pytest.mark.parametrize("blocks", [{}, {"group_block": 2, "term_block": 3}])
def test_edges(edge, blocks):
    rows = [(r.lang, r.source, r.text) for r in edge.collect()]
    got = held(divergence.audit(edge, least_docs=2, **blocks))
    assert got == Counter(plain.divergences(rows, 2, divergence.TOP_TERMS))
    assert any(k[1] == "" for k in got)


def test_many_sources_over_many_cells(spark):
    rng = np.random.default_rng(2)
    names = [f"s{i}" for i in range(11)] + [None, ""]
    # One source holds a third of all rows; one language has no kept term, one source of another no term at all.
    rows = []
    for i in range(300):
        source = "s0" if i % 3 == 0 else names[rng.integers(len(names))]
        words = [f"{'abcdefghij'[rng.integers(10)]}É{'XyZ'[rng.integers(3)]}" for _ in range(int(rng.integers(0, 30)))]
        rows.append(("en" if i % 4 else None, source, " ,7".join(words)))
    rows += [("xx", "s1", "rare"), ("xx", "s2", ""), ("en", "mute", "12 34")]
    df = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("count", F.lit(1)).withColumn("term", F.lit("x"))
    want = Counter(plain.divergences(rows, 10, 10))
    assert held(divergence.audit(df.repartition(5), group_block=3, term_block=4)) == want
    assert held(divergence.audit(df.repartition(2))) == want
    assert {k[4] for k in want if k[0] == "xx"} == {0}


def test_no_rows(empty):
    assert divergence.audit(empty).count() == 0


def test_large_counts_stay_exact(spark):
    """p of counts beyond 32 bits, and of a count times 10**9 beyond 64."""
    df = spark.createDataFrame([(10**14, 3 * 10**14 + 1)], "c bigint, b bigint")
    assert df.select(F.expr(divergence._p("c", "b"))).first()[0] == 1 + 10**9 * (10**14 + 2) // (3 * 10**14 + 1)
