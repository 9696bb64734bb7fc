"""Ranks, running totals, medians and cuts against brute force, with hot keys and both ways of every size switch."""

import hashlib
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tenura.functions.order import global_rank, group_summary, numeric_summary, running_totals
from tenura.operators import evaluation as E
from tenura.operators import features as FE
from tenura.operators import splitting as SP
from tenura.session import small_table


@pytest.mark.parametrize("small", [0, 10_000])
def test_running_totals_with_a_hot_group(spark, small):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"g{i % 7}", i, rng.randint(0, 9)) for i in range(1500)]
    rng.shuffle(rows)
    df = small_table(spark, rows, "g string, k bigint, v bigint").repartition(5)
    got = {(r["g"], r["k"]): r["before_v"] for r in running_totals(df, ["k"], ["v"], ["g"], partitions=6, small=small).collect()}
    want, seen = {}, {}
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        want[g, k] = seen.get(g, 0)
        seen[g] = want[g, k] + v
    assert got == want


@pytest.mark.parametrize("small", [0, 10_000])
def test_global_rank_without_group(spark, small):
    df = spark.range(2000).select((F.col("id") * 7919 % 2003).alias("k"))
    ranks = global_rank(df, ["k"], partitions=7, small=small).orderBy("k").collect()
    assert [r["rank"] for r in ranks] == list(range(1, 2001))


def test_null_groups_keep_their_rows(spark):
    df = small_table(spark, [(None, 1, 5), (None, 2, 6), ("a", 1, 7)], "g string, k bigint, v bigint")
    for small in (0, 100):
        got = sorted((r["g"] or "", r["k"], r["before_v"]) for r in running_totals(df, ["k"], ["v"], ["g"], small=small).collect())
        assert got == [("", 1, 0), ("", 2, 5), ("a", 1, 0)]


def test_running_totals_move_rows_once(spark):
    """One exchange by ranges; the sums are joined when the staged rows are read. Nulls add nothing, doubles are summed too."""
    rows = [(None if i % 5 == 0 else f"g{i % 3}", i, i % 4 or None, i / 8) for i in range(400)]
    df = small_table(spark, rows, "g string, k bigint, v bigint, w double").repartition(3)
    out = running_totals(df, ["k"], ["v", "w"], ["g"], partitions=7, small=0)
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r["k"]: (r["before_v"], r["before_w"]) for r in out.collect()}
    seen, want = {}, {}
    for g, k, v, w in rows:
        want[k] = seen.get(g, (0, 0.0))
        seen[g] = (want[k][0] + (v or 0), want[k][1] + w)
    assert got == want


CASES = {
    "even": [1.0, 2.0, 3.0, 10.0],
    "one": [5.0],
    "hot": [3.0] * 700 + [float(i) / 7 for i in range(900)],
    "wide": [1e-300, 1e300, -1e300, 0.0, 1.0, -1.0, 2.0, 1e-5],
    "negative": [-float(i) / 3 for i in range(501)],
    "close": [1.0 + i * 2.0**-52 for i in range(64)],
    "infinite": [float("-inf"), 1.0, 2.0, float("inf")],
}


def test_exact_medians_of_many_groups(spark):
    """Each case as a group and as a column, a hot group, a null group, a group without values; against ``numeric_summary`` of its rows."""
    rng = random.Random(9)
    rows = [(name, x, x * 2 if math.isfinite(x * 2) else x) for name, values in CASES.items() for x in values]
    rows += [("hot group", float(rng.randint(0, 50)), rng.random()) for _ in range(4000)] + [(None, 1.0, None), (None, 4.0, float("nan")), ("none", None, None)]
    rng.shuffle(rows)
    df = small_table(spark, rows, "g string, a double, b double").repartition(4)
    got = {(r["g"], r["column"]): r for r in group_summary(df, ["a", "b"], ["g"]).collect()}
    assert set(got) == {(g, c) for g in {r[0] for r in rows} for c in "ab"} - {(None, "b"), ("none", "a"), ("none", "b")}
    for (g, c), r in got.items():
        values = [x for h, *v in rows if h == g and (x := v["ab".index(c)]) is not None and x == x]
        low, high = sorted(values)[(len(values) - 1) // 2], sorted(values)[len(values) // 2]
        assert (r["n"], r["min"], r["max"]) == (len(values), min(values), max(values))
        assert r["median"] == (low if low == high else low + (high - low) * 0.5), (g, c)


def test_exact_medians(spark):
    longest = max(map(len, CASES.values()))
    rows = [tuple(v[i] if i < len(v) else (None if i % 2 else float("nan")) for v in CASES.values()) + (None,) for i in range(longest)]
    random.Random(2).shuffle(rows)
    df = small_table(spark, rows, ", ".join(f"{c} double" for c in [*CASES, "empty"])).repartition(4)
    got = numeric_summary(df, [*CASES, "empty"])
    for c, values in CASES.items():
        assert got[c]["n"] == len(values) and (got[c]["min"], got[c]["max"]) == (min(values), max(values)), c
        assert got[c]["median"] == pytest.approx(statistics.median(values), rel=1e-15), c
    assert got["empty"] == {"n": 0, "min": None, "max": None, "median": None}


def split_by_hand(rows, seed=42):
    out = {}
    for label in (0, 1):
        keys = sorted((k for k, y in rows if y == label), key=lambda k: hashlib.md5(f"{seed}|{k}".encode()).hexdigest())
        t = int(len(keys) * 0.15 + 0.5)
        out |= {k: "test" if i < t else "validation" if i < 2 * t else "train" for i, k in enumerate(keys)}
    return out


@pytest.mark.parametrize("n,share", [(60, 0.10), (211, 0.5), (3000, 0.07)])
def test_split(spark, n, share):
    """Property 4: nothing is lost and every part keeps the class share."""
    rows = [(f"C{i}", int(i < n * share)) for i in range(n)]
    df = small_table(spark, rows, "customer_id string, churn_label bigint").repartition(3)
    out = SP.stratified_split(df).collect()
    assert {r["customer_id"]: r["split"] for r in out} == split_by_hand(rows)
    for part in ("train", "validation", "test"):
        labels = [r["churn_label"] for r in out if r["split"] == part]
        assert abs(sum(labels) / len(labels) - share) <= 0.05 + 1 / len(labels)


def test_split_by_client_equals_split_alone(spark):
    rows = [(c, f"C{i}", int(i % 5 == 0)) for c, m in (("a", 400), ("b", 90)) for i in range(m)]
    df = small_table(spark, rows, "client_id string, customer_id string, churn_label bigint")
    out = SP.stratified_split(df, group=["client_id"]).collect()
    for c in ("a", "b"):
        assert {r["customer_id"]: r["split"] for r in out if r["client_id"] == c} == split_by_hand([(k, y) for g, k, y in rows if g == c])


def test_split_with_one_key_on_a_third_of_the_rows(spark):
    rows = [("hot" if i % 3 == 0 else f"C{i}", i % 2) for i in range(3000)]
    out = SP.stratified_split(small_table(spark, rows, "customer_id string, churn_label bigint")).collect()
    assert len(out) == 3000
    parts = {}
    for r in out:
        parts.setdefault((r["customer_id"], r["churn_label"]), set()).add(r["split"])
    assert all(len(p) == 1 for p in parts.values())  # rows of one key stay together


def test_split_refuses_bad_input(spark):
    df = small_table(spark, [("a", 0), ("b", 1), ("c", 2)], "customer_id string, churn_label bigint")
    with pytest.raises(ValueError):
        SP.stratified_split(df)
    with pytest.raises(ValueError):
        SP.stratified_split(df, train=0.5)
    unlabelled = small_table(spark, [("a", 0), ("b", None)], "customer_id string, churn_label bigint")
    assert {r["customer_id"]: r["split"] for r in SP.stratified_split(unlabelled).collect()}["b"] is None


def test_weight(spark):
    """Property 5."""
    rows = [(g, int(i < pos)) for g, pos, n in (("rare", 15, 100), ("edge", 30, 100), ("half", 50, 100), ("none", 0, 10)) for i in range(n)]
    df = small_table(spark, rows, "g string, churn_label bigint")
    got = {r["g"]: r["weight"] for r in SP.positive_weight(df, group=["g"]).collect()}
    assert got == {"rare": pytest.approx(85 / 15), "edge": 1.0, "half": 1.0, "none": None}
    with pytest.raises(Exception, match="no positive samples"):
        SP.positive_weight(df.filter("g = 'none'")).collect()


def auc_by_hand(pairs):
    pos, neg = [p for y, p in pairs if y], [p for y, p in pairs if not y]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_and_gate(spark):
    """Property 6, the boundary cases 0.70 and 0.699, ties, and groups of one class."""
    rng = random.Random(3)
    cases = {
        "edge": [(0, 0.3)] * 70 + [(0, 0.9)] * 30 + [(1, 0.8)] * 100,
        "below": [(0, 0.3)] * 699 + [(0, 0.9)] * 301 + [(1, 0.8)] * 1000,
        "ties": [(rng.randint(0, 1), rng.randint(0, 5) / 5) for _ in range(300)],
        "free": [(rng.randint(0, 1), rng.random()) for _ in range(300)],
        "low scores": [(0, 0.1)] * 20 + [(1, 0.2)] * 20,
    }
    rows = [(g, y, p) for g, pairs in cases.items() for y, p in pairs] + [("one class", 1, 0.5)]
    df = small_table(spark, rows, "g string, y bigint, p double").repartition(4)
    got = {r["g"]: r for r in E.evaluate(df, group=["g"]).collect()}
    for g, pairs in cases.items():
        assert got[g]["auc_roc"] == pytest.approx(auc_by_hand(pairs), abs=5.1e-5)
    assert got["edge"]["passed"] and got["edge"]["auc_roc"] == 0.7
    assert not got["below"]["passed"] and got["below"]["auc_roc"] == 0.699
    assert got["low scores"]["passed"] and got["low scores"]["f1_score"] == 0.0  # nothing else matters
    assert got["one class"]["auc_roc"] is None and not got["one class"]["passed"]
    whole = E.auc(df).first()["auc"]
    assert whole == pytest.approx(auc_by_hand([(y, p) for _, y, p in rows]))


def test_gate_looks_at_the_unrounded_area(spark):
    rows = [(0, 0.3)] * 69996 + [(0, 0.9)] * 30004 + [(1, 0.8)]
    df = small_table(spark, rows, "y bigint, p double")
    out = E.evaluate(df).first()
    assert out["auc_roc"] == 0.7 and not out["passed"]


@pytest.mark.parametrize("literal", [100, 0])
def test_codes_with_a_hot_value(spark, monkeypatch, literal):
    """Short lists use a literal map, long ones the join that sets hot values apart; both give the same codes."""
    rows = [("hot" if i % 3 == 0 else f"m{i % 40:02d}", i) for i in range(900)] + [(None, 900)]
    df = small_table(spark, rows, "payment_method string, i bigint")
    monkeypatch.setattr(FE, "LITERAL_CLASSES", literal)
    state = FE.fit_features(df)
    scored = small_table(spark, [("hot", 0), ("m01", 1), ("new", 2), (None, 3), ("m39", 4)], "payment_method string, i bigint")
    out = FE.encode_categories(FE.fill_values(scored, state), state).orderBy("i").collect()
    values = sorted({v for v, _ in rows if v})
    assert [r["payment_method"] for r in out] == [values.index("hot"), values.index("m01"), 0, values.index("hot"), values.index("m39")]
