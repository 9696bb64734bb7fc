"""Features, contributions, scoring, drift and the three flows."""

import itertools
import math
import random
import threading

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import fixtures as X
from tenura.operators import contributions as CO
from tenura.operators import drift as D
from tenura.operators import features as FE
from tenura.operators import group_features as GF
from tenura.operators import registry as R
from tenura.operators import scoring as S
from tenura.operators import training as T
from tenura.plans import runs
from tenura.session import small_table
from tenura.sources import client_tables as CT

FEATURES = "customer_id string, tenure_months double, monthly_charges double, total_charges double, contract_type string, gender string"


def feature_rows(seed, n, nulls):
    rng = random.Random(seed)

    def maybe(x):
        return None if rng.random() < nulls else x

    return [
        (f"C{i}", maybe(rng.randint(1, 72) * 1.0), maybe(rng.uniform(10, 200)), maybe(rng.uniform(10, 10000)),
         maybe(rng.choice(["month-to-month", "one_year", "two_year"])), maybe(rng.choice(["Male", "Female"])))
        for i in range(n)
    ]


@pytest.mark.parametrize("n,nulls", [(2, 0.5), (50, 0.3), (20, 1.0)])
def test_feature_table_is_whole(spark, n, nulls):
    """Properties 3 and 11: same rows, doubles in [0, 1], no null, and scoring twice gives the same."""
    df = small_table(spark, feature_rows(n, n, nulls), FEATURES)
    state = FE.fit_features(df)
    names = ["tenure_months", "monthly_charges", "total_charges", "contract_type", "gender", FE.INTERACTION]
    assert state.names == names
    first, second = (FE.apply_features(df, state).orderBy("customer_id").collect() for _ in range(2))
    assert first == second and len(first) == n
    assert all(0.0 <= r[c] <= 1.0 for r in first for c in names)


def test_scoring_mode_uses_stored_statistics(spark, tmp_path):
    df = small_table(spark, feature_rows(1, 30, 0.2), FEATURES)
    state = FE.fit_features(df)
    FE.write_state(state, str(tmp_path / "state"))
    again = FE.read_state(spark, str(tmp_path / "state"))
    assert again.rows == state.rows and again.maps == state.maps
    far = small_table(spark, [("x", 1e6, -5.0, None, "quarterly", None)], FEATURES)
    row = FE.apply_features(far.withColumn("age_bucket", F.lit("56+")), again).first()
    assert (row["tenure_months"], row["monthly_charges"], row["contract_type"]) == (1.0, 0.0, 0.0)
    with pytest.raises(ValueError):
        FE.apply_features(far, None)


def test_constant_feature_and_given_interaction(spark):
    df = small_table(spark, [("a", 5.0, 2.0), ("b", 5.0, 4.0)], "customer_id string, tenure_months double, interaction_x double")
    state = FE.fit_features(df)
    assert state.names == ["tenure_months", "interaction_x"]
    assert [r[1:] for r in FE.apply_features(df, state).orderBy("customer_id").collect()] == [(0.0, 0.0), (0.0, 1.0)]
    with pytest.raises(TypeError):
        FE.fit_features(df.withColumn("interaction_x", F.lit("text")))


# --- contributions ---------------------------------------------------------------------------------------------


def tree_value(leaves, x, known):
    """Expected margin when only ``known`` features are seen: unseen ones follow the training shares."""
    total = 0.0
    for leaf in leaves:
        part = leaf.value
        for f, low, high, share in zip(leaf.features, leaf.low, leaf.high, leaf.share):
            part *= (low < x[f] <= high) if f in known else share
        total += part
    return total


def shapley(leaves, x, n):
    out = []
    for j in range(n):
        rest = [i for i in range(n) if i != j]
        total = 0.0
        for size in range(n):
            weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
            for subset in itertools.combinations(rest, size):
                total += weight * (tree_value(leaves, x, {*subset, j}) - tree_value(leaves, x, {*subset}))
        out.append(total)
    return out


def test_tree_contributions_are_shapley_values(spark):
    rng = np.random.default_rng(4)
    x = rng.random((400, 4)).round(3)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3) | (x[:, 2] * x[:, 3] > 0.6)).astype(int)
    names = ["a", "b", "c", "d"]
    rows = [(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))]
    df = small_table(spark, rows, "i bigint, a double, b double, c double, d double, churn_label bigint")
    table = FE.VectorAssembler(inputCols=names, outputCol="features").transform(df)
    model = T.fit_trees(table, {"max_depth": 3, "min_child_weight": 1}, rounds=3, weight=None, split=None)
    leaves = CO.tree_leaves(model)
    margin = 2.0 * vector_to_array("rawPrediction")[1]
    scored = model.transform(table).select("i", *names, margin.alias("margin"))
    got = CO.tree_contributions(scored, leaves, names).orderBy("i").collect()
    assert any(len(leaf.features) < len(names) for leaf in leaves)
    for r in got:
        assert sum(r["contributions"]) + CO.expected_margin(leaves) == pytest.approx(r["margin"], abs=1e-9)
    for r in got[:25]:
        assert r["contributions"] == pytest.approx(shapley(leaves, [r[c] for c in names], 4), abs=1e-9)


def test_contributions_of_many_deep_leaves(spark):
    """Leaves of several hundred paths of up to 11 features, each by itself and all together; missing and infinite features."""
    rng = np.random.default_rng(8)
    names = [f"x{i}" for i in range(12)]
    leaves = []
    for _ in range(300):
        features = tuple(sorted(rng.choice(12, int(rng.integers(0, 12)), replace=False).tolist()))
        ends = np.sort(rng.integers(-2, 6, (len(features), 2)), axis=1) + [0, 1]
        low = tuple(float("-inf") if rng.random() < 0.3 else float(a) for a, _ in ends)
        high = tuple(float("inf") if rng.random() < 0.3 else float(b) for _, b in ends)
        leaves.append(CO.Leaf(float(rng.normal()), features, low, high, tuple(rng.uniform(0.1, 0.9, len(features)).tolist())))
    x = rng.integers(-2, 7, (60, 12)).astype(float)
    x[0, 3], x[1, 4] = np.nan, np.inf
    want = np.zeros_like(x)
    for leaf in leaves:
        at = list(leaf.features)
        if at:
            met = (x[:, at] > np.array(leaf.low)) & (x[:, at] <= np.array(leaf.high)) | (np.isposinf(x[:, at]) & np.isposinf(leaf.high))
            want[:, at] += CO.leaf_contributions(met @ (1 << np.arange(len(at))), leaf.share, leaf.value)
    df = small_table(spark, [(i, *map(float, v)) for i, v in enumerate(x)], "i bigint, " + ", ".join(f"{n} double" for n in names))
    got = CO.tree_contributions(df.repartition(2), leaves, names).orderBy("i").collect()
    assert np.abs(np.array([r["contributions"] for r in got]) - want).max() < 1e-9
    assert CO.tree_contributions(df.limit(0), leaves, names).count() == 0


def test_early_stopping(spark):
    assert T.best_round([5.0, 4.0, 4.5, 4.6, 3.0], 2) == (2, True)
    assert T.best_round([5.0, 4.0, 4.5, 4.6, 3.0], 3) == (5, False)
    assert T.best_round([1.0], 20) == (1, False)
    rng = np.random.default_rng(7)
    rows = [(i, float(a), float(b), int(a + rng.normal(0, 0.5) > 0.5), "validation" if i % 4 == 0 else "train") for i, (a, b) in enumerate(rng.random((600, 2)))]
    df = small_table(spark, rows, "i bigint, a double, b double, churn_label bigint, split string")
    table = FE.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    settings = {"max_depth": 3, "eta": 0.3}
    kept = T.fit_trees(table, settings, rounds=12, weight=None, patience=2)
    full = T.fit_trees(table.filter("split = 'train'"), settings, rounds=12, weight=None, split=None)
    held = table.filter("split = 'validation'")
    # The AUC of each round by counting pairs, from the scores of the model cut to these rounds.
    areas = []
    for n in range(1, 13):
        scores = [(r["churn_label"], r["p"]) for r in S.predict(T.first_trees(full, n), held, "p").collect()]
        pairs = [(p > q) + 0.5 * (p == q) for y, p in scores if y for z, q in scores if not z]
        areas.append(sum(pairs) / len(pairs))
    assert T.round_aucs(full, held) == pytest.approx(areas, abs=1e-12)
    keep, done = T.best_round([-a for a in areas], 2)
    assert kept.getNumTrees == keep < 12 and done
    assert kept.evaluateEachIteration(held) == pytest.approx(full.evaluateEachIteration(held)[:keep])
    for r in T.round_margins(full, full.transform(held).select("features", vector_to_array("rawPrediction")[1].alias("raw"))).collect():
        assert len(r["margins"]) == 12 and r["margins"][-1] == pytest.approx(2.0 * r["raw"], abs=1e-12)
    one_class = table.withColumn("churn_label", F.when(F.col("split") == "validation", 0).otherwise(F.col("churn_label")))
    assert T.fit_trees(one_class, settings, rounds=3, weight=None).getNumTrees == 3
    scored = S.predict(kept, table).agg(F.min("churn_probability"), F.max("churn_probability")).first()
    assert 0.0 <= scored[0] < scored[1] <= 1.0


def test_areas_of_rounds_stage_no_margins(spark, monkeypatch):
    """A margin of every row and round is never a row on disk; many ranges of margins give what one gives; ties count half."""
    rng = np.random.default_rng(8)
    rows = [(float(a), float(b), None if i % 50 == 0 else int(a + rng.normal(0, 0.5) > 0.5)) for i, (a, b) in enumerate(rng.random((700, 2)))]
    df = small_table(spark, rows, "a double, b double, churn_label bigint")
    table = FE.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).repartition(3)
    model = T.fit_trees(table, {"max_depth": 2, "eta": 0.3}, rounds=6, weight=None, split=None)
    margins = [(r["churn_label"], r["margins"]) for r in T.round_margins(model, table).collect() if r["churn_label"] is not None]
    want = []
    for n in range(6):
        pairs = [(m[n] > k[n]) + 0.5 * (m[n] == k[n]) for y, m in margins if y for z, k in margins if not z]
        want.append(sum(pairs) / len(pairs))

    def never(*_):
        raise AssertionError("staged")

    monkeypatch.setattr("tenura.functions.order.stage", never)
    assert T.round_aucs(model, table) == pytest.approx(want, abs=1e-12)
    monkeypatch.setattr(T, "RANGE_ROWS", 90)
    assert T.round_aucs(model, table) == pytest.approx(want, abs=1e-12)
    assert T.round_aucs(model, table.filter("churn_label = 1")) == [None] * 6
    assert T.round_aucs(model, table.limit(0)) == [None] * 6


def test_pairs_won_in_a_range_are_exact():
    most = 2**31 - 1
    runs = pa.table({"scores": [np.array([0.5, 1.0]).tobytes()] * 2, "pos": [np.array([most, 0], np.int32).tobytes()] * 2, "neg": [np.array([most, 1], np.int32).tobytes()] * 2})
    (row,) = T._span_area((pa.scalar(3), pa.scalar(1)), runs).to_pylist()
    assert row == {"round": 3, "span": 1, "won": (2 * most) ** 2, "pos": 2 * most, "neg": 2 * most + 2}


def test_three_settings_are_fitted_at_a_time(spark, monkeypatch):
    together = threading.Barrier(3)

    class Fitted:
        getNumTrees = 5

    monkeypatch.setattr(T, "_fit_parts", lambda *_: (Fitted, float(together.wait(20) >= 0)))
    df = small_table(spark, [(0.5, 1, 1.0, "train")], "features double, churn_label bigint, weight double, split string")
    assert [(r["trial"], r["trees"]) for r in T.tune_trees(df, T.draw_settings(3)).collect()] == [(0, 5), (1, 5), (2, 5)]


def _client_rows(n=900):
    rng = np.random.default_rng(12)
    rows = []
    for i in range(n):
        client = "hot" if i % 3 else ["a", "b", None][int(rng.integers(3))]
        rows.append((client, f"c{i}", float(rng.integers(0, 60)) if rng.random() > 0.1 else None, None if client == "a" else f"{rng.uniform(10, 90):.2f}",
                     None if client == "b" else str(rng.choice(["x", "y", "z"])), float(rng.random()) if client != "a" else None))
    return rows


CLIENT_SCHEMA = "client_id string, customer_id string, tenure_months double, monthly_charges string, payment_method string, interaction_own double"


@pytest.mark.parametrize("few", [0, 100_000])
def test_statistics_of_many_clients_are_those_of_each(spark, few):
    df = small_table(spark, _client_rows(), CLIENT_SCHEMA).repartition(4)
    state = GF.fit_features_by(df, few=few)
    table = GF.apply_features_by(df, state)
    got = {r["customer_id"]: r for r in table.collect()}
    assert len(got) == 900 and table.columns == ["client_id", "customer_id", *state.names]
    for client in ("hot", "a", "b", None):
        own = df.where(F.col("client_id").eqNullSafe(F.lit(client)))
        one, of = FE.fit_features(own), state.of(client)
        assert of.rows == one.rows and of.maps == one.maps
        for r in FE.apply_features(own, one).collect():
            assert [got[r["customer_id"]][c] for c in state.names] == pytest.approx([r[c] for c in state.names], abs=1e-12)


def test_rows_of_clients_without_statistics_fail(spark):
    df = small_table(spark, _client_rows(60), CLIENT_SCHEMA)
    state = GF.fit_features_by(df.where("client_id = 'hot'"))
    with pytest.raises(Exception, match="no features were learned for"):
        GF.apply_features_by(df.where("client_id = 'a'"), state).collect()


@pytest.mark.parametrize("group_rows", [7, 1_000_000])
def test_each_client_is_scored_by_its_model(spark, tmp_path, group_rows):
    """Models of different features, a hot client in many groups, against each model on its own; written and read back."""
    rng = np.random.default_rng(3)
    names = ["x", "y", "z"]
    rows = [("hot" if i % 3 else f"c{i % 2}", f"id{i}", *map(float, rng.random(3))) for i in range(200)]
    df = small_table(spark, rows, "client_id string, customer_id string, x double, y double, z double").repartition(3)

    def leaves(seed, width):
        r = np.random.default_rng(seed)
        return [CO.Leaf(float(r.normal()), (0, width - 1), (float("-inf"), 0.4), (float(r.random()), float("inf")), (0.5, 0.6)) for _ in range(9)]

    models = {"hot": ("m1", leaves(1, 3), names), "c0": ("m2", leaves(2, 2), ["z", "x"]), "c1": ("m3", leaves(3, 2), ["y", "z"]), "idle": ("m4", [], [])}
    CT.write_table(R.registry_of(spark, models), str(tmp_path / "registry"))
    registry = spark.read.schema(R.REGISTRY_SCHEMA).parquet(str(tmp_path / "registry"))
    got = {r["customer_id"]: r for r in R.score_by_client(df.withColumn("contributions", F.lit(1)), registry, names, group_rows=group_rows).collect()}
    assert len(got) == 200
    for client, (model, own, used) in models.items():
        for r in CO.tree_contributions(df.where(F.col("client_id") == client), own, used or names).collect():
            want = dict(zip(used, r["contributions"]))
            found = got[r["customer_id"]]
            assert found["model_id"] == model and found["contributions"] == pytest.approx([want.get(n, 0.0) for n in names], abs=1e-12)
            assert found["churn_probability"] == pytest.approx(1 / (1 + math.exp(-sum(want.values()) - CO.expected_margin(own))), abs=1e-12)
    with pytest.raises(Exception, match="has 0 models"):
        R.score_by_client(df, registry.where("client_id <> 'c1'"), names).collect()
    assert R.score_by_client(df.limit(0), registry, names).count() == 0


# --- scoring ---------------------------------------------------------------------------------------------------


def test_tiers(spark):
    """Property 7."""
    points = [0.0, 0.39999, 0.4, 0.5, 0.69999, 0.7, 1.0, float("nan"), None]
    df = small_table(spark, list(enumerate(points)), "i int, p double")
    tiers = [r[0] for r in df.orderBy("i").select(S.risk_tier(F.col("p"))).collect()]
    assert tiers == ["low", "low", "medium", "medium", "medium", "high", "high", "low", "low"]


def test_reasons(spark):
    """Property 8, ties, short lists and a wrong length."""
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(50)]
    names = list("abcdef")
    df = small_table(spark, rows, "i int, c array<double>")
    for r in df.select("i", "c", S.top_factors(F.col("c"), names).alias("top"), S.top_reasons(F.col("c"), names).alias("said")).collect():
        order = sorted(range(6), key=lambda k: -abs(r["c"][k]))[:3]
        assert [t["feature"] for t in r["top"]] == [names[k] for k in order]
        assert all(s.startswith(names[k]) and s[3] in "+-" for s, k in zip(r["said"], order))
    tie = small_table(spark, [([0.5, -0.5, 0.1],)], "c array<double>").select(S.top_reasons(F.col("c"), list("abc"), 5)).first()[0]
    assert tie == ["b (-0.50)", "a (+0.50)", "c (+0.10)"]
    with pytest.raises(Exception, match="feature names"):
        df.select(S.top_reasons(F.col("c"), ["a"])).collect()


# --- drift -----------------------------------------------------------------------------------------------------


def spread(counts, start=0.0):
    """Values in the middle of bins of width one, so many in each bin."""
    return [start + i + 0.5 for i, n in enumerate(counts) for _ in range(n)]


# Worked out on paper: shares of ten bins from 0 to 10, a share of none counted as 0.000001, and the sum of (b - a) ln(b / a).
EVEN = [10] * 10
PAIRS = {
    "same": (EVEN, EVEN, 0.0),
    # one bin 0.10 to 0.20, one 0.10 to 0.00: 0.1 ln 2 + 0.099999 ln 100000
    "moved": (EVEN, [20, 0, 10, 10, 10, 10, 10, 10, 10, 10], 0.1 * 0.6931471805599453 + 0.099999 * 11.512925464970229),
    # half of the bins 0.10 to 0.15, half 0.10 to 0.05: 5 (0.05 ln 1.5 + 0.05 ln 2)
    "tilted": (EVEN, [15] * 5 + [5] * 5, 0.25 * 0.4054651081081644 + 0.25 * 0.6931471805599453),
}


def test_psi(spark):
    """Pairs worked out by hand, too few values, an absent feature, constants, nulls and NaN."""
    ends = [0.0, 10.0]  # both sides span the same range; the two end values lie in the outer bins
    ref = {f: spread(a) for f, (a, _, _) in PAIRS.items()}
    cur = {f: spread(b) for f, (_, b, _) in PAIRS.items()}
    for f in PAIRS:
        for side in (ref, cur):
            side[f][side[f].index(min(side[f]))] = ends[0]
        ref[f][-1] = ends[1]
        if 9.5 in cur[f]:
            cur[f][-1] = ends[1]
    ref |= {"few": spread(EVEN), "gone": spread(EVEN), "flat": [7.0] * 20, "flat moved": [7.0] * 20}
    cur |= {"few": spread(EVEN)[:9], "flat": [7.0] * 15, "flat moved": [float(i) for i in range(15)], "new": spread(EVEN)}

    def rows(side):
        return [(f, float(v)) for f, values in side.items() for v in values] + [("same", None), ("same", float("nan"))]

    snapshot = D.training_snapshot(small_table(spark, rows(ref), "feature string, value double"))
    scores = D.psi_scores(snapshot, small_table(spark, rows(cur), "feature string, value double"))
    got = {r["feature"]: r["psi"] for r in scores.collect()}
    assert set(got) == {"same", "moved", "tilted", "flat", "flat moved"}
    assert got["flat"] == 0.0 and got["flat moved"] == 0.25
    for f, (_, _, psi) in PAIRS.items():
        assert got[f] == pytest.approx(psi, abs=1e-9)
    report = D.drift_report(scores, "2024-02-01").first()
    assert report["features_checked"] == 5 and report["features_drifted"] == ["flat moved", "moved", "tilted"] and report["alert_triggered"]
    empty = D.drift_report(scores.filter("psi < -1"), "2024-02-01").first()
    assert (empty["features_checked"], empty["features_drifted"], empty["alert_triggered"]) == (0, [], False)


def test_bands(spark):
    df = small_table(spark, [(0.0999,), (0.1,), (0.2,), (0.2001,)], "psi double")
    assert [r[0] for r in df.orderBy("psi").select(D.psi_band(F.col("psi"))).collect()] == ["stable", "moderate", "moderate", "significant"]
    assert [r["drifted"] for r in D.flagged(df).orderBy("psi").collect()] == [False, False, False, True]


# --- flows -----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def trained(spark, sf):
    return runs.train_client(X.churn_raw(spark, sf), X.RETAIL, settings={"max_depth": 3}, rounds=3, fit_on="train")


def test_training_leaves_no_copies(spark, sf):
    from tenura.session import _STAGED, staging

    with staging(spark):
        raw = X.churn_raw(spark, sf)
        before = len(_STAGED)
        done = runs.train_client(raw, X.RETAIL, settings={"max_depth": 2}, rounds=2)
        assert len(_STAGED) == before
        assert done.card.count() == 1 and done.prepared.validation.count() > 0 and done.state.codes.count() > 0


def test_contributions_of_deep_leaves():
    """Ten features in one leaf, against the sum over all subsets."""
    from itertools import combinations
    from math import factorial

    from tenura.operators.contributions import leaf_contributions

    rng = np.random.default_rng(4)
    share, m = rng.uniform(0.05, 0.95, 10), 10
    codes = np.array([0, 1, 37, 1023])
    got = leaf_contributions(codes, share.tolist(), 2.5)
    for row, code in enumerate(codes):
        met = np.array([(code >> k) & 1 for k in range(m)])

        def known(s):
            return np.prod([met[k] if k in s else share[k] for k in range(m)])

        for j in (0, 4):
            rest = [k for k in range(m) if k != j]
            total = sum(
                factorial(n) * factorial(m - n - 1) / factorial(m) * (known({*s, j}) - known(set(s))) for n in range(m) for s in combinations(rest, n)
            )
            assert got[row, j] == pytest.approx(2.5 * total, abs=1e-12)


def test_onboarding(spark, trained):
    card = trained.card.first()
    assert card["client_id"] == "retail" and card["dataset_rows"] == 150 and card["feature_count"] == 9
    assert card["model_id"].startswith("churn-gbt-") and card["data_contract_version"] == "1.0"
    gate = card["evaluation_gate"]
    assert gate["passed"] == (gate["margin"] >= 0) and card["hyperparameters"]["max_depth"] == "3"
    assert {r["feature"] for r in trained.snapshot.collect()} == {"tenure_months", "monthly_charges", "total_charges", "support_tickets"}


def test_three_clients_from_raw_rows_to_deliverable(spark, sf):
    """Trained and scored together: each client's rows come out once, with its own model; scores are those of its own trees."""
    raw = X.clients_raw(spark, sf)
    state, registry, reports = runs.train_clients(raw, X.catalog(spark), settings={"max_depth": 2}, rounds=2)
    assert reports.where("field = '*' AND present").count() == 3 and registry.count() == 3
    out = runs.score_clients(raw, X.catalog(spark), state, registry)
    counts = {r["client_id"]: (r["count"], r["n"]) for r in out.groupBy("client_id").agg(F.count("*").alias("count"), F.countDistinct("customer_id").alias("n")).collect()}
    assert set(counts) == {"retail", "shop", "bank"} and all(n == ids > 100 for n, ids in counts.values())
    assert out.where("NOT startswith(model_id, client_id) OR churn_probability NOT BETWEEN 0 AND 1").count() == 0
    assert out.select("model_id").distinct().count() == 3 and out.where("risk_tier IS NULL OR top_3_reasons IS NULL").count() == 0


def test_gate_before_training(spark, sf):
    raw = X.churn_raw(spark, sf).drop("Churned")
    with pytest.raises(ValueError):
        runs.train_client(raw, X.RETAIL, rounds=1)
    with pytest.raises(ValueError):
        runs.train_client(X.churn_raw(spark, sf).filter("false"), X.RETAIL, rounds=1)


def test_scoring_with_and_without_narratives(spark, sf, trained):
    raw = X.churn_raw(spark, sf)
    plain = {r["customer_id"]: r for r in runs.score_batch(raw, X.RETAIL, trained).collect()}

    def call(prompt):
        if "--- Customer: 60 ---" in prompt:
            raise RuntimeError
        ids = [line.split()[2] for line in prompt.splitlines() if line.startswith("--- Customer: ")]
        return "".join(f"CUSTOMER_ID: {i}\nNARRATIVE: About {i}.\n" for i in ids)

    told = {r["customer_id"]: r for r in runs.score_batch(raw, X.RETAIL, trained, call).collect()}
    assert set(plain) == set(told) and len(plain) == 150
    for c, r in told.items():
        assert r[:4] == plain[c][:4] and plain[c]["narrative_explanation"] == "N/A"
        assert r["narrative_explanation"] in (f"About {c}.", "N/A") and len(r["top_3_reasons"].split("; ")) == 3
    assert sum(r["narrative_explanation"] == "N/A" for r in told.values()) == 50


def test_drift_flow(spark, sf, trained):
    raw = X.churn_raw(spark, sf)
    scores, report = runs.check_batch(raw, X.RETAIL, trained.snapshot, "2024-02-01")
    assert all(abs(r["psi"]) < 1e-10 and r["band"] == "stable" for r in scores.collect()) and not report.first()["alert_triggered"]
    moved = raw.withColumn("tenure", (F.col("tenure").try_cast("double") * 0.1).cast("string"))
    scores, report = runs.check_batch(moved, X.RETAIL, trained.snapshot, "2024-02-01")
    assert report.first()["features_drifted"] == ["tenure_months"] and scores.first()["band"] == "significant"


@pytest.mark.parametrize("query", ["flagship", "trn_4", "scr_2"])
def test_queries_train_with_all_rounds(monkeypatch, query):
    """No query asks for fewer rounds, less patience or other settings than training has by itself."""
    import inspect

    from checks import flagship, q_models

    class Seen(Exception):
        pass

    def stand_in(of):
        def seen(*args, **kwargs):
            bound = inspect.signature(of).bind(*args, **kwargs)
            bound.apply_defaults()
            raise Seen({k: v for k, v in bound.arguments.items() if k in ("rounds", "patience")})

        return seen

    monkeypatch.setattr(q_models, "training_table", lambda spark, sf: (None, []))
    monkeypatch.setattr(flagship.X, "churn_raw", lambda spark, sf: None)
    monkeypatch.setattr(flagship, "train_client", stand_in(flagship.train_client))
    monkeypatch.setattr(T, "tune_trees", stand_in(T.tune_trees))
    monkeypatch.setattr(T, "fit_trees", stand_in(T.fit_trees))
    with pytest.raises(Seen) as said:
        (flagship.flagship if query == "flagship" else q_models.QUERIES[query])(None, None)
    assert said.value.args[0] in ({"rounds": T.MAX_ROUNDS}, {"rounds": T.MAX_ROUNDS, "patience": T.PATIENCE})
