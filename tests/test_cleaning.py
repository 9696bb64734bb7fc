"""The dirty 12-row table with its hand-derived results, and the value rules of cleaning and mapping."""

import pytest
from pyspark.sql import functions as F

from tenura.functions import values as V
from tenura.operators import cleaning as K
from tenura.operators import features as FE
from tenura.operators import mapping as M
from tenura.operators import validation as VA
from tenura.session import small_table
from tenura.sources.catalog import Mapping

SCHEMA = (
    "src_row bigint, customer_id string, tenure_months string, monthly_charges string, total_charges string, churn_label bigint, "
    "contract_type string, payment_method string, gender string, partner_status string"
)
DIRTY = [
    ("C001", "12", "50.0", "600.0", 0, "Month-to-month", "credit card", "M", "1"),
    ("C002", "N/A", "75.0", "1800.0", 1, "one year", "CC", "f", "0"),
    ("C003", "24", "null", "285.0", 1, "m2m", "bank transfer", "Male", "1"),
    ("C004", "-3", "95.0", "N/A", 0, "MTM", "ACH", "FEMALE", "0"),
    ("C005", "48", "30.0", "1440.0", 0, "Two year", "e-check", None, "1"),
    ("C006", "6", "110.0", "660.0", 1, "monthly", "visa", "m", "0"),
    ("C007", "ERROR", "50.0", "ERR", 0, "2 year", "mailed check", "F", "1"),
    ("C008", "0", "  ", "0", 1, "annual", "electronic check", "male", "0"),
    ("C003", "24", "95.0", "285.0", 1, "m2m", "bank transfer", "Male", "1"),
    ("C009", "72", "80.0", "99999", 0, "two_year", "credit_card", "female", "0"),
    ("C010", "---", "45.0", "500.0", 0, None, "check", "M", "1"),
    ("C010", "999", "45.0", "500.0", 0, None, "check", "M", "1"),
]


@pytest.fixture(scope="module")
def dirty(spark):
    return small_table(spark, [(i, *r) for i, r in enumerate(DIRTY)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def cleaned(dirty):
    table, report = K.clean_table(dirty)
    return table, {(r["section"], r["column"]): r for r in report.collect() if r["section"] != "changed"}


def column(df, name):
    return [r[0] for r in df.orderBy("src_row").select(name).collect()]


def test_golden_values(cleaned):
    table, _ = cleaned
    assert column(table, "tenure_months") == [12, None, 24, 0, 48, 6, None, 0, 72, None]
    assert column(table, "monthly_charges") == [50, 75, None, 95, 30, 110, 50, None, 80, 45]
    assert column(table, "total_charges") == [600, 1800, 285, None, 1440, 660, None, 0, 50000, 500]
    assert column(table, "contract_type") == [
        "month-to-month", "one_year", "month-to-month", "month-to-month", "two_year", "month-to-month", "two_year", "one_year", "two_year", None,
    ]
    assert column(table, "payment_method") == [
        "credit_card", "credit_card", "bank_transfer", "bank_transfer", "electronic_check", "credit_card", "mailed_check",
        "electronic_check", "credit_card", "mailed_check",
    ]
    assert column(table, "gender") == ["Male", "Female", "Male", "Female", None, "Male", "Female", "Male", "Female", "Male"]


def test_golden_report(cleaned, dirty):
    _, report = cleaned
    repeats = report["repeats", ""]
    assert (repeats["n"], repeats["pct"]) == (2, 16.7)
    assert repeats["message"] == "Removed 2 duplicates: 2 duplicate customer_ids (kept first occurrence) (16.7% of dataset)."
    tenure = report["garbage", "tenure_months"]
    assert (tenure["n"], tenure["pct"], tenure["item"]) == (3, 30.0, "N/A | ERROR | ---")
    assert tenure["message"] == (
        "Column 'tenure_months': 3 values (30.0%) couldn't be parsed as numbers (examples: ['N/A', 'ERROR', '---']). "
        "Converted to NaN — will be imputed later."
    )
    assert report["garbage", "monthly_charges"]["n"] == 2 and report["garbage", "total_charges"]["pct"] == 20.0
    assert report["capped", "tenure_months"]["message"] == "Column 'tenure_months': 1 outlier values capped to [0, 120] range."
    assert report["capped", "total_charges"]["n"] == 1
    assert {c: report["nulls", c]["n"] for s, c in report if s == "nulls"} == {
        "tenure_months": 3, "monthly_charges": 2, "total_charges": 2, "contract_type": 1, "gender": 1,
    }
    assert (report["total_nulls", ""]["n"], report["total_nulls", ""]["pct"]) == (9, 10.0)


def test_golden_spellings_and_severity(dirty):
    issues = K.issue_counts(K.remove_repeats(dirty))
    changed = {r["column"]: r["n"] for r in K.category_changes(issues).groupBy("column").agg(F.count("*").alias("n")).collect()}
    assert changed == {"contract_type": 8, "payment_method": 9, "gender": 7}
    loud = {r["column"]: r["severity"] for r in K.garbage_profile(issues, max_garbage=0.20).collect()}
    assert loud == {"tenure_months": "CRITICAL", "monthly_charges": "NOTE", "total_charges": "NOTE"}  # strictly above


def test_golden_validation_and_fills(cleaned):
    table, _ = cleaned
    report = {r["field"]: r for r in VA.validation_report(table).collect()}
    assert report["*"]["present"] and not any(r["error"] for r in report.values())
    assert not report["age_bucket"]["present"] and all(report[f]["present"] for f in ("contract_type", "payment_method"))
    rows = {r["feature"]: r for r in FE.fit_features(table).rows}
    assert (rows["tenure_months"]["impute_num"], rows["monthly_charges"]["impute_num"], rows["total_charges"]["impute_num"]) == (12, 62.5, 630)
    fills = [rows[c]["impute_cat"] for c in ("contract_type", "payment_method", "gender", "partner_status")]
    assert fills == ["month-to-month", "credit_card", "Male", "0"]


def test_switches(dirty):
    table = K.clean_rows(dirty, repeats=False, cap=False, categories=False)
    assert table.count() == 12
    assert table.agg(F.min("tenure_months"), F.max("total_charges")).first()[:] == (-3.0, 99999.0)
    assert table.filter("gender = 'FEMALE'").count() == 1


def test_exact_and_null_id_repeats(spark):
    rows = [(0, "a", "1"), (1, "a", "1"), (2, None, "x"), (3, None, "y"), (4, None, "x"), (5, "b", None), (6, "b", None)]
    df = small_table(spark, rows, "src_row bigint, customer_id string, v string")
    counts = K.repeat_counts(df).first()
    assert (counts["rows_before"], counts["exact_repeats"], counts["id_repeats"], counts["rows_after"]) == (7, 3, 1, 3)
    assert sorted(r["src_row"] for r in K.keep_first(K.drop_exact_repeats(df)).collect()) == [0, 2, 5]
    assert sorted(r["src_row"] for r in K.remove_repeats(df).collect()) == [0, 2, 5]
    kept = K.counted_repeats(df)
    assert K.repeat_totals(kept).first() == counts
    no_id = df.drop("customer_id")
    assert sorted(r["src_row"] for r in K.remove_repeats(no_id).collect()) == [0, 2, 3, 5]
    assert K.keep_first(no_id).count() == 7


def test_numbers(spark):
    texts = ["12", " 12 ", "1.5", ".5", "5.", "-3", "+4", "1e3", "inf", "-Infinity", "1,000", "1_000", "0x10", "$5", "1d", "1.0f", "nan", "", "  ", "1e400", None]
    want = [12, 12, 1.5, 0.5, 5, -3, 4, 1000, float("inf"), float("-inf")] + [None] * 11
    df = small_table(spark, [(i, t) for i, t in enumerate(texts)], "i int, t string")
    kind = df.schema["t"].dataType
    got = [r[0] for r in df.orderBy("i").select(V.to_number(F.col("t"), kind)).collect()]
    assert got == want
    whole = [r[0] for r in df.orderBy("i").select(V.to_whole(F.col("t"), kind)).collect()]
    assert whole == [12, 12, 1, 0, 5, -3, 4, 1000] + [None] * 13
    big = small_table(spark, [("9007199254740993",)], "t string").select(V.to_whole(F.col("t"), kind)).first()[0]
    assert big == 9007199254740993


def test_infinity_is_capped_and_nan_is_null(spark):
    df = small_table(spark, [(0, "inf"), (1, "-inf"), (2, "nan")], "src_row bigint, tenure_months string")
    assert column(K.clean_rows(df), "tenure_months") == [120.0, 0.0, None]
    issues = {(r["kind"], r["column"]): r["n"] for r in K.issue_counts(df).collect()}
    assert issues["garbage", "tenure_months"] == 1 and issues["capped", "tenure_months"] == 2


def test_unicode_and_tabs_are_stripped(spark):
    df = small_table(spark, [(0, "\tm2m\n"), (1, " MTM "), (2, " odd ")], "src_row bigint, contract_type string")
    assert column(K.normalize_categories(df), "contract_type") == ["month-to-month", "month-to-month", " odd "]


def test_text_of_numbers_and_rounding(spark):
    df = small_table(spark, [(0, 1.0), (1, 1.5), (2, float("nan")), (3, None), (4, -0.004), (5, 0.125)], "i int, x double")
    kind = df.schema["x"].dataType
    assert [r[0] for r in df.orderBy("i").limit(4).select(V.to_text(F.col("x"), kind)).collect()] == ["1", "1.5", None, None]
    signed = {r[0]: r[1] for r in df.filter("i in (0, 4, 5)").select("i", V.signed_text(F.col("x"))).collect()}
    assert signed == {0: "+1.00", 4: "-0.00", 5: "+0.13"}
    assert spark.range(1).select(V.signed_text(F.lit(-0.0)), V.fixed_text(F.lit(16.666), 1)).first()[:] == ("+0.00", "16.7")


def test_mapping_rules(spark):
    df = small_table(spark, [("x", 1, "1.5", None), ("y", 0, "bad", "k")], "Id string, Flag bigint, Fee string, extra string")
    m = Mapping("c", columns={"Id": "customer_id", "fee": "monthly_charges", "Flag": "churn_label", "gone": "gender"}, values={"churn_label": {1: "yes"}}, types={"Fee": "float"})
    out = M.apply_mapping(df, m)
    assert out.columns == ["customer_id", "churn_label", "Fee", "extra"]  # "fee" is another name than "Fee"
    assert [tuple(r) for r in out.orderBy("customer_id").collect()] == [("x", "yes", 1.5, None), ("y", "0", None, "k")]
    with pytest.raises(ValueError):
        M.rename_columns(df, {"Id": "customer_id", "Fee": "customer_id"})


def test_long_value_list_becomes_a_join(spark):
    pairs = {str(i): f"v{i}" for i in range(1000)}
    df = spark.range(1200).select(F.col("id").cast("string").alias("c"))
    out = M.map_values(df, {"c": pairs})
    assert out.filter("c like 'v%'").count() == 1000 and out.count() == 1200
    assert "Join" in out._jdf.queryExecution().executedPlan().toString()


def test_reports_of_many_clients_equal_those_of_each(spark, sf):
    """One job with groups, against one job a client."""
    from checks import fixtures as X
    from tenura.operators import drift as D

    rows = X.mapped(spark, sf)
    half = rows.filter("src_row % 3 = 0")
    both = rows.withColumn("client_id", F.lit("a")).union(half.withColumn("client_id", F.lit("b")))
    table, report = K.clean_table(both, group=["client_id"])
    got = {}
    for r in report.collect():
        got.setdefault(r["client_id"], []).append(tuple(r)[1:])
    alone = {c: K.clean_table(df) for c, df in (("a", rows), ("b", half))}
    for c, (_, own) in alone.items():
        assert sorted(got[c], key=repr) == sorted(map(tuple, own.collect()), key=repr)
    names = ["tenure_months", "monthly_charges"]
    snapshot = D.training_snapshot(D.long_values(table, names, ["client_id"]), group=["client_id"])
    moved = table.withColumn("tenure_months", F.col("tenure_months") * F.when(F.col("client_id") == "a", 0.2).otherwise(1.0))
    scores = D.psi_scores(snapshot, D.long_values(moved, names, ["client_id"]), group=["client_id"])
    said = {r["client_id"]: r["features_drifted"] for r in D.drift_report(scores, "2024-02-01", group=["client_id"]).collect()}
    assert said == {"a": ["tenure_months"], "b": []}
