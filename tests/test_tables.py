"""Configs, paths, validation over column subsets, prompts and responses."""

import itertools
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tenura.contract import CONTRACT, fields_by_tier
from tenura.operators import cleaning as K
from tenura.operators import mapping as M
from tenura.operators import prompts as P
from tenura.operators import validation as VA
from tenura.session import clear_staged, shared_folder, small_table, stage
from tenura.sources import catalog as C
from tenura.sources import client_tables as CT
from tenura.sources import csv_source as IO
from tenura.sources import paths as PA

WORD = st.text("abcdefgXYZ019_", min_size=1, max_size=8)
KINDS = st.sampled_from(["float", "int", "string", "category"])
CONFIGS = st.lists(
    st.tuples(WORD, st.dictionaries(WORD, WORD, max_size=4), st.dictionaries(WORD, st.dictionaries(WORD, WORD, min_size=1, max_size=3), max_size=3), st.dictionaries(WORD, KINDS, max_size=3)),
    min_size=1, max_size=60, unique_by=lambda c: c[0],
)


@settings(max_examples=4, deadline=None)
@given(configs=CONFIGS)
def test_configs_round_trip(spark, configs):
    """Property 1, many configs per job: rows to YAML text to rows."""
    catalog = C.catalog_of(spark, [C.Mapping(f"c_{n}", f"about {n}", cols, vals, types) for n, cols, vals, types in configs])
    texts = C.config_texts(catalog).select(F.concat("client_id", F.lit(".yaml")).alias("path"), "value")
    columns = ["client_id", "kind", "field", "from_value", "to_value", "status"]
    back = C.parse_configs(texts).select(columns)
    key = repr
    assert sorted(map(tuple, back.collect()), key=key) == sorted(map(tuple, catalog.select(columns).collect()), key=key)


YAML = """client_id: "shop"
source_description: "a shop"
column_mappings:
  CustomerID: customer_id
  Churn: churn_label
value_mappings:
  churn_label:
    1: 1
    Yes: 1
type_coercions:
  churn_label: "int"
"""


def test_config_files(spark, tmp_path):
    for name, text in (("a/mapping.yaml", YAML), ("b/mapping.draft.yaml", "client_id: b\ncolumn_mappings:\n")):
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_text(text)
    catalog = C.read_configs(spark, str(tmp_path))
    m = C.mapping_of(catalog, "shop")
    assert m == C.Mapping("shop", "a shop", {"CustomerID": "customer_id", "Churn": "churn_label"}, {"churn_label": {"1": "1", "Yes": "1"}}, {"churn_label": "int"})
    assert catalog.count() == 6
    for bad in ("", "source_description: x\n"):
        with pytest.raises(Exception, match="mapping config"):
            C.parse_configs(small_table(spark, [("p", bad)], "path string, value string")).collect()


def test_written_configs_share_folders_and_are_read_by_many_tasks(spark, tmp_path):
    ids = ["_a", "b.draft", "c/d e", "ü%", *[f"client_{k}" for k in range(300)]]
    rows = [(i, f"client_id: '{i}'\ncolumn_mappings:\n  x: y") for i in ids] * 2
    C.write_configs(spark.createDataFrame(rows, "client_id string, value string"), f"file://{tmp_path}/configs")
    files = list((tmp_path / "configs").rglob("*.yaml"))
    assert len(files) == len(ids) and len({f.parent for f in files}) <= spark.sparkContext.defaultParallelism
    loaded = C.read_configs(spark, f"file://{tmp_path}/configs")
    assert Counter(map(tuple, loaded.select("client_id", "from_value", "status").collect())) == Counter((i, "x", "approved") for i in ids)
    texts = C.config_texts(loaded).select("client_id", F.spark_partition_id().alias("task")).collect()
    assert len(texts) == len(ids) and len({r.task for r in texts}) > spark.sparkContext.defaultParallelism
    nameless = spark.createDataFrame([(None, None)], "client_id string, value string")
    C.write_configs(nameless, f"file://{tmp_path}/nameless")
    with pytest.raises(Exception, match="empty mapping config"):
        C.read_configs(spark, f"file://{tmp_path}/nameless").collect()


def test_paths_belong_to_their_client(spark):
    """Property 9."""
    ids = ["acme", "acme2", "acm", "zeta"]
    clients = small_table(spark, [(c, "2024-01-15", "2024-02-01", "v3") for c in ids], "client_id string, upload_date string, run_date string, model_version string")
    paths = PA.client_paths(clients, "lake").withColumnRenamed("client_id", "owner")
    asked = paths.withColumn("asked", F.explode(F.array(*map(F.lit, ids)))).withColumn("own", PA.belongs_to_client(F.col("path"), "lake", F.col("asked")))
    rows = asked.collect()
    assert len(rows) == 10 * 4 * 4 and all(r["own"] == (r["owner"] == r["asked"]) and r["owner"] in r["path"] for r in rows)
    assert not clients.limit(1).select(PA.belongs_to_client(F.lit("s3://other/acme/x"), "lake", F.lit("acme"))).first()[0]


def test_reads_refuse_files_of_other_clients(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "acme/x"))
    spark.range(2).write.parquet(str(tmp_path / "acme2/x"))
    own = spark.read.parquet(str(tmp_path / "acme/x"))
    assert PA.only_client_files(own, f"file://{tmp_path}/acme").count() == 3
    with pytest.raises(Exception, match="file of another client"):
        PA.only_client_files(spark.read.parquet(str(tmp_path / "acme2/x")), f"file://{tmp_path}/acme").count()


def test_csv_keeps_order_and_nulls_tokens(spark, tmp_path):
    text = "a,b\n" + "".join(f"{i},{['x', 'N/A', '', ' ', 'NaN', 'na'][i % 6]}\n" for i in range(60_000))
    (tmp_path / "big.csv").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = IO.read_client_csv(spark, str(tmp_path / "big.csv"), multi_line=False)
        assert df.rdd.getNumPartitions() > 3
        rows = df.orderBy("src_row").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [int(r["a"]) for r in rows] == list(range(60_000))
    assert [r["b"] for r in rows[:6]] == ["x", None, None, " ", None, "na"]


QUOTED = 'id,"a ""name""",x\n1,"he said ""hi"", bye",2\n2,"two\nlines","\\"\n3,,"N/A"\n'


def test_csv_cells_with_quotes_commas_and_line_breaks(spark, tmp_path):
    (tmp_path / "q.csv").write_text(QUOTED)
    rows = IO.read_client_csv(spark, str(tmp_path / "q.csv"), ["x", "id", 'a "name"']).orderBy("src_row").collect()
    assert [tuple(r)[:3] for r in rows] == [("2", "1", 'he said "hi", bye'), ("\\", "2", "two\nlines"), (None, "3", None)]
    with pytest.raises(ValueError, match="no columns"):
        IO.read_client_csv(spark, str(tmp_path / "q.csv"), ["id", "gone"])
    (tmp_path / "two").mkdir()
    (tmp_path / "two/a.csv").write_text("id,x\n1,2\n")
    (tmp_path / "two/b.csv").write_text("x,id\n4,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        IO.read_client_csv(spark, str(tmp_path / "two")).collect()


def _messy(rng, n):
    cells = ["", "x", 'a "quoted" word', "two\nlines", "\n\n", "comma, here", '"', "\r\nend", " blank ", "é", "N/A", "-"]
    return [[str(i), *(cells[rng.randrange(len(cells))] for _ in range(3))] for i in range(n)]


@pytest.mark.parametrize("size", [None, "800", "150"])
def test_quoted_files_are_split_and_keep_their_order(spark, tmp_path, size):
    """Three files with quotes and line breaks, against the csv module; the same rows and numbers for any split size."""
    import csv
    import random

    rng, want = random.Random(4), []
    for name in ("b.csv", "a.csv", "c.csv"):
        rows = _messy(rng, 50)
        with (tmp_path / name).open("w", newline="") as f:
            csv.writer(f, lineterminator="\r\n" if name == "c.csv" else "\n").writerows([["id", "x", "y y", "z"], *rows])
        want.append((name, [[r[0], *(None if c in ("", "N/A") else c for c in r[1:])] for r in rows]))
    want = [r for _, rows in sorted(want) for r in rows]
    if size:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = IO.read_client_csv(spark, str(tmp_path))
        got = [list(r) for r in df.orderBy("src_row").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r[:4] for r in got] == want and [r[4] for r in got] == list(range(150))


def test_first_rows_win_over_several_files(spark, tmp_path):
    """CLN-2 on three files: the first file by its path holds the row that stays."""
    for k, name in enumerate(("c.csv", "a.csv", "b.csv")):
        (tmp_path / name).write_text("customer_id,v\n" + "".join(f'{i},"{name}\n{i}"\n' for i in range(k, 40)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        kept = K.keep_first(IO.read_client_csv(spark, str(tmp_path)))
        got = {r["customer_id"]: r["v"] for r in kept.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {str(i): f"{'a.csv' if i else 'c.csv'}\n{i}" for i in range(40)}


def test_csv_files_with_nothing_in_them_and_open_quotes(spark, tmp_path):
    for name, text in (("empty.csv", ""), ("blank.csv", "\n\n"), ("head.csv", "id,x,\n"), ("open.csv", 'id,x\n1,"a\n2,b\n')):
        (tmp_path / name).write_text(text)
    assert IO.read_client_csv(spark, str(tmp_path / "empty.csv")).columns == ["src_row"]
    assert IO.read_client_csv(spark, str(tmp_path / "blank.csv")).count() == 0
    head = IO.read_client_csv(spark, str(tmp_path / "head.csv"))
    assert head.columns == ["id", "x", "_c2", "src_row"] and head.count() == 0
    with pytest.raises(Exception, match="not closed"):
        IO.read_client_csv(spark, str(tmp_path / "open.csv")).collect()
    assert [tuple(r) for r in IO.read_client_csv(spark, str(tmp_path / "open.csv"), multi_line=False).collect()][1:] == [("2", "b", 1)]


def _state(spark, path):
    return sorted((r["client_id"], r["run_date"], r["v"]) for r in spark.read.schema("v long, client_id string, run_date string").parquet(path).collect())


def _batch(spark, client, values, day="d1"):
    return small_table(spark, [(v, client, day) for v in values], "v long, client_id string, run_date string")


def test_clients_share_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    CT.write_table(_batch(spark, "a", [1, 2]), path)
    assert _state(spark, path) == [("a", "d1", 1), ("a", "d1", 2)]
    CT.write_table(_batch(spark, "b", [5]).union(_batch(spark, "b", [6], "d2")), path)
    assert _state(spark, path) == [("a", "d1", 1), ("a", "d1", 2), ("b", "d1", 5), ("b", "d2", 6)]
    CT.write_table(_batch(spark, "a", [3]), path)
    assert _state(spark, path) == [("a", "d1", 3), ("b", "d1", 5), ("b", "d2", 6)]
    with pytest.raises(FileExistsError):
        CT.write_table(_batch(spark, "c", [7]).union(_batch(spark, "b", [8], "d2")), path, mode="error")
    CT.write_table(_batch(spark, "c", []), path)
    assert _state(spark, path) == [("a", "d1", 3), ("b", "d1", 5), ("b", "d2", 6)]
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith("_")]


def test_a_write_that_dies_is_completed_or_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    CT.write_table(_batch(spark, "a", [1]).union(_batch(spark, "b", [1])), path)
    new = _batch(spark, "a", [2]).union(_batch(spark, "b", [2]))

    def dies(*args):
        raise KeyboardInterrupt

    # Before the exchange begins: the marker is there, nothing is exchanged yet.
    with monkeypatch.context() as m:
        m.setattr(CT, "_publish", dies)
        with pytest.raises(KeyboardInterrupt):
            CT.write_table(new, path)
    assert _state(spark, path) == [("a", "d1", 1), ("b", "d1", 1)]
    # In the middle: one partition is exchanged, the other one deleted only.
    (batch,) = (tmp_path / "t").glob("_batch-*")
    for p in (tmp_path / "t/client_id=a/run_date=d1").iterdir():
        p.unlink()
    (tmp_path / "t/client_id=a/run_date=d1").rmdir()
    assert CT.finish_writes(spark, path) == 1 and CT.finish_writes(spark, path) == 0
    assert _state(spark, path) == [("a", "d1", 2), ("b", "d1", 2)]
    # Before the marker: no reader and no later write sees it.
    with monkeypatch.context() as m:
        m.setattr(CT, "_COMPLETE", "nowhere/\0")
        with pytest.raises(Exception):
            CT.write_table(_batch(spark, "a", [9]), path)
    CT.write_table(_batch(spark, "b", [3]), path)
    assert _state(spark, path) == [("a", "d1", 2), ("b", "d1", 3)]
    assert CT.drop_unfinished(spark, path) == 1 and not list((tmp_path / "t").glob("_batch-*"))


def test_written_csv_is_read_by_others(spark, tmp_path):
    import csv

    cells = [("a", 'said "x", left'), ("b", "two\nlines"), ("c", " blank "), ("d", "back\\slash")]
    IO.write_csv(small_table(spark, cells, "id string, note string").coalesce(1), str(tmp_path / "out"))
    (file,) = (tmp_path / "out").glob("*.csv")
    with file.open(newline="") as f:
        assert [tuple(r) for r in csv.reader(f)] == [("id", "note"), *cells]


def test_reads_take_the_prefix_of_the_client(spark, tmp_path):
    (tmp_path / "acme2").mkdir()
    (tmp_path / "acme2/d.csv").write_text("id\n1\n")
    assert IO.read_client_csv(spark, str(tmp_path / "acme2/d.csv"), prefix=f"file://{tmp_path}/acme2").count() == 1
    with pytest.raises(Exception, match="file of another client"):
        IO.read_client_csv(spark, str(tmp_path / "acme2/d.csv"), prefix=f"file://{tmp_path}/acme").collect()


def test_samples_keep_n_rows_per_task_before_the_shuffle(spark):
    raw = spark.range(1000).select(F.when(F.col("id") < 990, "c").otherwise("d").alias("client_id"), F.col("id").alias("src_row"), F.create_map(F.lit("k"), F.col("id").cast("string")).alias("raw"))
    out = IO.sample_rows(raw, 5)
    assert [r["value"] for r in out.orderBy("client_id", "row_no").collect()] == ["0", "1", "2", "3", "4", "990", "991", "992", "993", "994"]
    assert "WindowGroupLimit [client_id" in out._jdf.queryExecution().executedPlan().toString()


# --- validation ------------------------------------------------------------------------------------------------


def test_valid_exactly_when_tier_one_is_there(spark):
    """Property 2, all subsets of the required fields with some of the others, in one job."""
    required, others = fields_by_tier(1), fields_by_tier(2) + fields_by_tier(3)
    tables = {}
    for n, have in enumerate(s for k in range(6) for s in itertools.combinations(required, k)):
        extra = others[: n % 7]
        tables[f"t{n}"] = [*have, *extra, "not_in_contract"]
    rows = [(t, c) for t, cols in tables.items() for c in cols] + [("none", None)]
    df = small_table(spark, rows, "table_name string, column_name string")
    got = {r["table_name"]: r for r in VA.verdicts(VA.field_presence(df)).collect()}
    for t, cols in tables.items():
        assert got[t]["is_valid"] == (set(required) <= set(cols))
        assert got[t]["n_missing"] == sum(c.field not in cols for c in CONTRACT)
    assert not got["none"]["is_valid"]


def test_bad_types_and_empty_tables(spark):
    schema = "customer_id string, tenure_months string, monthly_charges double, total_charges string, churn_label bigint, contract_type string, extra string"
    rows = [("a", "twelve", 1.0, "600.0", 0, "invalid_contract", "x"), ("b", "twenty-four", 2.0, " ", 1, "one_year", "y"), ("c", "abc", None, "3600.0", 0, None, "z")]
    df = small_table(spark, rows, schema)
    report = {r["field"]: r for r in VA.validation_report(df).collect()}
    assert report["*"]["present"]  # bad types do not reject
    assert report["tenure_months"]["error"] == "Field 'tenure_months': expected int, but 3 values cannot be converted to numeric"
    assert report["total_charges"]["n_bad"] == 1 and report["monthly_charges"]["error"] is None
    assert report["contract_type"]["error"] == (
        "Field 'contract_type': found 1 invalid values, the first of them 'invalid_contract'. Allowed: ['month-to-month', 'one_year', 'two_year']"
    )
    empty = {r["field"]: r for r in VA.validation_report(df.filter("false")).collect()}
    assert not any(r["present"] for r in empty.values()) and empty["*"]["error"] == "DataFrame is empty (0 rows)"
    assert not VA.is_valid(df.filter("false")) and not VA.is_valid(df.drop("churn_label")) and VA.is_valid(df)


@pytest.mark.parametrize("n", [100, 101, 1000])
def test_bad_values_are_told_alike_however_many(spark, n):
    df = spark.range(n).select(F.lit("c").alias("customer_id"), F.concat(F.lit("odd"), "id").alias("contract_type"))
    report = {r["field"]: r for r in VA.validation_report(df).collect()}["contract_type"]
    assert report["n_bad_values"] == n and f"found {n} invalid values, the first of them 'odd0'" in report["error"]
    assert VA.bad_values(df).count() == n


@pytest.mark.parametrize("n", [3, 250])
def test_value_keys_that_are_one_text_do_not_double_rows(spark, n):
    df = small_table(spark, [("1",), ("2",)], "v string")
    pairs = {**{k + 10: "x" for k in range(n)}, 1: "first", "1": "last"}
    assert sorted(r.v for r in M.map_values(df, {"v": pairs}).collect()) == ["2", "last"]


def test_clients_with_equal_ids_keep_their_rows(spark):
    df = small_table(spark, [("a", "7", 0), ("b", "7", 1), ("a", "7", 2)], "client_id string, customer_id string, src_row bigint")
    assert sorted((r.client_id, r.src_row) for r in K.remove_repeats(df).collect()) == [("a", 0), ("b", 1)]
    assert K.counted_repeats(df).count() == 2 and K.repeat_counts(df).first()["rows_after"] == 2


# --- catalog-driven mapping ------------------------------------------------------------------------------------


def test_only_usable_mappings_are_applied(spark):
    """Drafts are not used, a client's own bounds apply, raw columns with a field's name need no entry."""
    def entry(client, kind, field, old, new, status="approved"):
        return (client, kind, field, old, new, None, None, status)

    rows = [
        entry("a", "column", "monthly_charges", "Fee", "monthly_charges"), entry("a", "column", "gender", "Sex", "gender", "draft"),
        entry("a", "bound", "monthly_charges", "0", "900"), entry("b", "column", "monthly_charges", "Fee", "monthly_charges"),
        entry("b", "column", "partner_status", "gender", "partner_status"), entry("c", "column", "monthly_charges", "Fee", "monthly_charges", "draft"),
        entry("d", "column", "gender", "Sex", "gender"), entry("d", "column", "gender", "Fee", "gender"),
        entry("e", "value", "gender", "M", "Male"), entry("e", "value", "gender", "M", "Man"),
    ]
    catalog = small_table(spark, rows, C.CATALOG_SCHEMA)
    raw = small_table(spark, [(c, 0, {"Fee": "800", "Sex": "M", "gender": "F"}) for c in "abcdef"], "client_id string, src_row bigint, raw map<string,string>")
    mapped = M.apply_catalog(raw, catalog, leave_out=True)
    out = K.cap_numbers(K.with_client_bounds(K.parse_numbers(mapped), catalog))
    assert {r["client_id"]: (r["monthly_charges"], r["gender"], r["partner_status"]) for r in out.collect()} == {"a": (800.0, "F", None), "b": (500.0, None, "F")}
    reasons = {r["client_id"]: (r["n_rows"], r["reason"]) for r in M.rejected_clients(raw, catalog).collect()}
    assert reasons == {"c": (1, "no approved mapping"), "d": (1, "two columns become gender"), "e": (1, "a value of gender has two targets"), "f": (1, "no approved mapping")}
    with pytest.raises(Exception, match="no usable mapping for client"):
        M.apply_catalog(raw, catalog).collect()


def test_bounds_and_reasoning_survive_config_files(spark):
    rows = [("a", "column", "gender", "Sex", "gender", "high", "it says so", "approved"), ("a", "bound", "monthly_charges", "0", "900", None, None, "approved")]
    catalog = small_table(spark, rows, C.CATALOG_SCHEMA)
    back = C.parse_configs(C.config_texts(catalog).select(F.lit("a.yaml").alias("path"), "value"))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)


# --- prompts and responses -------------------------------------------------------------------------------------


def scored(spark, n):
    rows = [(f"CUST_{i:03d}", i, i / n, "high", [("contract_type", 0.23), ("tenure_months", -0.08)]) for i in range(n)]
    return small_table(spark, rows, "customer_id string, src_row bigint, churn_probability double, risk_tier string, top array<struct<feature:string,contribution:double>>")


@pytest.mark.parametrize("small", [0, 1000])
def test_prompts_hold_everything(spark, small):
    """Property 12; fifty customers make one prompt, order is kept."""
    prompts = P.narrative_prompts(P.batches(scored(spark, 120), ["src_row"], small=small), {"tenure_months": "How long"}).orderBy("batch_id").collect()
    assert [r["n_customers"] for r in prompts] == [50, 50, 20]
    for b, r in enumerate(prompts):
        at = [r["prompt"].index(f"--- Customer: CUST_{i:03d} ---\n") for i in range(b * 50, min(b * 50 + 50, 120))]
        assert at == sorted(at)
    text = prompts[0]["prompt"]
    assert "Churn probability: 0.02\nRisk tier: high\nTop contributing factors:\n  - contract_type (+0.23)\n  - tenure_months (-0.08)\n" in text
    assert "  - tenure_months: How long\n" in text and "under 150 words" in text and "non-technical" in text and "SHAP" in text
    assert P.prompt_head() in P.narrative_prompts(P.batches(scored(spark, 1), ["src_row"])).first()["prompt"]


TOLD = [
    ("CUSTOMER_ID: north\nNARRATIVE: Pays late.\n\nCUSTOMER_ID: south\nNARRATIVE: Stays. Pays on time.", {"north": "Pays late.", "south": "Stays. Pays on time."}),
    ("CUSTOMER_ID: north\nNARRATIVE: Begins here.\nGoes on.\r\n   Ends.  ", {"north": "Begins here. Goes on. Ends."}),
    ("", {}),
    ("Dear team\nNARRATIVE: of nobody\nCUSTOMER_ID: north\nCUSTOMER_ID: south\nNARRATIVE:\nbelow the mark", {"north": "", "south": "below the mark"}),
    ("CUSTOMER_ID: north\nNARRATIVE: before\nCUSTOMER_ID: north\nNARRATIVE: after", {"north": "after"}),
    ("  CUSTOMER_ID:  north CUSTOMER_ID: x \n\n NARRATIVE: marks NARRATIVE: once\nand CUSTOMER_ID: south within", {"north  x": "marks  once and CUSTOMER_ID: south within"}),
]


def test_narrative_responses(spark):
    df = small_table(spark, [*enumerate(text for text, _ in TOLD), (99, None)], "batch_id bigint, response string")
    got = {}
    for r in P.parse_narratives(df).collect():
        got.setdefault(r["batch_id"], {})[r["customer_id"]] = r["narrative"]
    assert got == {i: said for i, (_, said) in enumerate(TOLD) if said}


def test_calls_are_spread_and_made_once(spark, tmp_path):
    def call(prompt):
        import uuid

        from pyspark import TaskContext

        (tmp_path / uuid.uuid4().hex).write_text(prompt)
        return str(TaskContext.get().partitionId())

    prompts = small_table(spark, [(i, f"p{i}") for i in range(40)], "batch_id bigint, prompt string")
    answers = P.ask(prompts, call, threads=1)
    assert answers.count() == 40 and answers.count() == 40
    assert len({r.response for r in answers.collect()}) > 1 and len(list(tmp_path.iterdir())) == 40


def test_answers_outlive_tasks_and_jobs_that_die(spark, tmp_path):
    """A job that dies midway keeps the rounds before; a rerun asks only what is left; failed calls are tried again; equal prompts are asked once."""
    calls, store = tmp_path / "calls", str(tmp_path / "store")
    calls.mkdir()

    def caller(dies_at=None, fails_on=()):
        def call(prompt):
            import os
            import uuid

            (calls / uuid.uuid4().hex).write_text(prompt)
            if prompt == dies_at:
                os._exit(1)
            if prompt in fails_on:
                raise ValueError("down")
            return prompt.upper()

        return call

    def made():
        return [p.read_text() for p in calls.iterdir()]

    prompts = small_table(spark, [(i, f"p{i % 50}") for i in range(60)] + [(99, None)], "batch_id bigint, prompt string")
    with pytest.raises(Exception):
        P.ask(prompts, caller(dies_at="p7"), store=store, chunk=2, per_round=10, threads=1).count()
    kept = {r["response"].lower() for r in spark.read.parquet(store).collect()} if (tmp_path / "store").exists() else set()
    before = len(made())
    answers = P.ask(prompts, caller(fails_on=("p7",)), store=store, chunk=2, per_round=10, threads=1)
    got = {r["batch_id"]: r["response"] for r in answers.collect()}
    assert got == {**{i: None if i % 50 == 7 else f"P{i % 50}" for i in range(60)}, 99: None}
    assert len(made()) - before == 50 - len(kept)
    again = P.ask(prompts, caller(), store=store)
    assert {r["batch_id"]: r["response"] for r in again.collect()}[7] == "P7" and len(made()) - before == 51 - len(kept)


def test_failures_stay_in_their_batch(spark):
    def call(prompt):
        if "CUST_060" in prompt:
            raise ValueError("down")
        return "CUSTOMER_ID: CUST_001\nNARRATIVE: Fine.\nCUSTOMER_ID: CUST_119\nNARRATIVE: wrong batch"

    batched = stage(P.batches(scored(spark, 120), ["src_row"]))
    answers = P.ask(P.narrative_prompts(batched), call)
    assert {r["batch_id"]: r["response"] is None for r in answers.collect()} == {0: False, 1: True, 2: False}
    out = {r["customer_id"]: (r["narrative"], r["success"]) for r in P.attach_narratives(batched, P.parse_narratives(answers)).collect()}
    assert len(out) == 120 and out["CUST_001"] == ("Fine.", True) and out["CUST_119"] == ("wrong batch", True)
    assert sum(ok for _, ok in out.values()) == 2 and out["CUST_060"] == ("N/A", False)


ANSWERS = {
    "plain": ('[{"source_column": "Fee", "target_field": "monthly_charges", "confidence": "high", "reasoning": "r"}, {"source_column": "Id", "target_field": "customer_id"}]',
              [("Fee", "monthly_charges", "high", "r"), ("Id", "customer_id", "medium", "")]),
    "tagged": ('Here:\n\n```json\n[\n {"source_column": "t", "target_field": "tenure_months", "confidence": "high", "reasoning": "d"}\n]\n```\n', [("t", "tenure_months", "high", "d")]),
    "fenced": ('```\n[{"source_column": "t", "target_field": "tenure_months"}]\n``` bye', [("t", "tenure_months", "medium", "")]),
    "null target": ('[{"source_column": "x", "target_field": null}, {"target_field": null}]', []),
    "no source": ('[{"source_column": "x", "target_field": "gender"}, {"target_field": "gender"}]', []),
    "text": ("no brackets here", []),
    "object": ('{"source_column": "x", "target_field": "gender"}', []),
    "strings": ('["x"]', []),
    "cut off": ('[{"source_column": "x", "target_field": "gen', []),
    "single quotes": ("[{'source_column': 'x', 'target_field': 'gender'}]", []),
    "nothing": (None, []),
}


def test_mapping_answers(spark):
    df = small_table(spark, [(n, text) for n, (text, _) in ANSWERS.items()], "client_id string, response string")
    got = {n: [] for n in ANSWERS}
    for r in P.mapping_answers(df).orderBy("client_id", "pos").collect():
        got[r["client_id"]].append((r["source_column"], r["target_field"], r["confidence"], r["reasoning"]))
    assert got == {n: want for n, (_, want) in ANSWERS.items()}


def test_draft_catalog_is_readable_as_config_text(spark):
    df = small_table(spark, [("a", ANSWERS["plain"][0])], "client_id string, response string")
    text = C.config_texts(P.draft_rows(P.mapping_answers(df))).first()
    assert text["status"] == "draft" and "Fee: monthly_charges" in text["value"] and "confidence_scores" in text["value"]
    back = C.parse_configs(small_table(spark, [("a.draft.yaml", text["value"])], "path string, value string"))
    assert {(r["from_value"], r["confidence"], r["status"]) for r in back.collect()} == {("Fee", "high", "draft"), ("Id", "medium", "draft")}


def test_mapping_prompt_names_fields_columns_and_samples(spark):
    raw = small_table(spark, [("a", 0, {"shoe": "left 42", "laces": "1.5"}), ("a", 1, {"shoe": "it", "laces": None})], "client_id string, src_row bigint, raw map<string,string>")
    prompt = P.mapping_prompts(IO.sample_rows(raw)).first()["prompt"]
    assert "Client columns: ['shoe', 'laces']\n" in prompt and "  Row 1: shoe='left 42', laces=1.5\n  Row 2: shoe='it', laces=nan\n" in prompt
    assert all(f"  - {c.field} ({c.dtype}): {c.description}\n" in prompt for c in CONTRACT)


# --- staging ---------------------------------------------------------------------------------------------------


def test_staged_copies_live_in_the_shared_folder_and_can_be_cleared(spark):
    staged = stage(spark.range(5))
    assert staged.count() == 5 and shared_folder(spark) in staged.inputFiles()[0]
    assert clear_staged(spark) > 0 and clear_staged(spark) == 0


def test_a_shared_folder_is_asked_for_outside_one_machine():
    from tenura.session import require_shared_folder

    for master in ("local", "local[4]", "local[*]"):
        require_shared_folder(master)
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,3000]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            require_shared_folder(master)
