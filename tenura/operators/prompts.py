"""Prompt tables and response tables for narratives and mapping drafts. The model call itself is a given callable."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.contract import CONTRACT, ContractField
from tenura.functions import values as V
from tenura.functions.order import global_rank
from tenura.session import path_exists, stage, staged_folder

# The wording of the narrative prompt.
NARRATIVE_ROLE = (
    "You are an expert customer retention analyst writing for non-technical business users. "
    "For each customer, explain in plain English WHY the model predicts they are at risk of leaving. "
    "Reference specific feature values. Use simple language. Keep each explanation under 150 words. "
    "Do not use technical jargon like 'SHAP values' or 'feature importance.'"
)
NARRATIVE_TASK = (
    "For each customer below, write a plain-English paragraph (under 150 words) explaining why they are at risk of "
    "leaving. Reference the specific factors listed.\n\nFormat your response as:\nCUSTOMER_ID: [customer_id]\n"
    "NARRATIVE: [your explanation]\n\n(Repeat for each customer)\n\n"
)
DEFINITIONS_HEAD = "Feature definitions (for your reference):\n"
# The wording of the mapping prompt, around the columns, the sample rows and the field list.
MAPPING_HEAD = "You are a data mapping expert. A client has uploaded a CSV with the following columns:\n\nClient columns: "
MAPPING_SAMPLE = "\n\nSample data:\n"
MAPPING_FIELDS = (
    "\n\nYour task: Map each client column to the most appropriate standard field from this list:\n\nStandard fields:\n"
)
MAPPING_RULES = (
    "\n\nFor each mapping, provide:\n1. The source column name (from the client)\n"
    "2. The target field name (from the standard list)\n"
    '3. A confidence level: "high", "medium", or "low"\n'
    "4. A brief reasoning why you think this mapping is correct\n\n"
    'Output your response as a JSON array of objects with keys: "source_column", "target_field", "confidence", "reasoning"\n\n'
    "If a client column doesn't map to any standard field, include it with target_field: null.\n\n"
    "Only map columns where you have reasonable confidence. It's better to leave a column unmapped than to guess wrong."
)
BATCH_SIZE = 50
FENCE = "```"


# --- narratives ------------------------------------------------------------------------------------------------


def batches(scored: DataFrame, order: Sequence[str], size: int = BATCH_SIZE, **how) -> DataFrame:
    """LLM-1: add ``position`` (from 1) and ``batch_id`` (from 0): consecutive runs of ``size`` rows in the order."""
    ranked = global_rank(scored, order, name="position", **how)
    return ranked.withColumn("batch_id", F.floor((F.col("position") - 1) / F.lit(size)).cast("bigint"))


def customer_block(customer: Column, p: Column, tier: Column, factors: Column) -> Column:
    """One customer's part of a prompt; ``factors`` is ``array<struct<feature, contribution>>``."""
    lines = F.transform(
        factors,
        lambda f: F.concat(F.lit("  - "), F.coalesce(f["feature"], F.lit("unknown")), F.lit(" ("), V.signed_text(F.coalesce(f["contribution"], F.lit(0.0))), F.lit(")\n")),
    )
    return F.concat(
        F.lit("\n--- Customer: "), customer, F.lit(" ---\nChurn probability: "), V.fixed_text(p, 2),
        F.lit("\nRisk tier: "), tier, F.lit("\nTop contributing factors:\n"), F.array_join(lines, ""),
    )


def prompt_head(definitions: Mapping[str, str] | None = None) -> str:
    told = "".join(f"  - {name}: {text}\n" for name, text in (definitions or {}).items())
    return NARRATIVE_ROLE + "\n\n" + (DEFINITIONS_HEAD + told + "\n" if told else "") + NARRATIVE_TASK


def narrative_prompts(batched: DataFrame, definitions: Mapping[str, str] | None = None, p: str = "churn_probability", factors: str = "top") -> DataFrame:
    """LLM-2: one prompt per batch, customers in their order; a group is one batch, never more."""
    block = customer_block(F.col("customer_id").cast("string"), F.col(p), F.col("risk_tier"), F.col(factors))
    listed = batched.select("batch_id", F.struct("position", block.alias("block")).alias("b"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("b")), lambda b: b["block"]), "")
    return listed.groupBy("batch_id").agg(F.count("*").alias("n_customers"), F.concat(F.lit(prompt_head(definitions)), joined).alias("prompt"))


# Prompts of one task: what a task that dies has to ask again, at most.
CHUNK = 8
# Prompts after which answers are committed, at least.
ROUND = 4096


def ask(
    prompts: DataFrame, call: Callable[[str], str], key: str = "batch_id", tasks: int | None = None, threads: int = 4, store: str | None = None, chunk: int = CHUNK, per_round: int | None = None
) -> DataFrame:
    """LLM-5: ``(key, response)``; a call that raises gives a null response for its own prompt only.

    Answers are kept in the folder ``store`` by the hash of their prompt, and a prompt that has one is not asked again: equal prompts are
    asked once, a rerun after a failure asks what is left, and failed calls are tried anew. Prompts are dealt to at least ``tasks``
    tasks (all cores by default) of about ``chunk`` prompts with ``threads`` calls at a time, and answers are committed after each round of
    ``per_round`` prompts, so a lost executor costs its chunks and a lost driver its round. Without ``store`` answers last until
    ``clear_staged``. A null prompt is not asked.
    """
    spark = prompts.sparkSession
    asked = stage(prompts.select(key, "prompt", F.sha2("prompt", 256).alias("_hash")), "prompts")
    store = store or staged_folder(spark, "answers")
    schema = "_hash string, response string"
    open_ = asked.where("_hash IS NOT NULL").groupBy("_hash").agg(F.first("prompt").alias("prompt"))
    if path_exists(spark, store):
        open_ = open_.join(spark.read.schema(schema).parquet(store), "_hash", "left_anti")
    open_ = stage(open_, "open")
    n, tasks = open_.count(), tasks or spark.sparkContext.defaultParallelism
    rounds = -(-n // (per_round or max(ROUND, 8 * tasks * chunk)))
    own_round = F.pmod(F.xxhash64("_hash"), F.lit(max(rounds, 1)))

    def run(frames):
        import logging
        from multiprocessing.pool import ThreadPool

        import pandas as pd

        def answer(prompt):
            try:
                return call(prompt)
            except Exception as error:
                logging.getLogger("prompts").warning("call failed: %s", error)
                return None

        for frame in frames:
            with ThreadPool(threads) as pool:
                out = pool.map(answer, frame["prompt"], chunksize=1)
            yield pd.DataFrame({"_hash": frame["_hash"], "response": pd.Series(out, dtype=object, index=frame.index)})

    for number in range(rounds):
        dealt = open_.where(own_round == number).repartition(max(tasks, -(-n // (rounds * chunk))), "_hash")
        dealt.mapInPandas(run, schema).where("response IS NOT NULL").write.mode("append").parquet(store)
    if not path_exists(spark, store):
        return asked.select(key, F.lit(None).cast("string").alias("response"))
    # Two runs at once may both have answered a prompt.
    answers = spark.read.schema(schema).parquet(store).groupBy("_hash").agg(F.min("response").alias("response"))
    return asked.join(answers, "_hash", "left").select(key, "response")


def parse_narratives(responses: DataFrame) -> DataFrame:
    """LLM-3: ``(batch_id, customer_id, narrative)``.

    Text before the first id is dropped, the lines of a narrative are joined by blanks, and when a response names an id
    twice its last narrative counts.
    """
    blocks = responses.filter(F.col("response").isNotNull()).select(
        "batch_id", F.posexplode(F.split("response", r"(?U)(^|\n)[^\S\n]*CUSTOMER_ID:")).alias("at", "block")
    )
    lines = F.split("block", "\n")
    customer = V.strip(F.replace(lines[0], F.lit("CUSTOMER_ID:"), F.lit("")))
    trimmed = F.transform(F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1))), V.strip)
    said = F.transform(trimmed, lambda t: F.when(F.startswith(t, F.lit("NARRATIVE:")), V.strip(F.replace(t, F.lit("NARRATIVE:"), F.lit("")))).otherwise(t))
    text = F.array_join(F.filter(said, lambda t: t != ""), " ")
    found = blocks.filter(F.col("at") > 0).select("batch_id", "at", customer.alias("customer_id"), text.alias("narrative"))
    return found.groupBy("batch_id", "customer_id").agg(F.max_by("narrative", "at").alias("narrative"))


def attach_narratives(batched: DataFrame, narratives: DataFrame) -> DataFrame:
    """LLM-4: ``narrative`` and ``success`` for every customer; ``N/A`` where the batch failed or left the id out."""
    own = narratives.select("batch_id", F.col("customer_id").alias("_id"), F.col("narrative").alias("_text"))
    match = (batched["batch_id"] == own["batch_id"]) & (batched["customer_id"].cast("string") == own["_id"])
    joined = batched.join(own, match, "left").drop(own["batch_id"])
    return joined.select(*batched.columns, F.coalesce("_text", F.lit("N/A")).alias("narrative"), F.col("_text").isNotNull().alias("success"))


# --- mapping drafts --------------------------------------------------------------------------------------------


def _shown(value: Column) -> Column:
    number = V.to_number(value, T.StringType())
    return F.when(value.isNull(), "nan").when(number.isNotNull(), V.strip(value)).otherwise(V.quoted(value))


def mapping_prompts(samples: DataFrame, fields: list[ContractField] | None = None, rows: int = 3, cells: int = 8) -> DataFrame:
    """LLM-6: one prompt per client from its sample rows ``(client_id, row_no, pos, column, value)``.

    A group holds one client's few sample rows.
    """
    contract = "\n".join(f"  - {c.field} ({c.dtype}): {c.description}" for c in fields or CONTRACT)
    cell = F.struct("pos", F.concat("column", F.lit("="), _shown(F.col("value"))).alias("text"))
    per_row = samples.groupBy("client_id", "row_no").agg(
        F.array_sort(F.collect_list(cell)).alias("cells"), F.array_sort(F.collect_list(F.struct("pos", "column"))).alias("names")
    )
    line = F.concat(F.lit("  Row "), F.col("row_no"), F.lit(": "), F.array_join(F.transform(F.slice("cells", 1, cells), lambda c: c["text"]), ", "), F.lit("\n"))
    shown = F.when(F.col("row_no") <= rows, F.struct("row_no", line.alias("line")))
    per_client = per_row.groupBy("client_id").agg(
        F.array_sort(F.collect_list(shown)).alias("lines"), F.min_by("names", "row_no").alias("names")
    )
    names = F.concat(F.lit("["), F.array_join(F.transform("names", lambda n: V.quoted(n["column"])), ", "), F.lit("]"))
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "")
    prompt = F.concat(F.lit(MAPPING_HEAD), names, F.lit(MAPPING_SAMPLE), text, F.lit(MAPPING_FIELDS + contract + MAPPING_RULES))
    return per_client.select("client_id", prompt.alias("prompt"))


_ANSWER = "array<struct<source_column:string,target_field:string,confidence:string,reasoning:string>>"


def mapping_answers(responses: DataFrame) -> DataFrame:
    """LLM-7: ``(client_id, pos, source_column, target_field, confidence, reasoning)`` from ``(client_id, response)``.

    A code fence is stripped, rows without a target are dropped, confidence defaults to ``medium`` and reasoning to
    nothing. A response that is no JSON array, or that names a target without a source, gives no rows at all.
    """
    text = V.strip(F.col("response"))
    after_tag = F.element_at(F.split(text, FENCE + "json"), 2)
    after_fence = F.element_at(F.split(text, FENCE), 2)
    body = F.when(F.contains(text, F.lit(FENCE + "json")), F.element_at(F.split(after_tag, FENCE), 1))
    body = V.strip(body.when(F.contains(text, F.lit(FENCE)), after_fence).otherwise(text))
    items = F.when(body.rlike(r"(?s)^\[.*\]$"), F.from_json(body, _ANSWER, {"allowSingleQuotes": "false"}))
    broken = F.exists("items", lambda x: x.isNull() | (x["target_field"].isNotNull() & x["source_column"].isNull()))
    parsed = responses.select("client_id", items.alias("items")).filter(F.col("items").isNotNull() & ~broken)
    return parsed.select("client_id", F.posexplode("items").alias("pos", "m")).filter(F.col("m.target_field").isNotNull()).select(
        "client_id", "pos", "m.source_column", "m.target_field", F.coalesce("m.confidence", F.lit("medium")).alias("confidence"), F.coalesce("m.reasoning", F.lit("")).alias("reasoning")
    )


def draft_rows(answers: DataFrame) -> DataFrame:
    """LLM-8: catalog rows with status ``draft``; when a source column is named twice, its last target counts."""
    last = answers.groupBy("client_id", "source_column").agg(F.max_by(F.struct("target_field", "confidence", "reasoning"), "pos").alias("m"))
    return last.select(
        "client_id", F.lit("column").alias("kind"), F.col("m.target_field").alias("field"), F.col("source_column").alias("from_value"),
        F.col("m.target_field").alias("to_value"), "m.confidence", "m.reasoning", F.lit("draft").alias("status"),
    )


def approved_configs(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """LLM-9: paths that exist and are not drafts; both sides have a column ``path``."""
    return wanted.filter(~F.endswith("path", F.lit(".draft.yaml"))).join(existing.select("path").distinct(), "path", "left_semi")


def unmapped_columns(columns: DataFrame, catalog: DataFrame) -> DataFrame:
    """LLM-10: ``(client_id, column)`` rows that no column entry of the client's mapping names."""
    mapped = catalog.filter(F.col("kind") == "column").select("client_id", F.col("from_value").alias("column"))
    return columns.join(mapped, ["client_id", "column"], "left_anti")
