"""The three flows of a client's life: onboarding with training, scoring a batch, checking a batch for drift."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.contract import LABEL_FIELD
from tenura.operators import drift as D
from tenura.operators import prompts as P
from tenura.operators.cleaning import clean_rows, clean_table
from tenura.operators.contributions import Leaf, tree_contributions, tree_leaves
from tenura.operators.evaluation import evaluate, model_cards
from tenura.operators.features import FEW_VALUES, FeatureState, apply_features, feature_columns, fit_features
from tenura.operators.group_features import GroupState, apply_features_by, fit_features_by
from tenura.operators.mapping import apply_catalog, apply_mapping
from tenura.operators.registry import registry_of, score_by_client
from tenura.operators.scoring import deliverable, predict, risk_tier, top_factors
from tenura.operators.splitting import positive_weight, stratified_split, with_weights
from tenura.operators.training import DEFAULTS, MAX_ROUNDS, fit_trees
from tenura.operators.validation import is_valid, validation_report
from tenura.session import kept_here, stage, staging
from tenura.sources.catalog import Mapping as ClientMapping


class Prepared(NamedTuple):
    table: DataFrame
    cleaning: DataFrame
    validation: DataFrame


class Trained(NamedTuple):
    model: GBTClassificationModel
    leaves: list[Leaf]
    state: FeatureState
    evaluation: DataFrame
    card: DataFrame
    snapshot: DataFrame
    prepared: Prepared


def prepare(raw: DataFrame, mapping: ClientMapping, order: str = "src_row", **switches) -> Prepared:
    """Map, clean and validate; ``raw`` is read once, table and reports share the copy that cleaning stages."""
    table, report = clean_table(apply_mapping(raw, mapping), order=order, **switches)
    return Prepared(table, report, validation_report(table))


def train_client(
    raw: DataFrame,
    mapping: ClientMapping,
    settings: Mapping[str, float] | None = None,
    rounds: int = MAX_ROUNDS,
    fit_on: str = "all",
    seed: int = 42,
    order: str = "src_row",
) -> Trained:
    """Onboarding: prepare, gate on the contract, learn features, split, weight, train, evaluate, write the card.

    Features are learned on all rows by default, so that test rows share in fills and ranges; ``fit_on="train"`` learns
    them on the train rows alone.
    """
    with staging(raw.sparkSession) as spare:
        prepared = prepare(raw, mapping, order)
        if not is_valid(prepared.table):
            raise ValueError(f"{mapping.client_id}: a required field is missing or there are no rows")
        split = stratified_split(prepared.table, seed=seed)
        learn_from = split.filter(F.col("split") == "train") if fit_on == "train" else split
        state = fit_features(learn_from)
        weight = positive_weight(split, LABEL_FIELD).first()["weight"]
        table = stage(with_weights(apply_features(split, state, vector="features"), weight), "training")
        model = fit_trees(table, settings, rounds, seed=seed)
        tested = predict(model, table.filter(F.col("split") == "test"), "p").withColumnRenamed(LABEL_FIELD, "y")
        outcome = evaluate(tested).withColumns({"client_id": F.lit(mapping.client_id), "dataset_rows": F.lit(table.count())})
        outcome = kept_here(outcome)
        card = model_cards(outcome, state.names, {**DEFAULTS, **(settings or {}), "rounds": rounds, "scale_pos_weight": weight})
        numeric = feature_columns(prepared.table)[0]
        snapshot = kept_here(D.training_snapshot(D.long_values(prepared.table, numeric)))
        # What is returned holds for later runs: reports and short code lists as local tables, long lists as their copy.
        if sum(r["n_classes"] or 0 for r in state.rows) <= FEW_VALUES:
            state = state._replace(codes=kept_here(state.codes))
        else:
            spare(state.codes)
        leaves = tree_leaves(model)
        reports = Prepared(clean_rows(apply_mapping(raw, mapping), order=order), kept_here(prepared.cleaning), kept_here(prepared.validation))
    return Trained(model, leaves, state, outcome, card, snapshot, reports)


def score_batch(
    raw: DataFrame,
    mapping: ClientMapping,
    trained: Trained,
    call: Callable[[str], str] | None = None,
    definitions: Mapping[str, str] | None = None,
    order: str = "src_row",
    answers: str | None = None,
) -> DataFrame:
    """Scoring: everything after the removal of repeats is one narrow pass; narratives, where asked for, add theirs.

    ``answers`` names a folder that keeps what the model has said, for reruns.
    """
    clean = clean_rows(apply_mapping(raw, mapping), order=order)
    names = trained.state.names
    table = predict(trained.model, apply_features(clean, trained.state, vector="features")).drop("features")
    scored = tree_contributions(table, trained.leaves, names)
    if call is not None:
        told = scored.select(
            "customer_id", order, "churn_probability", "contributions", risk_tier(F.col("churn_probability")).alias("risk_tier"),
            top_factors(F.col("contributions"), names).alias("top"),
        )
        batched = stage(P.batches(told, [order, "customer_id"]), "batches")
        said = P.ask(P.narrative_prompts(batched, definitions), call, store=answers)
        scored = P.attach_narratives(batched, P.parse_narratives(said))
    return deliverable(scored, names)


def _clean_clients(raw: DataFrame, catalog: DataFrame, order: str) -> DataFrame:
    """Rows of all clients, mapped and cleaned; the label, which the catalog gives as text, as a number."""
    clean = clean_rows(apply_catalog(raw, catalog), order=order)
    return clean.withColumn(LABEL_FIELD, F.col(LABEL_FIELD).try_cast("int"))


def train_clients(raw: DataFrame, catalog: DataFrame, settings: Mapping[str, float] | None = None, rounds: int = MAX_ROUNDS, seed: int = 42, order: str = "src_row") -> tuple[GroupState, DataFrame, DataFrame]:
    """Onboarding of all clients of ``raw`` (client_id, src_row, raw map): ``(state, registry, reports)``.

    Mapping, cleaning, the report and the features of all clients are one job each; then each client's trees are fitted, one client
    after the other, as Spark fits one model at a time. Ids of clients come to the driver. A client whose report is not valid fails.
    """
    table = stage(_clean_clients(raw, catalog, order), "clients")
    reports = stage(validation_report(table, group=["client_id"]), "reports")
    refused = [r["client_id"] for r in reports.where("field = '*' AND NOT present").collect()]
    if refused:
        raise ValueError(f"a required field is missing or there are no rows: {refused}")
    state = fit_features_by(table)
    labelled = stage(apply_features_by(table, state, vector="features"), "features")
    models = {}
    for (client,) in labelled.select("client_id").distinct().collect():
        own = stratified_split(labelled.where(F.col("client_id") == client), seed=seed)
        weight = positive_weight(own, LABEL_FIELD).first()["weight"]
        model = fit_trees(stage(with_weights(own, weight), "training"), settings, rounds, seed=seed)
        models[client] = (f"{client}-{model.uid}", tree_leaves(model), state.names)
    return state, registry_of(raw.sparkSession, models), reports


def score_clients(raw: DataFrame, catalog: DataFrame, state: GroupState, registry: DataFrame, order: str = "src_row") -> DataFrame:
    """Scoring of all clients of ``raw`` in one job: each row by its client's mapping, statistics and model."""
    table = stage(apply_features_by(_clean_clients(raw, catalog, order), state), "features")
    return deliverable(score_by_client(table, registry, state.names), state.names, keep=["client_id", "model_id"])


def check_batch(raw: DataFrame, mapping: ClientMapping, trained_snapshot: DataFrame, run_date: str, threshold: float = D.THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Drift: ``(scores with bands, report)`` of a later batch; an alert stops nothing."""
    clean = clean_rows(apply_mapping(raw, mapping))
    scores = stage(D.psi_scores(trained_snapshot, D.long_values(clean, feature_columns(clean)[0])), "psi")
    return D.banded(scores), D.drift_report(scores, run_date, threshold)
