"""Where each client's files live, and whether a path belongs to a client."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The path of each kind of file below s3://<bucket>/<client_id>.
PATH_KINDS = {
    "raw_data": "raw/{upload_date}/data.csv",
    "config": "configs/mapping.yaml",
    "draft_config": "configs/mapping.draft.yaml",
    "processed": "processed/{run_date}/features.csv",
    "model": "models/{model_version}/model.tar.gz",
    "model_card": "models/{model_version}/model_card.json",
    "feature_artifacts": "models/{model_version}/feature_artifacts.pkl",
    "output": "outputs/scores/{run_date}/predictions.csv",
    "monitoring": "monitoring/drift_reports/{run_date}/report.json",
    "training_stats": "monitoring/training_stats.json",
}


def client_prefix(bucket: str | Column, client: Column) -> Column:
    bucket = F.lit(bucket) if isinstance(bucket, str) else bucket
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), client)


def client_path(kind: str, bucket: str | Column, client: Column, **parts: Column) -> Column:
    """SRC-4: one path of a client; ``parts`` fill the names in braces."""
    pieces, rest = [client_prefix(bucket, client), F.lit("/")], PATH_KINDS[kind]
    while "{" in rest:
        before, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        pieces += [F.lit(before), parts[name]]
    return F.concat(*pieces, F.lit(rest))


def client_paths(clients: DataFrame, bucket: str) -> DataFrame:
    """SRC-4: all ten paths for rows of ``(client_id, upload_date, run_date, model_version)``."""
    parts = {c: F.col(c) for c in ("upload_date", "run_date", "model_version")}
    pairs = [F.struct(F.lit(k).alias("kind"), client_path(k, bucket, F.col("client_id"), **parts).alias("path")) for k in PATH_KINDS]
    return clients.select("client_id", F.inline(F.array(*pairs)))


def belongs_to_client(path: Column, bucket: str | Column, client: Column) -> Column:
    """SRC-5: the path lies below this client's prefix; a longer client id with the same start does not count."""
    return F.startswith(path, F.concat(client_prefix(bucket, client), F.lit("/")))


def only_client_files(df: DataFrame, prefix: str) -> DataFrame:
    """SRC-5 on reads: fail the job when a row comes from a file outside ``prefix``; ``df`` is a file scan."""
    path = F.col("_metadata.file_path")
    inside = F.startswith(_one_slash(path), F.concat(_one_slash(F.lit(prefix.rstrip("/"))), F.lit("/")))
    refused = F.raise_error(F.concat(F.lit("file of another client: "), path)).cast("boolean")
    return df.filter(F.when(inside, True).otherwise(refused))


def _one_slash(path: Column) -> Column:
    """``file:///x`` and ``file:/x`` name the same file."""
    return F.regexp_replace(path, r"^(\w+:)/+", "$1/")
