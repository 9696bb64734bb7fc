"""Mapping configs as rows: ``(client_id, kind, field, from_value, to_value, confidence, reasoning, status)``.

Kinds: ``description``; ``column`` (from raw column to field); ``value`` (field, from, to); ``type`` (field, to);
``bound`` (field, from lowest to highest). One config file is one client's document and fits in a task; the catalog
of all clients is an ordinary table.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.session import small_table

# Config files that one task writes to a folder of its own.
FOLDER_FILES = 2000
CATALOG_SCHEMA = (
    "client_id string, kind string, field string, from_value string, to_value string, "
    "confidence string, reasoning string, status string"
)


@dataclass
class Mapping:
    """One client's mapping, for use on one client's table."""

    client_id: str
    description: str = ""
    columns: dict[str, str] = field(default_factory=dict)
    values: dict[str, dict[str, str]] = field(default_factory=dict)
    types: dict[str, str] = field(default_factory=dict)


def mapping_rows(m: Mapping, status: str = "approved") -> list[tuple]:
    rows = [(m.client_id, "description", None, None, m.description)] if m.description else []
    rows += [(m.client_id, "column", to, raw, to) for raw, to in m.columns.items()]
    rows += [(m.client_id, "value", f, str(a), str(b)) for f, pairs in m.values.items() for a, b in pairs.items()]
    rows += [(m.client_id, "type", f, None, t) for f, t in m.types.items()]
    return [(*r, None, None, status) for r in rows]


def catalog_of(spark: SparkSession, mappings: list[Mapping]) -> DataFrame:
    return small_table(spark, [r for m in mappings for r in mapping_rows(m)], CATALOG_SCHEMA)


def mapping_of(catalog: DataFrame, client_id: str) -> Mapping:
    """One client's entries as a ``Mapping``; the size of one config file, never of the data."""
    m = Mapping(client_id)
    for r in catalog.filter((F.col("client_id") == client_id) & (F.col("status") == "approved")).collect():
        if r.kind == "description":
            m.description = r.to_value
        elif r.kind == "column":
            m.columns[r.from_value] = r.to_value
        elif r.kind == "value":
            m.values.setdefault(r.field, {})[r.from_value] = r.to_value
        elif r.kind == "type":
            m.types[r.field] = r.to_value
    return m


def parse_configs(texts: DataFrame) -> DataFrame:
    """SRC-3: catalog rows from ``(path, value)`` rows that each hold one whole YAML document.

    Scalars are kept as the text that was typed, so ``Yes`` stays ``Yes`` and ``1`` stays ``1``. An empty document or
    one without ``client_id`` fails the job.
    """

    def parse(batches):
        import pandas as pd
        import yaml

        names = ["client_id", "kind", "field", "from_value", "to_value", "confidence", "reasoning", "status"]
        for batch in batches:
            rows = []
            for path, text in zip(batch["path"], batch["value"]):
                doc = yaml.load(text, Loader=yaml.BaseLoader)
                if not doc:
                    raise ValueError(f"empty mapping config: {path}")
                if "client_id" not in doc:
                    raise KeyError(f"mapping config without client_id: {path}")
                client, sure = doc["client_id"], doc.get("confidence_scores") or {}
                status = doc.get("status") or ("draft" if path.endswith(".draft.yaml") else "approved")
                found = []
                if doc.get("source_description"):
                    found.append(("description", None, None, doc["source_description"], None))
                for raw, to in (doc.get("column_mappings") or {}).items():
                    found.append(("column", to, raw, to, sure.get(raw)))
                for name, pairs in (doc.get("value_mappings") or {}).items():
                    found += [("value", name, a, b, None) for a, b in pairs.items()]
                for name, to in (doc.get("type_coercions") or {}).items():
                    found.append(("type", name, None, to, None))
                for name, ends in (doc.get("numeric_bounds") or {}).items():
                    found.append(("bound", name, ends[0], ends[1], None))
                why = doc.get("reasoning") or {}
                rows += [(client, *f, why.get(f[2]) if f[0] == "column" else None, status) for f in found]
            yield pd.DataFrame(rows, columns=names, dtype=object)

    return texts.select("path", "value").mapInPandas(parse, CATALOG_SCHEMA)


def read_configs(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3: all config files below ``path`` in one job.

    Spark opens 32 small files a task; a Python worker takes longer to begin than to parse them, so tasks are merged, to some for each core.
    """
    texts = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return parse_configs(texts.select(F.col("_metadata.file_path").alias("path"), "value").coalesce(_tasks(spark)))


def write_configs(texts: DataFrame, path: str) -> None:
    """SRC-3: a file ``config-<client_id>.yaml`` for each client of ``(client_id, value)`` below the new folder ``path``.

    A client's texts follow each other in its file, one a line or more. Each task fills one folder with some thousand files, so neither
    writing nor listing costs a folder a client; a task that runs again writes the same files.
    """

    def step(batches):
        files, root = _files(path)
        own, attempt = f"{root}/part-{TaskContext.get().partitionId():05d}", TaskContext.get().taskAttemptId()
        files.create_dir(own, recursive=True)
        name, lines, n = None, [], 0

        def close():
            # Other tasks see a file whole or not at all; Spark reads no names that begin with an underscore.
            with files.open_output_stream(f"{own}/_{attempt}") as f:
                f.write("".join(lines).encode())
            files.move(f"{own}/_{attempt}", f"{own}/config{'' if name is None else '-' + quote(name, safe='').replace('.', '%2E')}.yaml")

        for batch in batches:
            for client, value in zip(batch["client_id"].to_pylist(), batch["value"].to_pylist()):
                if lines and client != name:
                    close()
                    lines, n = [], n + 1
                name = client
                lines.append((value or "") + "\n")
        if lines:
            close()
            n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    spark = texts.sparkSession
    folders = max(spark.sparkContext.defaultParallelism, -(-texts.count() // FOLDER_FILES))
    dealt = texts.select(F.col("client_id").cast("string"), "value").repartition(folders, "client_id").sortWithinPartitions("client_id")
    dealt.mapInArrow(step, "n bigint").agg(F.sum("n")).collect()


def _tasks(spark: SparkSession) -> int:
    """Tasks of a step that is much work a client: some for each core."""
    return max(32, 4 * spark.sparkContext.defaultParallelism)


def _files(path: str) -> tuple[fs.FileSystem, str]:
    """(Arrow's file system, path) of a folder that Spark names."""
    uri = path.replace("s3a://", "s3://", 1) if "://" in path else path if ":" not in path else "file://" + path.split(":", 1)[1]
    return fs.FileSystem.from_uri(uri)


def config_texts(catalog: DataFrame) -> DataFrame:
    """SRC-3, the other way: one YAML document ``(client_id, status, value)`` per client; empty sections are left out.

    Entries are few bytes and their YAML much work, so clients are dealt to all cores and not merged by size.
    """

    def render(batches):
        import pandas as pd
        import yaml

        for batch in batches:
            rows = []
            for client, status, entries in zip(batch["client_id"], batch["status"], batch["entries"]):
                about, columns, values, types, sure, bounds, why = "", {}, {}, {}, {}, {}, {}
                for e in entries:
                    if e["kind"] == "description":
                        about = e["to_value"]
                    elif e["kind"] == "column":
                        columns[e["from_value"]] = e["to_value"]
                        if e["confidence"] is not None:
                            sure[e["from_value"]] = e["confidence"]
                        if e["reasoning"] is not None:
                            why[e["from_value"]] = e["reasoning"]
                    elif e["kind"] == "value":
                        values.setdefault(e["field"], {})[e["from_value"]] = e["to_value"]
                    elif e["kind"] == "type":
                        types[e["field"]] = e["to_value"]
                    elif e["kind"] == "bound":
                        bounds[e["field"]] = [e["from_value"], e["to_value"]]
                doc = {"client_id": client}
                sections = {"source_description": about, "column_mappings": columns, "confidence_scores": sure, "reasoning": why}
                if status == "draft":
                    doc["status"] = status
                sections |= {"value_mappings": values, "type_coercions": types, "numeric_bounds": bounds}
                doc |= {k: v for k, v in sections.items() if v}
                rows.append((client, status, yaml.dump(doc, default_flow_style=False, sort_keys=False, allow_unicode=True)))
            yield pd.DataFrame(rows, columns=["client_id", "status", "value"])

    entry = F.struct("kind", "field", "from_value", "to_value", "confidence", "reasoning")
    per_client = catalog.repartition(_tasks(catalog.sparkSession), "client_id", "status").groupBy("client_id", "status").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    return per_client.mapInPandas(render, "client_id string, status string, value string")


def mapping_coverage(catalog: DataFrame) -> DataFrame:
    """MAP-6: how many columns, value maps and types each client's mapping holds."""
    kind = F.col("kind")
    return catalog.groupBy("client_id").agg(
        F.count_if(kind == "column").alias("n_columns"),
        F.count_distinct(F.when(kind == "value", F.col("field"))).alias("n_value_maps"),
        F.count_if(kind == "type").alias("n_types"),
    )
