import os
import sys

import pytest

os.environ.setdefault("OMP_NUM_THREADS", "1")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def edge_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 977} Wort{i}" for i in range(20_000))
    texts = [
        (1, "Hello world, this is a text."), (2, "Hello world, this is a text."), (3, None), (4, ""), (5, " \n\t "), (6, long), (7, long + " more"),
        (8, PASSAGE.upper()), (9, f"before {PASSAGE} after"), (9, f"before {PASSAGE} after"), (None, "Hello world, this is a text."), (None, None),
        (10, "é ß İ 中文 <|endoftext|> don't stop!!"), (11, "same line\nother line\nsame line"), (12, "same line\n\nthird line"), (13, "same line "),
        (14, "hello world, THIS is a text."), (-5, "x"),
    ]
    return [(i, t, "en", "s1" if k % 3 else None, len(t) if t else None) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def pair_ids(sf):
    """Texts of the smallest test table."""
    import pyarrow.parquet as pq

    t = pq.read_table(f"{sf}/documents.parquet").to_pydict()
    return list(zip(t["doc_id"], t["text"]))
