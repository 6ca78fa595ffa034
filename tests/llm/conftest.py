import pytest

from tests.llm.helpers import awkward, passage


@pytest.fixture(scope="session")
def spaced_tables(spark, tmp_path_factory):
    """Tables with every awkward text but the very long one, each row under an id of its own, as in the test tables."""
    folder = str(tmp_path_factory.mktemp("spaced"))
    rows = [(i, t) for i, (_, t) in enumerate(awkward()) if t is None or len(t) < 50_000]
    tables = {
        "documents": ("doc_id long, text string", rows),
        "benchmark": ("item_id long, text string", [(1, "\r".join(passage(1, 20).split())), (2, None), (None, passage(5, 30)), (3, "one"), (3, passage(4, 9))]),
        "labels": ("doc_id long, quality int, toxic int", [(0, 1, 0)]),
    }
    for name, (schema, data) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder
