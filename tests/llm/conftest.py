import itertools

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def documents(spark):
    """Make a documents table of (doc_id, text[, lang]) with extra columns of clashing names."""

    def make(rows, lang="en"):
        rows = [(i, t, lang, "s", None if t is None else len(t), 1, 2, "x") for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, row int, segment int, found_language string"
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def write(tmp_path_factory):
    """Write tables of a folder and give its path."""

    numbers = itertools.count()

    def put(**tables):
        folder = tmp_path_factory.mktemp(f"tables{next(numbers)}")
        for name, df in tables.items():
            df.withColumns({c: F.col(c) for c in df.columns}).write.parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return put
