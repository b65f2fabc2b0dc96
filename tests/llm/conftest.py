from __future__ import annotations

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def table(spark, tmp_path):
    """Rows as a stored Parquet table in one file, as the operators read their input."""

    def store(rows, schema):
        path = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        return spark.read.parquet(path)

    return store
