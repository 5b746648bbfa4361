import os

import pytest
from pickbay.session import path_bytes, scratch_path, scratch_scope, stage, stage_bucketed


def _exists(path):
    return os.path.exists(path.removeprefix("file:"))


def test_scratch_goes_when_the_job_ends(spark):
    kept = scratch_path(spark, "kept")
    spark.range(3).write.parquet(kept)
    with scratch_scope(spark):
        stage(spark.range(5), "inside")
        table = stage_bucketed(spark.range(50), "inside-bucketed", "id")
        paths = [f.rsplit("/", 1)[0] for f in table.inputFiles()]
        assert table.count() == 50 and path_bytes(spark, paths[0]) > 0
    assert not any(map(_exists, paths)) and not [t for t in spark.catalog.listTables() if "inside" in t.name]
    assert spark.read.parquet(kept).count() == 3
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        failed = scratch_path(spark, "failed")
        spark.range(1).write.parquet(failed)
        1 / 0
    assert path_bytes(spark, failed) == 0
