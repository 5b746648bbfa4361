"""Replacing partitions and tables: failures and interruptions lose no rows."""

import pytest
from pickbay.session import scratch_path
from pickbay.sinks import overwrite_partition, overwrite_partitions, publish, replace_table

RUN, OTHER = {"dt": "2001-01-01", "pid": "p 1/a"}, {"dt": "2001-01-01", "pid": "p2"}


def rows(spark, path):
    df = spark.read.parquet(path)
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def failing(spark, n=3):
    """A result that throws after some of its tasks have written."""
    return spark.range(0, n, 1, n).selectExpr(f"case when id = {n - 1} then raise_error('late failure') else cast(id as string) end as v")


def hidden(spark, path):
    fs, root = publish.fs_and_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith(publish.PREFIX)]


@pytest.fixture
def table(spark):
    path = scratch_path(spark, "test-publish")
    df = spark.createDataFrame([("x",), ("y",)], "v string")
    overwrite_partition(df, path, RUN)
    overwrite_partition(df.where("v = 'x'"), path, OTHER)
    return path


def test_a_failing_rerun_keeps_the_old_rows(spark, table):
    before = rows(spark, table)
    with pytest.raises(Exception, match="late failure"):
        overwrite_partition(failing(spark), table, RUN)
    assert rows(spark, table) == before and not hidden(spark, table)
    with pytest.raises(Exception, match="late failure"):
        overwrite_partitions(failing(spark).selectExpr("v", "'2001-01-01' as dt", "'p2' as pid"), table, ["dt", "pid"])
    assert rows(spark, table) == before and not hidden(spark, table)
    whole = scratch_path(spark, "test-publish-ctas")
    replace_table(spark.createDataFrame([("old",)], "v string"), whole)
    with pytest.raises(Exception, match="late failure"):
        replace_table(failing(spark), whole)
    assert rows(spark, whole) == [("old",)]
    replace_table(spark.createDataFrame([("new", 1)], "v string, n int"), whole)
    assert rows(spark, whole) == [(1, "new")]


class Killed(BaseException):
    pass


def kill_at(monkeypatch, step):
    """Die instead of the step-th rename of a publish."""
    real, count = publish.rename, [0]

    def rename(*a):
        count[0] += 1
        if count[0] == step:
            raise Killed
        real(*a)
    monkeypatch.setattr(publish, "rename", rename)


@pytest.mark.parametrize("step", [1, 2, 3])
def test_an_interrupted_publish_is_finished_or_rolled_back(spark, table, monkeypatch, step):
    old = rows(spark, table)
    new = sorted([("2001-01-01", "p 1/a", "z"), *[r for r in old if r[1] == "p2"]], key=str)
    with monkeypatch.context() as m:
        kill_at(m, step)                                   # 1: the plan, 2: the old rows, 3: the new ones
        with pytest.raises(Killed):
            overwrite_partition(spark.createDataFrame([("z",)], "v string"), table, RUN)
    said = publish.recover(spark, table)
    got = sorted([(str(r[0]), *r[1:]) for r in rows(spark, table)], key=str)
    want = [(str(r[0]), *r[1:]) for r in (old if step == 1 else new)]
    assert got == sorted(want, key=str) and not hidden(spark, table)
    assert said == [] if step == 1 else said[0].startswith("finished")
    assert publish.recover(spark, table) == []
    overwrite_partition(spark.createDataFrame([("again",)], "v string"), table, RUN)
    assert [r[2] for r in rows(spark, table) if r[1] == "p 1/a"] == ["again"]


@pytest.mark.parametrize("step", [2, 3, 4, 5])
def test_an_interrupted_publish_of_many_partitions(spark, monkeypatch, step):
    path = scratch_path(spark, "test-publish-many")
    df = spark.createDataFrame([(f"{d}", d) for d in range(4)], "v string, d int")
    overwrite_partitions(df, path, ["d"])
    with monkeypatch.context() as m:
        kill_at(m, step)
        with pytest.raises(Killed):
            overwrite_partitions(df.where("d >= 2").selectExpr("'n' || v as v", "d"), path, ["d"])
    overwrite_partitions(df.where("d = 0").selectExpr("'later' as v", "d"), path, ["d"])   # the next writer recovers
    assert rows(spark, path) == [(0, "later"), (1, "1"), (2, "n2"), (3, "n3")]


def test_a_job_killed_while_writing_leaves_nothing_behind(spark, table):
    fs, _ = publish.fs_and_path(spark, table)
    before = rows(spark, table)
    home = publish._scope("dt=2001-01-01/pid=p2") + "dead"
    spark.range(5).write.parquet(f"{table}/{home}/new")                     # written aside, never published
    assert rows(spark, table) == before                                     # readers skip it
    assert publish.recover(spark, table, "dt=2001-01-01/pid=p9") == []
    assert publish.recover(spark, table, "dt=2001-01-01/pid=p2") == [f"dropped {home}"]
    assert rows(spark, table) == before and not hidden(spark, table)


def test_partitions_can_be_removed_with_others_replaced(spark):
    path = scratch_path(spark, "test-publish-remove")
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "v string, d int")
    overwrite_partitions(df, path, ["d"])
    with publish.aside(spark, path) as folder:
        df.where("d = 2").selectExpr("'B' as v", "d").write.partitionBy("d").parquet(folder)
        publish.replace(spark, path, {**publish.leaves(spark, folder, 1), "d=1": None})
    assert rows(spark, path) == [(2, "B"), (3, "c")]


def test_writers_of_other_targets_are_left_alone(spark, table):
    """What another job is writing aside is not dropped; an interrupted plan of any target is finished."""
    with publish.aside(spark, table, "dt=2001-01-01/pid=p3") as folder:
        spark.range(2).selectExpr("cast(id as string) as v").write.parquet(folder)
        overwrite_partition(spark.createDataFrame([("z",)], "v string"), table, OTHER)
        publish.replace(spark, table, {"dt=2001-01-01/pid=p3": folder})
    assert [r[2] for r in rows(spark, table) if r[1] == "p3"] == ["0", "1"]
    parent, name = table.rsplit("/", 1)
    with publish.aside(spark, parent, "another-table") as folder:
        spark.range(1).write.parquet(folder)
        replace_table(spark.range(1).selectExpr("'t' as v"), table)
        assert publish.fs_and_path(spark, folder)[0].exists(publish._path(spark, folder))
        with pytest.raises(ZeroDivisionError), publish.aside(spark, parent, "another-table"):
            1 / 0
