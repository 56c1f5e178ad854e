import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from pizarra import session
from pizarra.sources import io


def test_partitioned_reads_of_tables_and_queries():
    assert io.table_options(query="select 1") == {"query": "select 1"}
    assert io.table_options(table="t") == {"dbtable": "t"}
    ranges = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "90", "numPartitions": "3"}
    assert io.table_options(table="t", partition_column="id", lower_bound=0, upper_bound=90, num_partitions=3) == {"dbtable": "t", **ranges}
    assert io.table_options(query="select id from t", partition_column="id", lower_bound=0, upper_bound=90, num_partitions=3) == {
        "dbtable": "(select id from t) q", **ranges}
    for bad in ({}, {"query": "q", "table": "t"}, {"table": "t", "partition_column": "id"}):
        with pytest.raises(ValueError):
            io.table_options(**bad)


@pytest.mark.parametrize("master,allowed", [("local[4]", True), ("local", True), ("local-cluster[2,1,1024]", False), ("yarn", False)])
def test_only_local_masters_get_a_temporary_checkpoint_folder(master, allowed, tmp_path, monkeypatch):
    made = []
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: made[0] if made else None, setCheckpointDir=made.append,
                         getConf=lambda: SimpleNamespace(get=lambda key, default: default))
    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda prefix: str(tmp_path))
    if allowed:
        assert session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc)) == str(tmp_path)
    else:
        with pytest.raises(RuntimeError):
            session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_scratch_tables_are_deleted_on_request(spark):
    path = session.scratch_path(spark, "probe")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path.removeprefix("file:"))
    kept = session._SCRATCH[spark.sparkContext.applicationId]
    session._SCRATCH[spark.sparkContext.applicationId] = [path]
    assert session.clean_scratch(spark) == 1 and not os.path.exists(path.removeprefix("file:"))
    session._SCRATCH[spark.sparkContext.applicationId] = [p for p in kept if p != path]


# ---------------------------------------------------------------- tables replaced in one step

def test_a_failed_replace_leaves_the_old_rows(spark):
    path = session.scratch_path(spark, "replaced")
    io.replace_files(spark.range(5), path)

    @F.udf("long")
    def fails(x):
        if x == 7:
            raise ValueError("lost")
        return x

    with pytest.raises(Exception):
        io.replace_files(spark.range(10).select(fails("id").alias("id")), path)
    assert sorted(r.id for r in io.read_files(spark, path).collect()) == [0, 1, 2, 3, 4]
    reader = io.read_files(spark, path)
    io.replace_files(spark.range(2).withColumn("extra", F.lit("x")), path)
    assert reader.count() == 5                                    # a reader keeps the version it began with
    assert io.read_files(spark, path).columns == ["id", "extra"] and io.read_files(spark, path).count() == 2
    assert io.drop_old_versions(spark, path) == 2 and io.read_files(spark, path).count() == 2


def test_an_absent_table_is_an_error(spark):
    with pytest.raises(Exception):
        io.read_files(spark, session.scratch_path(spark, "absent"))


# ---------------------------------------------------------------- rejected records

def test_rejected_records_have_a_reason(spark):
    path = session.scratch_path(spark, "ragged")
    lines = ["1;a;2.5", "2;b", "3;c;4.5;", "4;d;x", '5;"e;e";1', "6;;", "z;b", "7;g;1;2;3", ";;", '8;"q\\"q;";3', ""]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    kept, rejected = io.read_checked(spark, path, "id long, `na.me` string, v double")
    assert sorted([tuple(r) for r in kept.collect()], key=str) == sorted(
        [(1, "a", 2.5), (2, "b", None), (5, "e;e", 1.0), (6, None, None), (None, None, None), (8, 'q"q;', 3.0)], key=str)
    assert {(r.record, r.reason) for r in rejected.collect()} == {
        ("3;c;4.5;", "too many fields"), ("4;d;x", "bad value"), ("z;b", "bad value"), ("7;g;1;2;3", "too many fields")}
    strict, more = io.read_checked(spark, path, "id long, `na.me` string, v double", pad_short=False)
    assert strict.count() == 5 and ("2;b", "too few fields") in {(r.record, r.reason) for r in more.collect()}
