"""What the lake keeps beside its tables, and how a whole table is replaced."""

from __future__ import annotations

import glob
import os

import pytest

from strata.sources.lake import FRESH, OLD, Lake


def test_a_read_opens_no_file_for_its_schema(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.replace_batch(spark.createDataFrame([("a", "b")], "x string, y string"), "bronze", "t", "2017-01")
    lake.replace_batch(spark.createDataFrame([("a", "c")], "x string, z string"), "bronze", "t", "2017-02")
    assert lake.read("bronze", "t").columns == ["x", "y", "z", "_batch_id"]
    assert sorted(map(str, lake.read("bronze", "t").select("x", "y", "z", "_batch_id").collect())) == [
        "Row(x='a', y='b', z=None, _batch_id='2017-01')",
        "Row(x='a', y=None, z='c', _batch_id='2017-02')",
    ]
    for file in glob.glob(str(tmp_path / "bronze/t/_batch_id=2017-01/*.parquet")):
        with open(file, "wb") as f:
            f.write(b"spoiled")
    assert lake.read("bronze", "t").columns == ["x", "y", "z", "_batch_id"]
    assert lake.read_batch("bronze", "t", "2017-02").select("z").collect()[0].z == "c"
    with pytest.raises(ValueError, match="column z is string, not int"):
        lake.replace_batch(spark.createDataFrame([(1,)], "z int"), "bronze", "t", "2017-03")
    assert lake.read_batch("bronze", "t", "2017-03") is None


def test_a_table_without_a_kept_schema_gets_one(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    spark.createDataFrame([("a", "b", "2017-01")], "x string, y string, _batch_id string").write.partitionBy("_batch_id").parquet(lake.path("bronze", "t"))
    lake.replace_batch(spark.createDataFrame([("c",)], "w string"), "bronze", "t", "2017-02")
    assert [f.name for f in lake.union_schema("bronze", "t")] == ["x", "y", "w"] and lake.marker(lake.path("bronze", "t"), "_schema")
    assert lake.read("bronze", "t").count() == 2


def test_an_overwrite_that_breaks_off_leaves_the_old_table(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(spark.range(3), "gold", "t")
    with pytest.raises(Exception, match="broken"):
        lake.overwrite(spark.range(9).selectExpr("if(id = 7, raise_error('broken'), id) AS id"), "gold", "t")
    assert lake.read("gold", "t").count() == 3
    lake.overwrite(lake.read("gold", "t").union(spark.range(1)), "gold", "t")  # may read the table it replaces
    assert lake.read("gold", "t").count() == 4 and os.listdir(tmp_path / "gold") == ["t"]


@pytest.mark.parametrize("whole", [True, False])
def test_a_publish_that_breaks_off_between_its_moves_is_mended(spark, tmp_path, whole):
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(spark.range(3), "gold", "t")
    path = lake.path("gold", "t")
    os.rename(path, path + OLD)  # the first move
    if whole:
        spark.range(5).write.parquet(path + FRESH)
    assert lake.register(("gold",)) == ["gold.t"]
    assert lake.read("gold", "t").count() == (5 if whole else 3)
    assert os.listdir(tmp_path / "gold") == ["t"]
    spark.sql("DROP TABLE gold.t")


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), buckets=1)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
        lake.replace_keyed(spark.range(0, 200_000, 1, 8).selectExpr("id", "sha2(cast(id AS string), 256) AS text"), "gold", "t", ["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(glob.glob(lake.path("gold", "t") + "/_bucket=0/*.parquet")) > 2
    assert lake.read("gold", "t").distinct().count() == 200_000
