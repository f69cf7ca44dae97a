from pyspark.sql import functions as F

from test_files import control, land
from tidegate import schemas
from tidegate.streaming.receive import receive_available


def test_receive_available(spark, tmp_path, rows):
    registry = str(tmp_path / "registry")
    schema = schemas.META_SCHEMAS["data_file"]
    spark.createDataFrame([], schema).write.parquet(registry)
    base = control(spark)

    def run():
        query = receive_available(
            spark,
            f"{tmp_path}/Files",
            f"{tmp_path}/checkpoint",
            "daily_update",
            lambda: base.with_tables(data_file=spark.read.schema(schema).parquet(registry)),
            lambda new: new.write.mode("append").parquet(registry),
        )
        assert query.awaitTermination(120)
        return rows(spark.read.schema(schema).parquet(registry), "file_id", "filename", "batch_id")

    land(tmp_path, "cust_1.csv", "x\n")
    assert run() == [(1, "cust_1.csv", 4)]
    land(tmp_path, "cust_2.csv", "x\n")
    land(tmp_path, "other.csv", "x\n")
    assert run() == [(1, "cust_1.csv", 4), (2, "cust_2.csv", 4)]
    assert run() == [(1, "cust_1.csv", 4), (2, "cust_2.csv", 4)]
    assert spark.read.schema(schema).parquet(registry).filter(F.col("file_status") != "REGISTERED").count() == 0
