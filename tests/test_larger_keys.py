"""Queries on keys beyond those of the small tables."""

import duckdb
from oracle import compare

from foliograph.plans.catalogue import ORACLE, QUERIES


def test_image_sides_over_two_bytes(spark, tmp_path):
    keys = [1, 65533, 65534, 65535, 65536, 65537, 131074, 1_200_001, 16_777_216]
    rows = [(k, s) for k, s in zip(keys, [1, 50, 65535, 65536, 7, 70_000, 3, 9, 255])]
    spark.createDataFrame(rows, "p_partkey bigint, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    assert compare(QUERIES["image_sizes"](spark, str(tmp_path)), con, ORACLE["image_sizes"]) == ""
