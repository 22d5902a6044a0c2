"""What must stay bounded as tables grow: tables collected for joins, and the share of the work that one task gets."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Small tables of one file each, as one row group."""
    root = tmp_path_factory.mktemp("tables")
    rows = spark.range(400).select(F.col("id").cast("int").alias("k"), "id")
    made = {
        "customer": rows.select(F.col("id").alias("c_custkey")),
        "part": rows.select(F.col("id").alias("p_partkey"), F.concat(F.lit("blue part "), "id").alias("p_name"), F.lit("Brand#1").alias("p_brand"),
                            F.lit("SMALL TIN").alias("p_type"), (F.col("k") % 50 + 1).alias("p_size")),
        "orders": rows.select(F.col("id").alias("o_orderkey"), F.lit("O").alias("o_orderstatus"), F.lit("1-URGENT").alias("o_orderpriority")),
    }
    for name, df in made.items():
        df.coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.mark.parametrize("name", ["ddl_columns_awkward", "cell_text_awkward", "drop_blank_rows", "dedupe_headers"])
def test_costly_rows_are_dealt_over_all_tasks(spark, tables, name):
    sizes = E.queries()[name](spark, tables).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("name", ["mapping_from_stored_pages", "mapping_job", "match_candidates", "deactivate_orphans"])
def test_mapping_collects_no_table_but_the_type_map(spark, tables, name):
    rows = E.queries()[name](spark, tables)
    assert rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") <= 1
