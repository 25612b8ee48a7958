from pyspark.sql import Window
from pyspark.sql import functions as F

from quayside.operators.ranking import sort_key, tile_starts, with_ntiles, with_row_index, with_running_total


def test_tile_sizes():
    assert tile_starts(7, 5) == [2, 4, 5, 6]
    assert tile_starts(3, 5) == [1, 2]
    assert tile_starts(0, 5) == []


def test_ntiles_equal_the_built_in_with_ties_and_nulls(spark):
    # a third of the rows share one value, some are NULL
    df = spark.range(1000).select(
        F.col("id").alias("customer_id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.hash("id") % 100).alias("value"),
    )
    df = df.repartition(8, "customer_id")
    ours = with_ntiles(
        df,
        {
            "up": sort_key("value", "customer_id"),
            "down": sort_key("value", "customer_id", descending=True),
        },
    )
    built_in = df.withColumns(
        {
            "up": F.ntile(5).over(Window.orderBy(F.asc_nulls_last("value"), "customer_id")),
            "down": F.ntile(5).over(Window.orderBy(F.desc_nulls_first("value"), "customer_id")),
        }
    )
    assert ours.exceptAll(built_in).isEmpty() and built_in.exceptAll(ours).isEmpty()


def test_seven_customers_with_ties(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5, 5, 5, 1, 9, 9, 2])], "customer_id long, spent int")
    rows = with_ntiles(df, {"tile": sort_key("spent", "customer_id", descending=True)}).collect()
    assert {r.customer_id: r.tile for r in rows} == {4: 1, 5: 1, 0: 2, 1: 2, 2: 3, 6: 4, 3: 5}


def test_row_index_is_dense_across_partitions(spark):
    df = spark.range(5000).select((F.lit(4999) - F.col("id")).alias("id")).repartition(7)
    indexed = with_row_index(df, ["id"])
    assert indexed.filter("row_index <> id").isEmpty()
    assert indexed.count() == 5000


def test_running_total_leaves_out_the_current_row(spark):
    df = spark.range(1, 2001).repartition(5)
    totals = with_running_total(df, ["id"], "id", "before")
    assert totals.filter("before <> id * (id - 1) div 2").isEmpty()


def test_empty_input(spark):
    empty = spark.createDataFrame([], "customer_id long, spent int")
    assert with_ntiles(empty, {"tile": sort_key("spent", "customer_id")}).count() == 0
    assert with_row_index(empty, ["customer_id"]).count() == 0
