"""One key holds a third of all rows: results stay whole and the work is split."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillmark.operators import dashboard, derive, directory, marts, quality
from tillmark.operators.versions import latest_version

ROWS = 60_000
HOT = 7


@pytest.fixture
def skewed(spark):
    """Small partitions count as skewed, and nothing is broadcast."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def keys(spark):
    hot = F.when(F.col("id") % 3 == 0, HOT).otherwise(F.col("id") % 1000)
    return spark.range(ROWS).repartition(8).withColumn("k", hot.cast("long"))


def plan_after(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_a_hot_order_are_split_in_the_join(skewed):
    lines = keys(skewed).select(
        F.col("k").alias("order_id"), (F.col("id") % 50).alias("product_id"),
        F.lit(1).alias("quantity"), F.lit(D("2.00")).cast("decimal(10,2)").alias("total_price"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )
    orders = skewed.range(1000).withColumn("order_status", F.when(F.col("id") < 500, 3).otherwise(4))
    products = skewed.range(50).select(
        "id", F.lit("n").alias("product_name"), F.lit("c").alias("product_code"),
        F.lit(1).cast("long").alias("category_id"))
    category = skewed.range(1, 2).withColumn("category_name", F.lit("A"))
    out = marts.product_sales_ranking(lines, orders, products, category)
    assert "skew=true" in plan_after(out)
    want = keys(skewed).where("k < 500").count()
    found = out.agg(F.sum("total_quantity"), F.sum("total_sales")).first()
    assert tuple(found) == (want, D(want) * 2)


def test_orphans_of_a_hot_parent_are_all_found(skewed):
    child = keys(skewed).withColumn("note", F.sha2(F.col("id").cast("string"), 256))
    parent = skewed.range(1000).where(F.col("id") != HOT)
    out = quality.orphans(child, parent, "k")
    assert "skew=true" in plan_after(out)
    assert out.count() == keys(skewed).where(F.col("k") == HOT).count()


def test_hot_users_keep_their_addresses_and_rows(skewed):
    rows = keys(skewed).select("id", F.col("k").alias("user_id"))
    marked = derive.default_addresses(rows)
    assert marked.count() == ROWS
    firsts = {r.user_id: r.id for r in rows.groupBy("user_id").agg(F.min("id").alias("id")).collect()}
    assert {r.user_id: r.id for r in marked.where("is_default = 1").collect()} == firsts
    gone = skewed.createDataFrame([(HOT,)], "id long")
    left = directory.cascade_delete(
        {"py_user": skewed.range(1000), "user_behavior": rows}, "py_user", gone
    )
    assert left["user_behavior"].count() == rows.where(F.col("user_id") != HOT).count()


def test_a_hot_key_reaches_the_shuffle_as_one_row_per_task(skewed):
    rows = keys(skewed).select(F.col("k").alias("key"), F.col("id").alias("at"), F.lit("x").alias("v"))
    out = latest_version(rows, "key", "at")
    want = {r.key: r.at for r in rows.groupBy("key").agg(F.max("at").alias("at")).collect()}
    assert {r.key: r["at"] for r in out.collect()} == want


def test_hot_product_and_hot_buyer_totals(skewed):
    details = keys(skewed).select(
        F.col("k").alias("product_id"), F.lit(1).alias("quantity"),
        F.lit(D("1.00")).cast("decimal(10,2)").alias("actual_price"))
    products = skewed.range(1000).select(
        "id", F.concat(F.lit("p"), F.col("id")).alias("product_name"),
        (F.col("id") % 4).alias("category_id"))
    best = dashboard.hot_products(details, products).first()
    assert (best.product_name, best.total_quantity) == (
        f"p{HOT}", keys(skewed).where(F.col("k") == HOT).count())
    categories = skewed.range(5).withColumn("category_name", F.concat(F.lit("c"), F.col("id")))
    sales = dashboard.category_sales(categories, products, details)
    assert sales.agg(F.sum("total_sales")).first()[0] == ROWS
    users = dashboard.user_distribution(
        keys(skewed).select(F.col("id").alias("user_id"), F.lit("北京市").alias("province")))
    assert users.first().value == ROWS
