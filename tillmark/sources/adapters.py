"""The retail model over a star schema of orders, lines, parts, customers and events.

Small dimensions the star schema lacks are listed here; everything else is derived
column by column from its tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions import money_sum, zero_padded

MONEY = "decimal(12,2)"

# With a declared schema no file has to be opened to plan a query.
STAR = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
}

CHANNELS = [(1, "Web", "online"), (2, "App", "online"), (3, "Mini", "online"),
            (4, "Shop", "offline"), (5, "Phone", "offline"), (6, "Kiosk", "offline")]
CAMPAIGNS = [(1, "Summer", "discount"), (2, "Welcome", "coupon"), (3, "Members", "discount"),
             (4, "Flash", "flash_sale"), (5, "Birthday", "gift"), (6, "Winter", "discount")]
CATEGORIES = [(1, "ECONOMY"), (2, "LARGE"), (3, "MEDIUM"), (4, "PROMO"), (5, "SMALL"),
              (6, "STANDARD"), (7, "CLEARANCE")]
TIERS = [(1, "T1", 0, 1500000), (2, "T2", 1500001, 2500000), (3, "T3", 2500001, 3500000),
         (4, "T4", 3500001, 9999999), (5, "T5", 10000000, 99999999)]
STORES = [(1, "North"), (2, "South"), (3, "East"), (4, "West"), (5, "Centre")]


def _rows(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A literal table. Spark knows its size, so joins with it are broadcast."""
    values = ", ".join(str(r) for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


class Retail:
    """Retail tables over one directory of Parquet files, each read when asked for."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.schema(STAR[table]).parquet(f"{self.base}/{table}.parquet")

    # dimensions

    def channels(self) -> DataFrame:
        return _rows(self.spark, "id, channel_name, channel_type", CHANNELS)

    def campaigns(self) -> DataFrame:
        return _rows(self.spark, "id, campaign_name, campaign_type", CAMPAIGNS)

    def categories(self) -> DataFrame:
        return _rows(self.spark, "id, category_name", CATEGORIES)

    def levels(self) -> DataFrame:
        return _rows(self.spark, "id, level_name, min_points, max_points", TIERS)

    def stores(self) -> DataFrame:
        return _rows(self.spark, "id, store_name", STORES)

    def products(self) -> DataFrame:
        ids = F.create_map(*[F.lit(x) for i, name in CATEGORIES for x in (name, i)])
        return self.raw("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("product_name"),
            F.concat(F.lit("P"), zero_padded("p_partkey", 6)).alias("product_code"),
            ids[F.col("p_type")].alias("category_id"),
            F.col("p_type").alias("category_name"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        )

    def users(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("username"),
            F.col("c_mktsegment").alias("nickname"),
            F.lit("user").alias("role"),
        )

    def addresses(self) -> DataFrame:
        nation = self.raw("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("province")
        )
        return (
            self.raw("customer")
            .join(nation, "c_nationkey")
            .select(
                F.col("c_custkey").alias("id"), F.col("c_custkey").alias("user_id"), "province"
            )
        )

    # facts

    def behavior(self) -> DataFrame:
        return self.raw("events").select(
            F.col("event_id").alias("id"),
            "user_id",
            F.col("event_type").alias("behavior_type"),
            F.col("ts").alias("create_time"),
        )

    def orders(self) -> DataFrame:
        key, status = F.col("o_orderkey"), F.col("o_orderstatus")
        digit = F.substring("o_orderpriority", 1, 1).cast("int")
        method = F.element_at(
            F.array(*map(F.lit, ["alipay", "wechat", "card", "points"])),
            (key % 4 + 1).cast("int"),
        )
        return self.raw("orders").select(
            key.alias("id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").alias("create_time"),
            F.col("o_totalprice").cast(MONEY).alias("payment_amount"),
            F.when(status == "F", 3).when(status == "P", 1).otherwise(0).alias("order_status"),
            F.when(status == "O", 0).otherwise(1).alias("payment_status"),
            method.alias("payment_method"),
            F.when(key % 50 != 0, digit).alias("channel_id"),
            F.when(digit <= 3, "online").otherwise("offline").alias("order_source"),
            F.when(key % 10 < 3, key % 5 + 1).alias("campaign_id"),
        )

    def orders_with_discounts(self) -> DataFrame:
        """Orders with ``discount_amount`` from their lines and the gross total."""
        details = self.details()
        cuts = details.groupBy(F.col("order_id").alias("id")).agg(
            money_sum(details, "discount_price").alias("cut")
        )
        cut = F.coalesce("cut", F.lit(0)).cast(MONEY)
        return (
            self.orders()
            .join(cuts, "id", "left")
            .withColumn("discount_amount", cut)
            .withColumn(
                "total_amount", (F.col("payment_amount") + F.col("discount_amount")).cast(MONEY)
            )
            .drop("cut")
        )

    def details(self) -> DataFrame:
        total = F.col("l_extendedprice").cast(MONEY)
        cut = F.round(total * F.col("l_discount").cast("decimal(4,2)"), 2).cast(MONEY)
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            total.alias("total_price"),
            cut.alias("discount_price"),
            (total - cut).cast(MONEY).alias("actual_price"),
        )
