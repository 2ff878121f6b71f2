"""Shapes the driver's star-schema tables like the clickstream inputs.

The oracle SQL in ``plans/oracle.py`` states the same mapping.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import rounded
from ..operators.cleaning import clean_category, clean_properties, event_whitelist
from ..operators.sequences import reco_sequences

# Fixed value: 2024-01-01 00:00 UTC in epoch milliseconds.
PROPERTY_EPOCH_MS = 1704067200000
DAY_MS = 86_400_000


@dataclass
class StarTables:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def all_events(self) -> DataFrame:
        e = self.table("events")
        kind = F.col("event_type")
        return e.select(
            F.col("user_id").alias("visitorid"),
            F.col("ts").cast("timestamp").alias("timestamp"),
            F.when(kind == "click", "addtocart")
            .when(kind == "purchase", "transaction")
            .otherwise(kind)
            .alias("event"),
            F.get_json_object("props", "$.k").cast("bigint").alias("itemid"),
            F.when(kind == "purchase", F.col("event_id")).alias("transactionid"),
            "event_id",
        )

    def raw_events(self) -> DataFrame:
        """Unclean events: missing keys and copies at fixed places."""
        e = self.all_events()
        n = F.col("event_id")
        rows = e.select(
            F.when(n % 101 != 0, F.unix_millis("timestamp")).cast("string").alias("timestamp"),
            F.when(n % 97 != 0, F.col("visitorid")).alias("visitorid"),
            "event",
            F.when(n % 89 != 0, F.col("itemid")).alias("itemid"),
            "transactionid",
            F.explode(F.array_repeat(n, F.when(n % 50 == 0, 2).otherwise(1))).alias("_copy"),
        )
        return rows.drop("_copy")

    def events(self) -> DataFrame:
        return event_whitelist(self.all_events()).drop("event_id")

    def raw_properties(self) -> DataFrame:
        p = self.table("part")
        key = F.col("p_partkey")
        at = F.lit(PROPERTY_EPOCH_MS) + key * 1000

        def entry(ts, name, value, when):
            row = F.struct(
                ts.cast("string").alias("timestamp"), F.lit(name).alias("property"), value.alias("value")
            )
            return F.when(when, row)

        always = F.lit(True)
        entries = F.array(
            entry(at, "price", F.concat(F.lit("n"), F.col("p_retailprice").cast("string")), key % 7 != 3),
            entry(at, "categoryid", F.col("p_brand"), always),
            entry(
                at + DAY_MS,
                "categoryid",
                F.concat(F.lit("Brand#"), (F.col("p_size") % 25 + 1).cast("string")),
                key % 10 == 0,
            ),
            entry(at, "name", F.col("p_name"), always),
            entry(at, "categoryid", F.col("p_brand"), key % 20 == 1),
        )
        rows = p.select(key.alias("itemid"), F.explode(F.array_compact(entries)).alias("e"))
        return rows.select("e.timestamp", "itemid", "e.property", "e.value")

    def properties(self) -> DataFrame:
        return clean_properties(self.raw_properties())

    def raw_categories(self) -> DataFrame:
        brand = F.regexp_extract("p_brand", r"(\d+)", 1).cast("bigint")
        ids = self.table("part").select(brand.alias("c")).distinct()
        return ids.select(
            F.col("c").cast("string").alias("categoryid"),
            F.when(F.col("c") > 5, F.col("c") % 5 + 1).cast("string").alias("parentid"),
        )

    def categories(self) -> DataFrame:
        return clean_category(self.raw_categories())

    def mart(self) -> DataFrame:
        """Sales mart from order lines; the forecast is the mean of the item's seven rows before."""
        brand = F.regexp_extract("p_brand", r"(\d+)", 1).cast("bigint")
        parts = self.table("part").select(F.col("p_partkey").alias("itemid"), brand.alias("categoryid"))
        daily = (
            self.table("lineitem")
            .groupBy(F.col("l_partkey").alias("itemid"), F.to_date("l_shipdate").alias("date"))
            .agg(rounded(F.sum("l_extendedprice")).alias("sales"))
        )
        before = Window.partitionBy("itemid").orderBy("date").rowsBetween(-7, -1)
        recent = F.coalesce(F.avg("sales").over(before), F.lit(0.0))
        return (
            daily.withColumn("forecast", rounded(recent, 4))
            .join(parts, "itemid", "left")
            .select("itemid", "date", "categoryid", "sales", "forecast")
        )

    def price_history(self) -> DataFrame:
        """Unit prices after discount in whole cents, at the time of shipping: a property that changes."""
        price = F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity") * 100) / 100
        return self.table("lineitem").select(
            F.col("l_shipdate").cast("timestamp").alias("timestamp"),
            F.col("l_partkey").alias("itemid"),
            F.lit("price").alias("property"),
            price.alias("value"),
        )

    def order_days(self) -> DataFrame:
        """Item-days of the order dates: lines and units ordered."""
        lines = self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return lines.groupBy(F.col("l_partkey").alias("itemid"), F.to_date("o_orderdate").alias("date")).agg(
            F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("units")
        )

    def sequences(self) -> DataFrame:
        return reco_sequences(self.events(), self.properties(), self.categories())
