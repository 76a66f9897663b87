"""Auction events laid over the driver's tables, as FIXTURES.md section 4 defines them."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.settings import Settings, basic, refined

AS_OF = date(2026, 1, 6)

# record_date by l_partkey % 8.
RECORD_DATES = (
    "2026-01-06 00:00:00",
    "2026-01-04 12:00:00",
    "2026-01-03 12:00:00",
    "2026-01-01 00:00:00",
    "2025-12-31 00:00:00",
    "2025-12-30 23:59:59",
    "2026-01-05 00:00:00",
    "2026-01-05 23:59:59",
)
# Customers of one host, so hosts grow with the data; and of the countries whose volume does not.
CUSTOMERS_PER_HOST = 200
CUSTOMERS_OF_SMALL_COUNTRIES = 150


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture_settings(variant: str) -> Settings:
    return {"basic": basic, "refined": refined}[variant](as_of=AS_OF)


def _record_date() -> Column:
    slot = F.col("l_partkey") % 8
    chain = F
    for number, text in enumerate(RECORD_DATES):
        instant = datetime.fromisoformat(text).replace(tzinfo=timezone.utc)
        chain = chain.when(slot == number, F.lit(instant))
    return chain


def bid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    auctions = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    rows = table(spark, sf_dir, "lineitem").join(
        auctions, F.col("l_orderkey") == F.col("o_orderkey")
    )
    s8 = F.col("l_suppkey") % 8
    n = F.col("n_nationkey")
    part, order, supplier = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_suppkey")
    big = (n % 5 == 0) | ((n == 22) & (supplier % 2 == 0))
    vol = F.col("l_quantity").cast("bigint") * 20 * F.when(big, 7).otherwise(1)
    weight = F.when((F.col("n_regionkey") == 3) & (n != 22), F.lit(2)).otherwise(
        s8 * (1 + n % 4) + F.when(F.length("c_mktsegment") > 9, 9).otherwise(0)
    )
    no_requests = ((s8 == 5) & (n % 5 == 2)) | ((s8 == 0) & (n % 5 == 0))
    host = F.floor(F.col("o_custkey") / CUSTOMERS_PER_HOST)
    unplaced = (n % 5 == 3) & (F.col("o_custkey") > CUSTOMERS_OF_SMALL_COUNTRIES)
    cents = F.floor(F.col("l_extendedprice") * F.col("l_discount")).cast("bigint")
    revenue = (cents * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(18,4)")
    failed = (order % 11 == 0) | ((s8 == 3) & (n % 5 == 1))
    return rows.select(
        F.when(supplier % 50 == 7, None)
        .when(s8 == 1, "unrulyfsx")
        .otherwise(F.concat(F.lit("bidder_"), s8.cast("string")))
        .alias("bidder_id"),
        F.when(part % 97 == 0, None)
        .when(part % 97 == 1, "nan")
        .otherwise(F.col("r_name"))
        .alias("geo_continent"),
        F.when(part % 89 == 0, None)
        .when((part % 89 == 1) | (n == 10) | unplaced, "nan")
        .when(n == 22, "RU")
        .otherwise(F.col("n_name"))
        .alias("geo_country"),
        F.when(order % 6 != 0, F.concat(F.lit("h"), host.cast("string"), F.lit(".example")))
        .alias("host"),
        F.when(failed, "500").when(order % 11 == 1, "404").alias("error_code"),
        _record_date().alias("record_date"),
        F.floor(vol * (s8 * 13 + n % 5) / 100).cast("bigint").alias("bids"),
        F.when(~no_requests, vol).alias("bid_requests"),
        vol.alias("bid_opportunities"),
        F.when(part % 41 != 0, F.floor(vol * weight / 100).cast("bigint")).alias("total_top_bids"),
        F.when(s8.isin(0, 2), F.lit(0).cast("decimal(18,4)"))
        .otherwise(revenue)
        .alias("estimated_adjusted_revenue"),
    )
