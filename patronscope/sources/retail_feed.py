"""Raw invoice lines derived from the order, line, customer, nation and part tables.

A few deterministic defects (cancellations, blank ids, service codes, zero prices, negative quantities) are derived from
the keys so that every cleaning rule has rows to act on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_transactions(spark: SparkSession, folder: str, by_order: bool = False) -> DataFrame:
    """Invoice lines. With ``by_order`` the same rows leave the last join order by order, so that sums over orders or customers
    combine before they are shuffled; lines then carry their part's columns through that join, which suits readers of few."""
    cancelled, returned = F.col("cancelled"), F.col("returned")
    line = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
        ((F.col("l_returnflag") == "R") & (F.col("l_linenumber") <= 2)).alias("cancelled"),
        ((F.col("l_linenumber") == 7) & (F.col("l_linestatus") == "O")).alias("returned"))
    order = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    buyer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    part = table(spark, folder, "part").select("p_partkey", "p_name")

    part_key, order_key = F.col("l_partkey"), F.col("l_orderkey")
    # Orders find their customers first: lines, the largest table, are then shuffled for two joins and not for three.
    bought = order.join(buyer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")), F.col("o_custkey") == F.col("c_custkey"))
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    pieces = F.col("l_quantity").cast("int")

    joins = [(bought, order_key == F.col("o_orderkey")), (part, part_key == F.col("p_partkey"))]
    (first, at_first), (last, at_last) = reversed(joins) if by_order else joins

    return (
        line.join(first, at_first)
        .join(last, at_last)
        .select(
            F.concat(F.when(cancelled, "C").otherwise(""), order_key.cast("string")).alias("invoice"),
            F.when(part_key % 50 == 0, "POST").when(part_key % 83 == 0, "M")
            .otherwise(F.concat(F.lit(" p"), F.lpad(part_key.cast("string"), 6, "0"))).alias("stock_code"),
            F.when(part_key % 211 != 0, F.col("p_name")).alias("description"),
            (F.when(returned, -1).otherwise(1) * pieces).alias("quantity"),
            F.timestamp_add("HOUR", (order_key % 24).cast("int"), F.col("o_orderdate")).alias("invoice_date"),
            F.when(part_key % 97 == 0, 0.0)
            .otherwise(F.floor(cents / pieces).cast("double") / 100).alias("unit_price"),
            F.when(order_key % 13 == 0, None).when(order_key % 17 == 0, " ")
            .otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
            "country",
        )
    )


def experiment(spark: SparkSession, folder: str, rfm: DataFrame | None = None) -> DataFrame:
    """Two-group experiment from the event stream: conversion is purchase value above the group's threshold."""
    control = F.col("customer_id") % 2 == 0
    bought = F.col("event_type") == "purchase"
    users = (
        table(spark, folder, "events")
        .groupBy(F.col("user_id").alias("customer_id"))
        .agg(
            (F.sum(F.when(bought, F.floor(F.col("value") * 100 + 0.5)).otherwise(0)) / F.lit(100.0)).alias("spent"),
            F.count_if(bought).alias("items_purchased"),
        )
    )
    converted = F.col("spent") > F.when(control, 1000).otherwise(900)
    revenue = F.when(converted, F.col("spent")).otherwise(0.0)
    table_ = users.select(
        "customer_id",
        F.when(control, "Control").otherwise("Treatment").alias("grp"),
        converted.cast("int").alias("converted"),
        revenue.alias("revenue"),
        "items_purchased",
        (revenue / F.greatest("items_purchased", F.lit(1))).alias("aov"),
    )
    if rfm is None:
        return table_
    return table_.join(rfm.select("customer_id", "rfm_score"), "customer_id", "left")
