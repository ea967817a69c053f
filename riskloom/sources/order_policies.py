"""Policy rows derived from the supplied order tables.

The rows hold nulls, bad dates, bad years, zero divisors, zero-length policies and exact copies, and
`u`, a deterministic score with many ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import cut_for

ROW_IDS = ["policy_id", "line_k", "sup_k", "part_k"]


def order_policies(spark: SparkSession, folder: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    c = F.col
    # Parquet footers hold the count.
    cut_for(spark, table("lineitem").count())
    # Both order tables grow together, so they meet by key and no side is sent to every task.
    joined = (
        table("lineitem")
        .join(
            table("orders").select("o_orderkey", "o_orderpriority").hint("merge"),
            c("l_orderkey") == c("o_orderkey"),
        )
        .join(table("part").select("p_partkey", "p_type", "p_brand", "p_size"), c("l_partkey") == c("p_partkey"))
    )
    ship = c("l_shipdate").cast("date")
    term = F.when(c("l_linenumber") == 7, 0).when(c("l_linenumber") == 6, 180).otherwise(364)
    order, part = c("l_orderkey"), c("l_partkey")

    def policy_text(day):
        return F.upper(F.date_format(day, "dd-MMM-yy"))

    def unless(condition, value):
        return F.when(~condition, value)

    draw = (order * 104729 + part * 1299709 + c("l_suppkey") * 15485863 + c("l_linenumber") * 611953) % 10007
    lot = (order * 7919 + part * 31 + c("l_linenumber")) % 1000
    policies = joined.select(
        order.alias("policy_id"),
        c("l_linenumber").alias("line_k"),
        c("l_suppkey").alias("sup_k"),
        part.alias("part_k"),
        (order % 3).cast("int").alias("SEX"),
        F.when(c("l_returnflag") == "A", 1201).when(c("l_returnflag") == "N", 1202).otherwise(1204).alias("INSR_TYPE"),
        F.when(order % 101 == 0, "bad-date").when(order % 97 != 0, policy_text(ship)).alias("INSR_BEGIN"),
        unless(part % 103 == 0, policy_text(F.date_add(ship, term))).alias("INSR_END"),
        unless(part % 89 == 0, c("l_extendedprice")).alias("INSURED_VALUE"),
        (c("l_extendedprice") * c("l_tax")).alias("PREMIUM"),
        unless(part % 83 == 0, (c("l_quantity").cast("int") % 8).cast("double")).alias("SEATS_NUM"),
        unless(order % 4 == 0, c("l_quantity")).alias("CARRYING_CAPACITY"),
        unless(part % 79 == 0, c("p_type")).alias("TYPE_VEHICLE"),
        (c("p_size") * 100).cast("double").alias("CCM_TON"),
        c("p_brand").alias("MAKE"),
        unless(order % 73 == 0, c("o_orderpriority")).alias("USAGE"),
        F.when(order % 61 == 0, "n/a")
        .otherwise((F.year(ship) - c("p_size") % 20).cast("string"))
        .alias("PROD_YEAR"),
        F.when(lot < 75, c("l_extendedprice") * 0.25).when(order % 5 == 0, 0.0).alias("CLAIM_PAID"),
        (draw.cast("double") / 10007.0).alias("u"),
    )
    copies = F.explode(F.when(c("policy_id") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return policies.select("*", copies.alias("copy")).drop("copy")


def scored_policies(spark: SparkSession, folder: str) -> DataFrame:
    """order_policies with a label `y` and a score `p` that leans on it (for metrics only)."""
    paid = F.col("CLAIM_PAID") > 0
    return order_policies(spark, folder).withColumns(
        {
            "y": F.when(paid, 1).otherwise(0),
            "p": F.col("u") * 0.7 + F.when(paid, 0.25).otherwise(0.0),
        }
    )
