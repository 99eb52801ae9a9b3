"""Stuffed pages (p9) and packing into containers (p7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataq.llm import packing, page_shapes
from strataq.session import spread, table


def _capacities(spark: SparkSession, d: str) -> dict[str, int]:
    """The token capacities, a table of fixed size."""
    return {r["limit_name"]: r["max_size"] for r in table(spark, d, "size_limits").where("unit = 'tokens'").select("limit_name", "max_size").collect()}


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(spread(table(spark, d, "documents")), _capacities(spark, d))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers of each capacity are."""
    filled = p7_packed(spark, d).groupBy("capacity_name", "container_id").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_items"))
    return filled.groupBy("capacity_name").agg(F.count("*").alias("n_containers"), F.sum("n_tokens").alias("n_tokens"), F.max("n_tokens").alias("fullest"), F.sum("n_items").alias("n_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return page_shapes.stuffed_pages(spread(table(spark, d, "documents")))


def p9_profiles(spark: SparkSession, d: str) -> DataFrame:
    return page_shapes.profile_pages(spread(table(spark, d, "documents")))


QUERIES = {"p7_packed": p7_packed, "p7_fill": p7_fill, "p9_found": p9_found, "p9_profiles": p9_profiles}
SQL: dict[str, str] = {}
