"""Personal data in readers' reports (p3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataq.llm.personal_data import redact
from strataq.session import spread, table

#: A key for the queries; a real one comes from the caller's secret store.
KEY = b"strataq example key"


def _redacted(spark: SparkSession, d: str) -> DataFrame:
    reports = spread(table(spark, d, "feedback_reports")).where("id IS NOT NULL")
    fields = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in ("description", "contact_email")]))
    long = reports.select(F.col("id").alias("report_id"), "revision", fields.alias("x")).select("report_id", "revision", "x.field", "x.value").where("value IS NOT NULL")
    return redact(long, "value", KEY)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    items = _redacted(spark, d).select("report_id", "field", F.explode("redacted.items").alias("i"))
    return items.select("report_id", "field", "i.pii_type", "i.start_pos").distinct()


def p3_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Every report's fields with placeholders, as delivered."""
    return _redacted(spark, d).select("report_id", "revision", "field", F.col("redacted.text").alias("redacted"), F.size("redacted.items").alias("n_items"))


def p3_linked(spark: SparkSession, d: str) -> DataFrame:
    """Values that occur in several reports, by their link tags, and in how many writings."""
    values = _redacted(spark, d).select("report_id", "value", F.explode("redacted.items").alias("i"))
    items = values.select("report_id", "i.pii_type", "i.link", "i.placeholder", F.substring("value", F.col("i.start_pos"), F.col("i.length")).alias("written"))
    return items.groupBy("pii_type", "link").agg(F.min("placeholder").alias("placeholder"), F.countDistinct("report_id").alias("n_reports"), F.countDistinct("written").alias("n_writings")).where("n_reports > 1")


QUERIES = {"p3_found": p3_found, "p3_redacted": p3_redacted, "p3_linked": p3_linked}
SQL: dict[str, str] = {}
