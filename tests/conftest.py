import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from strataq.session import local_session

    s = local_session("tests", 4, "4g", **{"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4"})
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as a sorted list of tuples in the order of the named columns."""

    def of(df, *cols):
        cols = cols or df.columns
        return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)

    return of


TABLES = "law_norms law_versions law_version_blocks law_source_objects feedback_reports projection_removals documents eval_items size_limits".split()


@pytest.fixture(scope="session")
def odd_tables(spark, tmp_path_factory):
    """Folders with tables that hold no row, and with rows repeated, rows of nulls only, and rows with one column null each."""
    from pyspark.sql import functions as F

    base = tmp_path_factory.mktemp("tables")
    for name in TABLES:
        df = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        few = df.limit(30)
        if name == "size_limits":
            few.coalesce(1).write.parquet(str(base / "empty" / f"{name}.parquet"))
            few.coalesce(1).write.parquet(str(base / "nulls" / f"{name}.parquet"))
            continue
        df.limit(0).coalesce(1).write.parquet(str(base / "empty" / f"{name}.parquet"))
        odd = few.unionByName(few)
        one = df.limit(2)
        for c in df.columns:
            odd = odd.unionByName(one.withColumn(c, F.lit(None).cast(df.schema[c].dataType)))
        nothing = one.select(*[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns])
        odd.unionByName(nothing).coalesce(2).write.parquet(str(base / "nulls" / f"{name}.parquet"))
    return {"empty": str(base / "empty"), "nulls": str(base / "nulls")}
