"""Writers (A9-A12, A13 append, M3 check)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet, optionally partitioned (cleaned data by Status)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8") -> None:
    """A10: header CSV mirror."""
    df.write.mode("overwrite").option("header", True).option("sep", sep) \
        .option("encoding", encoding).csv(path)


def write_geojson_features(df: DataFrame, path: str, mode: str = "append") -> None:
    """One GeoJSON Feature per line (RFC 8142 style), appendable; the
    coordinates (JSON text) are written as the arrays they are."""
    properties = F.to_json(F.struct(F.col("suburb_key").alias("Suburb")))
    head = F.to_json(F.struct(F.col("geom_type").alias("type")))
    geometry = F.concat(F.rtrim(head, F.lit("}")), F.lit(',"coordinates":'), F.coalesce(F.translate("coordinates", "\r\n", ""), F.lit("null")), F.lit("}"))
    line = F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), geometry, F.lit("}"))
    df.select(line.alias("value")).write.mode(mode).text(path)


def check_outputs(spark: SparkSession, expected: dict[str, Sequence[str]]) -> DataFrame:
    """M3: read back every written Parquet output; one row per output with
    its row count and whether all expected columns are present."""
    rows = []
    for path, cols in expected.items():
        try:
            df = spark.read.parquet(path)
            rows.append((path, df.count(), all(c in df.columns for c in cols), True))
        except Exception:  # missing/unreadable output is a failed check
            rows.append((path, 0, False, False))
    return spark.createDataFrame(rows, "path string, n_rows long, columns_ok boolean, exists boolean")


def params_table(spark: SparkSession, items: dict[str, str]) -> DataFrame:
    """Decision parameters as a (name, value) table."""
    return spark.createDataFrame(sorted(items.items()), "name string, value string")
