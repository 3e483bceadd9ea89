"""Writers of result tables and annotations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_metrics(rows: DataFrame, path: str, keys: Sequence[str] = ("pair_id", "platform", "segmentation"), kind: str = "parquet") -> str:
    """Result tables by key folders; only the folders that ``rows`` fills are replaced."""
    out = rows.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys)
    out.option("header", True).csv(path) if kind == "csv" else out.parquet(path)
    return path


def geojson_text(objects: DataFrame) -> DataFrame:
    """(value): one GeoJSON feature a line from (object_id, object_type, ring)."""
    coordinates = F.array(F.transform("ring", lambda v: F.array(v.x, v.y)))
    properties = F.struct(F.lit("analysis_object").alias("role"), F.lit("object").alias("annotation_role"), "object_id", "object_type", F.col("object_type").alias("name"))
    return objects.select(F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates")).alias("geometry"))).alias("value"))


def write_geojson(objects: DataFrame, path: str) -> str:
    geojson_text(objects).write.text(path)
    return path


def write_commented_csv(rows: DataFrame, path: str, comments: Sequence[str]) -> None:
    """One CSV a task, each with its header; ``comments`` are ``#`` lines of a file of their own, which has the header too.

    No value of the first column may begin with ``#``: a reader would take the row for a comment.
    """
    first = F.col(rows.columns[0]).cast("string")
    safe = F.when(first.startswith("#"), F.raise_error(F.lit("a row would be read as a comment"))).otherwise(first)
    rows.withColumn(rows.columns[0], safe).write.option("header", True).csv(path)
    lines = [*(f"# {c}" for c in comments), ",".join(rows.columns)]
    rows.sparkSession.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("append").text(path)
