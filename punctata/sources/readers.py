"""Readers of study files: transcripts, boundaries, matrices, annotations, mapper output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctata.functions import names as N


def transcripts(rows: DataFrame, required: Sequence[str] = ("x", "y", "gene")) -> DataFrame:
    """Typed detections of a raw table: ``feature_name`` is the gene; bad numbers are null; rows without a place or gene go."""
    if "gene" not in rows.columns and "feature_name" in rows.columns:
        rows = rows.withColumnRenamed("feature_name", "gene")
    missing = [c for c in required if c not in rows.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    numbers = [c for c in ("x", "y", "z") if c in rows.columns]
    typed = rows.withColumns({c: F.expr(f"try_cast({c} AS DOUBLE)") for c in numbers} | {"gene": F.col("gene").cast("string")})
    typed = typed.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in numbers})
    if "cell_id" in rows.columns:
        typed = typed.withColumn("cell_id", F.col("cell_id").cast("string"))
    return typed.dropna(subset=[*numbers, "gene"])


def read_transcripts(spark: SparkSession, path: str, kind: str = "parquet", columns: Sequence[str] = ("x", "y", "z", "feature_name", "cell_id", "qv")) -> DataFrame:
    """A CSV or Parquet file of detections. CSV columns are read as text and typed after."""
    if kind == "parquet":
        return transcripts(spark.read.parquet(path))
    return transcripts(spark.read.option("header", True).csv(path, schema=", ".join(f"{c} string" for c in columns)))


def boundaries(rows: DataFrame) -> DataFrame:
    """Boundaries of the first plane with three vertices or more, keyed by EntityID; polygons become one-part lists."""
    kept = rows.where("ZIndex = 0").where(F.size("ring") >= 4)
    return kept.select(F.col("EntityID").alias("instance_id"), F.array("ring").alias("rings"))


def wide_counts(rows: DataFrame, cell: str, genes: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(counts, controls) in long form without zeros; columns named like blanks are controls."""
    long = rows.unpivot([cell], list(genes), "gene", "n").where(F.col("n") != 0)
    blank = F.lower("gene").contains("blank")
    return long.where(~blank), long.where(blank)


def read_wide_counts(spark: SparkSession, path: str, cell: str = "cell") -> tuple[DataFrame, DataFrame]:
    header = spark.read.option("header", True).csv(path)
    genes = [c for c in header.columns if c != cell]
    typed = spark.read.option("header", True).csv(path, schema=", ".join(f"`{c}` {'string' if c == cell else 'bigint'}" for c in header.columns))
    return wide_counts(typed, cell, genes)


def _triplets(lines: DataFrame) -> DataFrame:
    parts = F.split(F.trim("value"), r"\s+")
    return lines.where(~F.col("value").startswith("%")).select(*(parts[i].cast("bigint").alias(c) for i, c in enumerate(("i", "j", "n"))))


def read_triplets(spark: SparkSession, matrix: str, features: str, barcodes: str) -> DataFrame:
    """(cell_id, gene, feature_id, feature_type, n) of a sparse matrix with its features and barcodes.

    The size line says whether features are rows or columns. Names that repeat get -1, -2, ... in file order.
    Index tables hold their own line numbers, so the triplets meet them in two equi-joins.
    """
    lines = spark.read.text(matrix)
    size = lines.where(~F.col("value").startswith("%")).first()
    n_rows = int(size.value.split()[0])
    size_line = size.value
    body = _triplets(lines.where(F.col("value") != size_line))
    f = _numbered(spark, features, ("feature_id", "name", "feature_type"))
    b = _numbered(spark, barcodes, ("cell_id",))
    if f.count() != n_rows:
        body = body.select(F.col("j").alias("i"), F.col("i").alias("j"), "n")
    w = Window.partitionBy("name").orderBy("line")
    k = F.row_number().over(w) - 1
    named = f.withColumn("gene", F.when(k == 0, F.col("name")).otherwise(F.concat_ws("-", "name", k.cast("string"))))
    rows = body.join(named.withColumnRenamed("line", "i"), "i").join(b.withColumnRenamed("line", "j"), "j")
    return rows.select("cell_id", "gene", "feature_id", "feature_type", "n")


def _numbered(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Tab-separated lines with their number from 1. The file is one gzip member, so one task reads it in order."""
    from punctata.operators.ids import stable_ids

    lines = spark.read.text(path).withColumn("_at", F.monotonically_increasing_id())
    parts = F.split("value", "\t")
    return stable_ids(lines, ["_at"], "line").select("line", *(F.get(parts, i).alias(c) for i, c in enumerate(names)))


def vertices_to_rings(rows: DataFrame, label: str = "label_id", order: str = "vertex_no") -> DataFrame:
    """(label, cell_id, ring): vertices in order, closed; labels under three vertices go; the first cell id counts."""
    r = rows.groupBy(label).agg(F.array_sort(F.collect_list(F.struct(order, "x", "y"))).alias("v"), F.min_by("cell_id", order).alias("cell_id"))
    points = F.transform("v", lambda p: F.struct(p.x.alias("x"), p.y.alias("y")))
    closed = F.when(F.element_at("ring", 1) == F.element_at("ring", -1), F.col("ring")).otherwise(F.concat("ring", F.slice("ring", 1, 1)))
    return r.where(F.size("v") >= 3).select(label, "cell_id", points.alias("ring")).withColumn("ring", closed)


_POINT = "array<double>"
_PROPERTIES = "map<string,string>"


def geojson_features(text: DataFrame, column: str = "value") -> DataFrame:
    """(doc, no, kind, properties map, coordinates): features of collections, single features and bare geometries."""
    f = F.from_json(column, T.StructType.fromDDL("type string, features array<string>, properties string, geometry string"))
    rows = text.withColumn("_f", f)
    one = F.when(F.col("_f.type") == "FeatureCollection", F.col("_f.features")).when(F.col("_f.type") == "Feature", F.array(column)).otherwise(F.array(F.concat(F.lit('{"type":"Feature","properties":{},"geometry":'), F.col(column), F.lit("}"))))
    each = rows.select("doc", F.posexplode(one).alias("no", "feature"))
    parsed = each.withColumn("_g", F.from_json("feature", T.StructType.fromDDL(f"properties {_PROPERTIES}, geometry struct<type:string,coordinates:string>")))
    return parsed.where("_g.geometry IS NOT NULL").select("doc", "no", F.col("_g.geometry.type").alias("kind"), F.coalesce("_g.properties", F.create_map().cast(_PROPERTIES)).alias("properties"), F.col("_g.geometry.coordinates").alias("coordinates"))


def object_annotations(features: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """(object_id, object_type, ring, area) of polygon features; parts of a multipolygon are objects of their own.

    The type is the first of object_type, name, label, classification name, ``objects``; ids that are not given
    are type_0001, ... in feature order. An id that repeats, or a polygon without area, raises.
    """
    from punctata.operators.shapes import signed_area

    p = F.col("properties")
    got = lambda k: F.nullif(F.trim(p[k]), F.lit(""))
    kind = F.coalesce(got("object_type"), got("name"), got("label"), F.nullif(F.get_json_object(p["classification"], "$.name"), F.lit("")), F.lit("objects"))
    polygon = F.array(F.from_json("coordinates", f"array<array<{_POINT}>>"))
    parts = F.when(F.col("kind") == "MultiPolygon", F.from_json("coordinates", f"array<array<array<{_POINT}>>>")).when(F.col("kind") == "Polygon", polygon).otherwise(F.raise_error(F.concat(F.lit("an object must be a polygon, not "), F.col("kind"))))
    rows = features.withColumn("object_type", kind)
    if types is not None:
        rows = rows.where(F.lower("object_type").isin(*(t.strip().lower() for t in types)))
    rows = rows.withColumn("_parts", parts).select("doc", "no", "object_type", got("object_id").alias("_id"), F.size("_parts").alias("_n"), F.posexplode("_parts").alias("part", "_polygon"))
    w = Window.partitionBy("object_type").orderBy("doc", "no", "part")
    number = F.format_string("%s_%04d", N.safe_identifier("object_type"), F.row_number().over(w))
    object_id = F.when(F.col("_id").isNull(), number).when(F.col("_n") > 1, F.concat_ws("_", "_id", (F.col("part") + 1).cast("string"))).otherwise(F.col("_id"))
    ring = F.transform(F.get("_polygon", 0), lambda v: F.struct(v[0].alias("x"), v[1].alias("y")))
    named = rows.select(object_id.alias("object_id"), "object_type", ring.alias("ring")).withColumn("area", F.abs(signed_area(F.col("ring"))))
    checked = F.when(F.col("area") <= 0, F.raise_error(F.concat(F.lit("object without area: "), F.col("object_id")))).when(F.count("*").over(Window.partitionBy("object_id")) > 1, F.raise_error(F.concat(F.lit("duplicate object id: "), F.col("object_id"))))
    return named.withColumn("object_id", F.coalesce(checked.cast("string"), F.col("object_id")))


def role_features(features: DataFrame, role: str) -> DataFrame:
    """Features whose role, type, name, label, boundary or classification is one of the role's aliases, with their piece."""
    p = F.col("properties")
    classification = [F.get_json_object(p["classification"], f"$.{k}") for k in ("name", "label", "role")]
    # Text that is no JSON object is the classification itself.
    plain = F.when(~F.coalesce(p["classification"], F.lit("")).startswith("{"), p["classification"])
    values = F.array_compact(F.array(*(N.role_name(p[k]) for k in N.ROLE_KEYS), *(N.role_name(c) for c in classification), N.role_name(plain)))
    aliases = F.array(*(F.lit(a) for a in N.ROLE_ALIASES.get(role, (role,))))
    piece = F.coalesce(*(F.nullif(F.trim(p[k]), F.lit("")) for k in N.PIECE_KEYS), F.lit("piece_1"))
    return features.where(F.arrays_overlap(values, aliases)).withColumns({"piece_id": piece, "role": F.lit(role)})


def read_commented_csv(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """A CSV, or a folder of them, each with a header and ``#`` lines anywhere; columns are text. No rows at all raise."""
    rows = spark.read.option("comment", "#").option("header", True).csv(path, schema=", ".join(f"`{c}` string" for c in names))
    if rows.isEmpty():
        raise ValueError(f"no rows in {path}")
    return rows


_LEVEL = "struct<assignment:string,bootstrapping_probability:double,aggregate_probability:double,avg_correlation:double,directly_assigned:boolean,runner_up_probability:array<double>>"


def mapper_rows(cells: DataFrame, column: str = "levels") -> DataFrame:
    """One row for each cell and level of nested mapper JSON; text that does not parse gives none."""
    levels = F.from_json(column, f"map<string,{_LEVEL}>")
    rows = cells.select("cell_id", F.explode(levels).alias("level", "_v"))
    p = F.col("_v.bootstrapping_probability")
    runner = F.get("_v.runner_up_probability", 0)
    return rows.select("cell_id", "level", F.col("_v.assignment").alias("assignment"), p.alias("bootstrapping_probability"), F.col("_v.aggregate_probability").alias("aggregate_probability"), F.col("_v.avg_correlation").alias("avg_correlation"), F.col("_v.directly_assigned").alias("directly_assigned"), runner.alias("runner_up_probability"), (p - runner).alias("margin"))


def marker_lookup(text: DataFrame, terms: DataFrame, level: str, broad: Column, column: str = "value") -> DataFrame:
    """(label, name, broad_class, markers) of ``level/label -> ids`` JSON at one level; blank ids go."""
    rows = text.select(F.explode(F.from_json(column, "map<string,array<string>>")).alias("_k", "_m"))
    rows = rows.where(F.split_part("_k", F.lit("/"), F.lit(1)) == level).select(F.split_part("_k", F.lit("/"), F.lit(2)).alias("label"), F.filter(F.transform("_m", lambda m: F.trim(m)), lambda m: m != "").alias("markers"))
    return rows.join(terms, "label").withColumn("broad_class", broad)


def tagged(spark: SparkSession, pattern: str, expression: str, tags: Sequence[str]) -> DataFrame:
    """Parquet files of a path pattern, each row tagged from its path by the groups of ``expression``."""
    rows = spark.read.parquet(pattern).withColumn("_path", F.col("_metadata.file_path"))
    return rows.withColumns({t: F.regexp_extract("_path", expression, i) for i, t in enumerate(tags, 1)}).drop("_path")


def harvest_metrics(text: DataFrame, column: str = "value") -> DataFrame:
    """(trial, mode, metric, value): nested rigid and nonrigid blocks of metrics JSON, flattened."""
    j = F.from_json(column, "trial string, rigid map<string,double>, nonrigid map<string,double>")
    rows = text.select(j.alias("_j"))
    modes = F.explode(F.array(*(F.struct(F.lit(m).alias("mode"), F.col(f"_j.{m}").alias("m")) for m in ("rigid", "nonrigid"))))
    return rows.select("_j.trial", modes.alias("_m")).select("trial", "_m.mode", F.explode("_m.m").alias("metric", "value"))
