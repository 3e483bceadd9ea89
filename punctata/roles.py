"""Logical tables of a spatial transcriptomics study, as views over the supplied star schema.

Each role is one DataFrame for Spark and one common table expression for DuckDB, of the same rows.
Coordinates are dyadic, so sums over them are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctata.functions.session import dealt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_TRANSCRIPT = """p_brand AS gene, p_type AS feature_type, l_orderkey AS cell_id,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_orderkey END AS assignment,
       l_returnflag = 'N' AS background,
       CASE WHEN l_linestatus = 'F' THEN 'MERSCOPE' ELSE 'XENIUM' END AS platform,
       l_quantity AS qv,
       CAST(l_partkey % 500 AS DOUBLE) + l_quantity / 64e0 AS x,
       CAST((l_suppkey * 7 + l_orderkey) % 500 AS DOUBLE) + l_linenumber / 8e0 AS y"""

#: What makes a transcript: ties under all of these are equal rows.
FULL_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def _select(text: str) -> list[str]:
    """Splits a select list at its top-level commas."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(text[start:i])
            start = i + 1
    return [x.strip() for x in [*out, text[start:]]]


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections: gene, feature_type, cell_id, assignment, background, platform, qv, x, y."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
    return rows.selectExpr(*_select(_TRANSCRIPT))


def transcripts_by_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections dealt by cell to tasks whose number grows with the table, so counts by cell and gene need no other exchange."""
    rows = dealt(table(spark, sf_dir, "lineitem"), "l_orderkey").join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
    return rows.selectExpr(*_select(_TRANSCRIPT))


def numbered_transcripts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Detections with ``transcript_id`` 1..N in the order of the full key; with ``columns`` only those are made and moved."""
    from punctata.operators.ids import stable_ids

    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
    made = [e for e in _select(_TRANSCRIPT) if not columns or e.rpartition(" AS ")[2] in columns]
    keep = [c for c in ("p_brand", "p_type", *FULL_KEY[:5], "l_returnflag", "l_linestatus") if any(c in e for e in made)]
    return stable_ids(rows, FULL_KEY, "transcript_id", keep=keep).selectExpr("transcript_id", *made)


def cells(spark: SparkSession, sf_dir: str, shrink: float = 1.0) -> DataFrame:
    """Boxes around (cx, cy): instance_id, cx, cy, half."""
    return table(spark, sf_dir, "part").selectExpr("p_partkey AS instance_id", "CAST(p_partkey * 37 % 500 AS DOUBLE) AS cx", "CAST(p_partkey * 91 % 500 AS DOUBLE) AS cy", f"(2e0 + p_size / 16e0) / {shrink}D AS half")


def nuclei(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(spark, sf_dir, 2.0)


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 annotated boxes: object_id, object_type, cx, cy, half."""
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    return rows.selectExpr("concat('obj_', CAST(n_nationkey AS STRING)) AS object_id", "r_name AS object_type", "CAST(n_nationkey * 19 % 500 AS DOUBLE) AS cx", "CAST(n_nationkey * 83 % 500 AS DOUBLE) AS cy", "10e0 AS half")


def cell_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and section pair of each transcript cell: cell_id, broad_class, pair_id."""
    t = lambda n: table(spark, sf_dir, n)
    rows = t("orders").join(t("customer"), F.expr("o_custkey = c_custkey")).join(t("nation"), F.expr("c_nationkey = n_nationkey")).join(t("region"), F.expr("n_regionkey = r_regionkey"))
    return rows.selectExpr("o_orderkey AS cell_id", "o_orderpriority AS broad_class", "r_name AS pair_id")


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse counts: cell_id, gene, n."""
    return transcripts_by_cell(spark, sf_dir).groupBy("cell_id", "gene").agg(F.count("*").alias("n"))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One image: row, col, value; plane and channel from the row's vector."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("col", "value"))
    return rows.selectExpr("vec_id AS row", "CAST(col AS BIGINT) AS col", "CAST(value AS DOUBLE) AS value", "vec_id % 4 AS plane", "CAST(label % 2 AS BIGINT) AS channel")


def mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label raster on the same grid: row, col, label, 0 for background."""
    return pixels(spark, sf_dir).selectExpr("row", "col", "CASE WHEN col % 8 = 7 THEN 0 ELSE CAST(floor(row / 10) AS BIGINT) * 8 + CAST(floor(col / 8) AS BIGINT) + 1 END AS label")


def ring(cx: Column | str = "cx", cy: Column | str = "cy", half: Column | str = "half") -> Column:
    """The closed ring of a box, counter-clockwise from its lower left corner."""
    x, y, h = (F.col(c) if isinstance(c, str) else c for c in (cx, cy, half))
    corner = lambda a, b: F.struct((x + a * h).alias("x"), (y + b * h).alias("y"))
    return F.array(corner(-1, -1), corner(1, -1), corner(1, 1), corner(-1, 1), corner(-1, -1))


SQL = {
    "transcripts": f"SELECT {_TRANSCRIPT} FROM lineitem JOIN part ON l_partkey = p_partkey",
    "numbered": f"SELECT row_number() OVER (ORDER BY {', '.join(FULL_KEY)}) AS transcript_id, {_TRANSCRIPT} FROM lineitem JOIN part ON l_partkey = p_partkey",
    "cells": "SELECT p_partkey AS instance_id, CAST(p_partkey * 37 % 500 AS DOUBLE) AS cx, CAST(p_partkey * 91 % 500 AS DOUBLE) AS cy, 2e0 + p_size / 16e0 AS half FROM part",
    "nuclei": "SELECT p_partkey AS instance_id, CAST(p_partkey * 37 % 500 AS DOUBLE) AS cx, CAST(p_partkey * 91 % 500 AS DOUBLE) AS cy, (2e0 + p_size / 16e0) / 2e0 AS half FROM part",
    "objects": "SELECT concat('obj_', CAST(n_nationkey AS VARCHAR)) AS object_id, r_name AS object_type, CAST(n_nationkey * 19 % 500 AS DOUBLE) AS cx, CAST(n_nationkey * 83 % 500 AS DOUBLE) AS cy, 10e0 AS half FROM nation JOIN region ON n_regionkey = r_regionkey",
    "cell_class": "SELECT o_orderkey AS cell_id, o_orderpriority AS broad_class, r_name AS pair_id FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "counts": "SELECT cell_id, gene, count(*) AS n FROM transcripts GROUP BY cell_id, gene",
    "pixels": "SELECT vec_id AS row, CAST(i - 1 AS BIGINT) AS col, CAST(embedding[i] AS DOUBLE) AS value, vec_id % 4 AS plane, CAST(label % 2 AS BIGINT) AS channel FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)",
    "mask": "SELECT row, col, CASE WHEN col % 8 = 7 THEN 0 ELSE (row // 10) * 8 + col // 8 + 1 END AS label FROM pixels",
}
_NEEDS = {"counts": ["transcripts"], "mask": ["pixels"]}


def sql(roles: str, body: str) -> str:
    """``body`` after the expressions of ``roles`` (names by spaces); it may begin with further expressions."""
    names: list[str] = []
    for r in roles.split():
        names += [n for n in [*_NEEDS.get(r, []), r] if n not in names]
    ctes = ", ".join(f"{n} AS ({SQL[n]})" for n in names)
    body = body.strip()
    more = "" if body[:6].upper() == "SELECT" or body[:1] == "(" else ", " if ctes else ""
    lead = f"WITH {ctes}" if ctes or more else ""
    if not ctes and body[:6].upper() != "SELECT":
        lead = "WITH "
    return f"{lead}{more} {body}".strip()
