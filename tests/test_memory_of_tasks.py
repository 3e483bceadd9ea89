"""What a task holds does not grow with the table: rows are dealt to more tasks, and no key without a partner gathers in one."""

from pyspark.sql import functions as F

from punctata import roles
from punctata.functions.session import dealt
from punctata.operators import ids
from punctata.operators.counts import table_diff


def _rows_of_tasks(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_more_rows_are_dealt_to_more_tasks(spark):
    for n in (1000, 10_000):
        rows = dealt(spark.range(n), "id", each=100)
        assert rows.rdd.getNumPartitions() == n // 100
        assert max(_rows_of_tasks(rows)) < 200
    assert dealt(spark.range(0), "id").count() == 0


def test_ids_without_a_partner_do_not_gather(spark):
    """Most rows are null or a sentinel; by a shuffled join of fixed partitions each task has its share of them."""
    rows = spark.range(8000).selectExpr("id AS row", "CASE WHEN id % 8 = 0 THEN id WHEN id % 8 < 5 THEN NULL ELSE -1 END AS a").repartition(8)
    mapping = spark.range(8000).selectExpr("id AS old", "id * 2 AS new").hint("merge")
    held = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled",)}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = ids.translate(rows, "a", mapping, "old", "new", [-1])
        assert max(_rows_of_tasks(out)) < 2000
        got = {r.row: r.a for r in out.collect()}
    finally:
        for c, v in held.items():
            spark.conf.set(c, v)
    assert got == {i: 2 * i if i % 8 == 0 else None for i in range(8000)}


def test_difference_of_tables_with_null_keys(spark):
    """Null keys meet nothing, as in a full join; a cell of both tables is dealt once."""
    a = spark.createDataFrame([(1, "x", 2), (1, None, 3), (2, "x", 1)], "cell_id long, gene string, n long")
    b = spark.createDataFrame([(1, "x", 5), (1, None, 3), (3, "y", 4)], "cell_id long, gene string, n long")
    out = table_diff(a, b)
    plan = out._jdf.queryExecution().toString()
    assert "FullOuter" not in plan
    r = out.first()
    assert (r.nnz, r.abs_sum, r.increased, r.decreased, r.same, r.one_sided) == (5, 14, 2, 1, 0, 2)


def test_counts_are_made_where_their_cells_are(spark):
    """The exchange by cell is the only one before the counts of cells and genes."""
    d = "/root/testdata/sf0.001"
    plan = roles.counts(spark, d)._jdf.queryExecution().toString()
    assert "REPARTITION_BY_NUM" in plan and "hashpartitioning(cell_id" not in plan
    want = roles.transcripts(spark, d).groupBy("cell_id", "gene").count()
    assert roles.counts(spark, d).exceptAll(want).isEmpty() and want.exceptAll(roles.counts(spark, d)).isEmpty()
