"""Masks, filters and scalar rules on points, cells and genes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctata.functions import names as N
from punctata.functions.ranks import quantiles


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def assigned_numeric(rows: DataFrame, column: str, name: str = "assigned") -> DataFrame:
    """If ``column`` holds any null, assigned rows are those not null (0 is an id); else those not 0.

    The test for a null goes over the whole table: one partial aggregate, joined back as one row.
    """
    any_null = rows.agg(F.coalesce(F.bool_or(F.col(column).isNull()), F.lit(False)).alias("_any"))
    return rows.crossJoin(F.broadcast(any_null)).withColumn(name, F.when(F.col("_any"), F.col(column).isNotNull()).otherwise(F.col(column) != 0)).drop("_any")


def assigned_text(c: Column | str) -> Column:
    return _c(c).isNotNull() & ~N.normalized(c).isin(*N.UNASSIGNED_TEXT)


def background(rows: DataFrame, column: str) -> Column:
    """True for background: null or true booleans, null or non-zero numbers, any text but the false words."""
    kind, c = rows.schema[column].dataType, F.col(column)
    if isinstance(kind, T.BooleanType):
        return F.coalesce(c, F.lit(True))
    if isinstance(kind, T.NumericType):
        return F.coalesce(c, F.lit(1)) != 0
    return F.coalesce(~N.normalized(column).isin(*N.FALSE_TEXT), F.lit(True))


def with_assigned(points: DataFrame, assignment: str | None = None, background_column: str = "background", name: str = "assigned") -> DataFrame:
    """The background column decides if there is one, else the assignment column does."""
    if background_column in points.columns:
        return points.withColumn(name, ~background(points, background_column))
    if assignment is None:
        raise KeyError("neither a background nor an assignment column")
    if isinstance(points.schema[assignment].dataType, T.NumericType):
        return assigned_numeric(points, assignment, name)
    return points.withColumn(name, assigned_text(assignment))


def is_control(*columns: str) -> Column:
    """Any of the columns holds one of the control words."""
    return N.any_token(F.lower(F.concat_ws("\x1f", *columns)), N.CONTROL_TOKENS)


def drop_platform_probes(rows: DataFrame, gene: str = "gene", platform: str = "platform") -> DataFrame:
    """Case-sensitive probe words by platform."""
    bad = F.lit(False)
    for p, words in N.PLATFORM_PROBES.items():
        bad = bad | ((F.col(platform) == p) & F.col(gene).rlike("|".join(words)))
    return rows.where(~bad)


def export_filter(points: DataFrame, exclude: str, min_qv: float) -> tuple[Column, Column]:
    """(usable, excluded): finite coordinates, a gene, good quality; excluded if the gene starts with ``exclude``."""
    ok = ~F.isnan("x") & ~F.isnan("y") & (F.abs("x") < float("inf")) & (F.abs("y") < float("inf")) & (F.coalesce(F.trim("gene"), F.lit("")) != "")
    ok = ok & F.coalesce(~F.isnan(F.col("qv").cast("double")) & (F.col("qv") >= min_qv), F.lit(False))
    return F.coalesce(ok, F.lit(False)), F.coalesce(F.col("gene").rlike(f"^(?:{exclude})"), F.lit(False))


def exported(points: DataFrame, exclude: str, min_qv: float) -> tuple[DataFrame, Observation]:
    """The rows that ``export_filter`` leaves, and an observation of n_input, n_written, n_excluded and n_seeded (written with an assignment).

    The counters are filled by the first action on the rows, so writing them counts them.
    """
    usable, excluded = export_filter(points, exclude, min_qv)
    seen = Observation()
    marked = points.withColumns({"_usable": usable, "_excluded": excluded})
    ok = F.col("_usable") & ~F.col("_excluded")
    marked = marked.observe(
        seen, F.count(F.lit(1)).alias("n_input"), F.count_if(ok).alias("n_written"), F.count_if(F.col("_usable") & F.col("_excluded")).alias("n_excluded"), F.count_if(ok & F.col("assignment").isNotNull()).alias("n_seeded"),
    )
    return marked.where(ok).drop("_usable", "_excluded"), seen


def crop(points: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    return points.where(F.col("x").between(x0, x1) & F.col("y").between(y0, y1))


def cell_rule(transcripts: float, genes: float, min_area: float, max_area: float) -> dict[str, Column]:
    """What each rule keeps, by name; a cell stays if all do."""
    return {"transcripts": F.col("n_transcripts") > transcripts, "genes": F.col("n_genes") > genes, "area": F.col("area").between(min_area, max_area)}


def cells_then_genes(counts: DataFrame, min_counts: int, min_cells: int, least_cells: int = 0, least_genes: int = 0) -> DataFrame:
    """Counts of cells with enough counts, then of genes seen in enough of those cells.

    Fewer than ``least_cells`` cells or ``least_genes`` genes raise; clustering needs 3 and 2.
    """
    good = counts.groupBy("cell_id").agg(F.sum("n").alias("_s")).where(F.col("_s") >= min_counts)
    kept = counts.join(good.select("cell_id"), "cell_id", "left_semi")
    seen = kept.where("n > 0").groupBy("gene").agg(F.count("*").alias("_k")).where(F.col("_k") >= min_cells)
    kept = kept.join(seen.select("gene"), "gene", "left_semi")
    if least_cells or least_genes:
        n = good.agg(F.count("*").alias("cells")).crossJoin(seen.agg(F.count("*").alias("genes"))).first()
        if n.cells < least_cells or n.genes < least_genes:
            raise ValueError(f"too few cells or genes remain: {n.cells} cells, {n.genes} genes")
    return kept


def observed_wins(points: DataFrame, axes: Sequence[str] = ("x", "y")) -> DataFrame:
    """Moved coordinates are kept as ``proseg_moved_*``; the observed ones take their place."""
    moved = {f"proseg_moved_{a}": F.col(a) for a in axes}
    return points.withColumns(moved).withColumns({a: F.col(f"observed_{a}") for a in axes})


def points_contract(points: DataFrame, keep_text: bool = True) -> DataFrame:
    """Types of a points table: text gene and cell_id, whole-number ids where a column holds nothing else.

    An id column with a value that is no whole number stays text and no value is lost; one aggregate over the
    table finds out. A null ``cell`` is 0. With ``keep_text=False`` such a value is null, or 0 in ``cell``, and
    the table is not read before.
    """
    ids = ["cell", "transcript_id", "assignment"]
    text = dict.fromkeys(ids, False)
    if keep_text:
        found = points.agg(*(F.coalesce(F.bool_or(F.col(c).isNotNull() & F.expr(f"try_cast({c} AS BIGINT)").isNull()), F.lit(False)).alias(c) for c in ids)).first()
        text = found.asDict()
    typed = {c: F.col(c).cast("string") if text[c] else F.expr(f"try_cast({c} AS BIGINT)") for c in ids}
    typed["cell"] = F.coalesce(typed["cell"], F.lit("0" if text["cell"] else 0))
    return points.select(F.col("gene").cast("string").alias("gene"), *(typed[c].alias(c) for c in ids), F.col("cell_id").cast("string").alias("cell_id"))


def affine(x: Column, y: Column, m: Sequence[Sequence[float]]) -> tuple[Column, Column]:
    """The map of a 2x3 or 3x3 matrix; coefficients are literals of the plan."""
    (a, b, t), (c, d, u) = m[0], m[1]
    return a * x + b * y + t, c * x + d * y + u


def inverse(m: Sequence[Sequence[float]]) -> list[list[float]]:
    (a, b, t), (c, d, u) = m[0], m[1]
    k = a * d - b * c
    if k == 0:
        raise ValueError("the map has no inverse")
    return [[d / k, -b / k, (b * u - d * t) / k], [-c / k, a / k, (c * t - a * u) / k]]


def transform_points(points: DataFrame, m: Sequence[Sequence[float]]) -> DataFrame:
    """Finite points move and keep ``raw_x``, ``raw_y``; others stay as they are, without raw values."""
    finite = (F.abs("x") < float("inf")) & (F.abs("y") < float("inf"))
    x, y = affine(F.col("x"), F.col("y"), m)
    return points.select(
        *(c for c in points.columns if c not in ("x", "y")),
        F.when(finite, x).otherwise(F.col("x")).alias("x"), F.when(finite, y).otherwise(F.col("y")).alias("y"),
        F.when(finite, F.col("x")).alias("raw_x"), F.when(finite, F.col("y")).alias("raw_y"),
    )


def broad_class(label: Column) -> Column:
    """Broad class of a supercluster label: map, labels kept as they are, neuron labels, neuron words."""
    label = F.trim(label)
    out = F.when(F.lit(False), F.lit(""))
    for k, v in N.NON_NEURON_CLASSES.items():
        out = out.when(label == k, v)
    return out.when(label.isin(*N.KEPT_LABELS), label).when(label.isin(*N.NEURON_LABELS) | N.any_token(F.lower(label), N.NEURON_TOKENS), N.NEURON_CLASS).otherwise(label)


def neuron_split(neurotransmitter: Column) -> Column:
    t = F.upper(neurotransmitter)
    inhibitory, excitatory = t.rlike("GABA|GLY"), t.contains("VGLUT")
    return F.when(inhibitory & ~excitatory, "Inhibitory").when(excitatory & ~inhibitory, "Excitatory").otherwise("Other")


def label_split(label: Column) -> Column:
    """Inhibitory or excitatory by the words of a label, the inhibitory ones first; else Other."""
    t = F.lower(F.trim(label))
    return F.when(N.any_token(t, N.INHIBITORY_TOKENS), "Inhibitory").when(N.any_token(t, N.EXCITATORY_TOKENS), "Excitatory").otherwise("Other")


def proximity(distance: Column, inside: Column, edges: Sequence[float] = (50, 100, 200)) -> Column:
    near, middle, far = edges
    return F.when(inside | (distance < near), "near").when(distance < middle, "middle").when(distance <= far, "far").otherwise("beyond_max")


def depth_flag(inside: Column, depth: Column, streamline: Column, near_side: Column) -> Column:
    return F.when(~inside, "outside_ribbon").when(depth.isNull(), "no_laplace_depth").when(streamline.isNull(), "no_streamline").when(near_side, "near_side_boundary").otherwise("assigned")


def stretch(rows: DataFrame, column: str = "value", keys: Sequence[str] = (), low: float = 0.02, high: float = 0.98) -> DataFrame:
    """``stretched``: the column between its percentiles on 0..1; a flat range widens by 1, non-finite values are 0."""
    finite = F.col(column).isNotNull() & ~F.isnan(column) & (F.abs(column) < float("inf"))
    p = quantiles(rows.where(finite).select(*keys, F.col(column).alias("_value")), "_value", [low, high], keys, name="_p")
    joined = rows.join(p, list(keys), "left") if keys else rows.join(F.broadcast(p), F.lit(True), "left")  # one row
    a, b = F.col("_p")[0], F.col("_p")[1]
    top = F.when(b <= a, a + 1).otherwise(b)
    return joined.withColumn("stretched", F.when(finite, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(column) - a) / (top - a)))).otherwise(0.0)).drop("_p")


def equal_area_depth(phi: Column, ratio: Column) -> Column:
    """Depth of equal area from a Laplace depth and a clipped area ratio."""
    p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), phi))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (2 * p + (ratio - 1) * p * p) / (1 + ratio)))


def positive_label(c: str) -> Column:
    """A positive whole number, or the number a text ends with; else null."""
    number = F.expr(f"try_cast({c} AS BIGINT)")
    tail = F.nullif(F.regexp_extract(c, "([0-9]+)$", 1), F.lit("")).try_cast("bigint")
    value = F.coalesce(number, tail)
    return F.when(value > 0, value)


def ids_with_fallback(rows: DataFrame, chosen: str, fallback: str, name: str = "query_id", order: Sequence[str] = ()) -> DataFrame:
    """``chosen`` unless blank, then ``fallback``; repeats get -1, -2, ... in ``order``."""
    base = F.coalesce(F.nullif(F.trim(F.col(chosen).cast("string")), F.lit("")), F.col(fallback))
    w = Window.partitionBy("_base").orderBy(*order)
    numbered = rows.withColumn("_base", base).withColumn("_k", F.row_number().over(w) - 1)
    return numbered.withColumn(name, F.when(F.col("_k") == 0, F.col("_base")).otherwise(F.concat_ws("-", "_base", F.col("_k").cast("string")))).drop("_base", "_k")


def pattern_label(scores: Mapping[str, Column], q_values: Mapping[str, Column], eligible: Column, clustered: Column, disperse: Column, pericellular: Column, membrane: Column) -> Column:
    """Primary pattern of a gene; of equal compartment scores the first listed counts."""
    names = list(scores)
    top = F.greatest(*scores.values()) if len(names) > 1 else scores[names[0]]
    best = F.coalesce(*(F.when(scores[n] == top, F.lit(n)) for n in names))
    best_q = F.coalesce(*(F.when(best == n, q_values[n]) for n in names))
    return (
        F.when(~F.coalesce(eligible, F.lit(False)), "insufficient_transcripts")
        .when(F.coalesce(clustered, F.lit(False)), "residual_multiscale_clustered")
        .when(F.coalesce(disperse, F.lit(False)), "spatially_disperse")
        .when((F.coalesce(best_q, F.lit(1.0)) < 0.05) & (top > 0), F.concat(best, F.lit("_enriched")))
        .when(pericellular >= 0.25, "pericellular")
        .when(membrane >= 0.25, "membrane_proximal")
        .otherwise("diffuse_or_unresolved")
    )


def plot_frame(rows: DataFrame, keys: Sequence[str], group: str, metrics: Sequence[str], depth: str | None = None, label: str | None = None, known: Sequence[str] = ()) -> DataFrame:
    """(keys, group, metric, value): values that a plot can show, in long form.

    Rows stay with a group that is not null, a finite ``depth`` and a ``label`` among ``known``, where these are named; of their metrics
    the finite ones above 0.
    """
    ok = F.col(group).isNotNull()
    if depth:
        ok = ok & F.coalesce(~F.isnan(depth) & (F.abs(depth) < float("inf")), F.lit(False))
    if label:
        ok = ok & F.coalesce(F.col(label).isin(*known), F.lit(False))
    picked = rows.where(ok).select(*keys, group, *(F.col(m).cast("double").alias(m) for m in metrics))
    long = picked.unpivot([*keys, group], list(metrics), "metric", "value")
    return long.where((F.col("value") > 0) & ~F.isnan("value") & (F.col("value") < float("inf")))
