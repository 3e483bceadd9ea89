"""Name clean-up and the word lists that predicates use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal the reference's for right results.
UNASSIGNED_TEXT = ("0", "0.0", "", "none", "nan", "null", "unassigned")
TRUE_TEXT = ("true", "t", "1", "yes", "y")
FALSE_TEXT = ("false", "f", "0", "no", "n")
CONTROL_TOKENS = ("blank", "control", "negative", "negcontrol", "unassigned", "deprecated")
PLATFORM_PROBES = {"XENIUM": ("Blank",), "MERSCOPE": ("UnassignedCodeword", "NegControlCodeword", "NegControlProbe")}
NON_NEURON_CLASSES = {
    "Oligodendrocyte": "Oligodendrocytes",
    "Committed oligodendrocyte precursor": "Oligodendrocyte precursors",
    "Oligodendrocyte precursor": "Oligodendrocyte precursors",
    "Astrocyte": "Astrocytes",
    "Microglia": "Microglia",
    "Fibroblast": "Fibroblasts",
    "Vascular": "Vascular cells",
}
KEPT_LABELS = ("Bergmann glia", "Choroid plexus", "Ependymal", "Miscellaneous", "Splatter")
NEURON_LABELS = (
    "Upper-layer intratelencephalic", "Deep-layer intratelencephalic", "Deep-layer near-projecting", "Deep-layer corticothalamic and 6b",
    "MGE interneuron", "CGE interneuron", "LAMP5-LHX6 and Chandelier", "Hippocampal CA1-3", "Hippocampal CA4", "Hippocampal dentate gyrus",
    "Amygdala excitatory", "Medium spiny neuron", "Eccentric medium spiny neuron", "Mammillary body", "Thalamic excitatory",
    "Midbrain-derived inhibitory", "Upper rhombic lip", "Cerebellar inhibitory", "Lower rhombic lip",
)
NEURON_TOKENS = ("neuron", "interneuron", "excitatory", "inhibitory", "intratelencephalic", "corticothalamic")
ROLE_ALIASES = {
    "pia": ("pia", "pial", "pial_boundary", "surface_pia", "depth_0"),
    "wm": ("wm", "white", "white_matter", "grey_white", "gray_white", "gm_wm", "grey_white_boundary", "gray_white_boundary", "depth_1"),
    "side": ("side", "edge", "tissue_edge", "side_boundary", "artificial"),
    "exclusion": ("exclude", "exclusion", "mask", "tear", "fold", "vessel"),
    "ribbon": ("ribbon", "cortical_ribbon", "cortex", "cortical_mask"),
}
PIECE_KEYS = ("tissue_piece_id", "piece_id", "region_id", "component_id")
ROLE_KEYS = ("role", "type", "name", "label", "boundary", "boundary_type")
UNKNOWN_LABEL, NEURON_CLASS = "Mixed/Unknown", "Neurons"


def normalized(c: Column | str) -> Column:
    """Trimmed and lower-cased."""
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))


def table_key(c: Column | str, prefix: str = "table_") -> Column:
    """Runs of other characters than letters, digits and _ become one _; outer _ go."""
    return F.concat(F.lit(prefix), F.btrim(F.regexp_replace(c, "[^0-9a-zA-Z_]+", "_"), F.lit("_")))


def safe_token(c: Column | str) -> Column:
    cleaned = F.btrim(F.regexp_replace(normalized(c), "[^A-Za-z0-9]+", "_"), F.lit("_"))
    return F.when(cleaned == "", F.lit("value")).otherwise(cleaned)


def safe_identifier(c: Column | str) -> Column:
    """Other characters than letters, digits, `.`, `_` and `-` become `_` one by one; outer `_` go."""
    return F.lower(F.btrim(F.regexp_replace(c, r"[^\p{L}\p{N}._-]", "_"), F.lit("_")))


def role_name(c: Column) -> Column:
    return F.translate(normalized(c), "- /", "___")


def any_token(c: Column, tokens: tuple[str, ...]) -> Column:
    return c.rlike("|".join(tokens))


# Words of a label that tell its neurons apart.
INHIBITORY_TOKENS = ("inhibitory", "interneuron", "chandelier", "medium spiny")
EXCITATORY_TOKENS = ("excitatory", "intratelencephalic", "corticothalamic", "near-projecting", "hippocampal", "mammillary", "rhombic lip")
