"""Small fixed dimensions. Each is a constant-size table (13 rows or fewer): broadcasting them is always safe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values (must equal the reference's for identical results) -------------------------------------------
# Level-1 consumer-price categories: two-digit code -> normalised "XX - Label".
COICOP_LEVEL1 = [
    ("00", "00 - Ensemble"),
    ("01", "01 - Alimentation et boissons non alcoolisées"),
    ("02", "02 - Boissons alcoolisées et tabac"),
    ("03", "03 - Articles d'habillement et chaussures"),
    ("04", "04 - Logement, eau, gaz, électricité"),
    ("05", "05 - Ameublement, équipement ménager"),
    ("06", "06 - Santé"),
    ("07", "07 - Transports"),
    ("08", "08 - Communications"),
    ("09", "09 - Loisirs et culture"),
    ("10", "10 - Enseignement"),
    ("11", "11 - Restaurants et hôtels"),
    ("12", "12 - Biens et services divers"),
]

# Series identifier -> label of the labelled (XML) source.
SERIES_LABELS = [
    ("001759970", "00 - Ensemble"),
    ("001763417", "01 - Alimentation et boissons non alcoolisées"),
    ("001763491", "02 - Boissons alcoolisées, tabac et stupéfiants"),
    ("001763508", "03 - Articles d'habillement et chaussures"),
    ("001763529", "04 - Logement, eau, gaz, électricité et autres combustibles"),
    ("001763565", "05 - Meubles, articles de ménage et entretien courant du foyer"),
    ("001763620", "06 - Santé"),
    ("001763641", "07 - Transports"),
    ("001763683", "08 - Communications"),
    ("001763698", "09 - Loisirs et culture"),
    ("001763774", "10 - Enseignement"),
    ("001763781", "11 - Restaurants et hôtels"),
    ("001763851", "Ensemble hors énergie"),
]

# Latency histogram upper bounds in seconds (data API, prediction API).
DATA_LATENCY_BOUNDS = [0.01, 0.05, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0]
PREDICT_LATENCY_BOUNDS = [0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0]

# Request path -> endpoint label, first rule that fits.
ENDPOINT_RULES = [
    ("is", "/api/inflation", "/api/inflation"),
    ("in", "/api/inflation/", "/api/inflation/{sub}"),
    ("is", "/api/prix-alimentaires", "/api/prix-alimentaires"),
    ("in", "/api/prix-alimentaires/", "/api/prix-alimentaires/{sub}"),
    ("in", "/api/predict/", "/api/predict/{categorie}"),
    ("in", "/api/metrics/", "/api/metrics/{categorie}"),
]

# Budgets (euros per month) of the inflation-in-euros table.
BUDGETS = [300, 500, 800, 1200, 2000]

# Title markers of the labelled source.
TITLE_COICOP_MARKER = "Nomenclature Coicop : "
TITLE_COUNTRY_MARKER = " - France - "
TITLE_DISCONTINUED_SUFFIX = " - Séries arrêtées"
UNKNOWN_LABEL = "inconnu"
UNCLASSIFIED_CATEGORY = "non-classe"
# ------------------------------------------------------------------------------------------------------------------


def literal_table(spark: SparkSession, rows, names: list[str]) -> DataFrame:
    """A small fixed table built from literals on the JVM (folded into a local relation by the optimizer): no
    Python worker at run time, unlike ``createDataFrame`` of a Python list."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def coicop_dim(spark: SparkSession, code="code", label="label") -> DataFrame:
    return literal_table(spark, COICOP_LEVEL1, [code, label])


def series_label_dim(spark: SparkSession, series_id="series_id", label="label") -> DataFrame:
    return literal_table(spark, SERIES_LABELS, [series_id, label])


def sql_values(rows, columns) -> str:
    """The same fixed table as an SQL VALUES list (used by the DuckDB oracle)."""

    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(columns)})"
