"""Incident type -> class mapping as a literal map lookup (no join, no UDF)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Treated incident type (upper case, '_' for spaces) -> incident class.
INCIDENT_CLASSES = {
    "PORTE_DE_ARMA": "ARMAS",
    "EXTORSAO_MEDIANTE_SEQUESTRO": "SEQUESTRO",
    "APREENSAO_DE_ENTORPECENTES": "DROGAS",
    "PORTE_DE_ENTORPECENTES": "DROGAS",
    "TRAFICO_DE_ENTORPECENTES": "DROGAS",
    "HOMICIDIO_CULPOSO_OUTROS": "HOMICÍDIO",
    "HOMICIDIO_CULPOSO_POR_ACIDENTE_DE_TRANSITO": "HOMICÍDIO",
    "HOMICIDIO_DOLOSO": "HOMICÍDIO",
    "HOMICIDIO_DOLOSO_POR_ACIDENTE_DE_TRANSITO": "HOMICÍDIO",
    "LATROCINIO": "HOMICÍDIO",
    "LESAO_CORPORAL_SEGUIDA_DE_MORTE": "HOMICÍDIO",
    "TENTATIVA_DE_HOMICIDIO": "HOMICÍDIO",
    "LESAO_CORPORAL_DOLOSA": "LESAO CORPORAL",
    "LESAO_CORPORAL_CULPOSA_POR_ACIDENTE_DE_TRANSITO": "LESAO CORPORAL",
    "LESAO_CORPORAL_CULPOSA_OUTRAS": "LESAO CORPORAL",
    "FURTO_DE_CARGA": "ROUBO E FURTO",
    "FURTO_OUTROS": "ROUBO E FURTO",
    "FURTO_ROUBO_DE_CELULAR": "ROUBO E FURTO",
    "FURTO_ROUBO_DE_VEICULO": "ROUBO E FURTO",
    "ROUBO_A_BANCO": "ROUBO E FURTO",
    "ROUBO_DE_CARGA": "ROUBO E FURTO",
    "ROUBO_OUTROS": "ROUBO E FURTO",
}
DEFAULT_CLASS = "OUTROS"
# Labels merged into one type before classification (source C).
VEHICLE_LABELS = ("FURTO DE VEÍCULO", "ROUBO DE VEÍCULO")
VEHICLE_MERGED = "FURTO ROUBO DE VEICULO"
# ---------------------------------------------------------------------------


def classify(col: Column | str, mapping: dict | None = None, default: str = DEFAULT_CLASS) -> Column:
    """Literal map lookup; unknown and NULL types fall to ``default``."""
    mapping = INCIDENT_CLASSES if mapping is None else mapping
    c = F.col(col) if isinstance(col, str) else col
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(lookup, c), F.lit(default))
