"""Tables of the star schema and of model results."""

from __future__ import annotations

from pyspark.sql.types import StructType


def _struct(*columns: tuple[str, str]) -> StructType:
    out = StructType()
    for name, kind in columns:
        out = out.add(name, kind)
    return out


_KEY = ("id", "long")

# Columns and types of the stored tables.
DIMENSIONS: dict[str, StructType] = {
    "politique": _struct(
        _KEY,
        ("etiquette_parti", "long"),
        ("annee", "integer"),
        ("code_dept", "string"),
        ("candidat", "string"),
        ("total_voix", "long"),
        ("orientation_politique", "string"),
    ),
    "securite": _struct(_KEY, ("annee", "integer"), ("code_dept", "string"), ("delits_total", "long")),
    "sante": _struct(_KEY, ("code_dept", "string"), ("annee", "integer"), ("esperance_vie", "double")),
    "education": _struct(
        _KEY,
        ("code_departement", "string"),
        ("annee_fermeture", "integer"),
        ("libelle_departement", "string"),
        ("nombre_total_etablissements", "long"),
        ("nb_public", "long"),
        ("nb_prive", "long"),
        ("pct_public", "double"),
        ("pct_prive", "double"),
    ),
    "environnement": _struct(
        _KEY,
        ("code_insee_region", "string"),
        ("annee", "integer"),
        ("parc_eolien_mw", "double"),
        ("parc_solaire_mw", "double"),
    ),
    "socio_economie": _struct(
        _KEY,
        ("annee", "integer"),
        ("pib_euros_par_habitant", "double"),
        ("code_insee_region", "string"),
        ("evolution_prix_conso", "double"),
        ("pib_par_inflation", "double"),
    ),
    "technologie": _struct(_KEY, ("annee", "integer"), ("depenses_rd_pib", "double")),
    "demographie": _struct(
        _KEY,
        ("annee", "integer"),
        ("code_departement", "string"),
        ("nom_departement", "string"),
        ("population_totale", "long"),
        ("population_hommes", "long"),
        ("population_femmes", "long"),
        ("pop_0_19", "long"),
        ("pop_20_39", "long"),
        ("pop_40_59", "long"),
        ("pop_60_74", "long"),
        ("pop_75_plus", "long"),
    ),
}

FACT = _struct(
    ("annee_code_dpt", "string"),
    ("id_parti", "long"),
    ("securite_id", "long"),
    ("socio_eco_id", "long"),
    ("sante_id", "long"),
    ("environnement_id", "long"),
    ("education_id", "long"),
    ("demographie_id", "long"),
    ("technologie_id", "long"),
)

MODEL_RESULTS = _struct(
    ("run_timestamp", "timestamp"),
    ("model_name", "string"),
    ("description", "string"),
    ("accuracy", "double"),
    ("cv_mean", "double"),
    ("cv_std", "double"),
    ("winner_id", "long"),
    ("winner_name", "string"),
    ("winner_pct", "double"),
)
