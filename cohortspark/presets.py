"""Ready-made description of the quarterly labour survey person extract."""

from __future__ import annotations

from .functions.coerce import is_finite
from .spec import Cascade, DatasetSpec, FieldSpec, FilterStep, PeriodNaming

# --- fixed values -----------------------------------------------------------
# Header names, standard names, code lists, labels and texts below belong to the
# survey files and to the published result tables; they must not change.
OCCUPATION_CODES = ("1", "2", "3", "4")

SURVEY_FIELDS = (
    FieldSpec("P05D01", "salario_mensual", "numeric"),
    FieldSpec("P02A03", "edad", "numeric"),
    FieldSpec("P05C07A", "antiguedad_anios", "numeric"),
    FieldSpec("P05C07B", "antiguedad_meses", "numeric"),
    FieldSpec("P05H01A", "horas_semanales", "numeric"),
    FieldSpec("P03A03A", "nivel_educativo", "open_code"),
    FieldSpec("P05C16", "categoria_ocupacional", "closed_code", OCCUPATION_CODES),
    FieldSpec("DOMINIO", "dominio", "open_code"),
    FieldSpec("OCUPADOS", "ocupado", "code"),
    FieldSpec("NUM_HOGAR", "NUM_HOGAR", "code"),
    FieldSpec("NUM_PERSONA", "NUM_PERSONA", "code"),
    FieldSpec("FACTOR", "FACTOR", "numeric"),
    FieldSpec("ANIO", "ANIO", "code"),
    FieldSpec("TRIMESTRE", "TRIMESTRE", "code"),
)

OCCUPATION_LABELS = {
    "1": "1 - Empleado de gobierno",
    "2": "2 - Empleado de empresa privada",
    "3": "3 - Jornalero o peón",
    "4": "4 - Servicio doméstico",
}

STEP_LABELS = {
    0: "Registros originales",
    1: "Edad interpretable (numérica y finita)",
    2: "Edad mayor o igual a 15 años",
    3: "Persona ocupada (OCUPADOS == 1)",
    4: "Categoría ocupacional válida (1, 2, 3 o 4)",
    5: "Salario interpretable (numérico)",
    6: "Salario finito y mayor que cero",
    7: "Antigüedad en años válida (numérica y finita)",
    8: "Antigüedad en meses entera entre 0 y 11",
    9: "Antigüedad total mayor o igual a cero",
    10: "Antigüedad total no mayor que la edad",
    11: "Horas semanales finitas y mayores que cero",
    12: "Horas semanales no mayores que 168",
}

EXPECTED_PERIODS = ("2025T1", "2025T2", "2025T3", "2025T4", "2026T1")

SURVEY_NAMING = PeriodNaming(
    survey_token="ENEIC",
    include=("PERSONA",),
    exclude_name=("DICCIONARIO", "DICTIONARY", "BOLETA"),
    exclude_path=("HOGAR", "VIVIENDA"),
    quarter_words={
        "PRIMER": 1,
        "PRIMERO": 1,
        "SEGUNDO": 2,
        "TERCER": 3,
        "TERCERO": 3,
        "CUARTO": 4,
    },
    quarter_romans={"I": 1, "II": 2, "III": 3, "IV": 4},
)
# --- end of fixed values ----------------------------------------------------


_CONDITIONS = {
    1: lambda c: is_finite(c["edad"]),
    2: lambda c: c["edad"] >= 15,
    3: lambda c: c["ocupado"] == "1",
    4: lambda c: c["categoria_ocupacional"].isin(*OCCUPATION_CODES),
    5: lambda c: c["salario_mensual"].isNotNull(),
    6: lambda c: is_finite(c["salario_mensual"]) & (c["salario_mensual"] > 0),
    7: lambda c: is_finite(c["antiguedad_anios"]),
    8: lambda c: c["antiguedad_meses"].between(0, 11) & (c["antiguedad_meses"] % 1 < 1e-9),
    9: lambda c: is_finite(c["antiguedad"]) & (c["antiguedad"] >= 0),
    10: lambda c: c["antiguedad"] <= c["edad"],
    11: lambda c: is_finite(c["horas_semanales"]) & (c["horas_semanales"] > 0),
    12: lambda c: c["horas_semanales"] <= 168,
}

SURVEY_CASCADE = Cascade(
    start=STEP_LABELS[0],
    inputs={
        name: (name, kind)
        for kind, names in (
            (
                "numeric",
                (
                    "edad",
                    "salario_mensual",
                    "antiguedad_anios",
                    "antiguedad_meses",
                    "antiguedad",
                    "horas_semanales",
                ),
            ),
            ("code", ("ocupado", "categoria_ocupacional")),
        )
        for name in names
    },
    steps=tuple(
        FilterStep(step, STEP_LABELS[step], condition)
        for step, condition in _CONDITIONS.items()
    ),
    duration=("antiguedad", "antiguedad_anios", "antiguedad_meses"),
)

LABOUR_SURVEY = DatasetSpec(
    fields=SURVEY_FIELDS,
    keys=("periodo_archivo", "NUM_HOGAR", "NUM_PERSONA"),
    target="salario_mensual",
    numeric=("edad", "antiguedad", "horas_semanales"),
    categorical=("nivel_educativo", "categoria_ocupacional", "dominio"),
    audited=tuple(f.name for f in SURVEY_FIELDS if f.source not in ("ANIO", "TRIMESTRE")),
    duration=("antiguedad", "antiguedad_anios", "antiguedad_meses"),
    cascade=SURVEY_CASCADE,
    naming=SURVEY_NAMING,
    labels={"categoria_ocupacional": OCCUPATION_LABELS},
)
