"""The whole study on generated extracts, checked by the laws between its tables."""

import random

import pandas as pd
import pytest

from cohortspark import LABOUR_SURVEY
from cohortspark.plans.study import run_study
from test_sources import write_extract


def person(rng, i):
    age, education = rng.randint(10, 70), rng.randint(0, 7)
    pay = 500 + 40 * age + 300 * education + rng.randint(-200, 200)
    employed = rng.random() < 0.8
    return {
        "P05D01": f"{pay}.0" if employed else "",
        "P02A03": str(age),
        "P05C07A": str(rng.randint(0, 9)) if employed else "",
        "P05C07B": str(rng.randint(0, 11)) if employed else "",
        "P05H01A": str(rng.randint(10, 80)) if employed else "",
        "P03A03A": str(education),
        "P05C16": str(rng.randint(1, 6)) if employed else "",
        "DOMINIO": str(rng.randint(1, 3)),
        "OCUPADOS": "1.0" if employed else "",
        "NUM_HOGAR": str(i // 3),
        "NUM_PERSONA": str(i % 3),
        "FACTOR": "1.5",
        "ANIO": "2025",
        "TRIMESTRE": "1",
    }


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("study")
    rng = random.Random(5)
    for name in ("I-2025", "II-2025", "III-2025", "IV-2025", "I-2026"):
        rows = [person(rng, i) for i in range(400)]
        write_extract(root / "raw" / f"Personas-ENEIC-{name}.csv", [*rows, rows[0]])
    written = run_study(spark, str(root / "raw"), str(root / "work"), root / "tables")
    return {p.stem: pd.read_csv(p) for p in written}


def test_tables_are_complete(tables):
    assert len(tables) == 27
    assert list(tables["filter_audit"].columns) == [
        "conjunto", "paso", "descripcion", "registros_antes", "registros_excluidos",
        "registros_despues", "porcentaje_excluido",
    ]
    assert list(tables["errors_by_salary_band"].columns)[:4] == [
        "modelo", "banda_salario", "n", "salario_medio"
    ]
    assert "MAE_validacion_2025" in tables["validation_vs_test"].columns


def test_audit_laws(tables):
    audit = tables["filter_audit"]
    for _, steps in audit.groupby("conjunto"):
        assert (steps.registros_antes - steps.registros_excluidos == steps.registros_despues).all()
        assert (steps.registros_antes.iloc[1:].values == steps.registros_despues.iloc[:-1].values).all()
    last = audit[audit.paso == 12].registros_despues.sum()
    assert tables["prepared_counts_by_period"].filas_elegibles.sum() == last
    assert audit[audit.paso == 0].registros_antes.sum() == 5 * 401
    copies = tables["duplicate_key_audit"]
    assert copies.tipo.tolist() == ["exacto"] * 2 and copies.claves_duplicadas.tolist() == [4, 1]
    missing = tables["missing_summary"]
    share = 100 * missing.faltantes / missing.registros_totales
    assert missing.porcentaje_faltante.tolist() == pytest.approx(share.tolist())
    assert missing[missing.variable == "nivel_educativo"].faltantes.sum() == 0


def test_profile_laws(tables):
    n = tables["descriptive_stats"].n.iloc[0]
    shares = tables["categorical_distributions_2025"].groupby("variable")
    assert shares.porcentaje.sum().tolist() == pytest.approx([100] * 3)
    assert (shares.n.sum() == n).all()
    profile = tables["cluster_profiles"]
    mean = (profile.n * profile.edad_media).sum() / n
    described = tables["descriptive_stats"].set_index("variable")
    assert mean == pytest.approx(described.media["edad"])
    parts = tables["cluster_dominio_summary"]
    assert parts.groupby("cluster").porcentaje_cluster.sum().tolist() == pytest.approx([100] * len(profile))


def test_error_laws(tables):
    test = tables["model_comparison_test_2026"].set_index("modelo")
    for name in ("errors_by_education", "errors_by_domain", "errors_by_salary_band"):
        for model, rows in tables[name].groupby("modelo"):
            assert (rows.n * rows.MAE).sum() / rows.n.sum() == pytest.approx(test.MAE[model])
    change = tables["validation_vs_test"]
    for metric in ("MAE", "RMSE", "R2"):
        difference = change[f"{metric}_test_2026"] - change[f"{metric}_validacion_2025"]
        assert difference.tolist() == pytest.approx(change[f"delta_{metric}"].tolist())
    assert tables["rf_feature_importances"].importancia.sum() == pytest.approx(1)
    width = 3 + sum(tables["rf_feature_importances"].feature.str.startswith(c + "__").sum() for c in LABOUR_SURVEY.categorical)
    assert len(tables["rf_feature_importances"]) == width
    points = tables["prediction_points"]
    assert (points.residuo - (points.salario_mensual - points.prediction)).abs().max() < 1e-9
    assert test.R2["Linear Regression"] > 0.8 > test.R2["Baseline"]
