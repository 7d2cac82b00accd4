"""Registered queries whose numbers depend on a run, checked by laws; and the SQL of these.

A sketch, a k-means segmentation or a forest has no equivalent in SQL; what must hold for
whatever it gives has: row numbers, bounds, sums, and equality of a model with its copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.derive import value_band, with_residual
from ..operators.evaluate import cube_laws, error_cube
from ..operators.predict import LR_CONFIGS, RF_CONFIGS, best_config, feature_importance_table, pipeline_for, score_models, sweep
from ..operators.profile import descriptive_statistics, median_by_group
from ..operators.quantiles import quantile_cuts
from ..operators.relational import kept, settle
from ..operators.sample import deterministic_sample, random_rows_of_files
from ..operators.segment import best_k, kmeans_sweep, prepare_kmeans_features, segment_composition, segment_profile, silhouettes
from ..operators.sketches import CUTS, described_states, merge_states, rank_check, rank_error, value_states
from ..presets import LABOUR_SURVEY
from ..sources.sinks import load_model, save_model
from .oracles import _KEPT
from .queries import _train_and_validation, rounded
from .views import CHARGES, charges, survey_prepared, table, work_folder

Query = Callable[[SparkSession, str], DataFrame]

#: Error of the sketches that the descriptive tables use by default.
_DEFAULT_ERROR = 1.0 / 10_000 + 1e-9


def merged_descriptives(spark: SparkSession, sf: str) -> DataFrame:
    """Moments by dataset, merged from stored states of periods."""
    states = settle(value_states(survey_prepared(spark, sf), by=["periodo_archivo", "conjunto"]))
    table = described_states(merge_states(states, ["conjunto"]), ["conjunto"])
    return rounded(table.select("conjunto", "variable", "n", "media", "stddev", "min", "max"))


def merged_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Whether quantiles of periods, and those merged from them, are as near as stated."""
    prepared = survey_prepared(spark, sf)
    states = settle(value_states(prepared, by=["periodo_archivo", "conjunto"]))
    checked = []
    for groups, some in ((["periodo_archivo"], states), (["conjunto"], merge_states(states, ["conjunto"]))):
        answers = described_states(some, groups)
        seen = rank_check(prepared, answers, LABOUR_SURVEY.profiled, groups, rank_error())
        checked.append(seen.select(F.col(groups[0]).alias("grupo"), "variable", "corte", "n", "dentro"))
    return checked[0].unionByName(checked[1])


def default_sketch_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """The same for the sketches of the descriptive table and of medians by group."""
    prepared = settle(survey_prepared(spark, sf).select("conjunto", "nivel_educativo", *LABOUR_SURVEY.profiled))
    answers = descriptive_statistics(prepared, by=["conjunto"])
    seen = rank_check(prepared, answers, LABOUR_SURVEY.profiled, ["conjunto"], _DEFAULT_ERROR)
    medians = median_by_group(prepared, "nivel_educativo").withColumn("variable", F.lit(LABOUR_SURVEY.target))
    medians = medians.withColumnRenamed("mediana_salario", "mediana")
    some = {"mediana": CUTS["mediana"]}
    more = rank_check(prepared, medians, [LABOUR_SURVEY.target], ["nivel_educativo"], _DEFAULT_ERROR, some)
    return seen.withColumnRenamed("conjunto", "grupo").unionByName(more.withColumnRenamed("nivel_educativo", "grupo"))


def segment_laws(spark: SparkSession, sf: str) -> DataFrame:
    """Silhouettes of all k, and the profile and composition of the best segments."""
    columns = [*LABOUR_SURVEY.numeric, LABOUR_SURVEY.target, *LABOUR_SURVEY.categorical]
    with kept(survey_prepared(spark, sf).select(*columns)) as (rows,):
        features, _ = prepare_kmeans_features(rows)
        scores, models = kmeans_sweep(features)
        scored = silhouettes(features, models)
        inside = F.col("silhouette").between(-1.0, 1.0) & (F.col("segmentos") == F.col("k"))
        laws = [scored.select(F.concat(F.lit("silueta "), F.col("k")).alias("ley"), "n", inside.alias("cumple"))]
        segmented = models[best_k(scores)].transform(features)
        profile = segment_profile(segmented)
        whole = F.abs(F.sum("porcentaje") - 100.0) < 1e-6
        means = [F.sum(F.col("n") * F.col(f"{c}_media")) / F.sum("n") for c in ("edad", "salario")]
        overall = segmented.agg(F.avg("edad").alias("edad"), F.avg("salario_mensual").alias("salario")).first()
        same = whole
        for mean, name in zip(means, ("edad", "salario")):
            same = same & (F.abs(mean - F.lit(overall[name])) < 1e-6 * (1.0 + abs(overall[name])))
        laws.append(profile.agg(F.lit("perfil").alias("ley"), F.sum("n").alias("n"), same.alias("cumple")))
        parts = segment_composition(segmented, LABOUR_SURVEY.categorical)
        sums = parts.groupBy("variable", "cluster").agg(
            F.sum("n").alias("n"), (F.sum("n") == F.max("n_cluster")).alias("a"), (F.abs(F.sum("porcentaje_cluster") - 100.0) < 1e-6).alias("b")
        )
        composed = F.bool_and(F.col("a") & F.col("b")).alias("cumple")
        laws.append(sums.groupBy(F.concat(F.lit("composicion "), F.col("variable")).alias("ley")).agg(F.sum("n").alias("n"), composed))
        stacked = laws[0]
        for law in laws[1:]:
            stacked = stacked.unionByName(law)
        return settle(stacked)


def fitted_model_laws(spark: SparkSession, sf: str) -> DataFrame:
    """The winners of both sweeps on later rows: one written prediction table, its error
    cube, residual points, importances, and the predictions of saved and loaded copies."""
    train, validation = _train_and_validation(spark, sf)
    winners, laws = {}, []
    for name, configs in (("Linear Regression", LR_CONFIGS), ("Random Forest", RF_CONFIGS)):
        metrics, models = sweep(train, validation, configs, CHARGES)
        metrics = settle(metrics)
        good = F.bool_and((F.col("MAE") > 0) & (F.col("MAE") <= F.col("RMSE")) & (F.col("R2") <= 1) & (F.col("R2") > 0.5))
        laws.append(metrics.agg(F.lit("barrido").alias("ley"), F.lit(name).alias("modelo"), F.count("*").alias("n"), good.alias("cumple")))
        config = best_config(metrics, configs)
        winners[name] = models[config["modelo"]], config
    rows = charges(spark, sf)
    with kept(rows.where("era = 'train'")) as (fitted,):
        final = {name: pipeline_for(config, CHARGES).fit(fitted) for name, (_, config) in winners.items()}
    test = rows.where("era = 'test'")
    keep = [*CHARGES.keys, *CHARGES.categorical, "charge"]
    predictions = settle(score_models(test, final, keep))
    cuts = quantile_cuts(test, "charge", exact=True)
    cube = error_cube(
        predictions,
        {"l_returnflag": "l_returnflag", "l_linestatus": "l_linestatus", "banda": value_band(F.col("charge"), cuts)},
        label_col="charge",
    )
    laws.append(cube_laws(settle(cube)).select(F.concat(F.lit("cubo "), F.col("dimension")).alias("ley"), "modelo", "n", "cumple"))

    folder = f"{work_folder(spark)}/models"
    for name, model in final.items():
        save_model(model, f"{folder}/{name.replace(' ', '_')}")
    copies = {name: load_model(f"{folder}/{name.replace(' ', '_')}") for name in final}
    again = score_models(test, {f"{n}": m for n, m in copies.items()}, keep)
    both = predictions.withColumn("__side", F.lit(1)).unionByName(again.withColumn("__side", F.lit(-1)))
    unlike = both.groupBy("modelo", *CHARGES.keys, "charge", "prediction").agg(F.sum("__side").alias("s"))
    laws.append(unlike.groupBy("modelo").agg(
        F.lit("modelo recargado").alias("ley"), F.count_if(F.col("s") != 0).alias("n"), F.bool_and(F.col("s") == 0).alias("cumple")))

    sample = deterministic_sample(test, max_rows=500, key_columns=CHARGES.keys)
    points = with_residual(score_models(sample, final, [*CHARGES.keys, "charge"]), "charge")
    exact = F.bool_and(F.col("residuo") == F.col("charge") - F.col("prediction"))
    laws.append(points.groupBy("modelo").agg(F.lit("puntos").alias("ley"), F.count("*").alias("n"), exact.alias("cumple")))

    forest = winners["Random Forest"][0]
    shares = feature_importance_table(forest.stages[-1], forest.transform(validation))
    adds_up = (F.abs(F.sum("importancia") - 1.0) < 1e-9) & (F.min("importancia") >= 0)
    laws.append(shares.agg(F.lit("importancias").alias("ley"), F.lit("Random Forest").alias("modelo"), F.count("*").alias("n"), adds_up.alias("cumple")))
    stacked = laws[0].select("ley", "modelo", "n", "cumple")
    for law in laws[1:]:
        stacked = stacked.unionByName(law.select("ley", "modelo", "n", "cumple"))
    return settle(stacked)


def random_rows(spark: SparkSession, sf: str) -> DataFrame:
    """500 random line items, repeated keys included, for any partitioning."""
    lines = table(spark, sf, "lineitem")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    return random_rows_of_files(lines, 500).withColumn("l_shipdate", day)


def law_queries() -> dict[str, Query]:
    found = (merged_descriptives, merged_quantiles, default_sketch_ranks, segment_laws, fitted_model_laws, random_rows)
    return {f.__name__: f for f in found}


def law_oracles() -> dict[str, str]:
    names = LABOUR_SURVEY.profiled

    def moments(n: str) -> str:
        r = lambda x: f"(round({x}, 4) + 0.0)"
        return f"""SELECT conjunto, '{n}' AS variable, count({n}) AS n, {r(f'avg({n})')} AS media,
            {r(f'stddev_samp({n})')} AS stddev, {r(f'min({n})')} AS "min", {r(f'max({n})')} AS "max" FROM kept GROUP BY 1"""

    def ranks(group: str, variables=names, cuts=tuple(CUTS)) -> str:
        return " UNION ALL ".join(
            f"SELECT {group} AS grupo, '{n}' AS variable, '{c}' AS corte, count({n}) AS n, true AS dentro FROM kept GROUP BY 1"
            for n in variables for c in cuts
        )

    laws = [f"SELECT 'silueta {k}' AS ley" for k in (2, 3, 4, 5)] + ["SELECT 'perfil'"]
    laws += [f"SELECT 'composicion {c}'" for c in LABOUR_SURVEY.categorical]
    cubes = " UNION ALL ".join(f"SELECT 'cubo {d}' AS ley, n FROM t" for d in ("l_returnflag", "l_linestatus", "banda"))
    return {
        "merged_descriptives": f"WITH {_KEPT} " + " UNION ALL ".join(map(moments, names)),
        "merged_quantiles": f"WITH {_KEPT} {ranks('periodo_archivo')} UNION ALL {ranks('conjunto')}",
        "default_sketch_ranks": f"""WITH {_KEPT} {ranks('conjunto')} UNION ALL
            {ranks('nivel_educativo', (LABOUR_SURVEY.target,), ('mediana',))}""",
        "segment_laws": f"""WITH {_KEPT}, l AS ({' UNION ALL '.join(laws)})
            SELECT ley, (SELECT count(*) FROM kept) AS n, true AS cumple FROM l""",
        "fitted_model_laws": f"""WITH t AS (SELECT count(*) AS n FROM lineitem WHERE year(l_shipdate) >= 2000),
            w AS (SELECT count(DISTINCT l_returnflag) + count(DISTINCT l_linestatus) + 6 AS n FROM lineitem WHERE year(l_shipdate) < 2000),
            m AS (SELECT unnest(['Linear Regression', 'Random Forest']) AS modelo),
            l AS (SELECT 'barrido' AS ley, CAST(3 AS BIGINT) AS n UNION ALL {cubes}
              UNION ALL SELECT 'modelo recargado', 0 UNION ALL SELECT 'puntos', least(500, n) FROM t)
            SELECT ley, modelo, n, true AS cumple FROM l, m
            UNION ALL SELECT 'importancias', 'Random Forest', n, true FROM w""",
        "random_rows": """WITH o AS (SELECT *, row_number() OVER () - 1 AS r FROM lineitem)
            SELECT * EXCLUDE (r, l_shipdate), strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM o
            ORDER BY sha256('42¦lineitem.parquet¦' || CAST(r AS VARCHAR)) LIMIT 500""",
    }
