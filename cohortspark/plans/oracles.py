"""The registered queries in plain SQL, written from their meaning.

Where a query parses text, its SQL says which value the text stands for instead
of parsing it again.
"""

from __future__ import annotations

from ..presets import LABOUR_SURVEY, OCCUPATION_LABELS, STEP_LABELS
from .queries import (
    EXTRACT_PATHS,
    HEADER_FILE,
    HEADER_NAME,
    REQUIRED_HEADERS,
)
from .views import DATASET_TEXT, FILE_TEXT, PERIOD_TEXT, PERSON_TEXT, QUARTER, YEAR


def _sql(text: str) -> str:
    return text.format(S="VARCHAR")


def _r(value: str, digits: int = 4) -> str:
    return f"(round({value}, {digits}) + 0.0)"


# What the survey texts stand for. ``salario`` keeps NaN and infinity.
_PERSON = f"""
person AS (SELECT
  CASE WHEN l_orderkey % 17 = 0 OR l_orderkey % 19 = 0 THEN NULL
       WHEN l_orderkey % 23 = 0 THEN 'nan'::DOUBLE
       WHEN l_orderkey % 29 = 0 THEN NULL
       WHEN l_orderkey % 31 = 0 THEN 'inf'::DOUBLE
       WHEN l_orderkey % 37 = 0 THEN -5.0
       ELSE l_extendedprice END AS salario_mensual,
  CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE CAST(l_quantity + 10 AS DOUBLE) END AS edad,
  CASE WHEN l_suppkey % 47 = 0 THEN 'inf'::DOUBLE
       ELSE CAST(l_suppkey % 40 AS DOUBLE) END AS antiguedad_anios,
  CASE WHEN l_partkey % 43 = 0 THEN 11.5 WHEN l_partkey % 47 = 0 THEN 12.0
       ELSE CAST(l_partkey % 12 AS DOUBLE) END AS antiguedad_meses,
  CASE WHEN l_partkey % 53 = 0 THEN 0.0 ELSE CAST(l_quantity * 3 + l_linenumber * 6 AS DOUBLE) END AS horas_semanales,
  CASE WHEN l_orderkey % 53 = 0 THEN 'DESCONOCIDO'
       ELSE CAST(l_partkey % 8 AS VARCHAR) END AS nivel_educativo,
  CASE WHEN l_linenumber <= 4 THEN CAST(l_linenumber AS VARCHAR)
       WHEN l_linenumber = 5 THEN '1' ELSE 'DESCONOCIDO' END AS categoria_ocupacional,
  CASE WHEN l_suppkey % 59 = 0 THEN 'DESCONOCIDO'
       ELSE CAST(1 + l_suppkey % 3 AS VARCHAR) END AS dominio,
  CASE WHEN l_suppkey % 61 = 0 THEN NULL WHEN l_returnflag = 'R' THEN '2' ELSE '1' END AS ocupado,
  CAST(l_orderkey AS VARCHAR) AS "NUM_HOGAR",
  CAST(l_linenumber AS VARCHAR) AS "NUM_PERSONA",
  CAST(l_quantity AS DOUBLE) AS "FACTOR",
  CAST({YEAR} AS VARCHAR) AS "ANIO",
  CAST({QUARTER} AS VARCHAR) AS "TRIMESTRE",
  {_sql(FILE_TEXT)} AS archivo_origen,
  {_sql(PERIOD_TEXT)} AS periodo_archivo,
  CAST({YEAR} AS INTEGER) AS anio_archivo,
  CAST({QUARTER} AS INTEGER) AS trimestre_calendario,
  {DATASET_TEXT} AS conjunto
  FROM lineitem),
survey AS (SELECT *, antiguedad_anios + antiguedad_meses / 12.0 AS antiguedad FROM person)"""

_STEPS = {
    1: "isfinite(edad)",
    2: "edad >= 15",
    3: "ocupado = '1'",
    4: "categoria_ocupacional IN ('1', '2', '3', '4')",
    5: "salario_mensual IS NOT NULL",
    6: "isfinite(salario_mensual) AND salario_mensual > 0",
    7: "isfinite(antiguedad_anios)",
    8: "isfinite(antiguedad_meses) AND antiguedad_meses = floor(antiguedad_meses)"
    " AND antiguedad_meses BETWEEN 0 AND 11",
    9: "isfinite(antiguedad) AND antiguedad >= 0",
    10: "antiguedad <= edad",
    11: "isfinite(horas_semanales) AND horas_semanales > 0",
    12: "horas_semanales <= 168",
}
_ALL_STEPS = " AND ".join(f"({c})" for c in _STEPS.values())
_KEPT = f"{_PERSON}, kept AS (SELECT * FROM survey WHERE {_ALL_STEPS})"

_NUMBERS = ("salario_mensual", "edad", "antiguedad", "horas_semanales")


def _stack(tables: list[str]) -> str:
    return "\nUNION ALL ".join(tables)


def _filter_audit() -> str:
    """Every step counts the rows that pass all steps up to it."""
    tables = []
    for step, label in STEP_LABELS.items():
        before = " AND ".join(f"coalesce({_STEPS[i]}, false)" for i in range(1, step)) or "true"
        after = f"{before} AND coalesce({_STEPS[step]}, false)" if step else "true"
        tables.append(
            f"""SELECT conjunto, {step} AS paso, '{label}' AS descripcion,
            count(*) FILTER (WHERE {before}) AS registros_antes,
            count(*) FILTER (WHERE {after}) AS registros_despues FROM survey GROUP BY conjunto"""
        )
    return f"""WITH {_PERSON}, steps AS ({_stack(tables)})
    SELECT conjunto, CAST(paso AS INTEGER) AS paso, descripcion, registros_antes,
      registros_antes - registros_despues AS registros_excluidos, registros_despues,
      CASE WHEN registros_antes > 0
        THEN 100.0::DOUBLE * (registros_antes - registros_despues) / registros_antes END
        AS porcentaje_excluido FROM steps"""


def _missing(source: str, conditions: dict[str, str]) -> str:
    tables = [
        f"""SELECT conjunto, '{name}' AS variable, count(*) AS registros_totales,
        count(*) FILTER (WHERE {condition}) AS faltantes FROM src GROUP BY conjunto"""
        for name, condition in conditions.items()
    ]
    return f"""WITH {source}, m AS ({_stack(tables)})
    SELECT *, 100.0::DOUBLE * faltantes / registros_totales AS porcentaje_faltante FROM m"""


def _missing_typed() -> str:
    conditions = {n: f'"{n}" IS NULL' for n in LABOUR_SURVEY.audited}
    conditions["salario_mensual"] = "salario_mensual IS NULL OR isnan(salario_mensual)"
    return _missing(f"{_PERSON}, src AS (SELECT * FROM survey)", conditions)


def _missing_staged() -> str:
    columns = ", ".join(f'{_sql(text)} AS "{n}"' for n, text in PERSON_TEXT.items())
    conditions = {
        n: f""""{n}" IS NULL OR trim("{n}") = '' OR lower(trim("{n}")) = 'nan'""" for n in PERSON_TEXT
    }
    source = f"src AS (SELECT {columns}, {DATASET_TEXT} AS conjunto FROM lineitem)"
    return _missing(source, conditions)


def _described(source: str, by: str) -> str:
    tables = [
        f"""SELECT {by}, '{n}' AS variable, count({n}) AS n, {_r(f'avg({n})')} AS media,
        {_r(f'quantile_disc({n}, 0.5)')} AS mediana, {_r(f'stddev_samp({n})')} AS stddev,
        {_r(f'min({n})')} AS "min", {_r(f'quantile_disc({n}, 0.25)')} AS p25,
        {_r(f'quantile_disc({n}, 0.75)')} AS p75, {_r(f'quantile_disc({n}, 0.95)')} AS p95,
        {_r(f'max({n})')} AS "max" FROM {source} GROUP BY {by}"""
        for n in _NUMBERS
    ]
    return _stack(tables)


_LABEL = (
    "CASE categoria_ocupacional "
    + " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in OCCUPATION_LABELS.items())
    + " ELSE 'DESCONOCIDO' END"
)
_DISTRIBUTED = {
    "categoria_ocupacional_etiqueta": _LABEL,
    "nivel_educativo": "nivel_educativo",
    "dominio": "dominio",
}


def _distribution(source: str, columns: dict[str, str], by: str = "") -> str:
    lead = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    tables = [
        f"""SELECT {lead}'{name}' AS variable, {expr} AS categoria, count(*) AS n,
        100.0::DOUBLE * count(*) / CAST(sum(count(*)) OVER ({part}) AS BIGINT) AS porcentaje
        FROM {source} GROUP BY {lead}{expr}"""
        for name, expr in columns.items()
    ]
    return _stack(tables)


def _correlations() -> str:
    tables = []
    for x in _NUMBERS:
        for y in _NUMBERS:
            r = "1.0::DOUBLE" if x == y else f"corr({x}, {y})"
            tables.append(
                f"SELECT conjunto, '{x}' AS variable_x, '{y}' AS variable_y, {r} AS r "
                "FROM kept GROUP BY conjunto"
            )
    return _stack(tables)


def _histogram(bins: int, value: str, back: str, digits: int, by: str = "") -> str:
    on = "v.g = e.g" if by else "true"
    group = f"{by} AS g" if by else "0 AS g"
    out = f"e.g AS {by}, " if by else ""
    return f"""WITH v AS (SELECT {group}, {value} AS x FROM orders),
    e AS (SELECT g, min(x) AS a, max(x) AS b FROM v GROUP BY g),
    c AS (SELECT v.g, CAST(least(floor((x - a) / (b - a) * {bins}), {bins - 1}) AS INTEGER) AS bin,
      count(*) AS n FROM v JOIN e ON {on} GROUP BY 1, 2),
    s AS (SELECT e.*, CAST(i AS INTEGER) AS i FROM e CROSS JOIN range({bins}) t(i))
    SELECT {out}e.i + 1 AS bin, {_r(back.format('a + (b - a) / %d.0 * e.i' % bins), digits)} AS desde,
      {_r(back.format('a + (b - a) / %d.0 * (e.i + 1)' % bins), digits)} AS hasta,
      coalesce(c.n, 0) AS n FROM s e LEFT JOIN c ON c.g = e.g AND c.bin = e.i"""


_DIGEST = "sha256(concat_ws('¦', '42', {keys}))"
_UNIT = "(CAST('0x' || substr(" + _DIGEST + ", 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"

_CHARGES = f"""
rows_ AS (SELECT *, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge,
  CASE WHEN year(l_shipdate) >= 2000 THEN 'test'
       WHEN {_UNIT.format(keys='CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)')} < 0.8
       THEN 'train' ELSE 'validation' END AS dataset FROM lineitem),
med AS (SELECT quantile_disc(charge, 0.5) AS m FROM rows_ WHERE dataset = 'train'),
pred AS (SELECT r.*, 'Baseline' AS modelo, m AS prediction FROM rows_ r CROSS JOIN med
  UNION ALL SELECT r.*, 'Precio', l_extendedprice FROM rows_ r
  UNION ALL SELECT r.*, 'Descuento', l_extendedprice * (1 - l_discount) FROM rows_ r),
err AS (SELECT *, charge - prediction AS e FROM pred WHERE dataset <> 'train')"""

_METRICS = f"""{_CHARGES}, metrics AS (SELECT modelo, dataset, avg(abs(e)) AS "MAE",
  sqrt(avg(e * e)) AS "RMSE", 1.0 - sum(e * e) / (var_pop(charge) * count(*)) AS "R2"
  FROM err GROUP BY modelo, dataset)"""

_BANDS = f"""{_CHARGES}, cuts AS (SELECT quantile_disc(charge, 0.25) AS c1,
  quantile_disc(charge, 0.5) AS c2, quantile_disc(charge, 0.75) AS c3,
  quantile_disc(charge, 0.95) AS c4 FROM rows_ WHERE dataset = 'test'),
banded AS (SELECT err.*, CASE WHEN charge <= c1 THEN 'p0-p25' WHEN charge <= c2 THEN 'p25-p50'
  WHEN charge <= c3 THEN 'p50-p75' WHEN charge <= c4 THEN 'p75-p95' ELSE 'p95+' END AS banda_salario
  FROM err CROSS JOIN cuts WHERE dataset = 'test'),
bands AS (SELECT modelo, banda_salario, count(*) AS n, avg(charge) AS salario_medio,
  quantile_disc(charge, 0.5) AS salario_mediano, avg(prediction) AS prediccion_media,
  avg(abs(e)) AS "MAE", sqrt(avg(e * e)) AS "RMSE", avg(e) AS error_medio
  FROM banded GROUP BY modelo, banda_salario)"""

_CUSTOMER_ORDERS = """co AS (SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority,
  c_acctbal, c_mktsegment,
  CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 5000 THEN 1 ELSE 2 END AS "cluster"
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def _deltas() -> str:
    columns = []
    for m in ("MAE", "RMSE", "R2"):
        v = f"""max(CASE WHEN dataset = 'validation' THEN "{m}" END)"""
        t = f"""max(CASE WHEN dataset = 'test' THEN "{m}" END)"""
        columns += [
            f'{_r(v)} AS "{m}_validation"',
            f'{_r(t)} AS "{m}_test"',
            f'{_r(f"{t} - {v}")} AS "delta_{m}"',
        ]
    change = """max(CASE WHEN dataset = 'test' THEN "RMSE" END)
      - max(CASE WHEN dataset = 'validation' THEN "RMSE" END)"""
    return f"""WITH {_METRICS} SELECT modelo, {', '.join(columns)},
    CASE WHEN {change} > 0 THEN 'aumentó' WHEN {change} < 0 THEN 'disminuyó'
    ELSE 'no cambió' END AS direccion FROM metrics GROUP BY modelo"""


_PERIOD = "CAST(year(o_orderdate) + 25 AS VARCHAR) || 'T' || CAST(quarter(o_orderdate) AS VARCHAR)"
_REQUIRED = ", ".join(f"('{c}')" for c in sorted(REQUIRED_HEADERS))


def _standard_columns() -> str:
    finite = lambda n: f'CASE WHEN isfinite("{n}") THEN "{n}" END AS "{n}"'
    numeric = {f.name for f in LABOUR_SURVEY.fields if f.kind == "numeric"} | {"antiguedad"}
    names = [f.name for f in LABOUR_SURVEY.fields]
    names += ["antiguedad", "archivo_origen", "periodo_archivo", "anio_archivo"]
    names += ["trimestre_calendario", "conjunto"]
    return ", ".join(finite(n) if n in numeric else f'"{n}"' for n in names)


def all_oracles() -> dict[str, str]:
    return {
        "period_from_name": f"""WITH s AS (SELECT *, CASE o_orderkey % 12 WHEN 6 THEN 'no_quarter'
            WHEN 7 THEN 'no_year' WHEN 8 THEN 'ambiguous_year' WHEN 9 THEN 'ambiguous_quarter'
            ELSE 'ok' END AS status FROM orders)
            SELECT o_orderkey, status,
            CASE WHEN status = 'ok' THEN {_PERIOD} END AS periodo_archivo,
            CASE WHEN status = 'ok' THEN CAST(year(o_orderdate) + 25 AS INTEGER) END AS anio_archivo,
            CASE WHEN status = 'ok' THEN CAST(quarter(o_orderdate) AS INTEGER) END
              AS trimestre_calendario FROM s""",
        "extract_selection": f"""SELECT o_orderkey,
            regexp_extract({_sql(EXTRACT_PATHS)}, '[^/]*$') AS archivo, 'ok' AS status,
            {_PERIOD} AS periodo_archivo, CAST(year(o_orderdate) + 25 AS INTEGER) AS anio_archivo,
            CAST(quarter(o_orderdate) AS INTEGER) AS trimestre_calendario
            FROM orders WHERE o_orderkey % 8 IN (0, 7)""",
        "period_metadata_check": """SELECT o_orderkey, CASE o_orderkey % 7
            WHEN 1 THEN 'contradicts_name' WHEN 3 THEN 'undetermined' WHEN 4 THEN 'bad_format'
            WHEN 5 THEN 'inconsistent' WHEN 6 THEN 'not_integer' ELSE 'ok' END AS estado FROM orders""",
        "extract_manifest": f"""WITH f AS (SELECT DISTINCT {_sql(PERIOD_TEXT)} AS p,
            CASE WHEN l_linestatus = 'F' AND year(l_shipdate) = 1997
              THEN 'Personas ' || {_sql(PERIOD_TEXT)} || '.csv' ELSE {_sql(FILE_TEXT)} END AS a
            FROM lineitem),
            g AS (SELECT p, count(*) AS n, min(a) AS a FROM f GROUP BY p),
            x AS (SELECT DISTINCT CAST(year(o_orderdate) + 26 AS VARCHAR) || 'T'
              || CAST(quarter(o_orderdate) AS VARCHAR) AS periodo FROM orders)
            SELECT periodo, a AS archivo, a IS NOT NULL AS encontrado, coalesce(n, 0) AS n_archivos
            FROM x LEFT JOIN g ON p = periodo""",
        "schema_audit": f"""WITH h AS (SELECT DISTINCT CAST(year(l_shipdate) AS VARCHAR) AS periodo,
            {_sql(HEADER_FILE)} AS archivo, {_sql(HEADER_NAME)} AS raw,
            'P' || CAST(l_linenumber AS VARCHAR) || ' ' || l_returnflag AS clean FROM lineitem),
            n AS (SELECT periodo, archivo, clean, count(*) AS k FROM h GROUP BY ALL),
            f AS (SELECT periodo, archivo, CAST(sum(k) AS BIGINT) AS columnas_originales,
              string_agg(clean, ', ' ORDER BY clean) FILTER (WHERE k > 1) AS repetidas
              FROM n GROUP BY ALL),
            m AS (SELECT f.archivo, string_agg(c, ', ' ORDER BY c) AS faltan
              FROM f CROSS JOIN (VALUES {_REQUIRED}) q(c)
              WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.archivo = f.archivo AND n.clean = q.c)
              GROUP BY f.archivo)
            SELECT periodo, f.archivo, columnas_originales,
              coalesce(faltan, 'ninguna') AS columnas_faltantes,
              coalesce(repetidas, 'ninguna') AS columnas_repetidas
            FROM f LEFT JOIN m ON m.archivo = f.archivo""",
        "text_staging": "SELECT "
        + ", ".join(
            [f"CAST({c} AS VARCHAR) AS {c}" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
            + [
                f"""CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR)
                ELSE CAST({c} AS VARCHAR) END AS {c}"""
                for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
            ]
            + ["l_returnflag", "l_linestatus"]
            + ["strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS l_shipdate"]
        )
        + " FROM lineitem",
        "standard_load": f"WITH {_PERSON} SELECT {_standard_columns()} FROM survey",
        "harmonised_rows": "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem",
        "sparse_rows": """SELECT o_orderstatus, count(*) AS n, NULL::VARCHAR AS o_orderpriority
            FROM orders GROUP BY o_orderstatus UNION ALL
            SELECT NULL, count(*), o_orderpriority FROM orders GROUP BY o_orderpriority""",
        "parquet_round_trip": f"""WITH {_KEPT} SELECT periodo_archivo, count(*) AS filas_elegibles
            FROM kept GROUP BY periodo_archivo""",
        "code_normalize": """WITH k AS (SELECT event_id, event_id % 10 AS s,
              CAST(event_id % 7 AS VARCHAR) AS d FROM events),
            c AS (SELECT event_id, s, CASE WHEN s <= 2 THEN d WHEN s = 3 THEN '00' || d
              WHEN s = 4 THEN '+' || d WHEN s = 5 THEN d || 'e2' WHEN s = 6 THEN '-0'
              WHEN s = 7 THEN d || '.5' WHEN s = 8 THEN 'nan' END AS codigo,
              CASE WHEN s <= 4 THEN d WHEN s = 5 AND d = '0' THEN '0' WHEN s = 5 THEN d || '00'
              WHEN s = 6 THEN '0' WHEN s = 7 THEN d || '.5' END AS canonico FROM k)
            SELECT event_id, codigo, canonico,
              CASE WHEN codigo IN ('1', '2', '3', '4') THEN codigo ELSE 'DESCONOCIDO' END AS cerrado
            FROM c""",
        "numeric_coerce": """SELECT o_orderkey, CASE o_orderkey % 12
              WHEN 6 THEN CAST(o_orderkey AS DOUBLE) WHEN 7 THEN -(o_orderkey % 10) / 10.0::DOUBLE
              WHEN 8 THEN o_orderkey * 100.0::DOUBLE WHEN 11 THEN o_orderkey + 0.5::DOUBLE END AS valor,
            CASE WHEN o_orderkey % 12 IN (0, 1, 3, 9, 10) THEN 'nulo'
              WHEN o_orderkey % 12 = 2 THEN 'nan' WHEN o_orderkey % 12 IN (4, 5) THEN 'infinito'
              ELSE 'finito' END AS estado,
            o_orderkey % 12 <= 2 AS faltante FROM orders""",
        "label_lookup": """SELECT event_id, event_type, CASE event_type WHEN 'view' THEN '1 - visita'
            WHEN 'click' THEN '2 - clic' WHEN 'purchase' THEN '3 - compra'
            ELSE 'DESCONOCIDO' END AS etiqueta FROM events""",
        "dictionary_lookup": """SELECT c_custkey, c_nationkey, coalesce(n_name, 'DESCONOCIDO') AS pais
            FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 0""",
        "text_fold": """SELECT doc_id, upper(replace(strip_accents(text), 'ß', 'ss')) AS plegado,
            regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g') AS compacto
            FROM documents""",
        "filter_audit": _filter_audit(),
        "eligible_rows": f"""WITH {_KEPT} SELECT periodo_archivo, "NUM_HOGAR", "NUM_PERSONA",
            salario_mensual, edad, antiguedad, horas_semanales, nivel_educativo,
            categoria_ocupacional, dominio, conjunto FROM kept""",
        "missing_typed": _missing_typed(),
        "missing_staged": _missing_staged(),
        "duplicate_key_audit": f"""WITH {_PERSON}, d AS (SELECT conjunto, periodo_archivo, "NUM_HOGAR",
              "NUM_PERSONA", count(*) AS n, count(DISTINCT to_json(survey)) AS v
              FROM survey GROUP BY ALL HAVING count(*) > 1)
            SELECT conjunto, CASE WHEN v = 1 THEN 'exacto' ELSE 'conflictivo' END AS tipo,
              count(*) AS claves_duplicadas, CAST(sum(n) AS BIGINT) AS registros_en_claves_duplicadas
            FROM d GROUP BY ALL""",
        "duplicate_key_detail": f"""WITH {_PERSON} SELECT periodo_archivo, "NUM_HOGAR", "NUM_PERSONA",
              count(*) AS n_registros, count(DISTINCT to_json(survey)) AS versiones_distintas,
              CASE WHEN count(DISTINCT to_json(survey)) = 1 THEN 'exacto' ELSE 'conflictivo' END AS tipo
            FROM survey GROUP BY periodo_archivo, "NUM_HOGAR", "NUM_PERSONA" HAVING count(*) > 1""",
        "duplicate_copies": """SELECT CASE o_orderstatus WHEN 'F' THEN 'exacto' ELSE 'conflictivo' END
              AS tipo, count(*) AS claves_duplicadas, 2 * count(*) AS registros_en_claves_duplicadas
            FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY 1""",
        "raw_period_counts": f"""SELECT {_sql(FILE_TEXT)} AS archivo_origen,
            {_sql(PERIOD_TEXT)} AS periodo_archivo, count(*) AS filas_originales
            FROM lineitem GROUP BY ALL""",
        "eligible_period_counts": f"""WITH {_KEPT} SELECT periodo_archivo,
            count(*) AS filas_elegibles FROM kept GROUP BY periodo_archivo""",
        "row_set_differences": """WITH o AS (SELECT o_orderkey AS clave, count(*) AS n FROM orders GROUP BY 1),
            l AS (SELECT l_orderkey AS clave, count(*) AS n FROM lineitem GROUP BY 1)
            SELECT coalesce(o.clave, l.clave) AS clave, coalesce(o.n, 0) AS n_izquierda,
            coalesce(l.n, 0) AS n_derecha FROM o FULL JOIN l ON o.clave = l.clave
            WHERE coalesce(o.n, 0) <> coalesce(l.n, 0)""",
        "descriptive_stats": f"WITH {_KEPT} {_described('kept', 'conjunto')}",
        "median_by_groups": f"""WITH {_CUSTOMER_ORDERS} SELECT c_mktsegment, o_orderpriority,
            count(*) AS n, quantile_disc(o_totalprice, 0.5) AS mediana_o_totalprice
            FROM co GROUP BY ALL""",
        "highest_median_group": f"""WITH {_KEPT} SELECT nivel_educativo,
            quantile_disc(salario_mensual, 0.5) AS mediana_salario, count(*) AS n
            FROM kept GROUP BY nivel_educativo ORDER BY 2 DESC, 1 LIMIT 1""",
        "period_median": f"""WITH {_KEPT} SELECT periodo_archivo, trimestre_calendario, count(*) AS n,
            quantile_disc(salario_mensual, 0.5) AS mediana_salario FROM kept GROUP BY ALL""",
        "period_first_to_last": f"""WITH {_KEPT}, s AS (SELECT periodo_archivo AS p,
              quantile_disc(salario_mensual, 0.5) AS m FROM kept GROUP BY 1)
            SELECT min(p) AS periodo_inicial, max(p) AS periodo_final,
              {_r('min_by(m, p)')} AS valor_inicial, {_r('max_by(m, p)')} AS valor_final,
              {_r('max_by(m, p) - min_by(m, p)')} AS cambio FROM s""",
        "categorical_distributions": f"WITH {_KEPT} {_distribution('kept', _DISTRIBUTED, 'conjunto')}",
        "categorical_distributions_sparse": f"""WITH {_KEPT}, d AS ({_distribution('kept', _DISTRIBUTED)})
            SELECT n, porcentaje, variable, {', '.join(
                f"CASE WHEN variable = '{c}' THEN categoria END AS {c}" for c in _DISTRIBUTED)} FROM d""",
        "document_distribution": """SELECT source, count(*) AS n, 100.0::DOUBLE * count(*)
            / CAST(sum(count(*)) OVER () AS BIGINT) AS porcentaje FROM documents GROUP BY source""",
        "leading_categories": f"""WITH d AS ({_distribution('documents', {'lang': 'lang', 'source': 'source'})})
            SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY variable ORDER BY n DESC, categoria) = 1""",
        "order_value_cuts": """SELECT o_orderstatus, count(*) AS n,
            quantile_disc(o_totalprice, 0.25) AS p25, quantile_disc(o_totalprice, 0.5) AS p50,
            quantile_disc(o_totalprice, 0.75) AS p75, quantile_disc(o_totalprice, 0.95) AS p95
            FROM orders GROUP BY o_orderstatus""",
        "value_histogram": _histogram(45, "o_totalprice", "{}", 4),
        "value_histogram_log": _histogram(20, "ln(o_totalprice)", "exp({})", 2),
        "value_histogram_by_group": _histogram(45, "o_totalprice", "{}", 4, "o_orderstatus"),
        "correlations": f"""WITH {_KEPT}, c AS ({_correlations()})
            SELECT conjunto, variable_x, variable_y, {_r('r')} AS r FROM c""",
        "correlation_square": f"WITH {_KEPT} "
        + _stack(
            [
                f"SELECT '{x}' AS variable, "
                + ", ".join(
                    f"{'1.0::DOUBLE' if x == y else _r(f'corr({x}, {y})')} AS {y}" for y in _NUMBERS
                )
                + " FROM kept"
                for x in _NUMBERS
            ]
        ),
        "strongest_association": f"""WITH {_KEPT}, c AS ({_correlations()})
            SELECT conjunto, variable_y AS variable, {_r('r')} AS r FROM c
            WHERE variable_x = 'salario_mensual' AND variable_y <> 'salario_mensual'
            QUALIFY row_number() OVER (PARTITION BY conjunto ORDER BY abs(r) DESC, variable_y) = 1""",
        "segment_profiles": f"""WITH {_CUSTOMER_ORDERS} SELECT "cluster", count(*) AS n,
            {_r('avg(o_totalprice)')} AS total_media,
            {_r('quantile_disc(o_totalprice, 0.5)')} AS total_mediana,
            {_r('avg(c_acctbal)')} AS saldo_media, {_r('quantile_disc(c_acctbal, 0.5)')} AS saldo_mediana,
            {_r('100.0::DOUBLE * count(*) / CAST(sum(count(*)) OVER () AS BIGINT)')} AS porcentaje
            FROM co GROUP BY "cluster" """,
        "segment_compositions": f"WITH {_CUSTOMER_ORDERS}, d AS ("
        + _stack(
            [
                f"""SELECT "cluster", '{c}' AS variable, {c} AS categoria, count(*) AS n,
                CAST(sum(count(*)) OVER (PARTITION BY "cluster") AS BIGINT) AS n_cluster
                FROM co GROUP BY "cluster", {c}"""
                for c in ("c_mktsegment", "o_orderpriority", "o_orderstatus")
            ]
        )
        + ") SELECT *, 100.0::DOUBLE * n / n_cluster AS porcentaje_cluster FROM d",
        "largest_segment": f"""WITH {_CUSTOMER_ORDERS} SELECT "cluster", count(*) AS n FROM co
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
        "scaled_features": "SELECT l_orderkey, l_linenumber, "
        + ", ".join(
            f"{_r(c)} AS {c}, {_r(f'({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()')} AS {c}_z"
            for c in ("l_quantity", "l_extendedprice", "l_discount")
        )
        + " FROM lineitem",
        "split_by_hash": f"""SELECT o_orderkey,
            CASE WHEN {_UNIT.format(keys='CAST(o_orderkey AS VARCHAR)')} < 0.8 THEN 'train'
            ELSE 'validation' END AS parte FROM orders""",
        "sample_by_hash": f"""SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders
            ORDER BY {_DIGEST.format(keys='CAST(o_orderkey AS VARCHAR)')} LIMIT 500""",
        "model_comparison": f"""WITH {_METRICS} SELECT modelo, dataset, {_r('"MAE"')} AS "MAE",
            {_r('"RMSE"')} AS "RMSE", {_r('"R2"')} AS "R2" FROM metrics""",
        "model_winner": f"""WITH {_METRICS} SELECT dataset,
            first(modelo ORDER BY "RMSE", modelo) AS "mejor_RMSE",
            first(modelo ORDER BY "MAE", modelo) AS "mejor_MAE" FROM metrics GROUP BY dataset""",
        "validation_vs_test": _deltas(),
        "metrics_are_finite": f"""WITH {_METRICS} SELECT count(*) AS filas,
            bool_and(isfinite("MAE") AND isfinite("RMSE") AND isfinite("R2")) AS finitas FROM metrics""",
        "grouped_errors": f"""WITH {_CHARGES} SELECT modelo, l_returnflag, count(*) AS n,
            {_r('avg(abs(e))')} AS "MAE", {_r('avg(e)')} AS error_medio
            FROM err WHERE dataset = 'test' GROUP BY ALL""",
        "brand_errors": f"""WITH {_CHARGES} SELECT modelo, coalesce(trim(p_brand), 'DESCONOCIDO') AS p_brand,
            count(*) AS n, {_r('avg(abs(e))')} AS "MAE", {_r('avg(e)')} AS error_medio
            FROM err LEFT JOIN part ON p_partkey = l_partkey AND p_size > 10
            WHERE dataset = 'test' GROUP BY ALL""",
        "worst_segments": f"""WITH {_CHARGES}, g AS (SELECT modelo, l_returnflag, count(*) AS n,
            avg(abs(e)) AS mae FROM err WHERE dataset = 'test' GROUP BY ALL)
            SELECT modelo, l_returnflag, n, {_r('mae')} AS "MAE" FROM g
            QUALIFY row_number() OVER (PARTITION BY modelo ORDER BY mae DESC, l_returnflag) = 1""",
        "band_errors": f"""WITH {_BANDS} SELECT modelo, banda_salario, n,
            {', '.join(f'{_r(c)} AS {c}' for c in (
                'salario_medio', 'salario_mediano', 'prediccion_media', '"MAE"', '"RMSE"', 'error_medio'))},
            {_r('"MAE"')} AS error_medio_absoluto FROM bands""",
        "top_band_vs_lower": f"""WITH {_BANDS}, t AS (SELECT modelo,
            max(n) FILTER (WHERE banda_salario = 'p95+') AS n,
            max("MAE") FILTER (WHERE banda_salario = 'p95+') AS hi,
            avg("MAE") FILTER (WHERE banda_salario <> 'p95+') AS lo,
            max(error_medio) FILTER (WHERE banda_salario = 'p95+') AS e FROM bands GROUP BY modelo)
            SELECT modelo, n AS n_p95_mas, {_r('hi')} AS "MAE_p95_mas",
            {_r('lo')} AS "MAE_promedio_bandas_inferiores",
            {_r('hi - lo')} AS "delta_MAE_p95_mas_menos_inferiores", {_r('e')} AS error_medio_p95_mas,
            CASE WHEN e > 0 THEN 'subestimación' ELSE 'sobreestimación' END AS direccion_error_p95_mas
            FROM t""",
        "residual_points": f"""WITH p AS (SELECT o_orderkey, o_totalprice FROM orders
            ORDER BY {_DIGEST.format(keys='CAST(o_orderkey AS VARCHAR)')} LIMIT 1000)
            SELECT *, 'Cien mil' AS modelo, 100000.0::DOUBLE AS prediction,
              o_totalprice - 100000.0::DOUBLE AS residuo FROM p
            UNION ALL SELECT *, 'Mitad', o_totalprice / 2, o_totalprice - o_totalprice / 2 FROM p""",
        "ols_slopes": f"""WITH {_CHARGES}, s AS (SELECT covar_pop(l_extendedprice, charge) AS c1,
            covar_pop(l_discount, charge) AS c2, covar_pop(l_extendedprice, l_discount) AS c12,
            var_pop(l_extendedprice) AS v1, var_pop(l_discount) AS v2,
            avg(charge) AS my, avg(l_extendedprice) AS m1, avg(l_discount) AS m2 FROM rows_),
            b AS (SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1,
            (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2 FROM s)
            SELECT 'l_extendedprice' AS termino, {_r('b1', 3)} AS valor FROM b
            UNION ALL SELECT 'l_discount', {_r('b2', 3)} FROM b
            UNION ALL SELECT 'intercept', {_r('my - b1 * m1 - b2 * m2', 3)} FROM b""",
    }
