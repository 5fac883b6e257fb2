"""Registered questions: the Spark form next to its check query."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from epiframe.contracts import BOUNDED_TABLES, DEATH_LABELS, FEATURES, LOAD_ORDER, SILVER, TRIMESTERS
from epiframe.functions.age import age_band, age_years, age_years_double, band_rank, register_age_function
from epiframe.functions.clean import nullify, to_int
from epiframe.operators import audit, cluster, dedup, ingest, quality, solvers, timeseries, trend
from epiframe.operators.ids import dense_id
from epiframe.plans import changes, dashboard, views
from epiframe.plans.silver import Silver
from epiframe.session import cut_lineage, shared_dir
from epiframe.sources.store import Store
from epiframe.sources.tables import held_back, load_silver
from epiframe.streaming import ingest as streaming
from workload import model
from workload.model import STUDY, table
from workload.oracle import with_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_DEATHS = ", ".join(f"'{label}'" for label in DEATH_LABELS)
_TRIMESTERS = ", ".join(f"'{label}'" for label in TRIMESTERS)
YEARS = (1996, 2000)
UFS = ["BA", "MG", "PE", "RJ", "SP"]
_UFS_SQL = "('BA', 'MG', 'PE', 'RJ', 'SP')"


def query(name: str, sql: str | None = None, **params: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_tables(sql, **params)
        return fn

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison; the sum order differs between engines."""
    return df.select(*[F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


def _r(*columns: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


# --- silver ------------------------------------------------------------------------------
def _silver_table(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return model.silver(spark, sf).table(name)

    return run


for _key, _name in {
    "silver_ufs": "ufs",
    "silver_municipios": "municipios",
    "silver_paises": "paises",
    "silver_regionais": "regionais_saude",
    "silver_unidades": "unidades_notificadoras",
    "silver_pacientes": "pacientes",
    "silver_notificacoes": "notificacoes_casos",
    "silver_obitos": "obitos",
    "silver_encerrados": "casos_encerrados",
}.items():
    query(_key, f"SELECT * FROM {_name}")(_silver_table(_name))


@query("dense_id", "SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderkey) AS id FROM orders")
def _(spark, sf):
    return dense_id(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", "id")


@query(
    "text_to_number_and_date",
    """SELECT row_id, TRY_CAST(nullif(nullif(trim(codigo_regional), ''), '/N') AS SMALLINT) AS regional,
              TRY_CAST(nullif(nullif(trim(idade_codificada), ''), '/N') AS INTEGER) AS idade,
              TRY_CAST(data_notificacao AS DATE) AS notificado, TRY_CAST(data_primeiros_sintomas AS DATE) AS sintomas,
              TRY_CAST(right(nullif(nullif(trim(semana_notificacao), ''), '/N'), 2) AS SMALLINT) AS semana
       FROM bronze""",
)
def _(spark, sf):
    from epiframe.functions.clean import to_date, week_of

    c = F.col
    return model.bronze(spark, sf).select(
        "row_id",
        to_int(nullify(c("codigo_regional")), "smallint").alias("regional"),
        to_int(nullify(c("idade_codificada")), "int").alias("idade"),
        to_date(c("data_notificacao")).alias("notificado"),
        to_date(c("data_primeiros_sintomas")).alias("sintomas"),
        week_of(c("semana_notificacao")).alias("semana"),
    )


# --- ages --------------------------------------------------------------------------------
@query("age_decode", "SELECT paciente_id, idade FROM idades")
def _(spark, sf):
    people = model.silver(spark, sf).pacientes("paciente_id", "idade_codificada")
    return people.select("paciente_id", age_years(F.col("idade_codificada")).cast("double").alias("idade"))


@query("age_decode_sql", "SELECT paciente_id, idade FROM idades")
def _(spark, sf):
    register_age_function(spark)
    people = model.silver(spark, sf).pacientes("paciente_id", "idade_codificada")
    return people.selectExpr("paciente_id", "CAST(idade_anos(idade_codificada) AS DOUBLE) AS idade")


@query("age_decode_double", "SELECT paciente_id, idade_anos FROM idades")
def _(spark, sf):
    people = model.silver(spark, sf).pacientes("paciente_id", "idade_codificada")
    return people.select("paciente_id", age_years_double(F.col("idade_codificada")).alias("idade_anos"))


_BANDS = "['0-4', '5-9', '10-14', '15-19', '20-29', '30-39', '40-49', '50-59', '60-69', '70-79', '80+']"


def _band_sql(age: str) -> str:
    """Band by position: bands of 5 years up to 20, of 10 years up to 80, then the rest."""
    return (
        f"{_BANDS}[CAST(CASE WHEN {age} < 20 THEN floor({age} / 5) + 1 "
        f"WHEN {age} < 80 THEN floor({age} / 10) + 3 ELSE 11 END AS INTEGER)]"
    )


@query(
    "age_bands",
    f"""SELECT faixa_etaria, CAST(list_position({_BANDS}, faixa_etaria) AS INTEGER) AS ordem, count(*) AS total
        FROM (SELECT {_band_sql('idade')} AS faixa_etaria FROM idades) GROUP BY faixa_etaria""",
)
def _(spark, sf):
    people = model.silver(spark, sf).pacientes("paciente_id", "idade_codificada")
    band = age_band(age_years(F.col("idade_codificada")))
    counts = people.groupBy(band.alias("faixa_etaria")).agg(F.count("*").alias("total"))
    return counts.select("faixa_etaria", band_rank(F.col("faixa_etaria")).alias("ordem"), "total")


# --- contract checks -----------------------------------------------------------------------
def _keys() -> list[tuple[str, tuple[str, ...]]]:
    return [(n, keys) for n in LOAD_ORDER for keys in ((SILVER[n].key,), *SILVER[n].uniques)]


@query(
    "pk_violations",
    " UNION ALL ".join(
        f"SELECT '{n}' AS tabela, '{','.join(k)}' AS colunas, concat_ws(',', {', '.join(k)}) AS chave, count(*) AS n_linhas "
        f"FROM {n} GROUP BY {', '.join(k)} HAVING count(*) > 1"
        for n, k in _keys()
    ),
)
def _(spark, sf):
    breaches = quality.contract_breaches(model.silver(spark, sf).settle().tables(), LOAD_ORDER, ("unique",))
    return breaches.select("tabela", F.col("coluna").alias("colunas"), "chave", "n_linhas")


# Raw codes against the tables they should point to: this is where unknown codes show.
_RAW_KEYS = {
    "uf_residencia": ("smallint", "ufs"),
    "uf_provavel_infeccao": ("smallint", "ufs"),
    "pais_residencia": ("smallint", "paises"),
    "pais_provavel_infeccao": ("smallint", "paises"),
    "codigo_unidade": ("int", "unidades_notificadoras"),
    "municipio_residencia": ("int", "municipios"),
}


@query(
    "fk_violations",
    " UNION ALL ".join(
        f"SELECT '{c}' AS coluna, chave, count(*) AS n_linhas FROM (SELECT CAST(TRY_CAST(nullif(nullif(trim(b.{c}), ''), '/N') "
        f"AS {t}) AS BIGINT) AS chave FROM bronze b) WHERE chave IS NOT NULL AND chave NOT IN (SELECT {SILVER[p].key} FROM {p}) "
        f"GROUP BY chave"
        for c, (t, p) in _RAW_KEYS.items()
    ),
)
def _(spark, sf):
    s = model.silver(spark, sf).settle()
    codes = s.bronze.select(*[to_int(nullify(F.col(c)), t).cast("long").alias(c) for c, (t, _) in _RAW_KEYS.items()])
    cells = F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).alias("chave")) for c in _RAW_KEYS])
    asked = codes.select(F.explode(cells).alias("c")).filter("c.chave IS NOT NULL").groupBy("c.coluna", "c.chave").agg(F.count("*").alias("n_linhas"))
    known = reduce(DataFrame.unionByName, [s.table(p).select(F.lit(c).alias("coluna"), F.col(SILVER[p].key).cast("long").alias("chave")) for c, (_, p) in _RAW_KEYS.items()])
    return asked.join(known, ["coluna", "chave"], "left_anti")


_REFS = [(n, ref) for n in LOAD_ORDER for ref in SILVER[n].refs]


@query(
    "fk_declared_violations",
    " UNION ALL ".join(
        f"SELECT '{n}' AS tabela, '{r.column}' AS coluna, CAST({r.column} AS BIGINT) AS chave, count(*) AS n_linhas FROM {n} "
        f"WHERE {r.column} IS NOT NULL AND {r.column} NOT IN (SELECT {SILVER[r.parent].key} FROM {r.parent}) GROUP BY {r.column}"
        for n, r in _REFS
    )
    + " UNION ALL SELECT 'bronze', 'municipio_residencia', chave, count(*) FROM (SELECT CAST(TRY_CAST(nullif(nullif("
    "trim(b.municipio_residencia), ''), '/N') AS INT) AS BIGINT) AS chave FROM bronze b) WHERE chave IS NOT NULL "
    "AND chave NOT IN (SELECT municipio_id // 10 FROM municipios) GROUP BY chave",
)
def _(spark, sf):
    s = model.silver(spark, sf).settle()
    found = quality.contract_breaches(s.tables(), LOAD_ORDER, ("foreign key",)).select("tabela", "coluna", F.col("chave").cast("long").alias("chave"), "n_linhas")
    # The raw town code has six digits: the town's id without its check digit.
    codes = s.bronze.select(to_int(nullify(F.col("municipio_residencia")), "int").cast("long").alias("code"))
    prefixes = s.municipios.select(F.expr("municipio_id div 10").alias("prefix"))
    towns = quality.check_fk(codes, "code", prefixes, "prefix", "municipios" in BOUNDED_TABLES).select(
        F.lit("bronze").alias("tabela"), F.lit("municipio_residencia").alias("coluna"), "chave", "n_linhas")
    return found.unionByName(towns)


@query(
    "not_null_violations",
    " UNION ALL ".join(
        f"SELECT '{n}' AS tabela, '{c}' AS coluna, 'not null' AS regra, count(*) FILTER (WHERE {c} IS NULL) AS n_violacoes FROM {n}"
        for n in LOAD_ORDER
        for c in SILVER[n].required
    ),
)
def _(spark, sf):
    tables = model.silver(spark, sf).tables()
    parts = [quality.check_not_null(tables[n], n, SILVER[n].required) for n in LOAD_ORDER]
    return reduce(DataFrame.unionByName, parts)


_RAW_WIDTHS = {"data_notificacao": 9, "data_primeiros_sintomas": 10, "idade_codificada": 4, "municipio_residencia": 6}


@query(
    "length_violations",
    " UNION ALL ".join(
        f"SELECT '{n}' AS tabela, '{c}' AS coluna, 'length' AS regra, count(*) FILTER (WHERE length({c}) > {w}) AS n_violacoes FROM {n}"
        for n, widths in [*[(n, SILVER[n].widths) for n in LOAD_ORDER if SILVER[n].widths], ("bronze", _RAW_WIDTHS)]
        for c, w in widths.items()
    ),
)
def _(spark, sf):
    s = model.silver(spark, sf)
    tables = s.tables()
    parts = [quality.check_length(tables[n], n, SILVER[n].widths) for n in LOAD_ORDER if SILVER[n].widths]
    parts.append(quality.check_length(s.bronze, "bronze", _RAW_WIDTHS))
    return reduce(DataFrame.unionByName, parts)


@query(
    "closure_violations",
    """SELECT c.*, CASE WHEN n.data_notificacao IS NULL THEN 'missing case'
              WHEN c.data_encerramento < n.data_notificacao THEN 'closure before notification' END AS motivo
       FROM casos_encerrados c LEFT JOIN notificacoes_casos n ON n.notificacao_id = c.notificacao_id""",
)
def _(spark, sf):
    s = model.silver(spark, sf)
    return quality.validate_closures(s.casos_encerrados, s.notificacoes_casos("notificacao_id", "data_notificacao"))


@query(
    "death_violations",
    f"""SELECT o.*, CASE WHEN n.evolucao_caso IS NULL THEN 'missing case'
              WHEN n.evolucao_caso NOT IN ({_DEATHS}) THEN 'outcome is not a death' END AS motivo
       FROM obitos o LEFT JOIN notificacoes_casos n ON n.notificacao_id = o.notificacao_id""",
)
def _(spark, sf):
    s = model.silver(spark, sf)
    return quality.validate_deaths(s.obitos, s.notificacoes_casos("notificacao_id", "evolucao_caso"))


@query(
    "evolution_violations",
    f"""SELECT u.*, CASE WHEN u.evolucao_caso NOT IN ({_DEATHS})
              AND EXISTS (SELECT 1 FROM obitos o WHERE o.notificacao_id = u.notificacao_id) THEN 'linked death row' END AS motivo
       FROM outcome_updates u""",
)
def _(spark, sf):
    s = model.silver(spark, sf)
    return quality.validate_evolution_updates(model.outcome_updates(spark, sf), s.obitos)


# --- changes to tables ------------------------------------------------------------------------
@query(
    "mark_duplicates",
    """SELECT notificacao_id, nduplic OR rn > 1 AS nduplic, rn > 1 AND NOT nduplic AS marcado
       FROM (SELECT n.notificacao_id, n.nduplic, row_number() OVER (
               PARTITION BY p.sexo, p.municipio_id, n.data_primeiros_sintomas, n.uf_provavel_infeccao
               ORDER BY n.data_notificacao NULLS LAST, n.notificacao_id) AS rn
             FROM notificacoes_casos n JOIN pacientes p ON p.paciente_id = n.paciente_id)""",
)
def _(spark, sf):
    s = model.silver(spark, sf)
    cases = s.notificacoes_casos(
        "notificacao_id", "paciente_id", "data_notificacao", "data_primeiros_sintomas", "uf_provavel_infeccao", "nduplic"
    )
    marked = dedup.mark_duplicates(cases, s.pacientes("paciente_id", "sexo", "municipio_id"))
    return marked.select("notificacao_id", "nduplic", "marcado")


@query(
    "mark_duplicates_count",
    """SELECT count(*) FILTER (WHERE rn > 1 AND NOT nduplic) AS linhas_afetadas
       FROM (SELECT nduplic, row_number() OVER (PARTITION BY sexo, municipio_id, data_primeiros_sintomas, uf_provavel_infeccao
                                                ORDER BY data_notificacao NULLS LAST, notificacao_id) AS rn FROM base)""",
)
def _(spark, sf):
    base = model.silver(spark, sf).base(
        "notificacao_id", "data_notificacao", "data_primeiros_sintomas", "uf_provavel_infeccao", "nduplic", "sexo", "municipio_id"
    )
    return dedup.count_marked(dedup.mark_duplicates(base))


_CASE_DEFAULTS = """CAST(NULL AS DATE) AS data_investigacao, coalesce(classificacao_final, 'Inconclusivo') AS classificacao_final,
    CAST(NULL AS VARCHAR) AS criterio_confirmacao, 'Indeterminado' AS autoctonia, uf_provavel_infeccao, municipio_provavel_infeccao,
    CAST(NULL AS SMALLINT) AS pais_provavel_infeccao, 'Ignorado' AS doenca_trabalho, 'Ignorado' AS evolucao_caso, FALSE AS nduplic,
    CAST(NULL AS SMALLINT) AS fluxo_retorno, CAST(NULL AS SMALLINT) AS fluxo_recebido"""
_CASE_HEAD = """paciente_id, data_notificacao, semana_notificacao, unidade_id, regional_notificacao,
    data_primeiros_sintomas, semana_primeiros_sintomas"""


@query(
    "validated_ingest",
    f"""SELECT (SELECT max(notificacao_id) FROM notificacoes_casos) + row_number() OVER (ORDER BY chegada) AS notificacao_id,
               {_CASE_HEAD}, {_CASE_DEFAULTS} FROM checked WHERE motivo IS NULL""",
)
def _(spark, sf):
    s = model.silver(spark, sf)
    units = s.unidades_notificadoras.select("unidade_id")
    cases = s.notificacoes_casos("notificacao_id")
    return ingest.validate_ingest(model.arrivals(spark, sf), s.pacientes("paciente_id"), units, "chegada", cases).accepted


@query("ingest_rejects", "SELECT chegada, motivo FROM checked WHERE motivo IS NOT NULL")
def _(spark, sf):
    s = model.silver(spark, sf)
    units = s.unidades_notificadoras.select("unidade_id")
    split = ingest.validate_ingest(model.arrivals(spark, sf), s.pacientes("paciente_id"), units, "chegada")
    return split.rejected.select("chegada", "motivo")


# A later version of the case table: inconclusive once cured, discarded cases purged, and one
# new case per customer.
_VERSION = ("notificacao_id", "data_notificacao", "semana_notificacao", "classificacao_final", "evolucao_caso", "nduplic")
_LATER = """
    SELECT notificacao_id, data_notificacao, semana_notificacao,
           CASE WHEN classificacao_final = 'Em investigação' AND evolucao_caso = 'Cura' THEN 'Inconclusivo'
                ELSE classificacao_final END AS classificacao_final, evolucao_caso, nduplic
    FROM {old} WHERE classificacao_final <> 'Descartado'
    UNION ALL
    SELECT -1 - c_custkey, CAST(NULL AS DATE), CAST(1 AS SMALLINT), 'Confirmado', 'Ignorado', FALSE FROM {customer}"""


def _json_sql(side: str) -> str:
    return "to_json({" + ", ".join(f"'{c}': {side}.{c}" for c in _VERSION) + "})"


@query(
    "audit_diff",
    f"""SELECT 'silver' AS nome_esquema, 'notificacoes_casos' AS nome_tabela,
               CASE WHEN o.notificacao_id IS NULL THEN 'INSERT' WHEN n.notificacao_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operacao,
               coalesce(o.notificacao_id, n.notificacao_id) AS chave,
               CASE WHEN o.notificacao_id IS NOT NULL THEN CAST({_json_sql('o')} AS VARCHAR) END AS dados_antigos,
               CASE WHEN n.notificacao_id IS NOT NULL THEN CAST({_json_sql('n')} AS VARCHAR) END AS dados_novos
        FROM notificacoes_casos o FULL OUTER JOIN later n ON n.notificacao_id = o.notificacao_id
        WHERE o.notificacao_id IS NULL OR n.notificacao_id IS NULL OR o.classificacao_final <> n.classificacao_final""",
    later=_LATER.format(old="notificacoes_casos", customer="customer"),
)
def _(spark, sf):
    old = model.silver(spark, sf).notificacoes_casos(*_VERSION)
    new = spark.sql(_LATER, old=old, customer=table(spark, sf, "customer"))
    log = audit.audit_diff(old, new, "notificacao_id", "silver", "notificacoes_casos")
    return log.drop("usuario_banco", "data_hora")


# --- the published tables ------------------------------------------------------------------------
def _scratch(spark: SparkSession, name: str) -> str:
    import uuid

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _store(spark: SparkSession, sf: str, *names: str) -> Store:
    """A new store with tables of the derived model, parents first, in buckets that even the smallest data fill and wider ones for more data."""
    s, store = model.silver(spark, sf).settle(), Store(spark, _scratch(spark, "store"))
    tx = store.begin()
    for name in names:
        rows, key = s.table(name), SILVER[name].key
        tx.put(name, rows, key, store.fitting(rows, key, 1 << 9))
    tx.commit()
    return store


@query(
    "load_violations",
    f"""SELECT 'casos_encerrados' AS tabela, c.caso_encerrado_id AS id, c.notificacao_id,
              CASE WHEN n.data_notificacao IS NULL THEN 'missing case'
                   WHEN c.data_encerramento < n.data_notificacao THEN 'closure before notification' END AS motivo
       FROM casos_encerrados c LEFT JOIN notificacoes_casos n ON n.notificacao_id = c.notificacao_id
       UNION ALL
       SELECT 'obitos', o.obito_id, o.notificacao_id, CASE WHEN n.evolucao_caso IS NULL THEN 'missing case'
              WHEN n.evolucao_caso NOT IN ({_DEATHS}) THEN 'outcome is not a death' END
       FROM obitos o LEFT JOIN notificacoes_casos n ON n.notificacao_id = o.notificacao_id""",
)
def _(spark, sf):
    root = _scratch(spark, "load")
    load_silver(spark, model.silver(spark, sf), root, strict=False, invalid="park")
    return held_back(spark, root)


_MARKS = """SELECT n.*, row_number() OVER (
               PARTITION BY p.sexo, p.municipio_id, n.data_primeiros_sintomas, n.uf_provavel_infeccao
               ORDER BY n.data_notificacao NULLS LAST, n.notificacao_id) AS rn
            FROM notificacoes_casos n JOIN pacientes p ON p.paciente_id = n.paciente_id"""


@query("published_after_marking", f"SELECT * EXCLUDE (rn) REPLACE (nduplic OR rn > 1 AS nduplic) FROM ({_MARKS})")
def _(spark, sf):
    store = _store(spark, sf, "pacientes", "notificacoes_casos")
    changes.mark_published_duplicates(store)
    return store.snapshot().table("notificacoes_casos")


@query(
    "published_after_batches",
    f"""SELECT * FROM notificacoes_casos UNION ALL
        SELECT (SELECT max(notificacao_id) FROM notificacoes_casos) + row_number() OVER (ORDER BY chegada % 2 = 0, chegada) AS notificacao_id,
               {_CASE_HEAD}, {_CASE_DEFAULTS} FROM checked WHERE motivo IS NULL""",
)
def _(spark, sf):
    store = _store(spark, sf, "unidades_notificadoras", "pacientes", "notificacoes_casos")
    arriving = model.arrivals(spark, sf)
    for name, part in (("odd", "chegada % 2 <> 0"), ("even", "chegada % 2 = 0"), ("odd", "chegada % 2 <> 0")):
        changes.insert_batch(store, arriving.filter(part), name, "chegada")
    return store.snapshot().table("notificacoes_casos")


def _whole_json(table: str, side: str, **replaced: str) -> str:
    return "CAST(to_json({" + ", ".join(f"'{f.name}': {replaced.get(f.name, f'{side}.{f.name}')}" for f in SILVER[table].fields) + "}) AS VARCHAR)"


@query(
    "audit_log",
    f"""SELECT row_number() OVER (ORDER BY kind, notificacao_id) AS log_id, 'silver' AS nome_esquema, 'notificacoes_casos' AS nome_tabela,
               CASE kind WHEN 0 THEN 'UPDATE' ELSE 'INSERT' END AS operacao, notificacao_id AS chave, dados_antigos, dados_novos
        FROM (SELECT 0 AS kind, notificacao_id, {_whole_json("notificacoes_casos", "m")} AS dados_antigos,
                     {_whole_json("notificacoes_casos", "m", nduplic="TRUE")} AS dados_novos
              FROM ({_MARKS}) m WHERE rn > 1 AND NOT nduplic
              UNION ALL SELECT 1, notificacao_id, NULL, {_whole_json("notificacoes_casos", "c")}
              FROM (SELECT (SELECT max(notificacao_id) FROM notificacoes_casos) + row_number() OVER (ORDER BY chegada) AS notificacao_id,
                           {_CASE_HEAD}, {_CASE_DEFAULTS} FROM checked WHERE motivo IS NULL) c)""",
)
def _(spark, sf):
    store = _store(spark, sf, "unidades_notificadoras", "pacientes", "notificacoes_casos")
    changes.mark_published_duplicates(store)
    changes.insert_batch(store, model.arrivals(spark, sf), "all", "chegada")
    return store.snapshot().table(changes.LOG).drop("usuario_banco", "data_hora")


# Corrections of patients in order: schooling of every fourth, then sex of every eighth, then every sixteenth goes.
_CORRECTED = {f.name: f"p.{f.name}" for f in SILVER["pacientes"].fields}


@query(
    "audit_patients",
    f"""SELECT row_number() OVER (ORDER BY step, paciente_id) AS log_id, 'silver' AS nome_esquema, 'pacientes' AS nome_tabela,
               CASE step WHEN 2 THEN 'DELETE' ELSE 'UPDATE' END AS operacao, paciente_id AS chave, dados_antigos, dados_novos
        FROM (SELECT 0 AS step, paciente_id, {_whole_json("pacientes", "p")} AS dados_antigos,
                     {_whole_json("pacientes", "p", escolaridade="'Ignorado'")} AS dados_novos FROM pacientes p WHERE paciente_id % 4 = 0
              UNION ALL SELECT 1, paciente_id, {_whole_json("pacientes", "p", escolaridade="'Ignorado'")},
                     {_whole_json("pacientes", "p", escolaridade="'Ignorado'", sexo="'Ignorado'")} FROM pacientes p WHERE paciente_id % 8 = 0
              UNION ALL SELECT 2, paciente_id, {_whole_json("pacientes", "p", escolaridade="'Ignorado'", sexo="'Ignorado'")}, NULL
              FROM pacientes p WHERE paciente_id % 16 = 0)""",
)
def _(spark, sf):
    store = _store(spark, sf, "pacientes")
    people = store.snapshot().table("pacientes")
    none = people.withColumn("escolaridade", F.lit("Ignorado"))
    steps = [none.filter("paciente_id % 4 = 0"), none.withColumn("sexo", F.lit("Ignorado")).filter("paciente_id % 8 = 0"), none.filter("paciente_id % 16 = 0")]
    steps = [df.withColumn("removed", F.lit(i == 2)).withColumn("ordem", F.col("paciente_id") * F.lit(1) + F.lit(i * 10**12)) for i, df in enumerate(steps)]
    changes.apply_changes(store, "pacientes", reduce(DataFrame.unionByName, steps), "ordem")
    return store.snapshot().table(changes.LOG).drop("usuario_banco", "data_hora")


# --- views -----------------------------------------------------------------------------------
@query(
    "view_weekly",
    """SELECT CAST(year(data_primeiros_sintomas) AS INTEGER) AS ano, semana_primeiros_sintomas, count(*) AS total_casos
       FROM notificacoes_casos WHERE classificacao_final = 'Confirmado' GROUP BY 1, 2""",
)
def _(spark, sf):
    s = model.silver(spark, sf)
    return views.weekly_series(s.notificacoes_casos("data_primeiros_sintomas", "semana_primeiros_sintomas", "classificacao_final"))


@query(
    "view_uf_year",
    """SELECT u.sigla AS uf, CAST(year(n.data_notificacao) AS INTEGER) AS ano, count(*) AS total_casos
       FROM notificacoes_casos n JOIN ufs u ON u.uf_id = n.uf_provavel_infeccao
       WHERE n.classificacao_final = 'Confirmado' GROUP BY 1, 2""",
)
def view_uf_year(spark, sf):
    s = model.silver(spark, sf)
    return views.uf_year(s.notificacoes_casos("data_notificacao", "uf_provavel_infeccao", "classificacao_final"), s.ufs)


@query(
    "view_pyramid",
    f"""SELECT {_band_sql('i.idade')} AS faixa_etaria, p.sexo, count(*) AS total_casos
        FROM notificacoes_casos n JOIN pacientes p ON p.paciente_id = n.paciente_id JOIN idades i ON i.paciente_id = p.paciente_id
        WHERE n.classificacao_final = 'Confirmado' AND p.sexo <> 'Ignorado' GROUP BY 1, 2""",
)
def _(spark, sf):
    s = model.silver(spark, sf)
    return views.age_pyramid(
        s.notificacoes_casos("paciente_id", "classificacao_final"), s.pacientes("paciente_id", "sexo", "idade_codificada")
    )


@query(
    "view_pregnancy",
    f"SELECT idade_gestacional, count(*) AS total_casos FROM pacientes WHERE idade_gestacional IN ({_TRIMESTERS}) GROUP BY 1",
)
def _(spark, sf):
    return views.pregnancy(model.silver(spark, sf).pacientes("idade_gestacional"))


@query(
    "view_kpis",
    f"""SELECT count(*) AS total_casos, CAST(sum(CAST(n.evolucao_caso = 'Óbito pelo agravo' AS INT)) AS BIGINT) AS total_obitos,
              CAST(sum(CAST(p.idade_gestacional IN ({_TRIMESTERS}) AS INT)) AS BIGINT) AS total_gestantes,
              CAST(sum(CAST(n.classificacao_final = 'Em investigação' AS INT)) AS BIGINT) AS aguardando_investigacao
       FROM notificacoes_casos n JOIN pacientes p USING (paciente_id)""",
)
def _(spark, sf):
    s = model.silver(spark, sf)
    return views.kpis(
        s.notificacoes_casos("paciente_id", "evolucao_caso", "classificacao_final"), s.pacientes("paciente_id", "idade_gestacional")
    )


def _summary_tables(s: Silver) -> dict[str, DataFrame]:
    return {
        "notificacoes_casos": s.notificacoes_casos(
            "notificacao_id", "paciente_id", "data_notificacao", "classificacao_final", "unidade_id", "uf_provavel_infeccao"
        ),
        "pacientes": s.pacientes("paciente_id", "municipio_id"),
        "unidades_notificadoras": s.unidades_notificadoras,
        "municipios": s.municipios,
    }


_SUMMARY = {
    "notificacao": "JOIN unidades_notificadoras x USING (unidade_id) JOIN municipios m ON m.municipio_id = x.municipio_id",
    "residencia": "JOIN pacientes x USING (paciente_id) JOIN municipios m ON m.municipio_id = x.municipio_id",
    "infeccao": "JOIN ufs m ON m.uf_id = n.uf_provavel_infeccao",
}
for _mode, _joins in _SUMMARY.items():

    def _summary(spark, sf, mode=_mode):
        return views.newest_first(views.uf_year_summary(mode, _summary_tables(model.silver(spark, sf))))

    query(
        f"summary_{_mode}",
        f"""SELECT m.uf_id AS uf_codigo, CAST(year(n.data_notificacao) AS INTEGER) AS ano, count(*) AS total_casos
            FROM notificacoes_casos n {_joins} WHERE n.classificacao_final = 'Confirmado' GROUP BY 1, 2 ORDER BY 2 DESC, 3 DESC""",
    )(_summary)


# --- dashboard ---------------------------------------------------------------------------------
_BASE_ORDER = [
    *[f.name for f in SILVER["notificacoes_casos"].fields],
    *[f.name for f in SILVER["pacientes"].fields if f.name != "paciente_id"],
    "sigla", "nome", "idade_anos", "ano", "ano_sintomas",
]


@query("base_denorm", f"SELECT {', '.join(_BASE_ORDER)} FROM base")
def _(spark, sf):
    s = model.silver(spark, sf)
    return dashboard.build_base(s.notificacoes_casos(), s.pacientes(), s.ufs).select(*_BASE_ORDER)


@query("base_from_records", f"SELECT {', '.join(_BASE_ORDER)} FROM base")
def _(spark, sf):
    return model.silver(spark, sf).base(*_BASE_ORDER)


_SCOPE = f"year(data_notificacao) BETWEEN {YEARS[0]} AND {YEARS[1]} AND sigla IN {_UFS_SQL}"
_SURE = "classificacao_final = 'Confirmado'"
_PREGNANT = f"idade_gestacional IN ({_TRIMESTERS})"
_DEAD = "evolucao_caso = 'Óbito pelo agravo'"


@query(
    "dash_kpis",
    f"""SELECT (SELECT count(*) FROM base WHERE {_SURE} AND {_SCOPE}) AS total_casos,
               (SELECT count(*) FROM base WHERE {_SURE} AND {_DEAD} AND {_SCOPE}) AS total_obitos,
               (SELECT count(*) FROM base WHERE {_SURE} AND {_PREGNANT} AND {_SCOPE}) AS total_gestantes,
               (SELECT count(*) FROM base WHERE classificacao_final = 'Em investigação' AND {_SCOPE}) AS aguardando_investigacao""",
)
def _(spark, sf):
    base = model.silver(spark, sf).base("data_notificacao", "classificacao_final", "evolucao_caso", "idade_gestacional", "sigla")
    return dashboard.kpis(base, YEARS, UFS)


@query(
    "dash_kpis_all_units",
    f"""SELECT count(*) FILTER (WHERE {_SURE}) AS total_casos, count(*) FILTER (WHERE {_SURE} AND {_DEAD}) AS total_obitos,
               count(*) FILTER (WHERE {_SURE} AND {_PREGNANT}) AS total_gestantes,
               count(*) FILTER (WHERE classificacao_final = 'Em investigação') AS aguardando_investigacao
        FROM base WHERE year(data_notificacao) BETWEEN {YEARS[0]} AND {YEARS[1]}""",
)
def _(spark, sf):
    base = model.silver(spark, sf).base("data_notificacao", "classificacao_final", "evolucao_caso", "idade_gestacional")
    return dashboard.kpis(base, YEARS, [])


_WEEKLY_SQL = f"""SELECT ano_sintomas, semana_primeiros_sintomas, count(*) AS total_casos FROM base
    WHERE {_SURE} AND ano_sintomas BETWEEN {YEARS[0]} AND {YEARS[1]} AND sigla IN {_UFS_SQL} GROUP BY 1, 2"""


def _dash_weekly(spark, sf):
    base = model.silver(spark, sf).base("data_primeiros_sintomas", "semana_primeiros_sintomas", "classificacao_final", "sigla")
    return dashboard.weekly_series(base, YEARS, UFS)


query("dash_weekly", _WEEKLY_SQL)(_dash_weekly)


@query(
    "weekly_plot",
    f"""SELECT *, round(ano_sintomas + (semana_primeiros_sintomas - 1) / 52, 6) AS periodo,
               ano_sintomas || '-S' || lpad(CAST(semana_primeiros_sintomas AS VARCHAR), 2, '0') AS rotulo
        FROM ({_WEEKLY_SQL})""",
)
def _(spark, sf):
    return rounded(dashboard.weekly_plot(_dash_weekly(spark, sf)), "periodo")


_UF_YEAR_SQL = f"SELECT sigla, ano, count(*) AS total_casos FROM base WHERE {_SURE} AND {_SCOPE} GROUP BY 1, 2"
_UF_YEAR_ALL_SQL = f"""SELECT sigla, ano, count(*) AS total_casos FROM base WHERE {_SURE} AND uf_provavel_infeccao IS NOT NULL
    AND ano BETWEEN {YEARS[0]} AND {YEARS[1]} GROUP BY 1, 2"""


def _uf_base(spark, sf):
    return model.silver(spark, sf).base("data_notificacao", "uf_provavel_infeccao", "classificacao_final", "sigla")


@query("dash_uf_year", _UF_YEAR_SQL)
def _(spark, sf):
    return dashboard.uf_year(_uf_base(spark, sf), YEARS, UFS)


@query(
    "total_per_uf_top5",
    f"""SELECT sigla, CAST(sum(total_casos) AS BIGINT) AS total_casos FROM ({_UF_YEAR_ALL_SQL})
        GROUP BY sigla ORDER BY total_casos DESC, sigla LIMIT 5""",
)
def _(spark, sf):
    return dashboard.largest_ufs(dashboard.uf_year(_uf_base(spark, sf), YEARS, []))


@query(
    "series_of_top5",
    f"""SELECT * FROM ({_UF_YEAR_ALL_SQL}) WHERE sigla IN (SELECT sigla FROM ({_UF_YEAR_ALL_SQL})
        GROUP BY sigla ORDER BY sum(total_casos) DESC, sigla LIMIT 5)""",
)
def _(spark, sf):
    return dashboard.series_of_largest(dashboard.uf_year(_uf_base(spark, sf), YEARS, []))


@query(
    "dash_pyramid",
    f"""SELECT faixa_etaria, sexo, total_casos, CAST(list_position({_BANDS}, faixa_etaria) AS INTEGER) AS ordem_faixa,
               CASE sexo WHEN 'Masculino' THEN -total_casos ELSE total_casos END AS total_casos_sinal
        FROM (SELECT {_band_sql('idade_anos')} AS faixa_etaria, sexo, count(*) AS total_casos FROM base
              WHERE {_SURE} AND {_SCOPE} AND sexo <> 'Ignorado' GROUP BY 1, 2)""",
)
def _(spark, sf):
    base = model.silver(spark, sf).base("data_notificacao", "classificacao_final", "sexo", "idade_anos", "sigla")
    return dashboard.age_pyramid(base, YEARS, UFS)


@query(
    "dash_pregnancy",
    f"SELECT idade_gestacional, count(*) AS total_casos FROM base WHERE {_SURE} AND {_SCOPE} AND {_PREGNANT} GROUP BY 1",
)
def _(spark, sf):
    base = model.silver(spark, sf).base("data_notificacao", "classificacao_final", "idade_gestacional", "sigla")
    return dashboard.pregnancy(base, YEARS, UFS)


@query(
    "year_bounds",
    "SELECT CAST(min(ano) AS INTEGER) AS ano_min, CAST(max(ano) AS INTEGER) AS ano_max FROM base",
)
def _(spark, sf):
    return dashboard.year_bounds(model.silver(spark, sf).base("data_notificacao"))


# --- time series ---------------------------------------------------------------------------------
def _study(spark, sf, *columns):
    base = model.silver(spark, sf).base("classificacao_final", "data_primeiros_sintomas", *columns)
    return timeseries.study_cases(base, *STUDY)


def _weekly(spark, sf):
    return timeseries.weekly_counts(_study(spark, sf))


def _weekly_uf(spark, sf):
    cases = _study(spark, sf, "sigla").filter(F.col("sigla").isNotNull())
    return timeseries.weekly_counts(cases, ["sigla"])


def _filled(spark, sf):
    return timeseries.fill_weeks(_weekly(spark, sf))


def _filled_uf(spark, sf):
    return timeseries.fill_weeks(_weekly_uf(spark, sf), ["sigla"])


query("series_weekly", "SELECT * FROM weekly")(_weekly)
query("series_gapfill", "SELECT * FROM filled_uf")(_filled_uf)


@query("seasonal_profile", "SELECT CAST(semana_epi AS INTEGER) AS semana_epi, round(media_casos, 6) AS media_casos FROM profile_week")
def _(spark, sf):
    return rounded(timeseries.seasonal_profile(_weekly(spark, sf)), "media_casos")


@query(
    "seasonal_profile_uf",
    "SELECT sigla, CAST(weekofyear(semana) AS INTEGER) AS semana_epi, round(avg(casos), 6) AS media_casos FROM weekly_uf GROUP BY 1, 2",
)
def _(spark, sf):
    return rounded(timeseries.seasonal_profile(_weekly_uf(spark, sf), ["sigla"]), "media_casos")


@query(
    "decompose_classical",
    """SELECT sigla, semana, casos, round(t, 6) AS tendencia, round(s - m, 6) AS sazonalidade, round(casos - t - (s - m), 6) AS residuo
       FROM (SELECT x.*, p.s, c.m
             FROM trended x
             LEFT JOIN (SELECT sigla, pos, avg(casos - t) AS s FROM trended GROUP BY 1, 2) p ON p.sigla = x.sigla AND p.pos = x.pos
             LEFT JOIN (SELECT sigla, avg(s) AS m FROM (SELECT sigla, pos, avg(casos - t) AS s FROM trended GROUP BY 1, 2) GROUP BY 1) c
               ON c.sigla = x.sigla)""",
    trended="""SELECT sigla, semana, casos, (row_number() OVER w - 1) % 52 AS pos,
                 CASE WHEN count(*) OVER (w ROWS BETWEEN 26 PRECEDING AND 26 FOLLOWING) = 53 THEN
                   (0.5 * lag(casos, 26) OVER w + 0.5 * lead(casos, 26) OVER w
                    + sum(casos) OVER (w ROWS BETWEEN 25 PRECEDING AND 25 FOLLOWING)) / 52 END AS t
               FROM filled_uf WINDOW w AS (PARTITION BY sigla ORDER BY semana)""",
)
def _(spark, sf):
    parts = timeseries.decompose_classical(_filled_uf(spark, sf), ["sigla"])
    return rounded(parts, "tendencia", "sazonalidade", "residuo")


def _robust_ctes(rounds: int) -> dict[str, str]:
    """Rounds of local lines, positions' means and bisquare weights, each from the one before."""
    ctes = {"weeks_0": """SELECT sigla, semana, casos, row_number() OVER w AS x, (row_number() OVER w - 1) % 52 AS pos, 1.0::DOUBLE AS wt, 0.0::DOUBLE AS before
        FROM filled_uf WINDOW w AS (PARTITION BY sigla ORDER BY semana)"""}
    wide, inner = "ROWS BETWEEN 26 PRECEDING AND 26 FOLLOWING", "ROWS BETWEEN 25 PRECEDING AND 25 FOLLOWING"

    def around(e: str, name: str) -> str:
        return f"(sum({e}) OVER (w {wide}) + sum({e}) OVER (w {inner})) / 2 AS {name}"

    moments = ", ".join(around(f"wt{e}", n) for e, n in (("", "m"), (" * x", "mx"), (" * x * x", "mxx"), (" * (casos - before)", "my"), (" * x * (casos - before)", "mxy")))
    for i in range(rounds + 1):
        ctes |= {
            f"moments_{i}": f"SELECT *, {moments} FROM weeks_{i} WINDOW w AS (PARTITION BY sigla ORDER BY semana)",
            f"lines_{i}": f"""SELECT *, my / nullif(m, 0) + CASE WHEN m * mxx - mx * mx > 1e-6 THEN (m * mxy - mx * my) / (m * mxx - mx * mx) ELSE 0 END
                * (x - mx / nullif(m, 0)) AS t FROM moments_{i}""",
            f"phases_{i}": f"SELECT sigla, pos, coalesce(sum(wt * (casos - t)) / nullif(sum(wt), 0), 0) AS s FROM lines_{i} GROUP BY 1, 2",
            f"parts_{i}": f"""SELECT l.sigla, semana, casos, x, l.pos, t, p.s - c.mean AS s, casos - t - (p.s - c.mean) AS r FROM lines_{i} l
                JOIN phases_{i} p ON p.sigla = l.sigla AND p.pos = l.pos
                JOIN (SELECT sigla, avg(s) AS mean FROM phases_{i} GROUP BY 1) c ON c.sigla = l.sigla""",
            f"weeks_{i + 1}": f"""SELECT sigla, semana, casos, x, pos, CASE WHEN scale <= 1e-9 THEN 1 WHEN abs(r) < scale THEN (1 - (r / scale) ** 2) ** 2 ELSE 0 END AS wt, s AS before
                FROM (SELECT *, 6 * median(abs(r)) OVER (PARTITION BY sigla) AS scale FROM parts_{i})""",
        }
    return ctes


@query(
    "decompose_robust",
    "SELECT sigla, semana, casos, round(t, 6) AS tendencia, round(s, 6) AS sazonalidade, round(r, 6) AS residuo FROM parts_3",
    **_robust_ctes(3),
)
def _(spark, sf):
    parts = timeseries.decompose_robust(_filled_uf(spark, sf), ["sigla"])
    return rounded(parts, "tendencia", "sazonalidade", "residuo")


def _trend(spark, sf):
    s = model.silver(spark, sf)
    cases = timeseries.study_cases(
        s.notificacoes_casos("data_notificacao", "data_primeiros_sintomas", "uf_provavel_infeccao", "classificacao_final"), *STUDY
    )
    return trend.yearly_trend(trend.cases_per_uf_year(cases, s.ufs))


@query(
    "trend_uf",
    f"SELECT uf, anos_com_dados, total_casos, {_r('tendencia_casos_ano', 'r2', 'p_value')} FROM trend",
)
def _(spark, sf):
    return rounded(_trend(spark, sf), "tendencia_casos_ano", "r2", "p_value")


@query("trend_top5", "SELECT uf, total_casos FROM trend ORDER BY total_casos DESC, uf LIMIT 5")
def _(spark, sf):
    return trend.largest(_trend(spark, sf)).select("uf", "total_casos")


@query(
    "holdout_split",
    """SELECT sigla, semana, casos, CASE WHEN row_number() OVER (PARTITION BY sigla ORDER BY semana DESC) <= 12
              THEN 'teste' ELSE 'treino' END AS conjunto FROM filled_uf""",
)
def _(spark, sf):
    return timeseries.split_holdout(_filled_uf(spark, sf), ["sigla"])


@query(
    "future_frame",
    "SELECT sigla, semana AS ds FROM filled_uf UNION ALL "
    "SELECT sigla, CAST(unnest(generate_series(max(semana) + 7, max(semana) + 84, INTERVAL 7 DAY)) AS DATE) FROM weekly_uf GROUP BY sigla",
)
def _(spark, sf):
    return timeseries.future_weeks(_filled_uf(spark, sf), ["sigla"])


@query("forecast_trend_seasonal", f"SELECT sigla, ds, {_r('yhat', 'yhat_lower', 'yhat_upper')} FROM forecast")
def _(spark, sf):
    return rounded(timeseries.forecast_trend_seasonal(_filled_uf(spark, sf), ["sigla"]), "yhat", "yhat_lower", "yhat_upper")


@query(
    "forecast_eval",
    """SELECT t.sigla, count(*) AS n_semanas, round(avg(abs(t.casos - f.yhat)), 6) AS mae,
              round(sqrt(avg((t.casos - f.yhat) ** 2)), 6) AS rmse
       FROM testing t JOIN forecast f ON f.sigla = t.sigla AND f.ds = t.semana GROUP BY t.sigla""",
    series="training",
    training="SELECT sigla, semana, casos FROM (SELECT *, row_number() OVER (PARTITION BY sigla ORDER BY semana DESC) AS rn FROM filled_uf) WHERE rn > 12",
    testing="SELECT sigla, semana, casos FROM (SELECT *, row_number() OVER (PARTITION BY sigla ORDER BY semana DESC) AS rn FROM filled_uf) WHERE rn <= 12",
)
def _(spark, sf):
    scores = timeseries.holdout_evaluation(_filled_uf(spark, sf), timeseries.forecast_trend_seasonal, ["sigla"])
    return rounded(scores, "mae", "rmse")


_WHOLE = "SELECT 'all' AS sigla, semana, casos FROM filled"
_CHANGE_SQL = """SELECT avg(casos) AS media_recente, (SELECT avg(yhat) FROM forecast WHERE ds > (SELECT max(semana) FROM filled)) AS media_prevista,
    (SELECT count(*) FROM forecast) - (SELECT count(*) FROM filled) AS n_forecast
    FROM (SELECT casos FROM filled ORDER BY semana DESC LIMIT 12)"""


@query(
    "forecast_change",
    f"""SELECT n_forecast, round(media_recente, 6) AS media_recente, round(media_prevista, 6) AS media_prevista,
               round((media_prevista / media_recente - 1) * 100, 6) AS variacao_previsao FROM ({_CHANGE_SQL})""",
    series="whole", whole=_WHOLE,
)
def _(spark, sf):
    weekly = cut_lineage(_filled(spark, sf))
    change = dashboard.forecast_change(weekly, timeseries.forecast_trend_seasonal(weekly))
    return rounded(change, "media_recente", "media_prevista", "variacao_previsao")


# --- municipality clusters ---------------------------------------------------------------------------
def _profile(spark, sf):
    s = model.silver(spark, sf)
    base = s.base("municipio_id", "classificacao_final", "idade_anos", "idade_gestacional", "evolucao_caso", "autoctonia")
    return cluster.municipality_profile(base, s.municipios, s.ufs)


def _clusters(spark, sf):
    return _profile(spark, sf).withColumn("cluster", (F.col("municipio_id") % 4).cast("int"))


_SHARES = ("idade_media", "pct_gestantes", "pct_obito", "pct_autoctone", "taxa_confirmacao")


@query(
    "municipality_profile",
    f"SELECT municipio_id, total_confirmados, total_notificados, nome, uf_id, sigla, uf_nome, {_r(*_SHARES)} FROM profile",
)
def _(spark, sf):
    return rounded(_profile(spark, sf), *_SHARES)


_Z = [f"z_{f}" for f in FEATURES]


@query("feature_zscores", f"SELECT municipio_id, {_r(*_Z)} FROM scaled")
def _(spark, sf):
    return rounded(cluster.zscores(_profile(spark, sf)).select("municipio_id", *_Z), *_Z)


def _silhouette_sql(distance: str) -> str:
    return f"""SELECT round(avg(CASE WHEN size = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhueta FROM (
          SELECT id, max(CASE WHEN own = other THEN n END) AS size, max(CASE WHEN own = other THEN d / nullif(n - 1, 0) END) AS a,
                 min(CASE WHEN own <> other THEN d / n END) AS b
          FROM (SELECT p.municipio_id AS id, p.cluster AS own, q.cluster AS other, count(*) AS n, sum({distance}) AS d
                FROM scaled p CROSS JOIN scaled_too q GROUP BY 1, 2, 3) GROUP BY id)"""


_SQUARED = " + ".join(f"(p.{z} - q.{z}) ** 2" for z in _Z)


@query("silhouette_squared_given_labels", _silhouette_sql(_SQUARED), scaled_too="SELECT * FROM scaled")
def _(spark, sf):
    scaled = cluster.zscores(_clusters(spark, sf))
    return rounded(cluster.silhouette_squared(scaled, "municipio_id", _Z, ["cluster"]).select("silhueta"), "silhueta")


_PAIRS = [(i, j) for i in range(len(_Z)) for j in range(i, len(_Z))]


@query("pca_covariance", "SELECT " + ", ".join(f"round(avg({_Z[i]} * {_Z[j]}), 6) AS c_{i}_{j}" for i, j in _PAIRS) + " FROM scaled")
def _(spark, sf):
    found = cluster.covariances(cluster.zscores(_profile(spark, sf)))
    return rounded(found, *found.columns)


@query("silhouette_given_labels", _silhouette_sql(f"sqrt({_SQUARED})"), scaled_too="SELECT * FROM scaled")
def _(spark, sf):
    scaled = cluster.zscores(_clusters(spark, sf))
    return rounded(cluster.silhouette(scaled, "municipio_id", _Z, ["cluster"]).select("silhueta"), "silhueta")


@query(
    "cluster_profile_given_labels",
    "SELECT cluster, " + ", ".join(f"round(avg({f}), 3) AS {f}" for f in FEATURES) + ", count(*) AS n_municipios FROM clusters GROUP BY cluster",
)
def _(spark, sf):
    return cluster.cluster_profile(_clusters(spark, sf))


_RISK_SQL = """SELECT cluster, avg(pct_obito) AS pct_obito_medio, avg(pct_gestantes) AS pct_gestantes_medio,
    CAST(sum(total_confirmados) AS BIGINT) AS total_confirmados, count(*) AS n_municipios FROM clusters GROUP BY cluster"""


@query(
    "cluster_risk_given_labels",
    f"""SELECT cluster, round(pct_obito_medio, 6) AS pct_obito_medio, round(pct_gestantes_medio, 6) AS pct_gestantes_medio,
               total_confirmados, n_municipios FROM ({_RISK_SQL}) ORDER BY pct_obito_medio DESC, cluster""",
)
def _(spark, sf):
    return rounded(dashboard.cluster_risk(_clusters(spark, sf)), "pct_obito_medio", "pct_gestantes_medio")


_SHARE_FEATURES = [f for f in FEATURES if f != "total_confirmados"]


@query(
    "cluster_members",
    f"SELECT nome, sigla, cluster, total_confirmados, {_r(*_SHARE_FEATURES)} FROM clusters WHERE cluster IN (1, 3)",
)
def _(spark, sf):
    return rounded(dashboard.cluster_members(_clusters(spark, sf), [1, 3]), *_SHARE_FEATURES)


# --- insights ------------------------------------------------------------------------------------------
def _core(spark, sf):
    base = model.silver(spark, sf).base("classificacao_final", "evolucao_caso", "idade_gestacional")
    # Each statistics table is read for several figures, so it is written first.
    weekly = cut_lineage(_weekly(spark, sf))
    filled = timeseries.fill_weeks(weekly)
    return dashboard.insights_core(
        base, filled, timeseries.seasonal_profile(weekly), timeseries.forecast_trend_seasonal(filled),
        cut_lineage(_trend(spark, sf)), cut_lineage(_clusters(spark, sf)),
    )


_TOTALS_SQL = f"""SELECT count(*) AS total_casos, count(*) FILTER (WHERE {_DEAD}) AS total_obitos,
    count(*) FILTER (WHERE {_PREGNANT}) AS total_gestantes FROM base WHERE {_SURE}"""
_CORE_CTES = {
    "totals": _TOTALS_SQL,
    "change": _CHANGE_SQL,
    "whole": _WHOLE,
    "up": "SELECT * FROM trend WHERE p_value < 0.10 AND tendencia_casos_ano > 0 ORDER BY tendencia_casos_ano DESC, uf LIMIT 1",
    "down": "SELECT * FROM trend WHERE p_value < 0.10 AND tendencia_casos_ano < 0 ORDER BY tendencia_casos_ano, uf LIMIT 1",
    "falling": "SELECT count(*) AS n FROM trend WHERE p_value < 0.10 AND tendencia_casos_ano < 0",
    "peak": "SELECT * FROM profile_week ORDER BY media_casos DESC, semana_epi LIMIT 1",
    "risk": f"{_RISK_SQL} ORDER BY pct_obito_medio DESC, cluster LIMIT 1",
    "core": """SELECT total_casos, total_obitos, total_gestantes, total_obitos / total_casos * 100 AS letalidade,
        total_gestantes / total_casos * 100 AS pct_gestantes,
        (SELECT uf FROM up) AS crescimento_uf, (SELECT tendencia_casos_ano FROM up) AS crescimento_casos, (SELECT r2 FROM up) AS crescimento_r2,
        (SELECT uf FROM down) AS declinio_uf, (SELECT tendencia_casos_ano FROM down) AS declinio_casos, (SELECT r2 FROM down) AS declinio_r2,
        (SELECT n FROM falling) AS n_declinio,
        (SELECT CAST(semana_epi AS INTEGER) FROM peak) AS pico_semana, (SELECT media_casos FROM peak) AS pico_media,
        (SELECT n_forecast FROM change) AS n_forecast, (SELECT (media_prevista / media_recente - 1) * 100 FROM change) AS variacao_previsao,
        (SELECT cluster FROM risk) AS risco_cluster, (SELECT pct_obito_medio FROM risk) AS risco_obito, (SELECT n_municipios FROM risk) AS risco_n
        FROM totals""",
}
_CORE_DOUBLES = (
    "letalidade", "pct_gestantes", "crescimento_casos", "crescimento_r2", "declinio_casos", "declinio_r2", "pico_media",
    "variacao_previsao", "risco_obito",
)
_CORE_OTHERS = (
    "total_casos", "total_obitos", "total_gestantes", "crescimento_uf", "declinio_uf", "n_declinio", "pico_semana", "n_forecast",
    "risco_cluster", "risco_n",
)


@query("insights_core", f"SELECT {', '.join(_CORE_OTHERS)}, {_r(*_CORE_DOUBLES)} FROM core", series="whole", **_CORE_CTES)
def _(spark, sf):
    core = _core(spark, sf)
    flat = core.select(
        "total_casos", "total_obitos", "total_gestantes", "letalidade", "pct_gestantes", "n_declinio",
        F.col("crescimento.uf").alias("crescimento_uf"), F.col("crescimento.tendencia_casos_ano").alias("crescimento_casos"),
        F.col("crescimento.r2").alias("crescimento_r2"),
        F.col("declinio.uf").alias("declinio_uf"), F.col("declinio.tendencia_casos_ano").alias("declinio_casos"),
        F.col("declinio.r2").alias("declinio_r2"),
        F.col("pico.semana_epi").alias("pico_semana"), F.col("pico.media_casos").alias("pico_media"),
        F.col("previsao.n_forecast").alias("n_forecast"), F.col("previsao.variacao_previsao").alias("variacao_previsao"),
        F.col("risco.cluster").alias("risco_cluster"), F.col("risco.pct_obito_medio").alias("risco_obito"),
        F.col("risco.n_municipios").alias("risco_n"),
    )
    return rounded(flat, *_CORE_DOUBLES)


@query(
    "insights_selected",
    """SELECT * FROM (
         SELECT 1 AS posicao, 'crescimento' AS tipo, CASE WHEN crescimento_uf IS NOT NULL THEN
             printf('%s: maior tendência de crescimento (+%.1f casos/ano, R²=%.2f)', crescimento_uf, crescimento_casos, crescimento_r2)
             ELSE printf('Nenhuma UF com crescimento significativo; %d UFs com queda significativa', n_declinio) END AS texto FROM core
         UNION ALL SELECT 2, 'declinio', CASE WHEN declinio_uf IS NOT NULL THEN
             printf('%s: maior tendência de queda (%.1f casos/ano, R²=%.2f)', declinio_uf, declinio_casos, declinio_r2) END FROM core
         UNION ALL SELECT 3, 'pico', printf('Pico sazonal médio na semana %d (%.1f casos)', pico_semana, pico_media) FROM core
         UNION ALL SELECT 4, 'previsao', printf('Previsão de %s de aproximadamente %.1f%% nas próximas %d semanas',
             CASE WHEN variacao_previsao > 0 THEN 'aumento' ELSE 'redução' END, abs(variacao_previsao), n_forecast) FROM core
         UNION ALL SELECT 5, 'risco', CASE WHEN risco_obito > 0 THEN
             printf('Cluster %d: maior taxa média de óbito (%.2f%%) entre %d municípios%s', risco_cluster, risco_obito * 100, risco_n,
                    CASE WHEN risco_n < 5 THEN ' (poucos municípios: interpretar com reserva)' ELSE '' END) END FROM core
         UNION ALL SELECT 6, 'gestantes', printf('%d casos confirmados em gestantes (%.1f%%)', total_gestantes, pct_gestantes) FROM core)
       WHERE texto IS NOT NULL""",
    series="whole", **_CORE_CTES,
)
def _(spark, sf):
    return dashboard.insights_selected(_core(spark, sf))


# --- the same operators on the given tables as they are ------------------------------------------------------
@query(
    "star_weekly_orders",
    """SELECT d.o_orderstatus, d.semana, coalesce(w.casos, 0) AS casos
       FROM (SELECT o_orderstatus, CAST(unnest(generate_series(min(semana), max(semana), INTERVAL 7 DAY)) AS DATE) AS semana
             FROM weeks GROUP BY o_orderstatus) d
       LEFT JOIN weeks w ON w.o_orderstatus = d.o_orderstatus AND w.semana = d.semana""",
    weeks="SELECT o_orderstatus, CAST(date_trunc('week', o_orderdate) AS DATE) AS semana, count(*) AS casos FROM orders GROUP BY 1, 2",
)
def _(spark, sf):
    counts = timeseries.weekly_counts(table(spark, sf, "orders"), ["o_orderstatus"], "o_orderdate")
    return timeseries.fill_weeks(counts, ["o_orderstatus"])


@query(
    "star_ship_profile",
    """SELECT l_returnflag, CAST(weekofyear(semana) AS INTEGER) AS semana_epi, round(avg(casos), 6) AS media_casos
       FROM (SELECT l_returnflag, CAST(date_trunc('week', l_shipdate) AS DATE) AS semana, count(*) AS casos FROM lineitem GROUP BY 1, 2)
       GROUP BY 1, 2""",
)
def _(spark, sf):
    counts = timeseries.weekly_counts(table(spark, sf, "lineitem"), ["l_returnflag"], "l_shipdate")
    return rounded(timeseries.seasonal_profile(counts, ["l_returnflag"]), "media_casos")


@query(
    "star_trend_nation",
    f"SELECT uf, anos_com_dados, total_casos, {_r('tendencia_casos_ano', 'r2', 'p_value')} FROM trend",
    uf_years="""SELECT n.n_name AS sigla, year(o.o_orderdate) AS ano, count(*) AS total_casos FROM orders o
        JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY 1, 2""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("ano")).agg(F.count("*").alias("n"))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    per_nation = orders.join(customers, "o_custkey").groupBy("c_nationkey", "ano").agg(F.sum("n").alias("total_casos"))
    names = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("sigla"))
    return rounded(trend.yearly_trend(per_nation.join(names, "c_nationkey")), "tendencia_casos_ano", "r2", "p_value")


@query(
    "star_repeated_lines",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_linhas FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(spark, sf):
    return quality.check_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "star_lines_without_event",
    """SELECT l_orderkey AS chave, count(*) AS n_linhas FROM lineitem l
       WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_id = l.l_orderkey) GROUP BY 1""",
)
def _(spark, sf):
    return quality.check_fk(table(spark, sf, "lineitem"), "l_orderkey", table(spark, sf, "events"), "event_id")


# --- models without a SQL form -----------------------------------------------------------------------------
@query("stl_by_key")
def _(spark, sf):
    return solvers.stl_by_key(_filled_uf(spark, sf), ["sigla"])


@query("forecast_by_key")
def _(spark, sf):
    return solvers.forecast_by_key(_filled_uf(spark, sf), ["sigla"])


@query("kmeans_sweep")
def _(spark, sf):
    return cluster.kmeans_sweep(_profile(spark, sf), "municipio_id")


@query("kmeans_final")
def _(spark, sf):
    return cluster.cluster_municipalities(_profile(spark, sf))


@query("pca_2d")
def _(spark, sf):
    return cluster.pca_scores(_profile(spark, sf)).select("municipio_id", "pca_1", "pca_2")


# --- streaming -------------------------------------------------------------------------------------------------
def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


@query(
    "stream_ingest",
    f"""SELECT chegada AS notificacao_id, {_CASE_HEAD}, {_CASE_DEFAULTS} FROM checked WHERE motivo IS NULL""",
)
def _(spark, sf):
    s = model.silver(spark, sf)
    arriving = _stream(spark, sf, "orders").selectExpr(*[f"{e} AS {n}" for n, e in model.ARRIVALS.items()])
    out = _scratch(spark, "ingest")
    units = s.unidades_notificadoras.select("unidade_id")
    run = streaming.stream_ingest(arriving, s.pacientes("paciente_id"), units, "chegada", out, f"{out}/checkpoint")
    run.awaitTermination()
    return spark.read.parquet(f"{out}/accepted").drop("batch")


@query(
    "stream_weekly",
    """SELECT event_type, CAST(date_trunc('week', ts) AS DATE) AS semana, count(*) AS casos FROM events GROUP BY 1, 2""",
)
def _(spark, sf):
    arriving = _stream(spark, sf, "events")
    out = _scratch(spark, "weekly")
    rows = streaming.weekly_rows(arriving, "ts", by=("event_type",))
    streaming.write_weekly(rows, f"{out}/counts", f"{out}/checkpoint").awaitTermination()
    return streaming.weekly_totals(spark.read.parquet(f"{out}/counts"), ("event_type",))
