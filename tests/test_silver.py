import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from epiframe.contracts import CASE_COLUMNS, SILVER
from epiframe.operators.ids import dense_id
from epiframe.operators.lookup import resolve_large
from epiframe.plans.dashboard import build_base
from epiframe.plans.silver import Silver
from workload import model

SF = "/root/testdata/sf0.001"

CLEAN = dict.fromkeys(CASE_COLUMNS.values(), "") | {
    "data_notificacao": "2018-02-01", "semana_notificacao": "201805", "uf_notificacao": "35", "municipio_notificacao": "355030",
    "codigo_regional": "1", "data_primeiros_sintomas": "2018-01-29", "semana_primeiros_sintomas": "201805",
    "idade_codificada": "4025", "sexo": "F", "uf_residencia": "35", "municipio_residencia": "355030", "pais_residencia": "1",
    "classificacao_final": "1", "codigo_unidade": "100", "tipo_unidade": "1", "uf_provavel_infeccao": "35",
}
TOWNS = [("35", "São Paulo", "3550308", "São Paulo"), ("35", "São Paulo", "3509502", "Campinas"), ("33", "Rio de Janeiro", "3304557", "Rio")]


def build(spark, rows, towns=TOWNS):
    names = ["row_id", *CLEAN]
    data = [(i, *[{**CLEAN, **r}[c] for c in CLEAN]) for i, r in enumerate(rows, 1)]
    bronze = spark.createDataFrame(data, "row_id long, " + ", ".join(f"{c} string" for c in names[1:]))
    return Silver(bronze, spark.createDataFrame(towns, "uf_code string, uf_nome string, municipio_id string, municipio_nome string"))


def test_prefix_unknown_codes_and_columns(spark):
    s = build(spark, [{}, {"uf_provavel_infeccao": "99", "municipio_residencia": "999999"}, {"uf_provavel_infeccao": None}])
    towns = [r[0] for r in s.pacientes("paciente_id", "municipio_id").orderBy("paciente_id").select("municipio_id").collect()]
    assert towns == [3550308, None, 3550308]
    ufs = [r[0] for r in s.notificacoes_casos("notificacao_id", "uf_provavel_infeccao").orderBy("notificacao_id").select("uf_provavel_infeccao").collect()]
    assert ufs == [35, None, None]
    for name, df in s.tables().items():
        assert [f.dataType for f in df.schema] == [f.type for f in SILVER[name].fields]


def test_countries(spark):
    rows = [{"pais_residencia": c} for c in ("1", "01", "5", "0", "/N", "40000")]
    got = {tuple(r) for r in build(spark, rows).paises.collect()}
    assert got == {(1, "Brasil"), (1, "Desconhecido"), (5, "Desconhecido")}


def test_unit_keeps_lowest_municipality(spark):
    rows = [{"municipio_notificacao": "355030"}, {"municipio_notificacao": "350950", "tipo_unidade": "2"}, {"codigo_unidade": "0"}]
    assert [tuple(r) for r in build(spark, rows).unidades_notificadoras.collect()] == [(100, None, 2, 3509502)]


def test_regions_are_numbered_in_order(spark):
    rows = [{"codigo_regional": "4.6"}, {"codigo_regional": "2"}, {"uf_notificacao": "33"}, {"uf_notificacao": "77"}]
    got = [tuple(r) for r in build(spark, rows).regionais_saude.orderBy("regional_saude_id").collect()]
    assert got == [(1, 1, 33), (2, 2, 35), (3, 5, 35)]


def test_ambiguous_prefix_fails_only_when_asked(spark):
    towns = [*TOWNS, ("35", "São Paulo", "3550309", "Outra")]
    quiet = build(spark, [{"municipio_residencia": "350950"}], towns)
    assert quiet.pacientes("municipio_id").first()[0] == 3509502
    with pytest.raises(PySparkException, match="more than one match"):
        build(spark, [{}], towns).pacientes("municipio_id").collect()


def test_malformed_gazetteer_code_fails(spark):
    with pytest.raises(PySparkException):
        build(spark, [{}], [("35", "São Paulo", "abc", "x")]).municipios.collect()


def test_one_patient_and_one_case_per_record(spark):
    s = model.silver(spark, SF)
    n = s.bronze.count()
    assert s.pacientes().count() == s.notificacoes_casos().count() == n


def test_base_from_records_equals_joined_base(spark):
    s = model.silver(spark, SF)
    joined = build_base(s.notificacoes_casos(), s.pacientes(), s.ufs)
    direct = s.base(*joined.columns)
    assert joined.exceptAll(direct).count() == direct.exceptAll(joined).count() == 0


@pytest.mark.parametrize("width", [1, 3, 1 << 20])
def test_dense_id(spark, width):
    df = spark.range(0, 500, 7).withColumn("key", F.col("id") * F.col("id") - 90)
    got = dense_id(df, "key", "n", width).orderBy("key").select("n").collect()
    assert [r[0] for r in got] == list(range(1, 73))


def test_large_lookup_spreads_hot_and_null_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(9000).withColumn("k", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")))
        dim = spark.range(100).withColumnRenamed("id", "key")
        got = resolve_large(df, "found", F.col("k"), dim, "key")
        assert got.count() == 9000
        assert got.filter("found = 7").count() == 3001
        assert got.filter("found IS NOT NULL AND found <> 7").count() == 32
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
