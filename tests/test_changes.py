import datetime as dt

import pytest
from pyspark.sql import functions as F

from epiframe.contracts import SILVER
from epiframe.operators import audit, dedup, ingest, quality
from workload import model

SF = "/root/testdata/sf0.001"
D = dt.date


def cases_frame(spark, rows):
    return spark.createDataFrame(
        rows, "notificacao_id long, paciente_id long, data_notificacao date, data_primeiros_sintomas date, uf_provavel_infeccao smallint, nduplic boolean"
    )


def test_duplicates_with_missing_keys(spark):
    cases = cases_frame(spark, [
        (1, 1, D(2020, 1, 5), D(2020, 1, 1), None, False),
        (2, 2, D(2020, 1, 4), D(2020, 1, 1), None, False),
        (3, 3, None, D(2020, 1, 1), None, False),
        (4, 4, D(2020, 1, 4), D(2020, 1, 1), 35, False),
        (5, 9, D(2020, 1, 6), D(2020, 1, 1), None, False),
        (6, 5, D(2020, 1, 9), D(2020, 1, 1), None, True),
    ])
    patients = spark.createDataFrame([(i, "Feminino", None) for i in range(1, 6)], "paciente_id long, sexo string, municipio_id int")
    marked = dedup.mark_duplicates(cases, patients)
    assert dedup.count_marked(marked).first()[0] == 2
    assert {r.notificacao_id for r in marked.collect() if r.marcado} == {1, 3}
    again = dedup.mark_duplicates(marked.drop("marcado"), patients)
    assert dedup.count_marked(again).first()[0] == 0
    assert again.columns == [*cases.columns, "marcado"]


def test_duplicates_one_hot_group_is_combined_before_the_shuffle(spark):
    s = model.silver(spark, SF)
    base = s.base("notificacao_id", "data_notificacao", "data_primeiros_sintomas", "uf_provavel_infeccao", "nduplic", "sexo", "municipio_id")
    plan = dedup.first_of_group(base)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


ARRIVING = (
    "chegada long, paciente_id long, data_notificacao date, semana_notificacao smallint, unidade_id int, regional_notificacao long, "
    "data_primeiros_sintomas date, semana_primeiros_sintomas smallint, classificacao_final string, uf_provavel_infeccao smallint, "
    "municipio_provavel_infeccao int"
)


def arrivals(spark, rows):
    full = [(i, p, D(2020, 1, 5), 1, u, None, s, 1, c, 35, None) for i, (p, u, s, c) in enumerate(rows, 1)]
    return spark.createDataFrame(full, ARRIVING)


def test_ingest_rules_in_order(spark):
    ok, late = D(2020, 1, 1), D(2020, 2, 1)
    batch = arrivals(spark, [
        (99, 88, late, "X"), (99, 88, late, "Confirmado"), (99, 88, ok, "Confirmado"), (1, 88, ok, "Confirmado"),
        (1, None, None, None), (1, 7, ok, "Descartado"),
    ])
    patients = spark.createDataFrame([(1,), (2,)], "paciente_id long")
    units = spark.createDataFrame([(7,)], "unidade_id int")
    known = spark.createDataFrame([(40,)], "notificacao_id long")
    split = ingest.validate_ingest(batch, patients, units, "chegada", known)
    assert {r.chegada: r.motivo for r in split.rejected.collect()} == {
        1: "invalid classification", 2: "symptoms after notification", 3: "unknown patient", 4: "unknown unit"}
    accepted = {r.notificacao_id: r for r in split.accepted.collect()}
    assert set(accepted) == {41, 42}
    assert accepted[41].classificacao_final == "Inconclusivo"
    assert (accepted[42].autoctonia, accepted[42].evolucao_caso, accepted[42].nduplic) == ("Indeterminado", "Ignorado", False)


def test_ingest_splits_the_batch_whole(spark):
    s = model.silver(spark, SF)
    batch = model.arrivals(spark, SF)
    split = ingest.validate_ingest(batch, s.pacientes("paciente_id"), s.unidades_notificadoras, "chegada")
    assert split.accepted.count() + split.rejected.count() == batch.count()


def test_closures(spark):
    cases = spark.createDataFrame([(1, D(2020, 1, 5)), (2, None)], "notificacao_id long, data_notificacao date")
    closures = spark.createDataFrame(
        [(1, 1, D(2020, 1, 4)), (2, 1, D(2020, 1, 5)), (3, 9, D(2020, 1, 9)), (4, 2, D(2020, 1, 9)), (5, 1, None)],
        "caso_encerrado_id long, notificacao_id long, data_encerramento date")
    got = {r.caso_encerrado_id: r.motivo for r in quality.validate_closures(closures, cases).collect()}
    assert got == {1: "closure before notification", 2: None, 3: "missing case", 4: "missing case", 5: None}


def test_deaths(spark):
    cases = spark.createDataFrame([(1, "Cura"), (2, "Óbito por outra causa")], "notificacao_id long, evolucao_caso string")
    deaths = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "obito_id long, notificacao_id long")
    got = {r.obito_id: r.motivo for r in quality.validate_deaths(deaths, cases).collect()}
    assert got == {1: "outcome is not a death", 2: None, 3: "missing case"}


def test_outcome_updates(spark):
    updates = spark.createDataFrame(
        [(1, "Cura"), (2, None), (3, "Cura"), (1, "Óbito pelo agravo")], "notificacao_id long, evolucao_caso string")
    deaths = spark.createDataFrame([(1,), (1,), (2,)], "notificacao_id long")
    got = sorted((r.notificacao_id, str(r.evolucao_caso), r.motivo) for r in quality.validate_evolution_updates(updates, deaths).collect())
    assert got == [(1, "Cura", "linked death row"), (1, "Óbito pelo agravo", None), (2, "None", None), (3, "Cura", None)]


def test_audit_log_replays(spark):
    schema = "k long, a string, b date"
    old = spark.createDataFrame([(1, "x", None), (2, "y", D(2020, 1, 1)), (3, "z", None)], schema)
    new = spark.createDataFrame([(1, "x", None), (2, None, D(2020, 1, 1)), (4, "w", None)], schema)
    log = audit.audit_diff(old, new, "k", "silver", "t")
    rows = {r.chave: r for r in log.collect()}
    assert {k: r.operacao for k, r in rows.items()} == {2: "UPDATE", 3: "DELETE", 4: "INSERT"}
    assert rows[2].dados_novos == '{"k":2,"a":null,"b":"2020-01-01"}'
    assert rows[3].dados_novos is None and rows[4].dados_antigos is None and rows[2].usuario_banco
    rebuilt = audit.replay(old, log, "k")
    assert rebuilt.exceptAll(new).count() == new.exceptAll(rebuilt).count() == 0


def test_contract_checks(spark):
    df = spark.createDataFrame([(1, "abc"), (1, None), (2, "abcd")], "id int, t string")
    assert [tuple(r) for r in quality.check_unique(df, ["id"]).collect()] == [(1, 2)]
    parent = spark.createDataFrame([(1,)], "p int")
    assert [tuple(r) for r in quality.check_fk(df, "id", parent, "p").collect()] == [(2, 1)]
    assert quality.check_not_null(df, "x", ["id", "t"]).filter("coluna = 't'").first().n_violacoes == 1
    assert quality.check_length(df, "x", {"t": 3}).first().n_violacoes == 1


def test_fk_breaches_of_every_declared_reference(spark):
    refs = SILVER["notificacoes_casos"].refs
    child = spark.range(1).select(*[F.lit(i + 1).cast("long").alias(r.column) for i, r in enumerate(refs)])
    tables = {r.parent: spark.createDataFrame([], f"{SILVER[r.parent].key} long") for r in refs} | {"notificacoes_casos": child}
    got = quality.fk_breaches(tables, ["notificacoes_casos"]).collect()
    assert sorted(map(tuple, got)) == sorted(("notificacoes_casos", r.column, i + 1, 1) for i, r in enumerate(refs))


def test_duplicates_broadcast_no_patients(spark):
    s = model.silver(spark, SF).settle()
    marked = dedup.mark_duplicates(s.notificacoes_casos(), s.pacientes())
    for key in ("paciente_id", "notificacao_id"):
        assert f"SortMergeJoin [{key}#" in marked._jdf.queryExecution().executedPlan().toString()


def test_a_patient_with_many_records_has_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(ingest, "SHARE", 10)
    rows = [(i, 7 if i < 400 else None if i < 500 else i) for i in range(600)]
    batch = spark.createDataFrame(rows, "chegada long, paciente_id long")
    patients = spark.createDataFrame([(7,), (501,), (502,), (502,), (None,)], "paciente_id long")
    out = ingest._with_patient(batch, patients)
    shares = {r.p: r.n for r in out.groupBy(F.col("paciente_id").alias("p")).agg(F.count_distinct("__share").alias("n")).collect()}
    assert shares[7] > 30 and shares[None] > 5 and shares[501] == 1
    known = out.filter("__patient IS NOT NULL").groupBy("__patient").count().collect()
    assert {r[0]: r[1] for r in known} == {7: 400, 501: 1, 502: 2} and out.count() == 601  # a patient that stands twice counts twice, as before
