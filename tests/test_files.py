import csv

import pytest
from pyspark.sql import functions as F

from epiframe.contracts import CASE_COLUMNS, GOLD, LOAD_ORDER
from epiframe.plans import dashboard
from epiframe.plans.run import run
from epiframe.sources import bronze, tables
from epiframe.sources.store import Store
from workload import model

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """The derived records as a raw case file and a gazetteer with title lines."""
    root = tmp_path_factory.mktemp("raw")
    cases = model.bronze(spark, SF).orderBy("row_id").collect()
    with open(root / "cases.csv", "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(["extra", *CASE_COLUMNS])
        for r in cases:
            out.writerow(["x", *["" if r[c] is None else r[c] for c in CASE_COLUMNS.values()]])
    towns = model.gazetteer(spark, SF).distinct().collect()
    with open(root / "towns.csv", "w", newline="", encoding="utf-8") as f:
        f.write("\n".join(f"title {i}" for i in range(6)) + "\n")
        out = csv.writer(f)
        out.writerow(["UF", "Nome_UF", "Região", "Código Município Completo", "Nome_Município"])
        for r in towns:
            out.writerow([r.uf_code, r.uf_nome, "r", r.municipio_id, r.municipio_nome])
    return root


def test_record_numbers_follow_file_order(spark, raw):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        df = bronze.read_case_file(spark, str(raw / "cases.csv"))
        assert df.rdd.getNumPartitions() > 4
        text = ["data_notificacao", "codigo_unidade", "data_encerramento"]
        got = [tuple(r) for r in df.orderBy("row_id").select("row_id", *text).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = model.bronze(spark, SF).orderBy("row_id").select("row_id", *[F.nullif(c, F.lit("")) for c in text]).collect()
    assert got == [tuple(r) for r in want]


def test_record_numbers_over_several_files(spark, tmp_path):
    lines = [f"{i}," for i in range(3000)]
    for part in range(3):
        (tmp_path / f"p{part}.csv").write_text("a,b\n" + "\n".join(lines[part * 1000 : part * 1000 + 1000]) + "\n")
    from epiframe.operators.ids import arrival_id

    df = arrival_id(spark.read.csv(str(tmp_path), header=True))
    assert all(r.row_id == int(r.a) + 1 for r in df.collect())


def test_record_numbers_scan_the_text_once(spark, raw, monkeypatch):
    from epiframe.operators import ids

    df = bronze.read_case_file(spark, str(raw / "cases.csv"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in plan and plan.count("FileScan parquet") == 2 and "BroadcastHashJoin" in plan
    monkeypatch.setattr(ids, "SPLITS", 0)
    more = bronze.read_case_file(spark, str(raw / "cases.csv"))
    assert df.exceptAll(more).count() == 0 and more.agg(F.max("row_id")).first()[0] == more.count()


def test_record_numbers_of_an_empty_file(spark, tmp_path):
    (tmp_path / "none.csv").write_text(case_lines())
    assert bronze.read_case_file(spark, str(tmp_path / "none.csv")).count() == 0


def case_lines(*records):
    header = ["extra", *CASE_COLUMNS]
    return "\n".join([",".join(header), *(",".join(r) for r in records)]) + "\n"


def test_broken_records_stop_the_load(spark, tmp_path):
    whole = ["x"] * (len(CASE_COLUMNS) + 1)
    (tmp_path / "short.csv").write_text(case_lines(whole, whole[:5], whole))
    (tmp_path / "quoted.csv").write_text(case_lines(whole, [*whole[:3], '"two\nlines"', *whole[4:]], whole))
    for name in ("short", "quoted"):
        with pytest.raises(Exception, match="MALFORMED|Malformed"):
            bronze.read_case_file(spark, str(tmp_path / f"{name}.csv"), with_id=False).select("data_notificacao").collect()
    kept = bronze.read_case_file(spark, str(tmp_path / "quoted.csv"), with_id=False, multi_line=True)
    assert kept.count() == 3 and "two\nlines" in [v for r in kept.collect() for v in r]


def test_a_cluster_must_name_the_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from epiframe.session import shared_dir

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(far)


def test_gazetteer_header_is_found(spark, raw):
    df = bronze.read_gazetteer(spark, str(raw / "towns.csv"))
    assert df.columns == ["uf_code", "uf_nome", "municipio_id", "municipio_nome"]
    want = model.gazetteer(spark, SF).distinct()
    assert df.exceptAll(want).count() == want.exceptAll(df).count() == 0
    with pytest.raises(LookupError):
        bronze.gazetteer_columns(["UF", "Nome_UF"])


def test_strict_load_refuses_and_publishes_nothing(spark, tmp_path):
    with pytest.raises(tables.ContractError) as error:
        tables.load_silver(spark, model.silver(spark, SF), str(tmp_path))
    rules = {(t, c, r) for t, c, r, _ in error.value.violations}
    assert ("paises", "pais_id", "unique") in rules
    assert ("notificacoes_casos", "data_notificacao", "not null") in rules
    assert Store(spark, str(tmp_path)).versions() == []


def test_clean_tables_load_strictly_and_refresh(spark, tmp_path):
    s = model.silver(spark, SF)
    t = s.tables()
    t["paises"] = t["paises"].dropDuplicates(["pais_id"])
    t["pacientes"] = t["pacientes"].fillna({"idade_codificada": 4000})
    dated = t["notificacoes_casos"].dropna(
        subset=["data_notificacao", "semana_notificacao", "data_primeiros_sintomas", "semana_primeiros_sintomas"]
    )
    t["notificacoes_casos"] = dated
    for child, day in (("obitos", "data_obito"), ("casos_encerrados", "data_encerramento")):
        t[child] = t[child].dropna(subset=[day]).join(dated.select("notificacao_id"), "notificacao_id", "left_semi").select(t[child].columns)
    first = tables.load_silver(spark, t, str(tmp_path))
    assert tables.load_silver(spark, t, str(tmp_path)) == first
    store = Store(spark, str(tmp_path))
    assert store.versions() == [1, 2]
    judged = tables.held_back(spark, str(tmp_path)).groupBy("tabela", "motivo").count().collect()
    assert {r.motivo for r in judged} == {None, "closure before notification", "outcome is not a death"}
    assert {r.tabela: r["count"] for r in judged if r.motivo is None} == {n: first[n] for n in tables.HELD_BACK}
    with pytest.raises(tables.ContractError, match="outcome is not a death"):
        tables.load_silver(spark, t, str(tmp_path), invalid="refuse")
    assert store.versions() == [1, 2]
    loaded = tables.published(spark, str(tmp_path))
    assert {n: df.count() for n, df in loaded.items()} == first
    assert tables.violations(loaded).filter("n_violacoes > 0").count() == 0


def test_blank_text_becomes_null(spark):
    assert tables.blank_as_null(spark.createDataFrame([("", 1)], "a string, b int")).first()[0] is None


def test_whole_run_from_files_to_gold(spark, raw, tmp_path):
    root = str(tmp_path / "store")
    counts = run(spark, str(raw / "cases.csv"), str(raw / "towns.csv"), str(tmp_path / "bronze"), root, study=model.STUDY, strict=False, restarts=2)
    assert set(counts) == {"bronze", "base", *LOAD_ORDER, *GOLD}
    assert Store(spark, root).versions() == [1]  # silver, base and gold came together
    silver = tables.published(spark, root)
    direct = model.silver(spark, SF).tables()
    for name in LOAD_ORDER:
        assert counts[name] == silver[name].count()
        assert direct[name].exceptAll(silver[name]).count() == 0, name
    gold = tables.published(spark, root, GOLD)
    assert gold["previsao_casos_semanal"].columns == ["ds", "yhat", "yhat_lower", "yhat_upper"]
    assert gold["previsao_casos_semanal"].count() == gold["sazonalidade_semanal"].count() + 12
    base = tables.published(spark, root, ["base"])["base"]
    joined = dashboard.build_base(silver["notificacoes_casos"], silver["pacientes"], silver["ufs"])
    assert joined.columns and joined.exceptAll(base.select(joined.columns)).count() == 0
    core = dashboard.insights_core(
        base, gold["sazonalidade_semanal"], gold["perfil_sazonal_semana_epi"], gold["previsao_casos_semanal"],
        gold["tendencia_casos_uf"], gold["clusters_municipios"],
    )
    assert dashboard.insights_selected(core).count() >= 4


def test_bucketed_join_needs_no_shuffle(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bucketed LOCATION '{tmp_path}'")
    t = model.silver(spark, SF)
    tables.write_bucketed({"pacientes": t.table("pacientes"), "notificacoes_casos": t.table("notificacoes_casos")}, "bucketed", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed.notificacoes_casos").join(spark.table("bucketed.pacientes"), "paciente_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE bucketed CASCADE")
