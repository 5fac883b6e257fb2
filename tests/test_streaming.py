import datetime as dt

from pyspark.sql import functions as F

from epiframe.operators import ingest
from epiframe.streaming import ingest as streaming
from workload import model

SF = "/root/testdata/sf0.001"


def test_two_runs_equal_one_batch(spark, tmp_path):
    s = model.silver(spark, SF)
    batch = model.arrivals(spark, SF)
    units = s.unidades_notificadoras.select("unidade_id")
    patients = s.pacientes("paciente_id")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def arrive(rows):
        rows.write.mode("append").parquet(source)
        stream = spark.readStream.schema(batch.schema).parquet(source)
        streaming.stream_ingest(stream, patients, units, "chegada", out, str(tmp_path / "cp")).awaitTermination()

    arrive(batch.filter("chegada < 700"))
    arrive(batch.filter("chegada >= 700"))
    checked = ingest.with_reason(batch, patients, units)
    rejected = spark.read.parquet(f"{out}/rejected").select("chegada", "motivo")
    want = checked.filter("motivo IS NOT NULL").select("chegada", "motivo")
    assert rejected.exceptAll(want).count() == want.exceptAll(rejected).count() == 0
    accepted = spark.read.parquet(f"{out}/accepted")
    assert accepted.count() == checked.filter("motivo IS NULL").count()
    assert accepted.select("batch").distinct().count() == 2


def test_weeks_start_on_monday_and_add_up(spark, tmp_path):
    source, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "ts timestamp, classificacao_final string"

    def arrive(*times):
        rows = [(dt.datetime.fromisoformat(t), "Confirmado") for t in times] + [(dt.datetime(2024, 1, 2), "Descartado")]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        streaming.write_weekly(streaming.weekly_confirmed(stream, "ts"), out, cp).awaitTermination()

    arrive("2024-01-01T00:00:00", "2024-01-07T23:59:59", "2024-01-08T00:00:00")
    arrive("2024-01-03T12:00:00")
    got = streaming.weekly_totals(spark.read.parquet(out)).orderBy("semana").collect()
    assert [(r.semana, r.casos) for r in got] == [(dt.date(2024, 1, 1), 3), (dt.date(2024, 1, 8), 1)]


def test_late_records_count_in_their_week(spark, tmp_path):
    source, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def arrive(day):
        spark.createDataFrame([(dt.datetime.fromisoformat(day),)], "ts timestamp").write.mode("append").parquet(source)
        stream = spark.readStream.schema("ts timestamp").parquet(source)
        streaming.write_weekly(streaming.weekly_rows(stream, "ts"), out, cp).awaitTermination()

    for day in ("2024-01-01", "2024-06-03", "2024-01-02"):
        arrive(day)
    got = streaming.weekly_totals(spark.read.parquet(out)).agg(F.sum("casos")).first()[0]
    assert got == 3
