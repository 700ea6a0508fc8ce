"""Extract helpers (S4, S5) and the priority CSV order (S8, W2) on literal frames."""
from pyspark.sql import functions as F

from roadrisk.sources.files import read_priorities_csv, write_priorities_csv
from roadrisk.sources.tables import chunk_summary, extract_by_period, partitioned_extract


def test_id_range_chunks_last_open_ended(spark):
    df = spark.range(1, 101).select(F.col("id").alias("OBJECTID"))
    got = {r.chunk: (r.rows, r.min_id, r.max_id)
           for r in chunk_summary(partitioned_extract(df, size=30, lo=1, hi=61)).collect()}
    # chunks of 30 ids from 1; everything from id 61 on falls in the last, open-ended chunk
    assert got == {0: (30, 1, 30), 1: (30, 31, 60), 2: (40, 61, 100)}


def test_yearly_and_monthly_slices(spark):
    rows = [(2015, 3), (2021, 12), (2022, 1), (2022, 8), (2022, 9), (2014, 5)]
    df = spark.createDataFrame(rows, "ANO_OCURRENCIA_ACC int, MES_NRO_OCURRENCIA_ACC int")
    got = sorted(r.slice for r in extract_by_period(df, list(range(2015, 2022)), 2022, list(range(1, 9))).collect())
    assert got == ["M2022-01", "M2022-08", "Y2015", "Y2021"]


def test_priorities_csv_is_sorted_report(spark, tmp_path):
    cols = ("MVINOMBRE string, HORARIO string, accidentes long, muertes long, heridos long, "
            "muertes_vulnerables long, heridos_vulnerables long, vulnerables int, label int, Prioridad string")
    rows = [("B", "Nocturno 2-5", 5, 1, 2, 1, 1, 2, 2, "1 Priorizado"),
            ("A", "Nocturno 2-5", 9, 0, 3, 0, 2, 1, 0, "3 NA"),
            ("C", "Nocturno 2-5", 7, 3, 2, 2, 1, 2, 2, "1 Priorizado"),
            ("D", "Nocturno 2-5", 1, 0, 1, 0, 0, 0, 1, "2 Complementario")]
    write_priorities_csv(spark.createDataFrame(rows, cols), str(tmp_path / "p"))
    files = list((tmp_path / "p").glob("part-*.csv"))
    assert len(files) == 1  # one file, header, report order
    lines = files[0].read_text().splitlines()
    assert lines[0].startswith("MVINOMBRE,HORARIO")
    assert [ln.split(",")[0] for ln in lines[1:]] == ["C", "B", "D", "A"]
    assert read_priorities_csv(spark, str(tmp_path / "p")).count() == 4
