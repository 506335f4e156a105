"""End-to-end refresh: landed CSV -> snapshot -> star schema -> TSV exports."""

import glob

from casestar.plans import testviews as TV
from casestar.plans.star import run_job


def test_run_job_exports(spark, small_dir, tmp_path):
    raw_path = str(tmp_path / "raw")
    TV.case_reports(spark, small_dir).write.option("header", True).csv(raw_path)
    out = str(tmp_path / "out")
    star = run_job(spark, raw_path, out)
    files = glob.glob(f"{out}/data_time/part-*.csv")
    assert len(files) == 1
    data = open(files[0], "rb").read()
    assert data.startswith(b"\xef\xbb\xbfDatum\tid_time\tones\ttime_cat\r\n")
    assert data.count(b"\r\n") == star.data_time.count() + 1
    first_row = data.split(b"\r\n")[1].split(b"\t")
    assert len(first_row[0]) == 10  # yyyy-MM-dd, no time part
    rki = spark.read.option("sep", "\t").option("header", True).csv(f"{out}/data_rki")
    assert rki.count() == star.data_rki.count() > 0
    assert rki.filter("Anzahl = '0'").count() == 0
