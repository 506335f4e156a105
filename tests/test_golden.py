"""Golden date dimension: 2020-01-02 .. 2022-01-06 (the reference's checked-in output)."""

import datetime as dt

from pyspark.sql import functions as F

from casestar.operators import dimensions as D


def test_date_dimension_golden(spark):
    facts = spark.createDataFrame([(dt.date(2020, 1, 2),), (dt.date(2022, 1, 6),)], "Meldedatum date")
    time = D.date_dim(facts)
    rows = time.orderBy("Datum").collect()
    assert len(rows) == 736
    assert (rows[0].Datum, rows[0].id_time, rows[-1].Datum, rows[-1].id_time) == (
        dt.date(2020, 1, 2), 0, dt.date(2022, 1, 6), 735)
    assert {r.ones for r in rows} == {1}
    counts = {r[0]: r[1] for r in time.groupBy("time_cat").count().collect()}
    assert [counts[k] for k in sorted(counts)] == [59, 92, 122, 151, 92, 122, 70, 21, 7]
    first = {r[0]: r[1] for r in time.groupBy("time_cat").agg(F.min("Datum")).collect()}
    assert first["7: 09.2021 - vor 4 Wochen"] == dt.date(2021, 10, 1)
    assert first["8: vor 4 Wochen - vor 1er Woche"] == dt.date(2021, 12, 10)
    assert first["9: letze Woche"] == dt.date(2021, 12, 31)
