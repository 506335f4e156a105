"""Invariants of the star schema on the driver's smallest tables."""

from pyspark.sql import functions as F

from casestar.operators import dimensions as D
from casestar.operators import facts as FA
from casestar.plans import testviews as TV
from casestar.plans.star import build_star


def test_star_schema_invariants(spark, small_dir):
    raw = TV.case_reports(spark, small_dir)
    star = build_star(raw, TV.districts(spark, small_dir), TV.district_category(spark, small_dir))
    facts = star.facts
    n_geo, n_days = star.data_geo.count(), star.data_time.count()
    n = {c: facts.select(c).distinct().count() for c in D.SPAN_VALUES}
    span = D.dense_span(star.data_geo_time, facts)
    assert span.count() == n_geo * n_days * n["Altersgruppe"] * n["Geschlecht"] * n["Status"]
    assert n["Status"] == 3

    dense = FA.densify(span, facts)
    assert dense.agg(F.sum("Anzahl")).first()[0] == facts.agg(F.sum("Anzahl")).first()[0]

    ids = [r[0] for r in star.data_geo_time.select("id_lk_time").orderBy("id_lk_time").collect()]
    assert ids == list(range(n_geo * n_days))

    # active + deaths + recovered = cases, per key
    wide = FA.normalise_and_sum(raw)
    per_key = facts.groupBy(*FA.FACT_KEYS).agg(F.sum("Anzahl").alias("s"))
    bad = per_key.join(wide, FA.FACT_KEYS).filter(F.col("s") != F.col("AnzahlFall"))
    assert bad.count() == 0

    # the sparse export equals the non-zero rows of the dense one
    sparse = star.data_rki
    assert sparse.exceptAll(dense.filter("Anzahl <> 0")).count() == 0
    assert dense.filter("Anzahl <> 0").exceptAll(sparse).count() == 0

    assert star.data_max_date.first()[0] == facts.agg(F.max("Meldedatum")).first()[0]
