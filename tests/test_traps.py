"""Literal fixtures for the semantic traps (FIXTURES.md §5)."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from casestar.functions import columns as C
from casestar.operators import aggregate as A
from casestar.operators import checks as CK
from casestar.operators import dimensions as D
from casestar.operators import facts as FA
from casestar.operators import joins as J
from casestar.operators import measures as M
from casestar.operators import series as S
from casestar.sources import readers as RD


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_null_key_sum(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None), ("b", None)], "k string, v bigint")
    assert rows(A.sum_by(df, ["k"], ["v"]), "k", "v") == [("a", 1), ("b", 0)]


def test_null_key_count_kept_and_sorted(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None), ("b", None)], "k string, v bigint")
    out = A.groupby_count_desc(df, ["k"]).collect()
    assert [r["count"] for r in out] == [2, 1, 1]
    assert {r["k"] for r in out} == {"a", "b", None}


def raw_reports(spark, rows_):
    return spark.createDataFrame(rows_, (
        "IdBundesland bigint, Bundesland string, IdLandkreis bigint, Landkreis string, "
        "Meldedatum string, Altersgruppe string, Geschlecht string, AnzahlFall bigint, "
        "AnzahlTodesfall bigint, AnzahlGenesen bigint"))


def test_retired_code_merges(spark):
    raw = raw_reports(spark, [
        (5, "NRW", 5354, "LK Aachen", "2020/03/01 00:00:00", "A15-A34", "M", 3, 1, 0),
        (5, "NRW", 5334, "StadtRegion Aachen", "2020/3/1 0:0:0", "A15-A34", "M", 2, 0, 1),
    ])
    out = FA.normalise_and_sum(raw).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.IdLandkreis, r.Landkreis, r.Meldedatum) == ("05334", "StadtRegion Aachen",
                                                          dt.date(2020, 3, 1))
    assert (r.AnzahlFall, r.AnzahlTodesfall, r.AnzahlGenesen) == (5, 1, 1)


def test_code_padding_never_truncates(spark):
    df = spark.createDataFrame([(8436,), (11000,), (123456,), (None,)], "c bigint")
    out = [r[0] for r in df.select(C.pad_code("c")).collect()]
    assert out == ["08436", "11000", "123456", None]


def test_unpadded_date_and_two_digit_year(spark):
    df = spark.createDataFrame([("2020/1/5 0:0:0", "3/7/97", "1/5/20")], "a string, b string, c string")
    r = df.select(C.parse_date("a"), C.parse_date("b", "m/d/y"), C.parse_date("c", "m/d/y")).first()
    assert tuple(r) == (dt.date(2020, 1, 5), dt.date(1997, 3, 7), dt.date(2020, 1, 5))


def test_bad_date_raises_or_rejects(spark):
    raw = raw_reports(spark, [(1, "S", 1001, "D", "zzz", "A80+", "W", 1, 0, 0)])
    with pytest.raises(Exception):
        FA.case_facts(raw).collect()
    assert FA.reject_rows(raw).count() == 1
    assert FA.normalise_and_sum(raw, on_error="null").count() == 0


def test_unknown_and_unmapped_age(spark):
    df = spark.createDataFrame([("unbekannt",), ("A99",)], "Altersgruppe string")
    df = df.withColumn("Altersgruppe", C.recode("Altersgruppe", {C.UNKNOWN_TEXT: C.UNKNOWN_LABEL}))
    out = dict((r[0], r[1]) for r in df.select("Altersgruppe", C.midpoint("Altersgruppe")).collect())
    assert out == {"keine Information": 44.5, "A99": None}


def test_null_safe_outer_join(spark):
    a = spark.createDataFrame([(None, "a")], "k string, x string")
    b = spark.createDataFrame([(None, "b")], "k string, y string")
    assert J.outer_join(a, b, on=["k"], null_safe=True).count() == 1
    assert J.outer_join(a, b, on=["k"]).count() == 2


def test_duplicate_keys_count_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    got = {(r["k"], r["count"]) for r in CK.duplicate_keys(df, ["k"]).collect()}
    assert got == {("a", 2), (None, 2)}


def _tiny_facts(spark):
    base = [(1, "S1", "01001", "D1"), (1, "S1", "01002", "D2"), (2, "S2", "02001", "D3")]
    data = []
    for i, (s, sn, g, gn) in enumerate(base):
        data.append((s, sn, g, gn, dt.date(2020, 1, 1 + i), "A80+", "W", "Aktiv", i + 1))
    data.append((1, "S1", "01001", "D1", dt.date(2020, 1, 5), "A80+", "W", "Aktiv", 0))
    return spark.createDataFrame(data, (
        "IdBundesland bigint, Bundesland string, IdLandkreis string, Landkreis string, "
        "Meldedatum date, Altersgruppe string, Geschlecht string, Status string, Anzahl bigint"))


def test_ids_and_zero_only_day(spark):
    facts = _tiny_facts(spark)
    time = D.date_dim(facts)
    assert time.count() == 5  # 2020-01-05 has only a zero count and is kept
    bridge = D.geo_time_keys(D.geo_dim(facts), time)
    got = {(r.IdLandkreis, r.id_time): (r["id_lk_time"], r["index"], r["id_bl_time"]) for r in bridge.collect()}
    assert sorted(v[0] for v in got.values()) == list(range(15))
    assert sorted({v[2] for v in got.values()}) == list(range(10))
    assert [got[("02001", t)][1] for t in range(5)] == [10, 11, 12, 13, 14]
    assert [got[("01002", t)][1] for t in range(5)] == [0, 1, 2, 3, 4]


def test_sparse_export_keeps_negatives(spark):
    facts = _tiny_facts(spark).withColumn(
        "Anzahl", F.when(F.col("IdLandkreis") == "01002", F.lit(-1)).otherwise(F.col("Anzahl")))
    out = FA.star_facts(facts)
    assert sorted(r.Anzahl for r in out.collect()) == [-1, 1, 3]
    bridge = D.geo_time_keys(D.geo_dim(facts), D.date_dim(facts))
    dense = FA.densify(D.dense_span(bridge, facts), facts)
    assert dense.count() == 15
    assert rows(dense.filter("Anzahl <> 0"), "id_lk_time", "Anzahl") == rows(out, "id_lk_time", "Anzahl")


def test_period_buckets(spark):
    df = spark.createDataFrame([(dt.date(2021, 12, 9),), (dt.date(2021, 12, 10),),
                                (dt.date(2021, 12, 30),), (dt.date(2021, 12, 31),)], "d date")
    out = [r[0][:1] for r in df.select(C.period_bucket("d", F.lit(dt.date(2022, 1, 6)))).collect()]
    assert out == ["7", "8", "8", "9"]


def test_row_lag_is_rows_not_days(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1), 10), (1, dt.date(2020, 1, 2), 20),
                                (1, dt.date(2020, 1, 9), 90)], "k int, d date, v bigint")
    out = S.lag_by(df, "k", "d", ["v"], 1).orderBy("d").collect()
    assert [r.lag_1_v for r in out] == [0, 10, 20]


@pytest.mark.parametrize("ys,expected", [
    ([None, 10, None, 30, None], [0.0, 10.0, 20.0, 30.0, 40.0]),
    ([10, 2, None, None], [10.0, 2.0, 0.0, 0.0]),
    ([None, 5, None], [None, 5.0, 5.0]),
    ([None, None], [None, None]),
])
def test_interpolation(spark, ys, expected):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1 + i), y) for i, y in enumerate(ys)],
                               "k int, d date, y bigint")
    out = S.interpolate(df, "k", "d", "y", "z").orderBy("d").collect()
    assert [r.z for r in out] == expected


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double")
    assert [r[0] for r in df.select(F.bround("x", 0)).collect()] == [0.0, 2.0, 2.0]


def test_growth_and_positivity_on_zero(spark):
    df = spark.createDataFrame([(3, 0, 3, 0)], "confirmed bigint, lag_1_confirmed bigint, c bigint, t bigint")
    assert M.growth(df, [], ["confirmed"], 1).first()[0] == 0.0
    assert M.ratio(df, [], "c", "t").first()[0] is None


def test_rekey_properties(spark):
    df = spark.createDataFrame([Row(g=[Row(type="P", properties=Row(rs="1", other="2"))])])
    out = df.select(F.to_json(C.rekey_properties("g", {"IDLandkreis": "rs"})[0]["properties"])).first()[0]
    assert out == '{"IDLandkreis":"1"}'


def test_cross_has_no_size_limit(spark):
    a = spark.range(3)
    b = spark.range(12_000).withColumnRenamed("id", "x")
    out = J.cross(a, b)
    assert out.count() == 36_000 and out.distinct().count() == 36_000
    assert J.cross(a, b.limit(0)).count() == 0


def test_span_with_many_category_values(spark):
    facts = spark.range(10_500).select(
        F.concat(F.lit("v"), "id").alias("Altersgruppe"), F.lit("M").alias("Geschlecht"), F.lit("Aktiv").alias("Status"))
    span = D.dense_span(spark.range(2).withColumnRenamed("id", "id_lk_time"), facts)
    assert span.count() == 21_000


@pytest.mark.parametrize("partitions", [1, 2, 4, 8, 200])
def test_row_ids_are_dense_and_ordered(spark, partitions):
    path = "/root/testdata/sf0.1/customer.parquet"
    c = spark.read.parquet(path).select("c_custkey").repartition(5)
    ids = [tuple(r) for r in D.with_row_id(c, ["c_custkey"], "i", partitions).orderBy("c_custkey").collect()]
    assert [i for _, i in ids] == list(range(len(ids)))


def _two_names(spark):
    rows = [(5, "S", code, name, "2020/03/01 00:00:00", "A00-A04", "M", n, 0, 0)
            for code, name, n in ((5334, "LK Aachen", 8), (5354, "Other", 9))]
    return spark.createDataFrame(rows, RD.CASE_FACTS_SCHEMA)


def test_a_district_with_two_names_fails(spark):
    facts = FA.case_facts(_two_names(spark))
    for make in (lambda: FA.star_facts(facts), lambda: D.geo_dim(facts),
                 lambda: D.geo_time_keys(D.geo_dim(facts), D.date_dim(facts))):
        with pytest.raises(Exception, match="geography"):
            make().collect()


def test_a_lookup_with_two_rows_for_a_key_fails(spark):
    facts = FA.case_facts(_two_names(spark).limit(1))
    twice = spark.createDataFrame([("05334", 1), ("05334", 2)], "rs string, population long")
    with pytest.raises(Exception, match="district lookup"):
        D.geo_dim(facts, twice).collect()


def test_star_keeps_the_sum(spark, small_dir):
    from casestar.plans import testviews as TV
    facts = FA.case_facts(TV.case_reports(spark, small_dir))
    assert FA.star_facts(facts).agg(F.sum("Anzahl")).first() == facts.agg(F.sum("Anzahl")).first()


def test_facts_are_read_by_header_name(spark, tmp_path):
    names = [f.name for f in RD.CASE_FACTS_SCHEMA.fields]
    order = ["ObjectId", *reversed(names), "Refdatum"]
    row = dict(zip(names, ["5", "Süd", "5001", 'D ""x"", y', "2020/03/01 00:00:00", "A00-A04", "M", "7", "1", "2"],
                   strict=True), ObjectId="9", Refdatum="z")
    text = ",".join(order) + "\n" + ",".join(f'"{row[c]}"' for c in order) + "\n"
    (tmp_path / "f.csv").write_text(text, encoding="utf-8")
    got = RD.read_facts(spark, str(tmp_path / "f.csv")).first()
    assert (got.Landkreis, got.AnzahlFall, got.AnzahlTodesfall, got.AnzahlGenesen) == ('D "x", y', 7, 1, 2)
    (tmp_path / "g.csv").write_text("A,B\n1,2\n")
    with pytest.raises(ValueError, match="AnzahlFall"):
        RD.read_facts(spark, str(tmp_path / "g.csv"))


def test_lookup_in_a_legacy_code_page(spark, tmp_path):
    (tmp_path / "k.tsv").write_bytes("krs17\tname\tkreis_id\r\nGöttingen\tx\t3159\r\n".encode("latin-1"))
    got = RD.read_categories(spark, str(tmp_path / "k.tsv"), RD.CATEGORIES_SCHEMA).first()
    assert (got.kreis_id, got.krs17) == ("03159", "Göttingen")


def test_null_keys_match_in_the_country_lookup(spark):
    from casestar.plans import feeds as FD
    base = spark.createDataFrame([(0, 1, None, "X", None, "XXX")],
                                 "kind int, key long, Province_State string, Country_Region string, iso2 string, iso3 string")
    names = spark.createDataFrame([("X", "x")], "country_region string, country_region_map string")
    groups = spark.createDataFrame([(None, "G")], "iso2 string, country_group string")
    keys = spark.createDataFrame([("X", "")], "country_region string, province_state string")
    assert FD.country_lookup(base, names, groups, keys).first().country_group == "G"


def test_long_series_interpolates_in_linear_time(spark):
    import time
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("t"),
                                    F.when(F.col("id") % 7 == 0, F.col("id") * 2).alias("v"))
    began = time.time()
    out = S.interpolate(df, "k", "t", "v")
    assert out.filter(F.abs(F.col("interpolated") - 2 * F.col("t")) > 1e-6).count() == 0
    assert time.time() - began < 60
