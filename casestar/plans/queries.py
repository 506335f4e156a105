"""Registered queries over the driver's tables, one per SURVEY §2 key.

Each builder runs the library operator on the whole of the reference-shaped
view; each oracle is independent DuckDB SQL over the same tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from casestar import oracle as O
from casestar.functions import columns as C
from casestar.operators import aggregate as A
from casestar.operators import cleaning as CL
from casestar.operators import dimensions as D
from casestar.operators import facts as FA
from casestar.operators import joins as J
from casestar.operators import reshape as R
from casestar.plans import testviews as TV
from casestar.plans.registry import ORACLE, register
from casestar.session import materialize


def _facts(spark, d):
    return FA.case_facts(TV.case_reports(spark, d))


def _shared_facts(spark, d):
    """Long facts written once to the shared checkpoint folder.

    For queries that read the facts several times (bounds, geography, value
    sets, the join): the raw aggregation runs once instead of per reader,
    and a lost executor re-reads files instead of recomputing shuffles.
    """
    return materialize(_facts(spark, d), "facts")


def _bridge(facts):
    """The geo x day bridge of written facts, from one pass over them."""
    summary = materialize(FA.facts_summary(facts), "facts_summary")
    return D.geo_time_keys(D.geo_dim(summary), D.date_dim(_dates(summary)))


def _geo_bounds(spark, d):
    """Per geography the first and last fact date, from the raw rows (no sums)."""
    return FA.geography_dates(TV.case_reports(spark, d))


def _dates(bounds):
    return bounds.select(F.explode(F.array("lo", "hi")).alias("Meldedatum"))


def _dims(spark, d):
    """Geography and date dimensions from one district-sized written summary."""
    summary = materialize(_geo_bounds(spark, d), "geo_bounds")
    return D.geo_dim(summary), D.date_dim(_dates(summary))


# --------------------------------------------------------------- flagship
@register("star_facts", O.sql("SELECT * FROM star", "star"))
def q_star_facts(spark, d):
    return FA.star_facts(_shared_facts(spark, d))


# ------------------------------------------------------------ aggregation
@register("agg_sum_multi", O.sql(f"""
  SELECT {O.FACT_KEYS},
         CAST(COALESCE(SUM(AnzahlFall), 0) AS BIGINT) AS AnzahlFall,
         CAST(COALESCE(SUM(AnzahlTodesfall), 0) AS BIGINT) AS AnzahlTodesfall,
         CAST(COALESCE(SUM(AnzahlGenesen), 0) AS BIGINT) AS AnzahlGenesen
  FROM case_reports
  WHERE IdBundesland IS NOT NULL AND Bundesland IS NOT NULL AND IdLandkreis IS NOT NULL
    AND Landkreis IS NOT NULL AND Meldedatum IS NOT NULL AND Altersgruppe IS NOT NULL
    AND Geschlecht IS NOT NULL
  GROUP BY {O.FACT_KEYS}""", "case_reports"))
def q_agg_sum_multi(spark, d):
    return A.sum_by(TV.case_reports(spark, d), FA.FACT_KEYS, FA.MEASURES)


@register("reagg_after_recode", O.sql("SELECT * FROM facts_wide", "facts_wide"))
def q_reagg_after_recode(spark, d):
    return FA.normalise_and_sum(TV.case_reports(spark, d))


@register("unpivot_measures", O.sql("SELECT * FROM facts", "facts"))
def q_unpivot_measures(spark, d):
    return _facts(spark, d)


@register("status_by_category", O.sql("""
  SELECT Altersgruppe, CAST(COALESCE(SUM(Anzahl), 0) AS BIGINT) AS Anzahl, Status
  FROM facts GROUP BY Altersgruppe, Status""", "facts"))
def q_status_by_category(spark, d):
    return A.rollup_status(_facts(spark, d))


@register("distinct_projection", O.sql(f"SELECT DISTINCT {O.GEO_KEYS} FROM facts", "facts"))
def q_distinct_projection(spark, d):
    return A.distinct_of(_geo_bounds(spark, d), D.GEO_KEYS)


@register("global_min_max", O.sql(
    "SELECT MIN(Meldedatum) AS min_date, MAX(Meldedatum) AS max_date FROM facts", "facts"))
def q_global_min_max(spark, d):
    return A.date_bounds(_dates(_geo_bounds(spark, d)), "Meldedatum")


# ------------------------------------------------------------- dimensions
@register("date_spine", O.sql("SELECT * FROM time_dim", "time_dim"))
def q_date_spine(spark, d):
    return D.date_dim(_dates(_geo_bounds(spark, d)))


@register("geo_time_keys", O.sql("SELECT * FROM bridge", "bridge"))
def q_geo_time_keys(spark, d):
    return D.geo_time_keys(*_dims(spark, d))


@register("dense_span", O.sql("SELECT * FROM span", "span"))
def q_dense_span(spark, d):
    facts = _shared_facts(spark, d)
    return D.dense_span(_bridge(facts), facts)


@register("densify_facts", O.sql("SELECT * FROM dense", "dense"))
def q_densify_facts(spark, d):
    facts = _shared_facts(spark, d)
    return FA.densify_packed(_bridge(facts), facts)


# ------------------------------------------------- projections and columns
@register("project_columns", O.sql(
    "SELECT IdBundesland, IdLandkreis, Meldedatum, AnzahlFall FROM case_reports", "case_reports"))
def q_project_columns(spark, d):
    return CL.project(TV.case_reports(spark, d),
                      ["IdBundesland", "IdLandkreis", "Meldedatum", "AnzahlFall"])


@register("drop_columns", O.sql(
    "SELECT * EXCLUDE (Bundesland, Landkreis) FROM case_reports", "case_reports"))
def q_drop_columns(spark, d):
    return CL.drop(TV.case_reports(spark, d), ["Bundesland", "Landkreis"])


@register("rename_columns", O.sql("""
  SELECT IdBundesland, Bundesland, IdLandkreis, Landkreis, Meldedatum, Altersgruppe, Geschlecht,
         AnzahlFall AS cases, AnzahlTodesfall AS deaths, AnzahlGenesen AS recovered
  FROM case_reports""", "case_reports"))
def q_rename_columns(spark, d):
    return CL.rename(TV.case_reports(spark, d), {
        "AnzahlFall": "cases", "AnzahlTodesfall": "deaths", "AnzahlGenesen": "recovered"})


@register("pad_region_code", O.sql(f"""
  SELECT o_orderkey, {O.pad5('o_orderkey').replace('>= 5', '>= 4').replace(', 5,', ', 4,')} AS code4,
         {O.pad5('o_orderkey')} AS code5
  FROM orders"""))
def q_pad_region_code(spark, d):
    o = TV.table(spark, d, "orders")
    return o.select("o_orderkey", C.pad_code("o_orderkey", 4).alias("code4"),
                    C.pad_code("o_orderkey", 5).alias("code5"))


# Fixed values in the SQL below: the unknown label and the renamed districts.
@register("recode_values", O.sql("""
  SELECT DISTINCT Altersgruppe, Geschlecht,
         CASE WHEN Altersgruppe = 'unbekannt' THEN 'keine Information' ELSE Altersgruppe END AS age_label,
         CASE WHEN Geschlecht = 'unbekannt' THEN 'keine Information' ELSE Geschlecht END AS sex_label,
         CASE Landkreis WHEN 'LK Göttingen (alt)' THEN 'LK Göttingen'
              WHEN 'LK Aachen' THEN 'StadtRegion Aachen' ELSE Landkreis END AS district
  FROM case_reports""", "case_reports"))
def q_recode_values(spark, d):
    cr = TV.case_reports(spark, d)
    return cr.select(
        "Altersgruppe", "Geschlecht",
        C.recode("Altersgruppe", {C.UNKNOWN_TEXT: C.UNKNOWN_LABEL}).alias("age_label"),
        C.recode("Geschlecht", {C.UNKNOWN_TEXT: C.UNKNOWN_LABEL}).alias("sex_label"),
        C.recode("Landkreis", C.DISTRICT_NAME_RECODE).alias("district")).distinct()


@register("strip_token", O.sql("""
  SELECT Landkreis, replace(Landkreis, 'NATION_', '') AS district_no, COUNT(*) AS n
  FROM case_reports GROUP BY Landkreis""", "case_reports"))
def q_strip_token(spark, d):
    cr = TV.case_reports(spark, d)
    return cr.groupBy("Landkreis").agg(F.count(F.lit(1)).alias("n")).select(
        "Landkreis", C.strip_token("Landkreis", "NATION_").alias("district_no"), "n")


@register("parse_dates", O.sql("""
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d_ymd_hms, CAST(o_orderdate AS DATE) AS d_ymd,
         CAST(o_orderdate AS DATE) AS d_int, CAST(o_orderdate AS DATE) AS d_mdy
  FROM orders"""))
def q_parse_dates(spark, d):
    o = TV.table(spark, d, "orders")
    ts = F.col("o_orderdate")
    return o.select(
        "o_orderkey",
        C.parse_date(F.date_format(ts, "yyyy/M/d H:m:s"), "Y/m/d H:M:S").alias("d_ymd_hms"),
        C.parse_date(F.date_format(ts, "yyyy-M-d"), "Y-m-d").alias("d_ymd"),
        C.parse_date(F.date_format(ts, "yyyyMMdd").cast("int"), "Ymd").alias("d_int"),
        C.parse_date(F.date_format(ts, "M/d/yy"), "m/d/y").alias("d_mdy"))


@register("category_midpoint", O.sql(f"""
  SELECT DISTINCT age, {O.MIDPOINT_CASE.format(c='age')} AS Alter_Zahl
  FROM (SELECT CASE WHEN Altersgruppe = 'unbekannt' THEN 'keine Information' ELSE Altersgruppe END AS age
        FROM case_reports) x""", "case_reports"))
def q_category_midpoint(spark, d):
    cr = TV.case_reports(spark, d)
    age = cr.select(C.recode("Altersgruppe", {C.UNKNOWN_TEXT: C.UNKNOWN_LABEL}).alias("age"))
    return age.select("age", C.midpoint("age").alias("Alter_Zahl")).distinct()


@register("period_bucket", O.sql(f"""
  SELECT DISTINCT date, {O.PERIOD_CASE.format(d='date', hi='(SELECT MAX(date) FROM daily)')} AS time_cat
  FROM daily""", "daily"))
def q_period_bucket(spark, d):
    ds = TV.daily_series(spark, d)
    top = ds.agg(F.max("date")).scalar()
    return ds.select("date", C.period_bucket("date", top).alias("time_cat")).distinct()


@register("derive_active", O.sql("""
  SELECT IdLandkreis, Meldedatum, Altersgruppe, Geschlecht,
         COALESCE(AnzahlFall, 0) - COALESCE(AnzahlTodesfall, 0) - COALESCE(AnzahlGenesen, 0) AS AnzahlAktiv
  FROM case_reports""", "case_reports"))
def q_derive_active(spark, d):
    cr = TV.case_reports(spark, d)
    return cr.select("IdLandkreis", "Meldedatum", "Altersgruppe", "Geschlecht",
                     C.active_of("AnzahlFall", "AnzahlTodesfall", "AnzahlGenesen")
                     .alias("AnzahlAktiv"))


def _confirmed_vs_tests(spark, d):
    ds = TV.daily_series(spark, d)
    a = ds.filter(F.col("confirmed") != 0).select("lu_id", "date", "confirmed")
    b = ds.filter(F.col("tested") != 0).select("lu_id", "date", "tested")
    return J.outer_join(a, b, on=["lu_id", "date"])


OUTER_SQL = """
  SELECT COALESCE(a.lu_id, b.lu_id) AS lu_id, COALESCE(a.date, b.date) AS date, a.confirmed, b.tested
  FROM (SELECT lu_id, date, confirmed FROM daily WHERE confirmed <> 0) a
  FULL OUTER JOIN (SELECT lu_id, date, tested FROM daily WHERE tested <> 0) b
    ON a.lu_id = b.lu_id AND a.date = b.date"""


@register("join_full_outer", O.sql(OUTER_SQL, "daily"))
def q_join_full_outer(spark, d):
    return _confirmed_vs_tests(spark, d)


@register("fill_defaults", O.sql(
    f"SELECT lu_id, date, COALESCE(confirmed, 0) AS confirmed, COALESCE(tested, -1) AS tested "
    f"FROM ({OUTER_SQL}) x", "daily"))
def q_fill_defaults(spark, d):
    return CL.fill(_confirmed_vs_tests(spark, d), {"confirmed": 0, "tested": -1})


@register("zero_as_missing", O.sql("SELECT * FROM tests_clean", "tests_clean"))
def q_zero_as_missing(spark, d):
    from casestar.plans.series_plan import tests_clean
    return tests_clean(TV.daily_series(spark, d))


@register("constant_column", O.sql(
    "SELECT IdLandkreis, Meldedatum, CAST(1 AS BIGINT) AS ones FROM case_reports", "case_reports"))
def q_constant_column(spark, d):
    cr = CL.project(TV.case_reports(spark, d), ["IdLandkreis", "Meldedatum"])
    return CL.with_constant(cr, "ones", F.lit(1).cast("bigint"))


# ---------------------------------------------------------------- filters
@register("filter_not_equal", O.sql(f"""
  SELECT * FROM (
    SELECT {O.FACT_KEYS}, 'AnzahlFall' AS Status, AnzahlFall AS Anzahl FROM facts_wide
    UNION ALL SELECT {O.FACT_KEYS}, 'AnzahlTodesfall', AnzahlTodesfall FROM facts_wide
    UNION ALL SELECT {O.FACT_KEYS}, 'AnzahlGenesen', AnzahlGenesen FROM facts_wide) x
  WHERE Status <> 'AnzahlFall'""", "facts_wide"))
def q_filter_not_equal(spark, d):
    wide = FA.normalise_and_sum(TV.case_reports(spark, d))
    long = R.measures_to_status(wide, FA.FACT_KEYS, FA.MEASURES, drop_measure=None, token="@")
    return CL.exclude_value(long, "Status", "AnzahlFall")


@register("filter_null_state", O.sql(f"""
  SELECT g.*, d.rs, d.population FROM (SELECT DISTINCT {O.GEO_KEYS} FROM facts) g
  FULL OUTER JOIN districts d ON g.IdLandkreis = d.rs
  WHERE g.IdLandkreis IS NOT NULL""", "facts", "districts"))
def q_filter_null_state(spark, d):
    geo = A.distinct_of(_geo_bounds(spark, d), D.GEO_KEYS)
    dist = TV.districts(spark, d).select("rs", "population")
    return CL.keep_present(J.outer_join(geo, dist, left_on=["IdLandkreis"], right_on=["rs"]),
                           "IdLandkreis")


@register("filter_nonzero", O.sql("SELECT * FROM facts WHERE Anzahl <> 0", "facts"))
def q_filter_nonzero(spark, d):
    return CL.nonzero(_facts(spark, d))


@register("filter_point", O.sql(
    "SELECT * FROM case_reports WHERE Altersgruppe = 'A15-A34' AND Geschlecht = 'M'", "case_reports"))
def q_filter_point(spark, d):
    return CL.point_lookup(TV.case_reports(spark, d), {"Altersgruppe": "A15-A34", "Geschlecht": "M"})


@register("filter_in_list", O.sql(
    "SELECT * FROM case_reports WHERE Altersgruppe IN ('A00-A04', 'A80+', 'unbekannt')",
    "case_reports"))
def q_filter_in_list(spark, d):
    return CL.in_set(TV.case_reports(spark, d), "Altersgruppe", ["A00-A04", "A80+", "unbekannt"])


@register("negative_audit", O.sql("SELECT * FROM customer WHERE c_acctbal < 0"))
def q_negative_audit(spark, d):
    return CL.negative_rows(TV.table(spark, d, "customer"), "c_acctbal")


@register("snapshot_at_max_date", O.sql(
    "SELECT * FROM daily WHERE date = (SELECT MAX(date) FROM daily)", "daily"))
def q_snapshot_at_max_date(spark, d):
    return CL.latest_snapshot(TV.daily_series(spark, d), "date")


# ------------------------------------------------------------------ joins
from casestar.operators import checks as CK  # noqa: E402
from casestar.operators import chunked as CH  # noqa: E402
from casestar.operators import store as ST  # noqa: E402
from casestar.operators import measures as M  # noqa: E402
from casestar.operators import series as S  # noqa: E402
from casestar.plans import series_plan as SP  # noqa: E402


@register("join_left_fact", O.sql("""
  SELECT sp.id_lk_time, sp.Altersgruppe, sp.Geschlecht, sp.Status, f.Anzahl
  FROM span sp LEFT JOIN facts f
    ON sp.IdLandkreis = f.IdLandkreis AND sp.IdBundesland = f.IdBundesland AND sp.Datum = f.Meldedatum
   AND sp.Altersgruppe = f.Altersgruppe AND sp.Geschlecht = f.Geschlecht AND sp.Status = f.Status""",
    "span", "facts"))
def q_join_left_fact(spark, d):
    facts = _shared_facts(spark, d)
    return FA.attach_packed(_bridge(facts), facts).select("id_lk_time", "Altersgruppe", "Geschlecht", "Status", "Anzahl")


@register("join_left_back", O.sql("""
  SELECT t.*, s.tested_announced FROM tests_clean t LEFT JOIN tests_est s
    ON t.lu_id = s.lu_id AND t.date = s.date""", "tests_clean", "tests_est"))
def q_join_left_back(spark, d):
    daily = TV.daily_series(spark, d)
    est = S.ffill(SP.tests_clean(daily), "lu_id", "date", "tested_reported_or_nan",
                  "tested_announced").select("lu_id", "date", "tested_announced")
    return J.attach_series(SP.tests_clean(daily), est, ["lu_id", "date"])


@register("join_cross", O.sql(
    f"SELECT g.*, CAST(1 AS BIGINT) AS ones, t.Datum, t.id_time, t.time_cat FROM geo g, time_dim t",
    "geo", "time_dim"))
def q_join_cross(spark, d):
    return J.cross(*_dims(spark, d))


@register("join_inner_multikey", O.sql("SELECT * FROM bridge", "bridge"))
def q_join_inner_multikey(spark, d):
    geo, time = _dims(spark, d)
    return D.geo_time_bridge(D.geo_time_dim(geo, time), D.state_time_dim(geo, time))


@register("join_inner_lookup", O.sql("""
  SELECT c.*, l.iso_3166_2_code FROM case_reports c
  JOIN (SELECT 'R-' || substr(r_name, 1, 2) AS iso_3166_2_code, CAST(r_regionkey AS BIGINT) AS IdBundesland
        FROM region) l ON c.IdBundesland = l.IdBundesland""", "case_reports"))
def q_join_inner_lookup(spark, d):
    return J.attach_lookup(TV.case_reports(spark, d), TV.state_lookup(spark, d), "IdBundesland")


def _measure(daily, m):
    return daily.select("lu_id", "date", m)


@register("join_inner_chain", O.sql("""
  SELECT a.lu_id, a.date, a.confirmed, b.recovered, c.deaths
  FROM daily a JOIN daily b ON a.lu_id = b.lu_id AND a.date = b.date
  JOIN daily c ON a.lu_id = c.lu_id AND a.date = c.date""", "daily"))
def q_join_inner_chain(spark, d):
    daily = TV.daily_series(spark, d)
    k = ["lu_id", "date"]
    return J.join_all([_measure(daily, "confirmed"), _measure(daily, "recovered"),
                       _measure(daily, "deaths")], [k, k])


@register("join_natural", O.sql("""
  SELECT f.*, g.population, g.n_suppliers, g.ones FROM facts f JOIN geo_full g
    ON f.IdBundesland = g.IdBundesland AND f.Bundesland = g.Bundesland
   AND f.IdLandkreis = g.IdLandkreis AND f.Landkreis = g.Landkreis""", "facts", "geo_full"))
def q_join_natural(spark, d):
    facts = _shared_facts(spark, d)
    geo = D.geo_dim(facts, TV.districts(spark, d), TV.district_category(spark, d))
    return J.natural_join(facts, materialize(geo, "geo"))


@register("join_keyed_merge", ORACLE["join_inner_chain"])
def q_join_keyed_merge(spark, d):
    daily = TV.daily_series(spark, d)
    return J.merge_series([_measure(daily, m) for m in ("confirmed", "recovered", "deaths")], ["lu_id", "date"])


AUDIT_SQL = """
  SELECT COALESCE(a.purchase_user, 'missing') AS purchase_user, a.date_a, a.tested,
         COALESCE(b.signup_user, 'missing') AS signup_user, b.date_b, b.recovered
  FROM (SELECT CAST(lu_id AS VARCHAR) AS purchase_user, date AS date_a, tested FROM daily WHERE tested <> 0) a
  FULL OUTER JOIN (SELECT CAST(lu_id AS VARCHAR) AS signup_user, date AS date_b, recovered
                   FROM daily WHERE recovered <> 0) b
    ON a.purchase_user = b.signup_user AND a.date_a = b.date_b"""


@register("join_match_audit", O.sql(
    f"SELECT * FROM ({AUDIT_SQL}) x WHERE purchase_user = 'missing' OR signup_user = 'missing'",
    "daily"))
def q_join_match_audit(spark, d):
    daily = TV.daily_series(spark, d)
    a = daily.filter(F.col("tested") != 0).select(
        F.col("lu_id").cast("string").alias("purchase_user"), F.col("date").alias("date_a"),
        "tested")
    b = daily.filter(F.col("recovered") != 0).select(
        F.col("lu_id").cast("string").alias("signup_user"), F.col("date").alias("date_b"),
        "recovered")
    cols = ["purchase_user", "signup_user"]
    audited = J.match_audit(a, b, ["purchase_user", "date_a"], ["signup_user", "date_b"], cols)
    return J.unmatched(audited, cols)


@register("join_split_outer", O.sql("""
  SELECT a.l_partkey, a.l_quantity, b.ps_part, b.n FROM (SELECT l_partkey, CAST(l_quantity AS BIGINT) AS l_quantity FROM lineitem) a
  FULL OUTER JOIN (SELECT l_partkey + 1 AS ps_part, COUNT(*) AS n FROM lineitem WHERE l_partkey % 3 > 0 GROUP BY 1) b
    ON a.l_partkey = b.ps_part"""))
def q_join_split_outer(spark, d):
    """Line items against counts of other parts; parts of many line items are hot."""
    li = TV.table(spark, d, "lineitem")
    a = materialize(li.select("l_partkey", F.col("l_quantity").cast("bigint").alias("l_quantity")), "split_left")
    b = materialize(li.filter("l_partkey % 3 > 0").groupBy((F.col("l_partkey") + 1).alias("ps_part")).agg(
        F.count(F.lit(1)).alias("n")), "split_right")
    return J.split_outer_join(a, b, ["l_partkey"], ["ps_part"], hot_rows=40)


# ------------------------------------------------------ more aggregations
@register("groupby_count_desc", O.sql("""
  SELECT NULLIF(Geschlecht, 'unbekannt') AS Geschlecht, COUNT(*) AS count
  FROM case_reports GROUP BY NULLIF(Geschlecht, 'unbekannt') ORDER BY count DESC""", "case_reports"))
def q_groupby_count_desc(spark, d):
    cr = TV.case_reports(spark, d).withColumn(
        "Geschlecht", F.nullif(F.col("Geschlecht"), F.lit("unbekannt")))
    return A.groupby_count_desc(cr, ["Geschlecht"])


@register("agg_sum_series", O.sql("""
  SELECT user_id AS lu_id, CAST(ts AS DATE) AS date,
         CAST(COALESCE(SUM(CAST(round(value * 100) AS BIGINT)), 0) AS BIGINT) AS value
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY user_id, CAST(ts AS DATE)"""))
def q_agg_sum_series(spark, d):
    e = TV.table(spark, d, "events").select(
        F.col("user_id").alias("lu_id"), F.col("ts").cast("date").alias("date"),
        TV.event_cents().alias("value"))
    return A.sum_by(e, ["lu_id", "date"], ["value"])


@register("sort_output", O.sql("""
  SELECT Altersgruppe, CAST(COALESCE(SUM(Anzahl), 0) AS BIGINT) AS Anzahl, Status
  FROM facts GROUP BY Altersgruppe, Status ORDER BY Anzahl DESC""", "facts"))
def q_sort_output(spark, d):
    return A.order_by(A.rollup_status(_facts(spark, d)), ["Anzahl"], ascending=False)


# ------------------------------------------------------- more dimensions
@register("geo_dimension", O.sql("SELECT * FROM geo_full", "geo_full"))
def q_geo_dimension(spark, d):
    return D.geo_dim(_geo_bounds(spark, d), TV.districts(spark, d), TV.district_category(spark, d))


@register("geo_time_dim", O.sql("""
  SELECT IdBundesland, Bundesland, IdLandkreis, Landkreis, ones, Datum, id_time, time_cat, id_lk_time
  FROM bridge""", "bridge"))
def q_geo_time_dim(spark, d):
    return D.geo_time_dim(*_dims(spark, d))


@register("state_time_dim", O.sql(
    'SELECT DISTINCT "index", IdBundesland, Bundesland, Datum, id_time, id_bl_time FROM bridge',
    "bridge"))
def q_state_time_dim(spark, d):
    return D.state_time_dim(*_dims(spark, d))


@register("sequential_row_id", O.sql(
    "SELECT c_custkey, c_name, ROW_NUMBER() OVER (ORDER BY c_custkey) - 1 AS lu_id FROM customer"))
def q_sequential_row_id(spark, d):
    c = TV.table(spark, d, "customer").select("c_custkey", "c_name")
    return D.with_row_id(c, ["c_custkey"], "lu_id")


# ------------------------------------------------------------------ checks
@register("check_join_cardinality", O.sql(f"""
  SELECT {O.FACT_KEYS}, COUNT(*) AS count FROM case_reports
  GROUP BY {O.FACT_KEYS} HAVING COUNT(*) > 1""", "case_reports"))
def q_check_join_cardinality(spark, d):
    return CK.duplicate_keys(TV.case_reports(spark, d), FA.FACT_KEYS)


@register("check_key_sets_equal", O.sql("""
  SELECT lu_id, date, 'left_only' AS side FROM
    (SELECT lu_id, date FROM daily WHERE confirmed <> 0 EXCEPT ALL SELECT lu_id, date FROM daily WHERE tested <> 0) a
  UNION ALL SELECT lu_id, date, 'right_only' AS side FROM
    (SELECT lu_id, date FROM daily WHERE tested <> 0 EXCEPT ALL SELECT lu_id, date FROM daily WHERE confirmed <> 0) b""",
    "daily"))
def q_check_key_sets_equal(spark, d):
    daily = TV.daily_series(spark, d)
    return CK.key_set_diff(daily.filter(F.col("confirmed") != 0),
                           daily.filter(F.col("tested") != 0), ["lu_id", "date"])


@register("check_key_fingerprint", O.sql("""
  SELECT what, l.n AS left_rows, r.n AS right_rows, same FROM (
    SELECT 'all' AS what, (SELECT COUNT(*) FROM daily) AS n) l
  JOIN (SELECT 'all' AS what, (SELECT COUNT(*) FROM daily) AS n, TRUE AS same) r USING (what)
  UNION ALL
  SELECT 'reported', (SELECT COUNT(*) FROM daily WHERE confirmed <> 0), (SELECT COUNT(*) FROM daily WHERE tested <> 0),
         NOT EXISTS (SELECT lu_id, date FROM daily WHERE confirmed <> 0 EXCEPT ALL SELECT lu_id, date FROM daily WHERE tested <> 0)
         AND (SELECT COUNT(*) FROM daily WHERE confirmed <> 0) = (SELECT COUNT(*) FROM daily WHERE tested <> 0)""", "daily"))
def q_check_key_fingerprint(spark, d):
    daily, keys = TV.daily_series(spark, d), ["lu_id", "date"]

    def verdict(a, b, what):
        sides = CK.key_fingerprints(a, b, keys).groupBy().pivot("side", ["left", "right"]).agg(
            F.first("rows").alias("rows"), F.first(F.struct("rows", "sum1", "sum2")).alias("print"))
        return sides.select(F.lit(what).alias("what"), F.coalesce("left_rows", F.lit(0)).alias("left_rows"),
                            F.coalesce("right_rows", F.lit(0)).alias("right_rows"),
                            F.col("left_print").eqNullSafe(F.col("right_print")).alias("same"))

    return verdict(daily, daily.orderBy("date"), "all").union(
        verdict(daily.filter("confirmed <> 0"), daily.filter("tested <> 0"), "reported"))


@register("check_lookup_coverage", O.sql("""
  SELECT DISTINCT lu_id, date FROM daily t WHERE tested <> 0
    AND NOT EXISTS (SELECT 1 FROM daily c WHERE c.confirmed <> 0 AND c.lu_id = t.lu_id AND c.date = t.date)""",
    "daily"))
def q_check_lookup_coverage(spark, d):
    daily = TV.daily_series(spark, d)
    return CK.uncovered_keys(daily.filter(F.col("tested") != 0),
                             daily.filter(F.col("confirmed") != 0), ["lu_id", "date"])


@register("check_row_count", O.sql("""
  SELECT COUNT(*) AS actual, CAST(0 AS BIGINT) AS expected, COUNT(*) = 0 AS ok
  FROM lineitem WHERE l_quantity < 0"""))
def q_check_row_count(spark, d):
    return CK.expect_count(TV.table(spark, d, "lineitem"), F.col("l_quantity") < 0, 0)


_PROFILE_TYPES = [("IdBundesland", "Int64.Type"), ("Bundesland", "type text"),
                  ("IdLandkreis", "Int64.Type"), ("Landkreis", "type text"),
                  ("Meldedatum", "type text"), ("Altersgruppe", "type text"),
                  ("Geschlecht", "type text"), ("AnzahlFall", "Int64.Type"),
                  ("AnzahlTodesfall", "Int64.Type"), ("AnzahlGenesen", "Int64.Type")]


@register("table_profile", O.sql(" UNION ALL ".join(
    f"SELECT 'case_reports' AS \"table\", '{c}' AS \"column\", CAST({i} AS BIGINT) AS position, "
    f"'{t}' AS export_type, COUNT({c}) AS non_null, COUNT(*) AS row_count FROM case_reports"
    for i, (c, t) in enumerate(_PROFILE_TYPES)), "case_reports"))
def q_table_profile(spark, d):
    return CK.profile(TV.case_reports(spark, d), "case_reports")


# ------------------------------------------------------------------ series
@register("series_position", O.sql(
    "SELECT *, ROW_NUMBER() OVER (PARTITION BY lu_id ORDER BY date) - 1 AS counter FROM tests_clean",
    "tests_clean"))
def q_series_position(spark, d):
    return S.series_position(SP.tests_clean(TV.daily_series(spark, d)), "lu_id", "date")


@register("forward_fill", O.sql("""
  SELECT *, last_value(tested_reported_or_nan IGNORE NULLS) OVER (PARTITION BY lu_id ORDER BY date
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tested_announced FROM tests_clean""",
    "tests_clean"))
def q_forward_fill(spark, d):
    return S.ffill(SP.tests_clean(TV.daily_series(spark, d)), "lu_id", "date",
                   "tested_reported_or_nan", "tested_announced")


@register("linear_interpolate", O.sql("SELECT * FROM tests_est", "tests_est"))
def q_linear_interpolate(spark, d):
    return SP.tests_estimated(TV.daily_series(spark, d))


@register("series_union", O.sql("""
  SELECT lu_id, date, 'confirmed' AS measure, confirmed AS value FROM daily
  UNION ALL SELECT lu_id, date, 'recovered', recovered FROM daily
  UNION ALL SELECT lu_id, date, 'deaths', deaths FROM daily""", "daily"))
def q_series_union(spark, d):
    daily = TV.daily_series(spark, d)
    parts = [daily.select("lu_id", "date", F.lit(m).alias("measure"), F.col(m).alias("value"))
             for m in ("confirmed", "recovered", "deaths")]
    return S.union_all(parts)


@register("reported_vs_estimated", O.sql("SELECT * FROM tests_decomposed", "tests_decomposed"))
def q_reported_vs_estimated(spark, d):
    return SP.tests_decomposed(TV.daily_series(spark, d))


@register("lag_measures", O.sql("SELECT *, " + ", ".join(
    [O.lag0(c, n) for n in (1, 7) for c in ("confirmed", "recovered", "deaths", "tested")])
    + " FROM daily", "daily"))
def q_lag_measures(spark, d):
    out = TV.daily_series(spark, d)
    for n in (1, 7):
        out = S.lag_by(out, "lu_id", "date", ["confirmed", "recovered", "deaths", "tested"], n)
    return out


@register("estimated_active", O.sql("SELECT * FROM series_active", "series_active"))
def q_estimated_active(spark, d):
    return SP.series_active(TV.daily_series(spark, d))


# ----------------------------------------- series of any length, in chunks
def _tests(spark, d):
    return SP.tests_clean(TV.daily_series(spark, d))


@register("chunked_position", ORACLE["series_position"])
def q_chunked_position(spark, d):
    return CH.position(_tests(spark, d), "lu_id", "date")


@register("chunked_fill", ORACLE["forward_fill"])
def q_chunked_fill(spark, d):
    return CH.ffill(_tests(spark, d), "lu_id", "date", "tested_reported_or_nan", "tested_announced")


@register("chunked_interpolate", O.sql(
    "SELECT lu_id, date, tested_reported, tested_reported_or_nan, tested FROM tests_est", "tests_est"))
def q_chunked_interpolate(spark, d):
    return CH.interpolate(_tests(spark, d), "lu_id", "date", "tested_reported_or_nan", "tested")


@register("chunked_lags", O.sql("SELECT *, " + ", ".join(
    O.lag0(c, 7) for c in ("confirmed", "recovered", "deaths", "tested")) + " FROM daily", "daily"))
def q_chunked_lags(spark, d):
    return CH.lag_by(TV.daily_series(spark, d), "lu_id", "date", ["confirmed", "recovered", "deaths", "tested"], 7,
                     rows_per_chunk=10)


# ---------------------------------------------------------------- measures
_GROWTH = ("active", "confirmed", "deaths", "recovered")


def _growth_sql(n: int) -> str:
    cols = []
    for m in _GROWTH:
        r = (f"CASE WHEN SUM(lag_{n}_{m}) = 0 THEN NULL "
             f"ELSE CAST(SUM({m}) AS DOUBLE) / CAST(SUM(lag_{n}_{m}) AS DOUBLE) END")
        g = f"COALESCE({r}, 1)"
        if n != 1:
            g = f"CASE WHEN {g} < 0 THEN NULL ELSE pow({g}, 1.0 / {n}) END"
        cols.append(f"round({g} - 1, 6) AS growth_{m}_{n}d")
    return "SELECT date, " + ", ".join(cols) + " FROM series_lags GROUP BY date"


def _rounded(df, keep):
    return df.select(*keep, *[F.round(c, 6).alias(c) for c in df.columns if c not in keep])


@register("growth_prev_day", O.sql(_growth_sql(1), "series_lags"))
def q_growth_prev_day(spark, d):
    return _rounded(M.growth(SP.series_lags(TV.daily_series(spark, d)), ["date"], _GROWTH, 1),
                    ["date"])


@register("growth_prev_week", O.sql(_growth_sql(7), "series_lags"))
def q_growth_prev_week(spark, d):
    return _rounded(M.growth(SP.series_lags(TV.daily_series(spark, d)), ["date"], _GROWTH, 7),
                    ["date"])


@register("ratio_total", O.sql("""
  SELECT date, round(CASE WHEN SUM(tested) = 0 THEN NULL
                          ELSE CAST(SUM(confirmed) AS DOUBLE) / CAST(SUM(tested) AS DOUBLE) END, 6) AS ratio
  FROM series_lags GROUP BY date""", "series_lags"))
def q_ratio_total(spark, d):
    s = SP.series_lags(TV.daily_series(spark, d))
    return _rounded(M.ratio(s, ["date"], "confirmed", "tested"), ["date"])


def _delta_sql(n: int) -> str:
    den = f"(SUM(tested) - SUM(lag_{n}_tested))"
    return (f"round(CASE WHEN {den} = 0 THEN NULL ELSE CAST(SUM(confirmed) - SUM(lag_{n}_confirmed) "
            f"AS DOUBLE) / CAST({den} AS DOUBLE) END, 6) AS ratio_delta_{n}d")


@register("ratio_delta", O.sql(
    f"SELECT date, {_delta_sql(1)}, {_delta_sql(7)} FROM series_lags GROUP BY date", "series_lags"))
def q_ratio_delta(spark, d):
    s = SP.series_lags(TV.daily_series(spark, d))
    return _rounded(M.ratio_delta(s, ["date"], "confirmed", "tested", (1, 7)), ["date"])


# ------------------------------------------------------ sources and sinks
from casestar.plans import geodocs as G  # noqa: E402
from casestar.plans import world as WD  # noqa: E402
from casestar.session import scratch_path  # noqa: E402
from casestar.sources import readers as RD  # noqa: E402
from casestar.sources import sinks as SK  # noqa: E402
from pyspark.sql import types as T  # noqa: E402


@register("src_delimited", O.sql("SELECT * FROM case_reports", "case_reports"))
def q_src_delimited(spark, d):
    path = scratch_path(spark, "case_reports_csv")
    _landed(spark, d).write.option("header", True).option("escape", '"').csv(path)
    return RD.read_facts(spark, path)


@register("src_tsv_codepage", O.sql("""
  SELECT 'R-' || substr(r_name, 1, 2) AS iso_3166_2_code, CAST(r_regionkey AS BIGINT) AS IdBundesland
  FROM region"""))
def q_src_tsv_codepage(spark, d):
    path = scratch_path(spark, "state_iso_tsv")
    (TV.state_lookup(spark, d).write.option("sep", "\t").option("header", True)
     .option("encoding", "ISO-8859-1").option("lineSep", "\r\n").csv(path))
    return RD.read_lookup(spark, path, RD.STATE_ISO_SCHEMA, encoding="ISO-8859-1")


O.cte("nation_geo", f"""
  SELECT CAST(n_regionkey AS BIGINT) AS region,
         ROW_NUMBER() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS position,
         'Polygon' AS type, {O.pad5('CAST(n_regionkey AS BIGINT) * 1000 + n_nationkey')} AS rs,
         n_name AS name, CAST(n_nationkey AS BIGINT) AS nation
  FROM nation""")


@register("src_nested_json", O.sql(
    "SELECT region, position, type, rs, name, nation FROM nation_geo", "nation_geo"))
def q_src_nested_json(spark, d):
    path = scratch_path(spark, "geometry_docs")
    G.write_documents(G.geometry_documents(spark, d), path)
    g = RD.read_geometries(spark, path, G.OBJECT_NAME, multi_line=True, schema=G.DOC_SCHEMA)
    return g.select(F.col("region").cast("bigint").alias("region"), "position", "type",
                    "properties.rs", "properties.name", "properties.nation")


def _rekeyed_docs(spark, d):
    docs = G.geometry_documents(spark, d)
    geoms = C.rekey_properties(G.geometries_of(F.col("doc")), {"IDLandkreis": "rs"})
    return docs.withColumn("doc", F.col("doc").withField(
        f"objects.{G.OBJECT_NAME}.geometries", geoms))


# The whole rewritten geometry: every member but the properties is as it was.
REKEYED = """'{"type":"Polygon","properties":{"IDLandkreis":"' || rs || '"},"id":"g' || nation ||
         '","arcs":[[' || position || ']]}'"""


@register("json_rekey", O.sql(
    f"SELECT region, position, {REKEYED} AS geometry FROM nation_geo", "nation_geo"))
def q_json_rekey(spark, d):
    docs = _rekeyed_docs(spark, d)
    g = docs.select("region", F.posexplode(G.geometries_of(F.col("doc"))).alias("position", "g"))
    return g.select("region", F.col("position").cast("bigint").alias("position"),
                    F.to_json("g").alias("geometry"))


@register("sink_json", O.sql(f"""
  SELECT region, '{{"region":' || region || ',"type":"Topology","objects":{{"{G.OBJECT_NAME}":' ||
         '{{"type":"GeometryCollection","geometries":[' || string_agg({REKEYED}, ',' ORDER BY position) ||
         ']}}}},"arcs":[' || string_agg('[[' || nation || ',0],[' || (nation + 1) || ',1]]', ',' ORDER BY position) ||
         ']}}' AS document
  FROM nation_geo GROUP BY region""", "nation_geo"))
def q_sink_json(spark, d):
    path = scratch_path(spark, "geometry_json")
    SK.export_json(_rekeyed_docs(spark, d).select("region", "doc.*"), path)
    lines = spark.read.text(path)
    return lines.select(F.get_json_object("value", "$.region").cast("bigint").alias("region"),
                        F.col("value").alias("document"))


@register("array_bbox_filter", O.sql("""
  SELECT vec_id, CAST(len(embedding) // 2 AS BIGINT) AS n_points,
         CAST(len(list_filter(
           list_transform(range(len(embedding) // 2),
             lambda i: {'lng': CAST(embedding[2 * i + 1] AS DOUBLE) * 100,
                        'lat': CAST(embedding[2 * i + 2] AS DOUBLE) * 100}),
           lambda p: p.lat >= 30 OR p.lng >= -15 OR p.lng >= 30)) AS BIGINT) AS n_kept
  FROM embeddings"""))
def q_array_bbox_filter(spark, d):
    e = TV.table(spark, d, "embeddings")
    emb = F.col("embedding")
    # Consecutive pairs are (lng, lat) in hundredths of a degree.
    coords = F.transform(
        F.sequence(F.lit(0), (F.size(emb) / 2).cast("int") - 1),
        lambda i: F.struct((emb[i * 2].cast("double") * 100).alias("lng"),
                           (emb[i * 2 + 1].cast("double") * 100).alias("lat")))
    # The reference's bounds, OR-ed.
    kept = C.filter_coords(coords, lambda p: (p["lat"] >= 30) | (p["lng"] >= -15)
                           | (p["lng"] >= 30))
    return e.select("vec_id", F.size(coords).cast("bigint").alias("n_points"),
                    F.size(kept).cast("bigint").alias("n_kept"))


def _landed(spark, d):
    """Case reports as landed: more columns than are used, in another order."""
    raw = TV.case_reports(spark, d)
    return raw.withColumns({"ObjectId": F.lit(1), "Refdatum": F.col("Meldedatum")}).select(
        *reversed(raw.columns), "ObjectId", "Refdatum")


LANDED_COLS = ["AnzahlGenesen", "AnzahlTodesfall", "AnzahlFall", "Geschlecht", "Altersgruppe", "Meldedatum", "Landkreis",
               "IdLandkreis", "Bundesland", "IdBundesland", "'1'", "Meldedatum"]


@register("sink_raw_snapshot", O.sql(
    "SELECT " + " || ',' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in LANDED_COLS) + " AS line FROM case_reports",
    "case_reports"))
def q_sink_raw_snapshot(spark, d):
    landed, kept = scratch_path(spark, "landed_csv"), scratch_path(spark, "raw_snapshot")
    _landed(spark, d).write.option("header", True).csv(landed)
    SK.snapshot_files(spark, landed, kept)
    lines = spark.read.parquet(kept).select(F.col("line").cast("string").alias("line"))
    return lines.filter(~F.col("line").startswith("AnzahlGenesen,"))


@register("export_ordered_file", O.sql(
    "SELECT " + " || chr(9) || ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in FA.EXPORT_COLS) + " AS line FROM star",
    "star"))
def q_export_ordered_file(spark, d):
    path = scratch_path(spark, "data_rki_ordered")
    SK.export_ordered_tsv(FA.star_facts(_shared_facts(spark, d)), path, ["id_lk_time", "Altersgruppe", "Geschlecht", "Status"])
    lines = spark.read.option("lineSep", "\r\n").text(path)
    return lines.filter(~F.col("value").contains("IdBundesland")).select(F.col("value").alias("line"))


@register("file_order_id", O.sql(
    "SELECT c_custkey, c_name, ROW_NUMBER() OVER (ORDER BY c_custkey DESC) - 1 AS row_id FROM customer"))
def q_file_order_id(spark, d):
    """The lookup lies in files from the last key to the first; ids follow the files."""
    path = scratch_path(spark, "customer_csv")
    c = TV.table(spark, d, "customer").select("c_custkey", "c_name")
    c.repartitionByRange(4, F.desc("c_custkey")).sortWithinPartitions(F.desc("c_custkey")).write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType())])
    return D.with_file_order_id(spark.read.option("header", True).schema(schema).csv(path))


def _untidy(spark, d):
    """Reports with dates that do not parse, and an age band that nobody mapped."""
    raw = TV.case_reports(spark, d)
    return raw.withColumns({
        "Meldedatum": F.when(F.col("AnzahlFall") == 7, F.lit("zzz")).otherwise(F.col("Meldedatum")),
        "Altersgruppe": F.when(F.col("AnzahlFall") == 9, F.lit("A99")).otherwise(F.col("Altersgruppe"))})


@register("reject_split", O.sql("""
  SELECT 'accepted' AS what, COUNT(*) FILTER (AnzahlFall <> 7) AS n FROM case_reports
  UNION ALL SELECT 'rejected', COUNT(*) FILTER (AnzahlFall = 7) FROM case_reports
  UNION ALL SELECT 'unmapped_age', COUNT(*) FILTER (AnzahlFall = 9) FROM case_reports
  UNION ALL SELECT 'null_key', COUNT(*) FILTER (AnzahlFall <> 7 AND Geschlecht IS NULL) FROM case_reports
  UNION ALL SELECT 'stored: ' || coalesce(r, 'accepted'), COUNT(*)
    FROM (SELECT CASE WHEN AnzahlFall = 7 THEN 'date' END AS r FROM case_reports) GROUP BY r""", "case_reports"))
def q_reject_split(spark, d):
    accepted, rejected, counts = FA.split_rejects(_untidy(spark, d), scratch_path(spark, "reports"))
    seen = spark.createDataFrame(list(counts.items()), "what string, n long")
    stored = accepted.select(F.lit(None).cast("string").alias("reason")).union(rejected.select("reason")).groupBy(
        F.concat(F.lit("stored: "), F.coalesce("reason", F.lit("accepted"))).alias("what")).agg(F.count(F.lit(1)).alias("n"))
    return seen.union(stored)


@register("fact_store_latest", O.sql(
    "SELECT * FROM facts WHERE Meldedatum = (SELECT MAX(Meldedatum) FROM facts)", "facts"))
def q_fact_store_latest(spark, d):
    path = scratch_path(spark, "fact_store")
    ST.write_fact_store(_facts(spark, d), "Meldedatum", path, ["IdLandkreis"])
    return ST.latest_of_store(spark, path, "Meldedatum")


_EXPORT_PROFILES = {
    "data_time": ("time_dim", [("Datum", "type date"), ("id_time", "Int64.Type"), ("ones", "Int64.Type"), ("time_cat", "type text")]),
    "data_rki": ("star", [("IdBundesland", "Int64.Type"), ("IdLandkreis", "type text"), ("id_time", "Int64.Type"),
                          ("id_lk_time", "Int64.Type"), ("id_bl_time", "Int64.Type"), ("Altersgruppe", "type text"),
                          ("Alter_Zahl", "type number"), ("Geschlecht", "type text"), ("Status", "type text"),
                          ("Anzahl", "Int64.Type")]),
}


@register("export_profile", O.sql(" UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", '{c}' AS \"column\", CAST({i} AS BIGINT) AS position, '{t}' AS export_type, "
    f"COUNT({c}) AS non_null, COUNT(*) AS row_count FROM {view}"
    for name, (view, cols) in _EXPORT_PROFILES.items() for i, (c, t) in enumerate(cols)), "time_dim", "star"))
def q_export_profile(spark, d):
    """Profiles counted while the exports are written."""
    facts = _shared_facts(spark, d)
    exports = {"data_time": (D.date_dim(facts), ["id_time"]), "data_rki": (FA.star_facts(facts), ["id_lk_time", "Altersgruppe"])}
    out = []
    for name, (df, order) in exports.items():
        out.append(SK.export_ordered_tsv(df, scratch_path(spark, name), order, profile_as=name)())
    return S.union_all(out)


# Feature documents from the vectors: consecutive pairs are points, four make a ring.
@register("document_ring_filter", O.sql("""
  SELECT vec_id, '{"type":"FeatureCollection","features":[' || array_to_string(list_transform(range(len(embedding) // 32), lambda f:
      '{"type":"Feature","id":' || f || ',"geometry":{"type":"Polygon","coordinates":[' ||
      array_to_string(list_transform(list_filter(range(4), lambda r: p[32 * f + 8 * r + 2] >= 30 OR p[32 * f + 8 * r + 1] >= -15
                                                             OR p[32 * f + 8 * r + 1] >= 30), lambda r:
        '[' || array_to_string(list_transform(range(4), lambda q:
          '[' || p[32 * f + 8 * r + 2 * q + 1] || ',' || p[32 * f + 8 * r + 2 * q + 2] || ']'), ',') || ']'), ',') ||
      ']}}'), ',') || ']}' AS document
  FROM (SELECT vec_id, embedding, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 100) AS BIGINT)) AS p
        FROM embeddings) e"""))
def q_document_ring_filter(spark, d):
    docs = G.feature_documents(spark, d)
    # The reference's bounds, OR-ed.
    kept = C.filter_features(F.col("doc.features"), lambda lat, lng: (lat >= 30) | (lng >= -15) | (lng >= 30))
    return docs.select("vec_id", F.to_json(F.col("doc").withField("features", kept)).alias("document"))


TIME_SCHEMA = T.StructType([
    T.StructField("Datum", T.DateType()), T.StructField("id_time", T.LongType()),
    T.StructField("ones", T.LongType()), T.StructField("time_cat", T.StringType())])
EXPORT_SCHEMA = T.StructType([
    T.StructField("IdBundesland", T.LongType()), T.StructField("IdLandkreis", T.StringType()),
    T.StructField("id_time", T.LongType()), T.StructField("id_lk_time", T.LongType()),
    T.StructField("id_bl_time", T.LongType()), T.StructField("Altersgruppe", T.StringType()),
    T.StructField("Alter_Zahl", T.DoubleType()), T.StructField("Geschlecht", T.StringType()),
    T.StructField("Status", T.StringType()), T.StructField("Anzahl", T.LongType())])


@register("sink_tsv_export", O.sql("SELECT * FROM time_dim", "time_dim"))
def q_sink_tsv_export(spark, d):
    path = scratch_path(spark, "data_time_tsv")
    SK.export_tsv(D.date_dim(_dates(_geo_bounds(spark, d))), path, single_file=True)
    return SK.read_tsv_export(spark, path, TIME_SCHEMA)


@register("sink_sparse_facts", O.sql("SELECT * FROM star", "star"))
def q_sink_sparse_facts(spark, d):
    path = scratch_path(spark, "data_rki_tsv")
    SK.export_facts(FA.star_facts(_shared_facts(spark, d)), path)
    return SK.read_tsv_export(spark, path, EXPORT_SCHEMA)


# ------------------------------------------------------------ wide dates
def _wide_sql(kind: str) -> str:
    collapse = ", ".join(f"'{c}'" for c in WD.COLLAPSE)
    return f"""
  WITH u AS (SELECT c.c_custkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
  cells AS (SELECT CAST(e.user_id AS VARCHAR) AS ps, u.n_name AS cr, CAST(e.ts AS DATE) AS d,
                   SUM(CASE WHEN e.event_type = '{kind}' THEN CAST(round(e.value * 100) AS BIGINT) END) AS v
            FROM events e JOIN u ON e.user_id = u.c_custkey GROUP BY 1, 2, 3),
  pairs AS (SELECT DISTINCT ps, cr FROM cells),
  days AS ({O.CALENDAR})
  SELECT p.cr AS country_region,
         CASE WHEN p.cr IN ({collapse}) THEN '' ELSE COALESCE(p.ps, '') END AS province_state,
         dd.d AS date, CAST(COALESCE(SUM(c.v), 0) AS BIGINT) AS number
  FROM pairs p CROSS JOIN days dd LEFT JOIN cells c ON c.ps = p.ps AND c.cr = p.cr AND c.d = dd.d
  GROUP BY 1, 2, 3"""


@register("unpivot_date_columns", _wide_sql("click"))
def q_unpivot_date_columns(spark, d):
    return R.wide_dates_to_long(WD.wide_series(spark, d, "confirmed"), WD.IDS, "Country/Region",
                                "Province/State", WD.COLLAPSE)


# ------------------------------------------------------------------ feeds
from casestar.plans import feeds as FD  # noqa: E402

_MOB = list(FD.MOBILITY_RENAME.values())


@register("mobility_feed", O.sql(
    "SELECT lk.IdBundesland, mob.sub_region_1, CAST(mob.date AS DATE) AS Datum, "
    + ", ".join(f'mob.p{i + 1} AS "{n}"' for i, n in enumerate(_MOB))
    + """, st."index", st.Bundesland, st.id_time, st.id_bl_time
  FROM mobility mob
  JOIN (SELECT 'R-' || substr(r_name, 1, 2) AS iso_3166_2_code, CAST(r_regionkey AS BIGINT) AS IdBundesland
        FROM region) lk ON mob.iso_3166_2_code = lk.iso_3166_2_code
  JOIN state_time st ON st.IdBundesland = lk.IdBundesland AND st.Datum = CAST(mob.date AS DATE)""",
    "mobility", "state_time"))
def q_mobility_feed(spark, d):
    st = D.state_time_dim(*_dims(spark, d))
    return FD.mobility_feed(FD.mobility_input(spark, d), TV.state_lookup(spark, d), st)


POLICY_COUNTRY = "NATION_7"


@register("policy_feed", O.sql(f"""
  SELECT p.CountryName, p.Date, p.StringencyIndex, t.Datum, t.id_time, t.time_cat
  FROM policy p JOIN time_dim t ON t.Datum = CAST(strptime(CAST(p.Date AS VARCHAR), '%Y%m%d') AS DATE)
  WHERE p.CountryName = '{POLICY_COUNTRY}'""", "policy", "time_dim"))
def q_policy_feed(spark, d):
    return FD.policy_feed(FD.policy_input(spark, d), D.date_dim(_dates(_geo_bounds(spark, d))), POLICY_COUNTRY)


@register("country_lookup", O.sql("SELECT * FROM country_lookup", "country_lookup"))
def q_country_lookup(spark, d):
    return FD.country_lookup(FD.lookup_input(spark, d), FD.map_names_input(spark, d),
                             FD.groups_input(spark, d), FD.world_keys(spark, d))


@register("world_series", O.sql("SELECT * FROM world_series", "world_series"))
def q_world_series(spark, d):
    return FD.world_series(spark, d)
