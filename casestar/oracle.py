"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each query is written independently in plain SQL over the driver's tables
(pre-registered views ``lineitem``, ``orders`` ...). ``CTES`` holds the
shared reference-shaped views; ``sql(final, *names)`` prepends the named
views and everything they depend on.
"""

from __future__ import annotations

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (deps, body)


def sql(final: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return final
    parts = ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order)
    return f"WITH {parts}\n{final}"


def pad5(expr: str) -> str:
    s = f"CAST({expr} AS VARCHAR)"
    return f"(CASE WHEN length({s}) >= 5 THEN {s} ELSE lpad({s}, 5, '0') END)"


# Fixed values, as in functions/columns.py: age bands, their midpoints, the unknown
# label and the period labels with their bounds.
AGE_CASE = """CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN CASE WHEN c.c_custkey % 2 = 1 THEN 'A05-A14' ELSE 'A00-A04' END
  WHEN 'BUILDING' THEN 'A15-A34' WHEN 'FURNITURE' THEN 'A35-A59'
  WHEN 'MACHINERY' THEN CASE WHEN c.c_custkey % 2 = 1 THEN 'A80+' ELSE 'A60-A79' END
  WHEN 'HOUSEHOLD' THEN 'unbekannt' END"""
SEX_CASE = """CASE WHEN o.o_orderkey % 97 <> 0 THEN
  CASE o.o_orderstatus WHEN 'F' THEN 'W' WHEN 'O' THEN 'M' WHEN 'P' THEN 'unbekannt' END END"""
# A nation's district code; one nation's is a code that another one was merged into.
DISTRICT_CODE = "CASE WHEN n.n_nationkey = 4 THEN 5334 ELSE CAST(n.n_regionkey AS BIGINT) * 1000 + n.n_nationkey END"
LATER = "(o.o_orderdate + INTERVAL 7463 DAY)"
QUANTITY = "(CAST(l.l_quantity AS BIGINT) * CASE WHEN l.l_orderkey % 89 = 0 THEN -1 ELSE 1 END)"
MIDPOINT_CASE = """CAST(CASE {c} WHEN 'A00-A04' THEN 2.0 WHEN 'A05-A14' THEN 9.5 WHEN 'A15-A34' THEN 24.5
  WHEN 'A35-A59' THEN 47.0 WHEN 'A60-A79' THEN 69.5 WHEN 'A80+' THEN 85.0
  WHEN 'keine Information' THEN 44.5 END AS DOUBLE)"""
PERIOD_CASE = """CASE WHEN {d} < DATE '2020-03-01' THEN '1: 01.2020 - 02.2020'
  WHEN {d} < DATE '2020-06-01' THEN '2: 03.2020 - 05.2020'
  WHEN {d} < DATE '2020-10-01' THEN '3: 06.2020 - 09.2020'
  WHEN {d} < DATE '2021-03-01' THEN '4: 10.2020 - 02.2021'
  WHEN {d} < DATE '2021-06-01' THEN '5: 03.2021 - 05.2021'
  WHEN {d} < DATE '2021-10-01' THEN '6: 06.2021 - 09.2021'
  WHEN {d} < {hi} - 27 THEN '7: 09.2021 - vor 4 Wochen'
  WHEN {d} < {hi} - 6 THEN '8: vor 4 Wochen - vor 1er Woche'
  ELSE '9: letze Woche' END"""

FACT_KEYS = "IdBundesland, Bundesland, IdLandkreis, Landkreis, Meldedatum, Altersgruppe, Geschlecht"
GEO_KEYS = "IdBundesland, Bundesland, IdLandkreis, Landkreis"

cte("case_reports", f"""
  SELECT CAST(r.r_regionkey AS BIGINT) AS IdBundesland, r.r_name AS Bundesland,
         CAST(CASE WHEN n.n_nationkey = 4 AND l.l_linenumber % 2 = 0 THEN 5354 ELSE {DISTRICT_CODE} END AS BIGINT) AS IdLandkreis,
         CASE WHEN n.n_nationkey <> 3 THEN n.n_name WHEN l.l_linenumber % 2 = 0 THEN 'LK Göttingen (alt)'
              ELSE 'LK Göttingen' END AS Landkreis,
         strftime({LATER}, '%Y/%m/%d %H:%M:%S') AS Meldedatum,
         {AGE_CASE} AS Altersgruppe,
         {SEX_CASE} AS Geschlecht,
         {QUANTITY} AS AnzahlFall,
         CASE WHEN l.l_returnflag = 'R' THEN {QUANTITY} ELSE 0 END AS AnzahlTodesfall,
         CASE WHEN l.l_returnflag = 'A' THEN {QUANTITY} ELSE 0 END AS AnzahlGenesen
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey""")

# Fixed values below: the retired district code and names.
cte("clean_reports", f"""
  SELECT IdBundesland, Bundesland,
         CASE WHEN {pad5('IdLandkreis')} = '05354' THEN '05334' ELSE {pad5('IdLandkreis')} END AS IdLandkreis,
         CASE Landkreis WHEN 'LK Göttingen (alt)' THEN 'LK Göttingen'
                        WHEN 'LK Aachen' THEN 'StadtRegion Aachen' ELSE Landkreis END AS Landkreis,
         CAST(strptime(Meldedatum, '%Y/%m/%d %H:%M:%S') AS DATE) AS Meldedatum,
         Altersgruppe, Geschlecht, AnzahlFall, AnzahlTodesfall, AnzahlGenesen
  FROM case_reports
  WHERE IdBundesland IS NOT NULL AND Bundesland IS NOT NULL AND IdLandkreis IS NOT NULL
    AND Landkreis IS NOT NULL AND Meldedatum IS NOT NULL AND Altersgruppe IS NOT NULL
    AND Geschlecht IS NOT NULL""", "case_reports")

cte("facts_wide", f"""
  SELECT {FACT_KEYS},
         CAST(COALESCE(SUM(AnzahlFall), 0) AS BIGINT) AS AnzahlFall,
         CAST(COALESCE(SUM(AnzahlTodesfall), 0) AS BIGINT) AS AnzahlTodesfall,
         CAST(COALESCE(SUM(AnzahlGenesen), 0) AS BIGINT) AS AnzahlGenesen
  FROM clean_reports GROUP BY {FACT_KEYS}""", "clean_reports")

cte("facts", f"""
  SELECT {FACT_KEYS}, 'Todesfall' AS Status, AnzahlTodesfall AS Anzahl FROM facts_wide
  UNION ALL SELECT {FACT_KEYS}, 'Genesen' AS Status, AnzahlGenesen AS Anzahl FROM facts_wide
  UNION ALL SELECT {FACT_KEYS}, 'Aktiv' AS Status,
         AnzahlFall - AnzahlTodesfall - AnzahlGenesen AS Anzahl FROM facts_wide""", "facts_wide")

cte("bounds", "SELECT MIN(Meldedatum) AS lo, MAX(Meldedatum) AS hi, "
    "date_diff('day', MIN(Meldedatum), MAX(Meldedatum)) + 1 AS n_days FROM facts", "facts")

cte("geo", f"SELECT DISTINCT {GEO_KEYS} FROM facts", "facts")

cte("geo_rank", f"""
  SELECT *, MIN(geo_rank) OVER (PARTITION BY IdBundesland, Bundesland) AS state_first
  FROM (SELECT {GEO_KEYS}, ROW_NUMBER() OVER (ORDER BY IdBundesland, IdLandkreis, Bundesland, Landkreis) - 1 AS geo_rank
        FROM geo) g""", "geo")

cte("geo_ranked", """
  SELECT *, DENSE_RANK() OVER (ORDER BY state_first) - 1 AS state_rank FROM geo_rank""", "geo_rank")

cte("time_dim", f"""
  SELECT d AS Datum, date_diff('day', b.lo, d) AS id_time, CAST(1 AS BIGINT) AS ones,
         {PERIOD_CASE.format(d='d', hi='b.hi')} AS time_cat
  FROM bounds b, (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds) s""",
    "bounds")

cte("bridge", f"""
  SELECT g.IdBundesland, g.Bundesland, g.IdLandkreis, g.Landkreis, CAST(1 AS BIGINT) AS ones,
         t.Datum, t.id_time, t.time_cat,
         g.geo_rank * b.n_days + t.id_time AS id_lk_time,
         g.state_first * b.n_days + t.id_time AS "index",
         g.state_rank * b.n_days + t.id_time AS id_bl_time
  FROM geo_ranked g, time_dim t, bounds b""", "geo_ranked", "time_dim", "bounds")

cte("span", """
  SELECT br.*, a.Altersgruppe, s.Geschlecht, st.Status
  FROM bridge br, (SELECT DISTINCT Altersgruppe FROM facts) a, (SELECT DISTINCT Geschlecht FROM facts) s,
       (SELECT DISTINCT Status FROM facts) st""", "bridge", "facts")


def export_select(src: str, anzahl: str = "Anzahl") -> str:
    age = "CASE WHEN Altersgruppe = 'unbekannt' THEN 'keine Information' ELSE Altersgruppe END"
    sex = "CASE WHEN Geschlecht = 'unbekannt' THEN 'keine Information' ELSE Geschlecht END"
    return f"""
  SELECT IdBundesland, IdLandkreis, id_time, id_lk_time, id_bl_time,
         {age} AS Altersgruppe, {MIDPOINT_CASE.format(c=age)} AS Alter_Zahl,
         {sex} AS Geschlecht, Status, {anzahl} AS Anzahl
  FROM {src}"""


cte("dense", export_select("""(SELECT sp.*, COALESCE(f.Anzahl, 0) AS Anz FROM span sp LEFT JOIN facts f
    ON sp.IdLandkreis = f.IdLandkreis AND sp.IdBundesland = f.IdBundesland AND sp.Datum = f.Meldedatum
   AND sp.Altersgruppe = f.Altersgruppe AND sp.Geschlecht = f.Geschlecht AND sp.Status = f.Status) x""",
                            "Anz"), "span", "facts")

cte("star", export_select("""(SELECT f.*, date_diff('day', b.lo, f.Meldedatum) AS id_time,
          g.geo_rank * b.n_days + date_diff('day', b.lo, f.Meldedatum) AS id_lk_time,
          g.state_rank * b.n_days + date_diff('day', b.lo, f.Meldedatum) AS id_bl_time
   FROM facts f JOIN geo_ranked g ON f.IdBundesland = g.IdBundesland AND f.IdLandkreis = g.IdLandkreis,
        bounds b WHERE f.Anzahl <> 0) x"""), "facts", "geo_ranked", "bounds")

# ----------------------------------------------------------- daily series
def _cents(kind: str) -> str:
    return (f"CAST(COALESCE(SUM(CASE WHEN event_type = '{kind}' "
            f"THEN CAST(round(value * 100) AS BIGINT) END), 0) AS BIGINT)")


cte("daily", f"""
  SELECT user_id AS lu_id, CAST(ts AS DATE) AS date,
         {_cents('click')} AS confirmed, {_cents('error')} AS deaths,
         {_cents('signup')} AS recovered, {_cents('purchase')} AS tested
  FROM events GROUP BY user_id, CAST(ts AS DATE)""")

cte("tests_clean", """
  SELECT lu_id, date, tested AS tested_reported, NULLIF(tested, 0) AS tested_reported_or_nan
  FROM daily""", "daily")

W_ORD = "PARTITION BY lu_id ORDER BY date"
def est_body(src: str) -> str:
    return f"""
  SELECT lu_id, date, tested_reported, tested_reported_or_nan, tested_announced,
         CASE WHEN n >= 2 THEN greatest((y1 - y0) / (x1 - x0) * (x - x0) + y0, CAST(0 AS DOUBLE))
              ELSE CAST(tested_announced AS DOUBLE) END AS tested
  FROM (
    SELECT *,
      COALESCE(first_value(sx0 IGNORE NULLS) OVER ({W_ORD} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
               last_value(sx0 IGNORE NULLS) OVER ({W_ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS x0,
      COALESCE(first_value(sy0 IGNORE NULLS) OVER ({W_ORD} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
               last_value(sy0 IGNORE NULLS) OVER ({W_ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS y0,
      COALESCE(first_value(sx1 IGNORE NULLS) OVER ({W_ORD} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
               last_value(sx1 IGNORE NULLS) OVER ({W_ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS x1,
      COALESCE(first_value(sy1 IGNORE NULLS) OVER ({W_ORD} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
               last_value(sy1 IGNORE NULLS) OVER ({W_ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS y1
    FROM (
      SELECT *,
        CASE WHEN kx IS NOT NULL AND px IS NOT NULL THEN px END AS sx0,
        CASE WHEN kx IS NOT NULL AND px IS NOT NULL THEN py END AS sy0,
        CASE WHEN kx IS NOT NULL AND px IS NOT NULL THEN kx END AS sx1,
        CASE WHEN kx IS NOT NULL AND px IS NOT NULL THEN ky END AS sy1
      FROM (
        SELECT *,
          last_value(kx IGNORE NULLS) OVER ({W_ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS px,
          last_value(ky IGNORE NULLS) OVER ({W_ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS py,
          COUNT(tested_reported_or_nan) OVER (PARTITION BY lu_id) AS n,
          last_value(tested_reported_or_nan IGNORE NULLS)
            OVER ({W_ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tested_announced
        FROM (
          SELECT *, CASE WHEN tested_reported_or_nan IS NOT NULL THEN x END AS kx,
                 CASE WHEN tested_reported_or_nan IS NOT NULL
                      THEN CAST(tested_reported_or_nan AS DOUBLE) END AS ky
          FROM (SELECT *, CAST(ROW_NUMBER() OVER ({W_ORD}) - 1 AS DOUBLE) AS x FROM {src}) a
        ) b
      ) c
    ) d
  ) e"""


cte("tests_est", est_body("tests_clean"), "tests_clean")

def dec_body(src: str) -> str:
    return f"""
  SELECT lu_id, date, tested_reported, ta AS tested_announced,
         round_even(COALESCE(te - ta, 0), 0) AS tested_extrapolated, te AS tested,
         CAST(CASE WHEN tested_reported_or_nan IS NULL THEN 1 ELSE 0 END AS BIGINT) AS tested_is_extrapolated
  FROM (SELECT *, round_even(COALESCE(CAST(tested_announced AS DOUBLE), 0), 0) AS ta,
               round_even(COALESCE(tested, 0), 0) AS te FROM {src}) x"""


cte("tests_decomposed", dec_body("tests_est"), "tests_est")


def lag0(c: str, n: int, name: str | None = None) -> str:
    return (f"COALESCE(lag({c}, {n}) OVER (PARTITION BY lu_id ORDER BY date), 0) "
            f"AS {name or f'lag_{n}_{c}'}")


cte("series_active", f"""
  SELECT *, COALESCE(confirmed - deaths - recovered - probably_recovered, 0) AS active
  FROM (SELECT *, greatest(least(lag_21_confirmed, confirmed) - recovered - deaths, 0) AS probably_recovered
        FROM (SELECT *, {lag0('confirmed', 21)} FROM daily) a) b""", "daily")

SERIES_LAGGED = ["confirmed", "recovered", "deaths", "tested", "active"]
cte("series_lags", "SELECT *, " + ", ".join(
    [lag0(c, 1) for c in SERIES_LAGGED] + [lag0(c, 7) for c in SERIES_LAGGED])
    + " FROM series_active", "series_active")

cte("districts", f"""
  SELECT {pad5(DISTRICT_CODE)} AS rs, n.n_name AS name,
         CAST(COALESCE(c.population, 0) AS BIGINT) AS population
  FROM nation n LEFT JOIN (SELECT c_nationkey, COUNT(*) AS population FROM customer GROUP BY c_nationkey) c
    ON n.n_nationkey = c.c_nationkey""")

cte("district_category", f"""
  SELECT {pad5(DISTRICT_CODE)} AS kreis_id,
         CAST(n.n_nationkey AS BIGINT) AS krs17, CAST(COALESCE(s.n_suppliers, 0) AS BIGINT) AS n_suppliers
  FROM nation n LEFT JOIN (SELECT s_nationkey, COUNT(*) AS n_suppliers FROM supplier GROUP BY s_nationkey) s
    ON n.n_nationkey = s.s_nationkey""")

cte("geo_full", f"""
  SELECT g.IdBundesland, g.Bundesland, g.IdLandkreis, g.Landkreis, d.population, c.n_suppliers,
         CAST(1 AS BIGINT) AS ones
  FROM geo g LEFT JOIN districts d ON g.IdLandkreis = d.rs
  LEFT JOIN district_category c ON g.IdLandkreis = c.kreis_id""", "geo", "districts", "district_category")

# ------------------------------------------------------------------ feeds
cte("state_time", 'SELECT DISTINCT "index", IdBundesland, Bundesland, Datum, id_time, id_bl_time FROM bridge',
    "bridge")

cte("mobility", f"""
  SELECT 'R-' || substr(r.r_name, 1, 2) AS iso_3166_2_code, r.r_name AS sub_region_1,
         strftime({LATER}, '%Y-%m-%d') AS date,
         CAST(SUM(CASE WHEN substr(o.o_orderpriority, 1, 1) = '1' THEN 1 ELSE 0 END) AS BIGINT) AS p1,
         CAST(SUM(CASE WHEN substr(o.o_orderpriority, 1, 1) = '2' THEN 1 ELSE 0 END) AS BIGINT) AS p2,
         CAST(SUM(CASE WHEN substr(o.o_orderpriority, 1, 1) = '3' THEN 1 ELSE 0 END) AS BIGINT) AS p3,
         CAST(SUM(CASE WHEN substr(o.o_orderpriority, 1, 1) = '4' THEN 1 ELSE 0 END) AS BIGINT) AS p4,
         CAST(SUM(CASE WHEN substr(o.o_orderpriority, 1, 1) = '5' THEN 1 ELSE 0 END) AS BIGINT) AS p5,
         COUNT(*) AS p6
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY 1, 2, 3""")

cte("policy", f"""
  SELECT n.n_name AS CountryName, CAST(strftime({LATER}, '%Y%m%d') AS INTEGER) AS Date,
         COUNT(*) AS StringencyIndex
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2""")

cte("world_pairs", """
  SELECT DISTINCT n.n_name AS country_region,
         CASE WHEN n.n_name IN ('NATION_1', 'NATION_6') THEN '' ELSE CAST(e.user_id AS VARCHAR) END AS province_state
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""")

cte("country_lookup", """
  SELECT lu.iso2, lu.country_region, lu.iso3, lu.lu_id, lu.province_state,
         COALESCE(m.country_region_map, lu.country_region) AS country_region_map,
         COALESCE(g.country_group, '') AS country_group
  FROM (SELECT ROW_NUMBER() OVER (ORDER BY kind, key) - 1 AS lu_id, iso2, iso3,
               COALESCE(Province_State, '') AS province_state, Country_Region AS country_region
        FROM (SELECT 0 AS kind, CAST(n_nationkey AS BIGINT) AS key, CAST(NULL AS VARCHAR) AS Province_State,
                     n_name AS Country_Region, 'N' || CAST(n_nationkey AS VARCHAR) AS iso2,
                     'NAT' || CAST(n_nationkey AS VARCHAR) AS iso3 FROM nation
              UNION ALL
              SELECT 1, CAST(c.c_custkey AS BIGINT), CAST(c.c_custkey AS VARCHAR), n.n_name,
                     'N' || CAST(n.n_nationkey AS VARCHAR), 'NAT' || CAST(n.n_nationkey AS VARCHAR)
              FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey) b) lu
  LEFT JOIN (SELECT n.n_name AS country_region,
                    upper(substr(lower(n.n_name), 1, 1)) || substr(lower(n.n_name), 2) AS country_region_map
             FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) m
    ON lu.country_region = m.country_region
  LEFT JOIN (SELECT 'N' || CAST(n.n_nationkey AS VARCHAR) AS iso2, r.r_name AS country_group
             FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) g
    ON lu.iso2 = g.iso2
  JOIN world_pairs p ON lu.country_region = p.country_region AND lu.province_state = p.province_state""",
    "world_pairs")


# ----------------------------------------------------------- world series
def _world_sum(kind: str, name: str) -> str:
    return f"CAST(COALESCE(SUM(c.v_{kind}), 0) AS BIGINT) AS {name}"


cte("world_cells", """
  SELECT CAST(e.user_id AS VARCHAR) AS ps, n.n_name AS cr, CAST(e.ts AS DATE) AS d,
         SUM(CASE WHEN e.event_type = 'click' THEN CAST(round(e.value * 100) AS BIGINT) END) AS v_click,
         SUM(CASE WHEN e.event_type = 'signup' THEN CAST(round(e.value * 100) AS BIGINT) END) AS v_signup,
         SUM(CASE WHEN e.event_type = 'error' THEN CAST(round(e.value * 100) AS BIGINT) END) AS v_error
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2, 3""")

CALENDAR = ("SELECT CAST(unnest(generate_series(MIN(CAST(ts AS DATE)), MAX(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d "
            "FROM events")
cte("calendar", CALENDAR)

cte("world_long", f"""
  SELECT p.cr AS country_region,
         CASE WHEN p.cr IN ('NATION_1', 'NATION_6') THEN '' ELSE COALESCE(p.ps, '') END AS province_state,
         dd.d AS date, {_world_sum('click', 'confirmed')}, {_world_sum('signup', 'recovered')},
         {_world_sum('error', 'deaths')}
  FROM (SELECT DISTINCT ps, cr FROM world_cells) p CROSS JOIN calendar dd
  LEFT JOIN world_cells c ON c.ps = p.ps AND c.cr = p.cr AND c.d = dd.d
  GROUP BY 1, 2, 3""", "world_cells", "calendar")

cte("world_te", """
  SELECT lu.lu_id, CAST(t.date AS DATE) AS date,
         CAST(COALESCE(SUM(COALESCE(t.total_tests, 0)), 0) AS BIGINT) AS tested
  FROM (SELECT 'NAT' || CAST(n.n_nationkey AS VARCHAR) AS iso_code, n.n_name AS location,
               strftime(e.ts, '%Y-%m-%d') AS date, SUM(CAST(round(e.value * 100) AS BIGINT)) AS total_tests
        FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
        WHERE e.event_type = 'purchase' GROUP BY 1, 2, 3) t
  FULL OUTER JOIN (SELECT * FROM country_lookup WHERE iso3 IS NOT NULL) lu ON t.iso_code = lu.iso3
  WHERE lu.lu_id IS NOT NULL AND t.date IS NOT NULL
  GROUP BY 1, 2""", "country_lookup")

cte("world_tests_clean", """
  SELECT lu_id, date, tested AS tested_reported, NULLIF(tested, 0) AS tested_reported_or_nan FROM world_te""",
    "world_te")
cte("world_tests_est", est_body("world_tests_clean"), "world_tests_clean")
cte("world_tests_dec", dec_body("world_tests_est"), "world_tests_est")

cte("world_active", f"""
  SELECT *, COALESCE(confirmed - deaths - recovered - probably_recovered, 0) AS active
  FROM (SELECT *, greatest(least(lag_21_confirmed, confirmed) - recovered - deaths, 0) AS probably_recovered
        FROM (SELECT *, {lag0('confirmed', 21)} FROM (
          SELECT t.lu_id, w.date, w.country_region, w.province_state, w.confirmed, w.recovered, w.deaths,
                 t.tested_reported, t.tested_announced, t.tested_extrapolated, t.tested, t.tested_is_extrapolated
          FROM world_long w
          JOIN country_lookup lu ON w.country_region = lu.country_region AND w.province_state = lu.province_state
          JOIN world_tests_dec t ON t.lu_id = lu.lu_id AND t.date = w.date) j) a) b""",
    "world_long", "country_lookup", "world_tests_dec")

WORLD_LAGGED = ["confirmed", "recovered", "deaths", "tested", "active", "tested_is_extrapolated"]
cte("world_series", "SELECT *, " + ", ".join(
    [lag0(c, n) for n in (1, 7) for c in WORLD_LAGGED]) + " FROM world_active", "world_active")
