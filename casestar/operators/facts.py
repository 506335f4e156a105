"""Case facts: clean, sum, unpivot, densify and the sparse star export
(SURVEY O18, O42, O47, O60, O61).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from casestar.functions.columns import (
    DISTRICT_CODE_RECODE,
    DISTRICT_NAME_RECODE,
    UNKNOWN_LABEL,
    UNKNOWN_TEXT,
    active_of,
    midpoint,
    pad_code,
    parse_date,
    recode,
)
from casestar.operators.aggregate import bounds_scalar, sum_by
from casestar.operators.dimensions import GEO_KEYS, SPAN_VALUES, geo_ranked, spread, value_sets
from casestar.operators.joins import attach_facts
from casestar.operators.reshape import measures_to_status
from casestar.session import materialize, settings

FACT_KEYS = GEO_KEYS + ["Meldedatum", "Altersgruppe", "Geschlecht"]
MEASURES = ["AnzahlFall", "AnzahlTodesfall", "AnzahlGenesen"]
EXPORT_COLS = ["IdBundesland", "IdLandkreis", "id_time", "id_lk_time", "id_bl_time",
               "Altersgruppe", "Alter_Zahl", "Geschlecht", "Status", "Anzahl"]
SPAN_JOIN_LEFT = ["IdLandkreis", "IdBundesland", "Datum", "Altersgruppe", "Geschlecht", "Status"]
SPAN_JOIN_RIGHT = ["IdLandkreis", "IdBundesland", "Meldedatum", "Altersgruppe", "Geschlecht",
                   "Status"]


def reject_rows(raw: DataFrame) -> DataFrame:
    """Raw rows whose report date does not parse (the T9 reject table)."""
    parsed = parse_date("Meldedatum", "Y/m/d H:M:S", on_error="null")
    return raw.filter(F.col("Meldedatum").isNotNull() & parsed.isNull())


def split_rejects(raw: DataFrame, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(accepted, rejected, counts) in one pass over the raw rows.

    Rows are written once, below ``path``, parted by whether they can be used; a
    rejected row carries its ``reason`` (``date`` if the report date does not parse).
    The counts are taken in that same write: ``accepted`` and ``rejected`` rows,
    ``unmapped_age`` accepted rows whose age band has no midpoint (they stay, their
    midpoint is NULL), and ``null_key`` accepted rows with a NULL key, which no sum
    will include (T1). A task keeps a file of each state open, so that its rows need no
    sort by state before they are written.
    """
    spark = raw.sparkSession
    bad_date = F.col("Meldedatum").isNotNull() & parse_date("Meldedatum", "Y/m/d H:M:S", on_error="null").isNull()
    marked = raw.withColumn("reason", F.when(bad_date, F.lit("date"))).withColumn(
        "state", F.when(F.col("reason").isNull(), F.lit("accepted")).otherwise(F.lit("rejected")))
    fine = F.col("reason").isNull()
    label = recode("Altersgruppe", {UNKNOWN_TEXT: UNKNOWN_LABEL})
    no_key = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in FACT_KEYS])
    seen = Observation()
    marked = marked.observe(seen, F.count_if(fine).alias("accepted"), F.count_if(~fine).alias("rejected"), F.count_if(
        fine & label.isNotNull() & midpoint(label).isNull()).alias("unmapped_age"), F.count_if(fine & no_key).alias("null_key"))
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "2"}):
        marked.write.mode("overwrite").partitionBy("state").parquet(path)
    written = spark.read.schema(marked.schema).parquet(path)
    accepted = written.filter("state = 'accepted'").drop("reason", "state")
    return accepted, written.filter("state = 'rejected'").drop("state"), dict(seen.get)


def normalise_and_sum(raw: DataFrame, on_error: str = "raise") -> DataFrame:
    """One row per cleaned fact key with the three measures summed.

    Sum by the raw keys first (map-side combined, only hashing per raw row),
    then pad, recode and parse once per distinct raw key, then sum again:
    recoding can merge keys (T3). The per-row cost on the raw data is a
    hash, not a date parse, and the second shuffle moves aggregated rows only.
    """
    keyed = raw.select(*FACT_KEYS, *MEASURES).na.drop(subset=FACT_KEYS)
    first = keyed.groupBy(*FACT_KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
    clean = first.withColumns({
        "IdLandkreis": recode(pad_code("IdLandkreis"), DISTRICT_CODE_RECODE),
        "Landkreis": recode("Landkreis", DISTRICT_NAME_RECODE),
        "Meldedatum": parse_date("Meldedatum", "Y/m/d H:M:S", on_error),
    })
    return sum_by(clean, FACT_KEYS, MEASURES)


def geography_dates(raw: DataFrame, on_error: str = "raise") -> DataFrame:
    """(geography, lo, hi): each geography's first and last fact date.

    All that the dimensions need, without the fact sums: distinct raw
    geographies and dates (map-side combined), cleaned once each.
    """
    keyed = raw.select(*FACT_KEYS).na.drop(subset=FACT_KEYS).select(*GEO_KEYS, "Meldedatum").distinct()
    clean = keyed.withColumns({
        "IdLandkreis": recode(pad_code("IdLandkreis"), DISTRICT_CODE_RECODE),
        "Landkreis": recode("Landkreis", DISTRICT_NAME_RECODE),
        "Meldedatum": parse_date("Meldedatum", "Y/m/d H:M:S", on_error),
    })
    return clean.groupBy(*GEO_KEYS).agg(F.min("Meldedatum").alias("lo"), F.max("Meldedatum").alias("hi"))


def facts_summary(facts: DataFrame) -> DataFrame:
    """(geography, lo, hi) from long facts: one row per district for all dimensions."""
    return facts.groupBy(*GEO_KEYS).agg(F.min("Meldedatum").alias("lo"), F.max("Meldedatum").alias("hi"))


def case_facts(raw: DataFrame, on_error: str = "raise") -> DataFrame:
    """Long facts: keys, ``Status`` in (Todesfall, Genesen, Aktiv), ``Anzahl``.

    Sum on two levels (``normalise_and_sum``), derive active from the sums,
    then unpivot (a narrow ``Expand``). Zero rows are kept: date bounds and
    category sets are taken from all facts (T32).
    """
    wide = normalise_and_sum(raw, on_error)
    wide = wide.withColumn("AnzahlAktiv",
                           active_of("AnzahlFall", "AnzahlTodesfall", "AnzahlGenesen"))
    return measures_to_status(wide, FACT_KEYS, MEASURES + ["AnzahlAktiv"])


def finish_export(df: DataFrame) -> DataFrame:
    """Recode unknown age/sex, add the age midpoint, keep the export columns.

    Two steps in order (T10): the midpoint lookup must see the recoded age.
    """
    df = df.withColumns({
        "Geschlecht": recode("Geschlecht", {UNKNOWN_TEXT: UNKNOWN_LABEL}),
        "Altersgruppe": recode("Altersgruppe", {UNKNOWN_TEXT: UNKNOWN_LABEL}),
    })
    return df.withColumn("Alter_Zahl", midpoint("Altersgruppe")).select(*EXPORT_COLS)


def densify(span: DataFrame, facts: DataFrame) -> DataFrame:
    """Dense facts over the whole key span, missing combinations as 0."""
    joined = attach_facts(span, facts, SPAN_JOIN_LEFT, SPAN_JOIN_RIGHT)
    return finish_export(joined.withColumn("Anzahl", F.coalesce(F.col("Anzahl"), F.lit(0))))


def attach_packed(bridge: DataFrame, facts: DataFrame, value_cols: Sequence[str] = tuple(SPAN_VALUES),
                  value: str = "Anzahl") -> DataFrame:
    """The span with each combination's ``value``, NULL where there is no fact.

    Equal to joining the span with the facts on six keys, but neither the span nor the
    facts are shuffled row by row: the facts of a (district, day) are packed into one
    map by the position of their category combination, the bridge meets these maps on
    (state, district, day), and only then every row explodes the category product and
    looks each combination up. Two facts for one key fail the job (the map holds a key
    once), as the many-to-one join must (T13). The number of tasks is that of the
    shuffle partitions, whether or not the maps are small enough to be broadcast.
    """
    sets = value_sets(facts, value_cols)
    code, size = F.lit(0).cast("bigint"), {}
    for c in value_cols:
        size[c] = F.size(sets[c])
        code = code * size[c] + F.array_position(sets[c], F.col(c)) - 1
    keys = {"IdBundesland": "IdBundesland", "IdLandkreis": "IdLandkreis", "Meldedatum": "Datum"}
    packed = facts.select(*[F.col(c).alias(name) for c, name in keys.items()], code.alias("__code"), value).groupBy(
        *keys.values()).agg(F.map_from_entries(F.collect_list(F.struct("__code", value))).alias("__facts"))
    out = spread(bridge, list(keys.values())).join(packed, list(keys.values()), "left")
    found = F.lit(0).cast("bigint")
    for c in value_cols:
        out = out.select("*", F.posexplode(sets[c]).alias(f"__{c}", c))
        found = found * size[c] + F.col(f"__{c}")
    return out.withColumn(value, F.try_element_at("__facts", found)).select(*bridge.columns, *value_cols, value)


def densify_packed(bridge: DataFrame, facts: DataFrame) -> DataFrame:
    """Dense facts over the whole key span, missing combinations as 0 (O60); the rows
    of ``densify(dense_span(bridge, facts), facts)`` without a join of the span."""
    joined = attach_packed(bridge, facts)
    return finish_export(joined.withColumn("Anzahl", F.coalesce(F.col("Anzahl"), F.lit(0))))


def star_facts(facts: DataFrame, geo: DataFrame | None = None) -> DataFrame:
    """The sparse fact export with every surrogate id (O61, flagship).

    Equal to ``nonzero(densify(span, facts))`` but never builds the span:
    non-zero facts join the (district-sized) ranked geography on ids only
    (T33) and the ids are computed by formula. Bounds and geography come
    from all facts, zero rows included (T32); negative counts stay (T23).
    """
    if geo is None:
        geo = facts.select(*GEO_KEYS).distinct()
    # Written, so that its size is known when the join is planned: the facts
    # then meet a broadcast of one row per district and are not shuffled.
    ranks = materialize(geo_ranked(geo).select("IdBundesland", "IdLandkreis", "geo_rank", "state_rank"), "geo_ranks")
    lo, hi = bounds_scalar(facts, "Meldedatum")
    n_days = (F.datediff(hi, lo) + 1).cast("bigint")
    nz = facts.filter(F.col("Anzahl") != 0).drop("Bundesland", "Landkreis")
    t = F.datediff("Meldedatum", lo).cast("bigint")
    out = nz.join(ranks, ["IdBundesland", "IdLandkreis"]).withColumns({
        "id_time": t,
        "id_lk_time": F.col("geo_rank") * n_days + t,
        "id_bl_time": F.col("state_rank") * n_days + t,
    })
    return finish_export(out)
