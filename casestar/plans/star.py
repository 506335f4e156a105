"""The live job: case reports -> star schema exports.

``build_star`` wires the operators into the five exports of the reference
run. The long facts are read by every export, so they are written once to
shared storage (``materialize``) instead of being recomputed per export.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from casestar.operators.aggregate import max_date_table
from casestar.operators.checks import observed_profile
from casestar.operators.cleaning import latest_snapshot, nonzero
from casestar.operators.dimensions import GEO_KEYS, date_dim, geo_dim, geo_time_keys, state_time_dim
from casestar.operators.facts import case_facts, split_rejects, star_facts
from casestar.operators.series import union_all
from casestar.plans.feeds import mobility_feed, policy_feed
from casestar.session import materialize


@dataclass
class StarSchema:
    facts: DataFrame        # long facts, zero rows included
    data_rki: DataFrame     # sparse fact export with ids
    data_geo_time: DataFrame
    data_time: DataFrame
    data_geo: DataFrame
    data_max_date: DataFrame
    # of a job
    profile: DataFrame | None = None            # a row per column of every export
    rejected: DataFrame | None = None           # raw rows left out, with the reason
    counts: dict[str, int] | None = None        # accepted, rejected, unmapped_age, null_key


def build_star(raw: DataFrame, districts: DataFrame | None = None,
               categories: DataFrame | None = None, persist_facts: bool = True) -> StarSchema:
    facts = case_facts(raw)
    if persist_facts:
        facts = materialize(facts, "facts")
    geo = geo_dim(facts, districts, categories)
    time = date_dim(facts)
    return StarSchema(
        facts=facts,
        data_rki=star_facts(facts),
        data_geo_time=geo_time_keys(geo, time),
        data_time=time,
        data_geo=geo,
        data_max_date=max_date_table(facts, "Meldedatum"),
    )


def run_job(spark, raw_path: str, out_dir: str, districts: DataFrame | None = None,
            categories: DataFrame | None = None, snapshot: bool = True,
            mobility: DataFrame | None = None, states: DataFrame | None = None,
            policy: DataFrame | None = None, country: str | None = None,
            world: DataFrame | None = None, world_lookup: DataFrame | None = None,
            one_file: bool = False) -> StarSchema:
    """The full refresh: snapshot the landed file(s), read, build, export, report.

    Writes ``source_snapshot`` (the landed lines as they are, in Parquet), ``reports``
    (the raw rows, accepted and rejected apart), and as TSV ``data_rki`` (non-zero facts),
    ``data_geo_time``, ``data_time``, ``data_geo`` and ``data_max_date``; with their inputs
    given also ``data_mobility``, ``data_stringency``, ``data_country``, ``data_world`` and
    ``data_world_latest``. The large ones are written by all tasks, each part with a
    header; with ``one_file`` their parts put end to end are one ordered file with one
    header. Bad dates do not stop the job: their rows are in the report. The profile of
    each export is counted while it is written.
    """
    from casestar.sources.readers import read_facts
    from casestar.sources.sinks import export_ordered_tsv, export_tsv, snapshot_files

    if snapshot:
        snapshot_files(spark, raw_path, f"{out_dir}/source_snapshot")
    raw, rejected, counts = split_rejects(read_facts(spark, raw_path), f"{out_dir}/reports")
    star = build_star(raw, districts, categories)
    profiles = []

    def export(df: DataFrame, name: str, order: list[str] | None = None) -> None:
        if order and one_file:
            result = export_ordered_tsv(df, f"{out_dir}/{name}", order, profile_as=name)
        else:
            seen, result = observed_profile(df, name)
            export_tsv(seen, f"{out_dir}/{name}", single_file=not order)
        profiles.append(result())

    export(star.data_max_date, "data_max_date")
    export(nonzero(star.data_rki, "Anzahl"), "data_rki", ["id_lk_time", "Altersgruppe", "Geschlecht", "Status"])
    export(star.data_geo_time, "data_geo_time", ["id_lk_time"])
    export(star.data_time, "data_time")
    export(star.data_geo, "data_geo")
    if mobility is not None:
        state_time = state_time_dim(star.data_geo.select(*GEO_KEYS), star.data_time)
        export(mobility_feed(mobility, states, state_time), "data_mobility", ["index"])
    if policy is not None:
        export(policy_feed(policy, star.data_time, country), "data_stringency", ["id_time"])
    if world_lookup is not None:
        export(world_lookup, "data_country", ["lu_id"])
    if world is not None:
        world = materialize(world, "world")
        export(world, "data_world", ["lu_id", "date"])
        export(latest_snapshot(world, "date"), "data_world_latest", ["lu_id"])
    return replace(star, profile=union_all(profiles), rejected=rejected, counts=counts)


def main(argv: list[str] | None = None) -> None:
    import argparse

    from casestar.session import build_session, clean_scratch
    from casestar.sources.readers import (
        CATEGORIES_SCHEMA, STATE_ISO_SCHEMA, read_categories, read_districts, read_lookup, read_mobility, read_policy)

    ap = argparse.ArgumentParser(description="case reports -> star schema exports")
    ap.add_argument("raw_path")
    ap.add_argument("out_dir")
    ap.add_argument("--districts", help="TSV with rs and population")
    ap.add_argument("--categories", help="TSV with kreis_id and krs17")
    ap.add_argument("--mobility", help="CSV of the mobility reports")
    ap.add_argument("--states", help="TSV with iso_3166_2_code and IdBundesland, for the mobility reports")
    ap.add_argument("--policy", help="CSV of the policy index")
    ap.add_argument("--country", help="country of the policy index")
    ap.add_argument("--one-file", action="store_true", help="parts of an export put end to end are one file")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    spark = build_session(args.master or "local[*]")
    report = run_job(
        spark, args.raw_path, args.out_dir,
        read_districts(spark, args.districts) if args.districts else None,
        read_categories(spark, args.categories, CATEGORIES_SCHEMA) if args.categories else None,
        mobility=read_mobility(spark, args.mobility) if args.mobility else None,
        states=read_lookup(spark, args.states, STATE_ISO_SCHEMA) if args.states else None,
        policy=read_policy(spark, args.policy) if args.policy else None, country=args.country,
        one_file=args.one_file)
    report.profile.show(200, truncate=False)
    print(report.counts)
    clean_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
