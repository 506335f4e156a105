"""Snapshots, ordered exports, file-order ids, the fact store, rejects and the job."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from casestar.operators import dimensions as D
from casestar.operators import facts as FA
from casestar.operators import store as ST
from casestar.plans import feeds as FD
from casestar.plans import testviews as TV
from casestar.plans.star import run_job
from casestar.sources import readers as RD
from casestar.sources import sinks as SK

HEAD = "ObjectId,IdLandkreis,IdBundesland,Landkreis,Bundesland,Meldedatum,Altersgruppe,Geschlecht,AnzahlFall,AnzahlTodesfall,AnzahlGenesen,Refdatum"


def parts(folder):
    return sorted(glob.glob(f"{folder}/part-*"))


def land(tmp_path, files):
    folder = tmp_path / "landed"
    folder.mkdir()
    for name, data in files.items():
        (folder / name).write_bytes(data)
    return str(folder)


def test_snapshot_keeps_every_byte(spark, tmp_path):
    line = "1,05001,1,Größe,S,2020/1/5 0:0:0,A80+,M,1,0,0,x"
    files = {"a.csv": f"﻿{HEAD}\r\n{line}\r\n\r\n{line}\r\n".encode(),
             "b.csv": f"{HEAD}\n{line}\n".encode("latin-1"), "c.csv": (f"{HEAD}\n" + f"{line}\n" * 3000).encode()}
    landed = land(tmp_path, files)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")       # a file in several blocks
    try:
        SK.snapshot_files(spark, landed, str(tmp_path / "kept"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    kept = spark.read.parquet(str(tmp_path / "kept"))
    assert kept.groupBy("line_no").count().filter("count > 1").isEmpty() and kept.agg(F.max("line_no")).first()[0] == kept.count() - 1
    for name, data in files.items():
        rows = kept.filter(F.col("file").endswith(name)).orderBy("line_no").collect()
        assert b"".join(bytes(r.line) + b"\n" for r in rows) == data
        assert {r.file_size for r in rows} == {len(data)}
    SK.restore_files(spark, str(tmp_path / "kept"), str(tmp_path / "back"))
    for name, data in files.items():
        assert b"".join(open(p, "rb").read() for p in parts(tmp_path / "back" / f"name={name}")) == data


def test_lookup_files_with_other_column_order(spark, tmp_path):
    landed = land(tmp_path, {"a.tsv": b"rs\tpopulation\n1\t100\n", "b.tsv": b"population\trs\n200\t2\n"})
    with pytest.raises(Exception, match="(?i)header"):
        RD.read_districts(spark, landed).collect()
    one = tmp_path / "one.tsv"
    one.write_bytes("﻿population\trs\r\n200\t2\r\n".encode())
    assert [tuple(r) for r in RD.read_districts(spark, str(one)).collect()] == [("00002", 200)]


@pytest.mark.parametrize("n", [1, 4, 200])
@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_ids_follow_the_files(spark, tmp_path, n, kind):
    spark.range(2000).select((F.col("id") * 7919 % 2003).alias("v")).repartition(3).write.option("header", True).format(
        kind).save(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.shuffle.partitions", n)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        df = spark.read.option("header", True).schema("v long").format(kind).load(str(tmp_path / "t"))
        got = [r.v for r in D.with_file_order_id(df).orderBy("row_id").collect()]
        ids = sorted(r.row_id for r in D.with_file_order_id(df).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[1])
    want = []
    for p in parts(tmp_path / "t"):
        if kind == "csv":
            want += [int(x) for x in open(p).read().split("\n")[1:] if x]
        else:
            import pyarrow.parquet as pq
            want += pq.read_table(p)["v"].to_pylist()
    assert got == want and ids == list(range(2000))


def test_ids_need_no_sort_of_the_rows(spark, tmp_path):
    spark.range(3000).select("id").repartition(3).write.option("header", True).csv(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        reader = spark.read.option("header", True).schema("id long")
        ids = D.with_file_order_id(reader.csv(str(tmp_path / "t")).filter("id % 3 > 0"))
        plan = ids._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Exchange hash" not in plan and "Sort" not in plan
        assert sorted(r.row_id for r in ids.collect()) == list(range(2000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    paths = parts(tmp_path / "t")                                   # every file twice, in one task
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        both = reader.csv(paths + paths)
        assert both.select(F.spark_partition_id()).distinct().count() == 1
        twice = D.with_file_order_id(both).orderBy("row_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert [r.row_id for r in twice] == list(range(6000))
    want = [int(x) for p in paths for _ in range(2) for x in open(p).read().split("\n")[1:] if x]
    assert [r.id for r in twice] == want


def test_parts_put_end_to_end_are_one_file(spark, tmp_path):
    df = spark.range(500).select(F.col("id").alias("x"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("t\tö "), "id")).alias("s"),
                                 F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int")).alias("d"), F.lit(2.0).alias("y"))
    result = SK.export_ordered_tsv(df.repartition(5), str(tmp_path / "o"), ["x"], parts=4, profile_as="o")
    files = parts(tmp_path / "o")
    assert len(files) > 1
    data = b"".join(open(p, "rb").read() for p in files)
    assert data.startswith("﻿x\ts\td\ty\r\n".encode()) and data.count("﻿".encode()) == 1
    lines = data.decode().split("\r\n")
    assert len(lines) == 502 and lines[-1] == "" and lines[2] == '1\t"t\tö 1"\t2020-01-02\t2.0' and lines[1] == "0\t\t2020-01-01\t2.0"
    assert [int(x.split("\t")[0]) for x in lines[1:-1]] == list(range(500))
    assert {r.column: (r.non_null, r.row_count, r.position) for r in result().collect()} == {
        "x": (500, 500, 0), "s": (428, 500, 1), "d": (500, 500, 2), "y": (500, 500, 3)}


def test_latest_day_reads_one_part(spark, tmp_path):
    days = spark.range(400).select(F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 100).cast("int")).alias("day"), "id")
    days = days.union(spark.createDataFrame([(None, -1)], "day date, id long"))
    path = str(tmp_path / "store")
    ST.write_fact_store(days, "day", path, ["id"])
    assert ST.last_month(spark, path) == "2020-04"
    got = ST.latest_of_store(spark, path, "day")
    assert sorted(r.id for r in got.collect()) == [99, 199, 299, 399] and got.columns == ["day", "id"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "= 2020-04" in plan
    some = ST.read_fact_store(spark, path, "day", dt.date(2020, 1, 31), dt.date(2020, 2, 1))
    assert some.count() == 8 and ST.read_fact_store(spark, path).count() == 401
    assert "PartitionFilters: [isnotnull(month" in some._jdf.queryExecution().executedPlan().toString()


def test_rejects_and_counts(spark, tmp_path):
    def row(day, age, sex="M"):
        return (1, "S", 5001, "D", day, age, sex, 1, 0, 0)

    raw = spark.createDataFrame(
        [row("2020/1/5 0:0:0", "A80+"), row("zzz", "A80+"), row("2020/13/5 0:0:0", "A99"), row("2020/1/6 0:0:0", "A99"),
         row("2020/1/6 0:0:0", "unbekannt"), row(None, "A80+"), row("2020/1/7 0:0:0", "A80+", None)], RD.CASE_FACTS_SCHEMA)
    accepted, rejected, counts = FA.split_rejects(raw, str(tmp_path / "r"))
    assert counts == {"accepted": 5, "rejected": 2, "unmapped_age": 1, "null_key": 2}
    assert accepted.columns == raw.columns and accepted.count() + rejected.count() == raw.count()
    assert sorted((r.Meldedatum, r.reason) for r in rejected.collect()) == [("2020/13/5 0:0:0", "date"), ("zzz", "date")]
    assert FA.case_facts(accepted).agg(F.sum("Anzahl")).first()[0] == 3
    accepted, rejected, counts = FA.split_rejects(raw.limit(0), str(tmp_path / "none"))
    assert counts["accepted"] == 0 and accepted.count() == 0 and rejected.count() == 0


def test_rejects_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    days = F.when(F.col("id") % 5 > 0, F.lit("2020/1/5 0:0:0")).otherwise(F.lit("zzz"))
    raw = spark.range(0, 1000, 1, 3).select(*[
        (days if f.name == "Meldedatum" else F.col("id")).cast(f.dataType).alias(f.name) for f in RD.CASE_FACTS_SCHEMA.fields])
    key, write, held = "spark.sql.maxConcurrentOutputFileWriters", DataFrameWriter.parquet, []
    before = spark.conf.get(key)
    # with a writer for each state Spark plans no sort by state below the write
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: held.append(spark.conf.get(key)) or write(self, *a, **b))
    accepted, rejected, counts = FA.split_rejects(raw, str(tmp_path / "r"))
    assert held == ["2"] and spark.conf.get(key) == before
    assert (accepted.count(), rejected.count(), counts["accepted"], counts["rejected"]) == (800, 200, 800, 200)
    assert sorted(os.path.basename(x) for x in glob.glob(str(tmp_path / "r" / "state=*"))) == ["state=accepted", "state=rejected"]


def test_job_writes_and_reports_everything(spark, small_dir, tmp_path):
    raw = TV.case_reports(spark, small_dir).withColumn("ObjectId", F.lit(1))
    raw = raw.withColumn("Meldedatum", F.when(F.col("AnzahlFall") == 7, "zzz").otherwise(F.col("Meldedatum")))
    raw.repartition(2).write.option("header", True).csv(str(tmp_path / "raw"))
    out = str(tmp_path / "out")
    report = run_job(spark, str(tmp_path / "raw"), out, TV.districts(spark, small_dir), TV.district_category(spark, small_dir),
                     mobility=FD.mobility_input(spark, small_dir), states=TV.state_lookup(spark, small_dir),
                     policy=FD.policy_input(spark, small_dir), country="NATION_7",
                     world=FD.world_series(spark, small_dir),
                     world_lookup=FD.country_lookup(FD.lookup_input(spark, small_dir), FD.map_names_input(spark, small_dir),
                                                    FD.groups_input(spark, small_dir), FD.world_keys(spark, small_dir)),
                     one_file=True)
    names = ["data_max_date", "data_rki", "data_geo_time", "data_time", "data_geo", "data_mobility", "data_stringency",
             "data_country", "data_world", "data_world_latest"]
    profile = report.profile.collect()
    assert {r.table for r in profile} == set(names)
    for name in names:
        data = b"".join(open(p, "rb").read() for p in parts(f"{out}/{name}"))
        columns = [r for r in sorted((r for r in profile if r.table == name), key=lambda r: r.position)]
        head, *body = data.decode().split("\r\n")
        assert head == "﻿" + "\t".join(r.column for r in columns)
        assert body[-1] == "" and len(body) - 1 == columns[0].row_count
    assert os.path.exists(f"{out}/source_snapshot")
    bad = raw.filter("AnzahlFall = 7").count()
    assert report.counts["rejected"] == bad == report.rejected.count() > 0
    assert report.counts["accepted"] + bad == raw.count()
    assert report.data_rki.count() == next(r.row_count for r in profile if r.table == "data_rki")
