"""Readers and sinks: date parsing, file-order dedup, CSV quoting, JSON dates."""

import datetime as dt
import glob
import json
import os

from pyspark.sql import functions as F

from quarry.operators import aggregates as A
from quarry.operators import filters as FL
from quarry.sources import writers as W
from quarry.sources.readers import LABEL_SCHEMA, read_articles, read_labels


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_read_articles_parses_dates_and_keeps_file_order(spark):
    rows = [
        ("u1", "2024-01-02 03:04:05", "EN", "t1", "first"),
        ("u1", "2024-01-03", "en", "t1b", "second copy of u1"),
        ("u2", "not a date", "en", "t2", "x"),
        ("u3", None, "fr", "t3", "y"),
        ("u4", "2022-01-01T00:00:00+00:00", "en", None, None),
    ]
    df = spark.createDataFrame(rows, "url string, date string, language string, title string, text string")
    path = W.write_stage(df.coalesce(1), W.scratch_path(spark, "raw"))
    arts = read_articles(spark, path)
    got = {r.title: r.date for r in arts.collect()}
    assert got["t1"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got["t1b"] == dt.datetime(2024, 1, 3)
    assert got["t2"] is None and got["t3"] is None
    assert got[None] == dt.datetime(2022, 1, 1)
    rep = A.time_report(arts, "date").first()
    assert rep.n_missing_date == 2 and rep.parse_success_pct == 60.0
    assert rep.min_date_utc == "2022-01-01 00:00:00+00:00"
    first = FL.dedup_first(arts, ["url"], "_file_order")
    assert {r.url: r.title for r in first.collect()}["u1"] == "t1"


def test_csv_doubles_quotes_and_reads_back(spark):
    df = spark.createDataFrame([(1, 'He said "hi", then left', "Noise", 0)], LABEL_SCHEMA)
    path = W.write_report_csv(df, W.scratch_path(spark, "csv"))
    raw = open(glob.glob(os.path.join(_local(path), "*.csv"))[0]).read()
    assert '"He said ""hi"", then left"' in raw
    back = read_labels(spark, path).first()
    assert back.topic_name == 'He said "hi", then left'


def test_jsonl_dates_are_epoch_millis_and_unicode_kept(spark):
    df = spark.createDataFrame([("ü", dt.datetime(2022, 1, 1, 0, 0, 1))], "t string, date timestamp")
    path = W.write_jsonl(df, W.scratch_path(spark, "jsonl"))
    line = open(glob.glob(os.path.join(_local(path), "*.json"))[0], encoding="utf-8").read().strip()
    rec = json.loads(line)
    assert rec == {"t": "ü", "date": 1640995201000}
    assert "ü" in line


def test_materialize_cuts_lineage(spark):
    df = spark.range(10).withColumn("sq", F.col("id") * F.col("id"))
    m = W.materialize(df, "m")
    assert sorted(r.sq for r in m.collect()) == [i * i for i in range(10)]
    assert "Scan parquet" in m._jdf.queryExecution().executedPlan().toString()


def test_dates_of_common_forms(spark):
    from quarry.functions.dates import parse_date

    cases = [
        ("2022-01-01 10:00:00.5", dt.datetime(2022, 1, 1, 10, 0, 0, 500000)),
        ("2022-01-01T10:00:00.123456+02:00", dt.datetime(2022, 1, 1, 8, 0, 0, 123456)),
        ("2022-01-01T10:00:00Z", dt.datetime(2022, 1, 1, 10)),
        ("2022/01/01", dt.datetime(2022, 1, 1)),
        ("Jan 1, 2022", dt.datetime(2022, 1, 1)),
        ("January 15, 2022", dt.datetime(2022, 1, 15)),
        ("15 Jan 2022", dt.datetime(2022, 1, 15)),
        ("20220115", dt.datetime(2022, 1, 15)),
        ("Sat, 15 Jan 2022 10:00:00 GMT", dt.datetime(2022, 1, 15, 10)),
        ("not a date", None), ("", None), (None, None), ("2022-13-45", None),
    ]
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(cases)], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(parse_date(F.col("s"))).collect()]
    assert got == [w for _, w in cases]
    stamp = dt.datetime(2022, 1, 1, 10, 0, 0, 123000)
    df = spark.createDataFrame([(stamp,)], "t timestamp")
    assert df.select(parse_date(F.col("t"), "timestamp")).first()[0] == stamp


def test_csv_report_keeps_outer_spaces_quotes_and_line_breaks(spark):
    rows = [("a", " lead and trail "), ("b", 'say "no", twice'), ("c", "two\nlines"), ("d", None)]
    df = spark.createDataFrame(rows, "k string, v string")
    path = W.write_report_csv(df, W.scratch_path(spark, "csv"))
    back = spark.read.schema(df.schema).options(header=True, escape='"', multiLine=True).csv(path)
    assert sorted(map(tuple, back.collect())) == rows
