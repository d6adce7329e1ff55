"""Column helpers, typed conform, run-id shaping, date range bounds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickflow import schemas
from clickflow.functions import (epoch_ms_to_string, epoch_text_to_string, non_blank, real_id, split_ids,
                                 split_line, string_to_epoch_ms)
from clickflow.sources.adapters import visit_date_range
from clickflow.sources.sinks import with_task_id

from .helpers import action, actions_df


def test_text_helpers(spark):
    df = spark.createDataFrame([("1,,2,",), (" ",), (None,), ("a b  ",)], "s string")
    r = df.select(split_ids("s").alias("ids"), non_blank("s").alias("nb"),
                  split_line("s").alias("parts")).collect()
    assert r[0].ids == ["1", "2"] and r[0].nb is True
    assert r[1].ids == [] and r[1].nb is False
    assert r[2].ids is None and r[2].nb is False
    assert r[3].parts == ["a", "b"]


def test_real_id(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,), (-2,)], "c long")
    assert [r[0] for r in df.select(real_id("c")).collect()] == [True, False, False, True]


def test_epoch_round_trip(spark):
    df = spark.createDataFrame([(1704067210123, "1704067210123", "x1")], "ms long, t string, bad string")
    r = df.select(epoch_ms_to_string("ms").alias("a"),
                  epoch_text_to_string("t", "yyyy-MM-dd").alias("b"),
                  epoch_text_to_string("bad").alias("c"),
                  string_to_epoch_ms(epoch_ms_to_string("ms")).alias("d"),
                  string_to_epoch_ms(F.lit("not a time")).alias("e")).first()
    assert r.a == "2024-01-01 00:00:10" and r.b == "2024-01-01" and r.c is None
    assert r.d == 1704067210000 and r.e is None


def test_conform_casts_and_orders(spark):
    df = spark.createDataFrame([("1", "x", "2024-01-01 00:00:00", "1704067200000", "2024-01-01",
                                 "A", "C", "7", "3")],
                               "adid string, junk string, ts string, ts_ms string, date string, "
                               "area string, city string, userid string, event_id string")
    out = schemas.conform(df, schemas.AD_LOG)
    assert out.schema == schemas.AD_LOG
    with pytest.raises(ValueError):
        schemas.conform(df.drop("area"), schemas.AD_LOG)


def test_date_range_blank_bounds_open(spark):
    days = [dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc) for d in (1, 5, 9)]
    df = actions_df(spark, [action(i, t0=t) for i, t in enumerate(days)])
    assert visit_date_range(df, "", " ").count() == 3
    assert visit_date_range(df, "2024-01-05", None).count() == 2
    assert visit_date_range(df, None, "2024-01-05").count() == 2
    assert visit_date_range(df, "2024-01-05", "2024-01-05").count() == 1


def test_task_id_prefix(spark):
    df = spark.createDataFrame([(1,)], "a int")
    r = with_task_id(df, "run-1").collect()
    assert r[0].task_id == "run-1" and with_task_id(df).columns == ["task_id", "a"]


def test_blank_is_what_java_trims(spark):
    df = spark.createDataFrame([("\t",), ("\n \r",), ("\x1f",), ("\t7",), ("\u00a0",), (None,)], "s string")
    assert [r[0] for r in df.select(non_blank("s")).collect()] == [False, False, False, True, True, False]


def test_cluster_session_needs_a_shared_folder():
    from types import SimpleNamespace

    from clickflow.session import shared_root

    sc = SimpleNamespace(master="spark://host:7077", getConf=lambda: {}, getCheckpointDir=lambda: None)
    spark = SimpleNamespace(sparkContext=sc, conf={})
    with pytest.raises(ValueError):
        shared_root(spark)
