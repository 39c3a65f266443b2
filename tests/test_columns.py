import pytest
from pyspark.sql import functions as F

from shoplens.functions import columns as X


def one(spark, col, data=None, schema="x string"):
    df = spark.createDataFrame(data or [(None,)], schema)
    return [r[0] for r in df.select(col.alias("v")).collect()]


def test_unpadded_time(spark):
    df = spark.createDataFrame([("2019-06-10 5:07:09",), ("2019-06-10 15:07:09",)], "t string")
    got = df.select(X.format_time(X.parse_action_time("t")).alias("v"), X.action_seconds("t").alias("s")).collect()
    assert [r.v for r in got] == ["2019-06-10 05:07:09", "2019-06-10 15:07:09"]
    assert got[1].s - got[0].s == 36000


def test_time_keys(spark):
    df = spark.createDataFrame([("2019-06-10 5:07:09",)], "t string")
    ts = X.parse_action_time("t")
    r = df.select(X.date_hour(ts).alias("dh"), X.date_key(ts).alias("dk"), X.minute_key(ts).alias("mk"),
                  F.date_format(X.parse_date_key(F.lit("20190610")), "yyyy-MM-dd").alias("pd"),
                  X.is_before("t", F.lit("2019-06-10 6:00:00")).alias("b"),
                  X.is_after("t", F.lit("2019-06-10 6:00:00")).alias("a"),
                  X.seconds_between(F.lit("2019-06-10 6:00:00"), "t").alias("d")).first()
    assert (r.dh, r.dk, r.mk, r.pd, r.b, r.a, r.d) == ("2019-06-10_05", "20190610", "201906100507",
                                                         "2019-06-10", True, False, 3171)


def test_today_yesterday(spark):
    r = spark.range(1).select(X.today().alias("t"), X.yesterday().alias("y")).first()
    assert len(r.t) == 10 and r.t > r.y


@pytest.mark.parametrize("num,den,want", [(57, 200, 0.29), (1, 3, 0.33), (2, 3, 0.67), (0, 5, 0.0), (5, 5, 1.0),
                                          (1, 8, 0.13), (3, 0, None)])
def test_ratio_half_up(spark, num, den, want):
    got = one(spark, X.ratio_half_up(F.lit(num), F.lit(den)))
    assert got == [want]


def test_round_half_up(spark):
    assert one(spark, X.round_half_up(F.lit(0.285), 2)) == [0.29]


@pytest.mark.parametrize("s,want", [("", ""), ("a", "a"), (",a", "a"), ("a,", "a"), (",a,", "a"), (",,", "")])
def test_trim_comma(spark, s, want):
    assert one(spark, X.trim_comma(F.lit(s))) == [want]


def test_blank_and_pad(spark):
    data = [(None,), ("",), ("x",), ("5",), ("12",)]
    got = spark.createDataFrame(data, "x string").select(X.is_blank("x").alias("b"), X.pad2("x").alias("p")).collect()
    assert [r.b for r in got] == [True, True, False, False, False]
    assert [r.p for r in got][3:] == ["05", "12"]


def test_packed_field_read(spark):
    rows = [("a=1|b=2|c=3",), ("a=|b=x=y|b=7",), ("a=1=2",), (None,)]
    df = spark.createDataFrame(rows, "x string")
    got = [r[0] for r in df.select(X.packed_field("x", "b")).collect()]
    assert got == ["2", "7", None, None]
    assert [r[0] for r in df.select(X.packed_field("x", "a")).collect()] == ["1", None, None, None]


def test_packed_field_write(spark):
    df = spark.createDataFrame([("a=1|b=2|c=3",), ("a=1",)], "x string")
    got = [r[0] for r in df.select(X.set_packed_field("x", "b", "9")).collect()]
    assert got == ["a=1|b=9|c=3", "a=1"]


def test_split_ids(spark):
    df = spark.createDataFrame([("1,2,2",), ("",), (None,), (" 7",)], "x string")
    assert [r[0] for r in df.select(X.split_ids("x")).collect()] == [[1, 2, 2], [], [], [7]]
    bad = spark.createDataFrame([("1,x",)], "x string")
    with pytest.raises(Exception):
        bad.select(X.split_ids("x")).collect()


def test_product_status(spark):
    rows = [('{"product_status": 0}',), ('{"product_status": 1}',), ('{"other": 0}',), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(X.product_status("x")).collect()]
    assert got == ["Self", "Third Party", "Third Party", "Third Party"]


def test_area_level(spark):
    rows = [("华北",), ("华东",), ("华中",), ("西北",), ("东北",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(X.area_level("x")).collect()]
    assert got == ["A_Level", "A_Level", "B_Level", "C_Level", "D_Level", "D_Level"]


def test_group_concat_distinct(spark):
    rows = [("a", 5, "X"), ("a", 20, "Y"), ("a", 5, "X"), ("a", 7, None)]
    df = spark.createDataFrame(rows, "g string, id long, name string")
    got = df.groupBy("g").agg(X.group_concat_distinct(X.concat_long_string("id", "name", ":")).alias("v")).first().v
    assert got == "20:Y,5:X"  # string order, NULL names skipped


def test_packed_field_quotes_special_characters(spark):
    df = spark.createDataFrame([("axb=2|a.b=1",)], "x string")
    r = df.select(X.packed_field("x", "a.b").alias("v"), X.set_packed_field("x", "a.b", "$9\\z").alias("w")).first()
    assert r.v == "1"
    assert r.w == "axb=2|a.b=$9\\z"
    alt = spark.createDataFrame([("k:1;j:2",)], "x string")
    assert alt.select(X.packed_field("x", "j", ";")).first()[0] is None  # '=' is the key separator
    semi = spark.createDataFrame([("k=1;j=2",)], "x string")
    assert semi.select(X.packed_field("x", "j", ";")).first()[0] == "2"
