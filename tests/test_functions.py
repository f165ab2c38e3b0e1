"""Row-level fixtures for every cleaning function (FIXTURES sections 3-4)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vitrina.functions import temporal
from vitrina.functions.numeric import decode_spelled_number, positive_amount, positive_int
from vitrina.functions.temporal import (
    calendar_columns, month_key, null_outside_date, null_outside_ts,
    parse_date_multi, parse_ts_multi, parse_ts_three,
)
from vitrina.functions.text import clean_code, clean_email, clean_motivo, clean_title

D, T = dt.date, dt.datetime

# input -> (customers date, returns timestamp, sales timestamp)
DATE_CASES = [
    ("2024-01-05", D(2024, 1, 5), T(2024, 1, 5), None),
    (" 2024-01-05 ", D(2024, 1, 5), T(2024, 1, 5), None),
    ("31/12/2023", D(2023, 12, 31), T(2023, 12, 31), None),
    ("12/31/2023", D(2023, 12, 31), T(2023, 12, 31), None),
    ("05/04/2024", D(2024, 4, 5), T(2024, 4, 5), None),
    ("05-04-2024", D(2024, 5, 4), T(2024, 5, 4), None),
    ("25-12-2023", D(2023, 12, 25), T(2023, 12, 25), None),
    ("12-25-2023", D(2023, 12, 25), T(2023, 12, 25), None),
    ("2023/07/09", D(2023, 7, 9), None, None),
    ("2023/07/09 10:11:12", D(2023, 7, 9), T(2023, 7, 9, 10, 11, 12), T(2023, 7, 9, 10, 11, 12)),
    ("2023/07/09garbage", D(2023, 7, 9), None, None),
    ("2023-07-09 10:11:12", D(2023, 7, 9), T(2023, 7, 9, 10, 11, 12), T(2023, 7, 9, 10, 11, 12)),
    ("09/07/2023 10:11:12", D(2023, 7, 9), T(2023, 7, 9, 10, 11, 12), T(2023, 7, 9, 10, 11, 12)),
    ("07-25-2023 10:11:12", None, T(2023, 7, 25, 10, 11, 12), None),
    ("25-07-2023 10:11:12", None, None, None),
    ("2024-02-30", None, None, None),
    ("1899-12-31", D(1899, 12, 31), T(1899, 12, 31), None),
    ("1999-12-31 23:59:59", D(1999, 12, 31), T(1999, 12, 31, 23, 59, 59), T(1999, 12, 31, 23, 59, 59)),
    ("2999-01-01", D(2999, 1, 1), T(2999, 1, 1), None),
    ("not a date", None, None, None),
    ("", None, None, None),
    (None, None, None, None),
]


def _rows(spark, values, *cols):
    return spark.createDataFrame([(v,) for v in values], "x string").select(*cols).collect()


def test_date_parsers(spark):
    rows = _rows(spark, [c[0] for c in DATE_CASES],
                 parse_date_multi("x").alias("d"), parse_ts_multi("x").alias("r"), parse_ts_three("x").alias("s"))
    for case, row in zip(DATE_CASES, rows):
        assert (row.d, row.r, row.s) == case[1:], case[0]


def test_range_rules(spark):
    df = spark.createDataFrame(
        [(D(1899, 12, 31), T(1999, 12, 31, 23, 59, 59)), (D(2024, 6, 30), T(2024, 6, 30, 0, 0, 0)),
         (D(2024, 7, 1), T(2024, 6, 30, 0, 0, 1)), (None, None)], "d date, t timestamp")
    got = df.select(null_outside_date("d", "2024-06-30 12:00:00").alias("d"),
                    null_outside_ts("t", "2024-06-30 12:00:00", upper="date").alias("ret"),
                    null_outside_ts("t", "2024-06-30 12:00:00", upper="instant").alias("sale")).collect()
    assert [r.d for r in got] == [None, D(2024, 6, 30), None, None]
    # returns: bounded by today at 00:00; sales: by the instant itself
    assert [r.ret for r in got] == [None, T(2024, 6, 30), None, None]
    assert [r.sale for r in got] == [None, T(2024, 6, 30), T(2024, 6, 30, 0, 0, 1), None]


def test_month_and_calendar(spark):
    df = spark.createDataFrame([(D(2024, 3, 3),), (None,)], "d date")
    r = df.select(month_key("d").alias("m"), *[c.alias(n) for n, c in calendar_columns("d").items()]).collect()
    assert r[0].m == "2024-03" and r[1].m is None
    assert (r[0].anio, r[0].mes, r[0].dia, r[0].trimestre) == (2024, 3, 3, 1)
    assert (r[0].nombre_mes, r[0].dia_semana, r[0].nombre_dia) == ("March", 1, "Sunday")


@pytest.mark.parametrize("raw,want", [
    ("5", 5), (" 5 ", 5), (" UNO ", 1), ("Diez", 10), ("cero", None), ("0", None), ("-2", None),
    ("3.7", None), ("23.0", None), ("once", None), ("", None), (None, None),
])
def test_cantidad(spark, raw, want):
    assert _rows(spark, [raw], positive_int(decode_spelled_number("x")).alias("q"))[0].q == want


MONTO = [("10.5", "10.50"), ("10.555", "10.56"), (" 7 ", "7.00"), ("1e3", "1000.00"), ("0.001", "0.00"),
         ("0", None), ("-1", None), ("abc", None), ("$5", None), ("1,5", None), ("NaN", None),
         ("Infinity", None), ("1e30", None), (None, None), ("19.999", "20.00"), ("gratis", None)]


def test_amounts(spark):
    rows = _rows(spark, [m[0] for m in MONTO], positive_amount("x").alias("m"))
    for (raw, want), row in zip(MONTO, rows):
        assert row.m == (Decimal(want) if want is not None else None), raw


EMAILS = [(" Ana@Mail.COM ", "ana@mail.com"), ("x.y+z@sub.mail.pe", "x.y+z@sub.mail.pe"), ("NULL", None),
          ("null ", None), ("", None), ("ana@mail", None), ("ana@mail.c", None), ("a b@mail.com", None),
          ("ñ@mail.com", None), (None, None)]


def test_email(spark):
    rows = _rows(spark, [e[0] for e in EMAILS], clean_email("x").alias("e"))
    assert [r.e for r in rows] == [e[1] for e in EMAILS]


MOTIVOS = [("  DEFECTO de fabrica ", "Defecto de fabrica"), ("talla", "Talla"), ("N/A", None), ("n/a", "N/a"),
           ("", None), ("   ", None), (None, None), ("x" * 1500, "X" + "x" * 1499)]


def test_motivo_whole_text(spark):
    rows = _rows(spark, [m[0] for m in MOTIVOS], clean_motivo("x").alias("m"))
    assert [r.m for r in rows] == [m[1] for m in MOTIVOS]


def test_title_and_code(spark):
    rows = _rows(spark, ["  juan PEREZ ", "maría-josé o'neil", "", None],
                 clean_title("x").alias("t"), clean_code("x").alias("c"))
    assert [r.t for r in rows] == ["Juan Perez", "María-josé O'neil", "", None]
    assert [r.c for r in rows] == ["JUAN PEREZ", "MARÍA-JOSÉ O'NEIL", "", None]


def test_no_python_udfs_in_functions(spark):
    df = spark.createDataFrame([("x",)], "x string").select(
        parse_date_multi("x"), parse_ts_multi("x"), parse_ts_three("x"), clean_email("x"),
        clean_motivo("x"), positive_amount("x"), positive_int(decode_spelled_number("x")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


def _three_formats(text):
    """The sales timestamps by their formats alone."""
    t = F.trim(F.col(text))
    return F.coalesce(*[F.when(t.rlike(temporal._SHAPE_GUARDS[f]), F.try_to_timestamp(t, F.lit(f))) for f in temporal.TS_THREE_FORMATS])


def test_usual_timestamps_need_no_format_parser(spark, monkeypatch):
    """Texts of 19 characters are cast, with the formats' results."""
    texts = ["2020-02-29 23:59:59", "2021/02/29 00:00:00", "29/02/2020 10:11:12", "31/04/2020 10:11:12", " 2020/12/31 24:00:00 ",
             "2020-01-01 00:00:60", "0000-01-01 00:00:00", "01/01/0000 00:00:00", "9999-12-31 23:59:59", "2020-13-01 00:00:00",
             "2020-01/01 00:00:00", "2020/01-01 00:00:00", "2020-01-01 00:00:0Z", "2020-01-01T00:00:00", "2020-01-01 00:00:00\n",
             "\t2020-01-01 00:00:00", "+020-01-01 00:00:00", "12020-01-01 00:00:00", "+12020/01/01 00:00:00", "01/01/12020 00:00:00",
             "2020-01-01", "2020-01-01 00:00:00Z", "2020-01-01 00:00:00.5", "", "N/D", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rows.select("t", temporal.parse_ts_three("t").cast("string").alias("got"), _three_formats("t").cast("string").alias("want")).collect():
        assert r.got == r.want, r
    monkeypatch.setattr(temporal, "_SHAPE_GUARDS", {f: "^none$" for f in temporal.TS_THREE_FORMATS})
    left = rows.where("t like '20%-% 23:59:59' or t like '29/%'").select(temporal.parse_ts_three("t").cast("string").alias("got"))
    assert sorted(r.got for r in left.collect()) == ["2020-02-29 10:11:12", "2020-02-29 23:59:59"]


def test_month_keys_of_any_year(spark):
    days = ["2020-01-31", "2020-10-01", "0999-09-09", "1000-01-01", "9999-12-31", "0001-01-01", "-0005-03-01", "+12020-11-01", None]
    rows = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("timestamp").alias("t"))
    for r in rows.select("t", temporal.month_key("t").alias("got"), F.date_format("t", "yyyy-MM").alias("want")).select("got", "want").collect():
        assert r.got == r.want, r


def test_number_words_of_any_length(spark):
    words = {"uno": "1", "ñandú": "7", "": "0", "veintiuno": "21"}
    texts = ["UNO", " uno ", "ÑANDÚ", "ñandu", "", "  ", "veintiuno", "veintidos", "12", "123", None]
    got = [r.v for r in spark.createDataFrame([(t,) for t in texts], "t string").select(decode_spelled_number("t", words).alias("v")).collect()]
    assert got == ["1", "1", "7", "ñandu", "0", "0", "21", "veintidos", "12", "123", None]


def test_texts_that_are_no_integer_are_not_cast(spark):
    """A failed cast throws; such texts skip it, with the cast's results."""
    texts = ["1", " 7 ", "-3", "+4", "4.5", ".5", "5.", "1e3", "2147483648", "N/D", "", "  ", "NaN", "1d", "3L", "0x1", "\t8\n", "9\u00a0",
             "1,5", "1_0", "99999999999999999999", "--1", "+", "\u0663", "uno", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    v = F.col("t").try_cast("int")
    got = rows.select("t", positive_int("t").alias("i"), F.when(v > 0, v).alias("want")).collect()
    for r in got:
        assert r.i == r.want, r
    assert [r.i for r in got][:4] == [1, 7, None, 4]
    # other types are cast as before
    assert tuple(spark.range(1).select(positive_int(F.lit(4.5).cast("double")), positive_int(F.lit(True))).first()) == (4, 1)
    # the plan asks for the shape before it casts
    assert "RLIKE" in rows.select(positive_int("t"))._jdf.queryExecution().optimizedPlan().toString()
