"""Expectations, the valid/quarantine split and metrics (FIXTURES section 5)."""

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from vitrina.operators import quality as Q

D = dt.date
AS_OF = "2024-06-30 12:00:00"
ROWS = [
    (1, "a@b.com", D(2024, 1, 5), None),
    (None, "a@b.com", D(2024, 1, 5), "ID cliente faltante"),
    (2, None, D(2024, 1, 5), "Email faltante"),
    (3, "bad", D(2024, 1, 5), "Email formato inválido"),
    (4, "a@b.com", None, "Fecha registro faltante"),
    (5, "a@b.com", D(1899, 12, 31), "Fecha registro fuera de rango"),
    (6, "a@b.com", D(2024, 7, 1), "Fecha registro fuera de rango"),
    (None, None, None, "ID cliente faltante, Email faltante, Fecha registro faltante"),
]


@pytest.fixture
def clean(spark):
    return spark.createDataFrame(
        [(r[0], "n", r[1], "c", r[2]) for r in ROWS],
        "id_cliente long, nombre string, email string, ciudad string, fecha_registro date")


def test_split_reasons(clean):
    valid, quarantine = Q.split_valid_quarantine(clean, AS_OF)
    assert [r.id_cliente for r in valid.collect()] == [1]
    got = {(r.id_cliente, r.email, r.fecha_registro): r for r in quarantine.collect()}
    for idc, email, fecha, reason in ROWS[1:]:
        row = got[(idc, email, fecha)]
        assert row.razones_rechazo == reason
        assert row.estado == "PENDIENTE_REVISION"
        assert row.fecha_cuarentena == dt.datetime(2024, 6, 30, 12)


def test_split_exhaustive_and_disjoint(spark, clean):
    valid, quarantine = Q.split_valid_quarantine(clean, AS_OF)
    assert valid.count() + quarantine.count() == clean.count()
    cols = list(Q.CLIENTE_COLUMNS)
    assert valid.select(cols).intersect(quarantine.select(cols)).count() == 0


def test_warn_metrics_one_pass(clean):
    m = {r.rule: (r.passed_records, r.failed_records)
         for r in Q.expectation_metrics(clean, Q.clientes_warnings(AS_OF)).collect()}
    assert m["warning_id_cliente_null"] == (6, 2)
    assert m["warning_email_null"] == (6, 2)
    assert m["warning_email_format"] == (5, 3)  # NULL e-mail fails the format rule too
    assert m["warning_fecha_registro_null"] == (6, 2)
    assert m["warning_fecha_registro_valida"] == (4, 4)


def test_observed_metrics_match_and_warn_keeps_rows(clean):
    obs = Observation("warns")
    out = Q.apply_expectations(clean, Q.clientes_warnings(AS_OF), obs)
    assert out.count() == clean.count()
    got = {m["rule"]: m["failed_records"] for m in Q.observed_metrics(obs, Q.clientes_warnings(AS_OF))}
    assert got["warning_email_format"] == 3


def test_drop_rule_null_fails(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, -1.0)], "id long, precio double")
    out = Q.apply_expectations(df, [Q.expect_or_drop("valid_precio", "precio > 0")])
    assert [r.id for r in out.collect()] == [1]


def test_fail_rule(spark):
    ok = spark.createDataFrame([(1,), (2,)], "id_venta long")
    assert Q.apply_expectations(ok, Q.ventas_constraints()[:1]).count() == 2
    bad = spark.createDataFrame([(1,), (None,)], "id_venta long")
    with pytest.raises(Exception, match="valid_id_venta"):
        Q.apply_expectations(bad, Q.ventas_constraints()[:1]).collect()


def test_constraint_dict(spark):
    rules = Q.constraints_from_dict({"pos": (F.col("x") > 0, "drop"), "nn": ("x IS NOT NULL", "warn")})
    df = spark.createDataFrame([(1,), (0,), (None,)], "x int")
    assert Q.apply_expectations(df, rules).count() == 1


def test_fail_rule_is_not_bypassed_by_a_drop_rule(spark):
    df = spark.createDataFrame([(1,), (None,)], "id long")
    rules = [Q.expect_or_fail("positive", F.col("id") > 0), Q.expect_or_drop("there", F.col("id").isNotNull())]
    with pytest.raises(Exception, match="positive"):
        Q.apply_expectations(df, rules).collect()
    with pytest.raises(Exception, match="positive"):
        Q.apply_expectations(df, rules[::-1]).count()


def test_not_null_is_checked_for_a_pruned_column(spark):
    from vitrina.operators.schema import enforce_schema
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k long, v string")
    with pytest.raises(Exception, match="NOT NULL column k"):
        enforce_schema(df, "k BIGINT NOT NULL, v STRING").select("v").collect()


def test_rule_names_may_hold_quotes(spark):
    df = spark.createDataFrame([(1,), (-1,)], "x int")
    assert [tuple(r) for r in Q.expectation_metrics(df, [Q.expect("it's", F.col("x") > 0)]).collect()] == [("it's", "warn", 1, 1)]


def test_common_constraints(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, -1.0)], "id long, precio double")
    assert [r.id for r in Q.apply_expectations(df, Q.common_constraints("id", ["precio"])).collect()] == [1, 2]
    with pytest.raises(Exception, match="valid_id"):
        Q.apply_expectations(spark.createDataFrame([(None, 1.0)], "id long, precio double"), Q.common_constraints("id", ["precio"])).collect()
