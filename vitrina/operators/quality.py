"""Data-quality expectations.

A rule is a named boolean expression with an action:

* ``warn``  - count failures, keep the row (Q1)
* ``drop``  - remove failing rows (Q2)
* ``fail``  - abort the job on the first failing row (Q3)

A rule whose expression is NULL counts as failed. Rules are evaluated on
the same input rows, all in one projection; metrics come from one pass.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vitrina.functions.temporal import as_of_date, as_of_timestamp
from vitrina.functions.text import EMAIL_PATTERN, join_reasons
from vitrina.sources import files

ACTIONS = ("warn", "drop", "fail")


@dataclass(frozen=True)
class Expectation:
    name: str
    condition: str | Column
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}, got {self.action!r}")

    def column(self) -> Column:
        c = F.expr(self.condition) if isinstance(self.condition, str) else self.condition
        return c

    def passed(self) -> Column:
        """True only when the condition is true; NULL fails."""
        return F.coalesce(self.column(), F.lit(False))


def expect(name: str, condition: str | Column) -> Expectation:
    return Expectation(name, condition, "warn")


def expect_or_drop(name: str, condition: str | Column) -> Expectation:
    return Expectation(name, condition, "drop")


def expect_or_fail(name: str, condition: str | Column) -> Expectation:
    return Expectation(name, condition, "fail")


def constraints_from_dict(rules: dict[str, tuple[str | Column, str]]) -> list[Expectation]:
    """Q4: ``{name: (sql_or_column, action)}`` -> list of expectations."""
    return [Expectation(name, cond, action) for name, (cond, action) in rules.items()]


def _observe_exprs(rules: Sequence[Expectation]) -> list[Column]:
    exprs = [F.count(F.lit(1)).alias("__rows")]
    exprs += [F.count_if(~r.passed()).alias(f"failed:{r.name}") for r in rules]
    return exprs


def apply_expectations(df: DataFrame, rules: Iterable[Expectation],
                       observation: Observation | str | None = None) -> DataFrame:
    """Apply warn/drop/fail rules to ``df``.

    Failure counts of every rule, over the same input rows, are attached
    to the plan with ``DataFrame.observe`` and collected when the plan runs
    (no extra pass). Pass an ``Observation`` to read them (batch), or a
    name (streaming: they appear in the query progress). The observe node
    also keeps the optimizer from pushing later filters below it, so the
    cleaned columns are computed once per row and not re-inlined into
    every predicate that reads them.

    Fail and drop rules are one expression in one filter: it raises for a row
    that fails a fail rule before it looks at the drop rules, so the optimizer
    cannot test a drop rule first.
    """
    rules = list(rules)
    if not rules:
        return df
    if observation is None:
        observation = f"expectations_{uuid.uuid4().hex[:12]}"
    if isinstance(observation, str) or not df.isStreaming:
        df = df.observe(observation, *_observe_exprs(rules))
    fails = [r for r in rules if r.action == "fail"]
    drops = [r for r in rules if r.action == "drop"]
    keep = F.lit(True)
    for r in drops:
        keep = keep & r.passed()
    for r in reversed(fails):
        keep = F.when(r.passed(), keep).otherwise(F.raise_error(F.lit(f"expectation '{r.name}' failed")).cast("boolean"))
    return df.filter(keep) if fails or drops else df


def expectation_metrics(df: DataFrame, rules: Iterable[Expectation]) -> DataFrame:
    """One row per rule (rule, action, passed_records, failed_records).

    One pass over ``df``: a single global aggregate (partial on every task,
    one tiny final merge), then one row per rule.
    """
    rules = list(rules)
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.count_if(~r.passed()).alias(f"f{i}") for i, r in enumerate(rules)]
    counts = df.agg(*aggs)
    per_rule = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"), F.col(f"f{i}").alias("failed"))
        for i, r in enumerate(rules)])
    return counts.select("total", F.explode(per_rule).alias("m")).select(
        "m.rule", "m.action",
        (F.col("total") - F.col("m.failed")).alias("passed_records"),
        F.col("m.failed").cast("long").alias("failed_records"),
    )


def observe_rules(df: DataFrame, rules: Iterable[Expectation], name: str) -> DataFrame:
    """Rows and failures of every rule as metrics of a (streaming) plan; no row changes."""
    return df.observe(name, *_observe_exprs(list(rules)))


def guarded_write(df: DataFrame, rules: Sequence[Expectation], path: str) -> tuple[str | None, int]:
    """Q3 as a transaction: the rows that pass are written to ``path`` only if no fail rule
    aborts. Returns (name of the rule that aborted, rows committed).

    The rows are written to a draft folder, which becomes ``path`` by one rename."""
    spark = df.sparkSession
    draft, seen = f"{path.rstrip('/')}_draft-{uuid.uuid4().hex[:8]}", Observation()
    try:
        apply_expectations(df, rules).observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(draft)
    except PySparkException as e:
        files.delete(spark, draft)
        aborted = next((r.name for r in rules if r.action == "fail" and f"expectation '{r.name}' failed" in str(e)), None)
        if aborted is None:
            raise  # another error is no verdict of a rule
        return aborted, 0
    files.mkdirs(spark, path.rstrip("/").rpartition("/")[0])
    files.rename(spark, draft, path)
    return None, int(seen.get["rows"])


def observed_metrics(observation: Observation | dict, rules: Iterable[Expectation]) -> list[dict]:
    """Turn an Observation filled by ``apply_expectations``, or the metrics that a
    streaming query reported, into metric rows."""
    got = observation if isinstance(observation, dict) else observation.get
    total = got["__rows"]
    out = []
    for r in rules:
        failed = got[f"failed:{r.name}"]
        out.append({"rule": r.name, "action": r.action,
                    "passed_records": total - failed, "failed_records": failed})
    return out


# ---------------------------------------------------------------------------
# Customers: warnings, valid / quarantine split, reasons
# ---------------------------------------------------------------------------

# Fixed values that must equal the reference's: limits, states, reason texts,
# and the rule names below.
DATE_LOWER = "1900-01-01"
QUARANTINE_STATE = "PENDIENTE_REVISION"
REASON_ID_MISSING = "ID cliente faltante"
REASON_EMAIL_MISSING = "Email faltante"
REASON_EMAIL_FORMAT = "Email formato inválido"
REASON_DATE_MISSING = "Fecha registro faltante"
REASON_DATE_RANGE = "Fecha registro fuera de rango"


def _date_in_range(as_of) -> Column:
    f = F.col("fecha_registro")
    return (f >= F.lit(DATE_LOWER).cast("date")) & (f <= as_of_date(as_of))


def clientes_warnings(as_of=None) -> list[Expectation]:
    """Q1: the five warn rules on cleaned customers."""
    return [
        expect("warning_id_cliente_null", F.col("id_cliente").isNotNull()),
        expect("warning_email_null", F.col("email").isNotNull()),
        expect("warning_email_format", F.col("email").rlike(EMAIL_PATTERN)),
        expect("warning_fecha_registro_null", F.col("fecha_registro").isNotNull()),
        expect("warning_fecha_registro_valida", _date_in_range(as_of)),
    ]


def clientes_valid_flag(as_of=None) -> Column:
    """All five checks hold. NULL-safe, so ``valid`` and ``~valid``
    partition the input exactly (P5 is its complement)."""
    cond = (
        F.col("id_cliente").isNotNull()
        & F.col("email").isNotNull()
        & F.col("email").rlike(EMAIL_PATTERN)
        & F.col("fecha_registro").isNotNull()
        & _date_in_range(as_of)
    )
    return F.coalesce(cond, F.lit(False))


def quarantine_reasons(as_of=None) -> Column:
    """Comma-joined reject reasons; NULL flags are skipped."""
    email, fecha = F.col("email"), F.col("fecha_registro")
    return join_reasons(
        F.when(F.col("id_cliente").isNull(), F.lit(REASON_ID_MISSING)),
        F.when(email.isNull(), F.lit(REASON_EMAIL_MISSING)),
        F.when(email.isNotNull() & ~email.rlike(EMAIL_PATTERN), F.lit(REASON_EMAIL_FORMAT)),
        F.when(fecha.isNull(), F.lit(REASON_DATE_MISSING)),
        F.when(fecha.isNotNull() & ~_date_in_range(as_of), F.lit(REASON_DATE_RANGE)),
    )


CLIENTE_COLUMNS = ("id_cliente", "nombre", "email", "ciudad", "fecha_registro")


def clientes_validos(clean: DataFrame, as_of=None) -> DataFrame:
    """Customers passing every check."""
    return clean.filter(clientes_valid_flag(as_of))


def clientes_cuarentena(clean: DataFrame, as_of=None) -> DataFrame:
    """P5/Q6/Q7: customers failing at least one check, with reasons."""
    return clean.filter(~clientes_valid_flag(as_of)).select(
        *CLIENTE_COLUMNS,
        quarantine_reasons(as_of).alias("razones_rechazo"),
        as_of_timestamp(as_of).alias("fecha_cuarentena"),
        F.lit(QUARANTINE_STATE).alias("estado"),
    )


def split_valid_quarantine(clean: DataFrame, as_of=None) -> tuple[DataFrame, DataFrame]:
    """Both sides from one boolean: exhaustive and disjoint."""
    return clientes_validos(clean, as_of), clientes_cuarentena(clean, as_of)


# ---------------------------------------------------------------------------
# Declared constraint sets (Q4). Patterns are Column expressions, so no
# SQL-literal escaping can change them.
# ---------------------------------------------------------------------------

def clientes_constraints() -> list[Expectation]:
    return [
        expect_or_fail("valid_id_cliente", F.col("id_cliente").isNotNull()),
        expect_or_drop("valid_email", F.col("email").rlike(EMAIL_PATTERN)),
    ]


def ventas_constraints() -> list[Expectation]:
    return [
        expect_or_fail("valid_id_venta", F.col("id_venta").isNotNull()),
        expect_or_drop("valid_cantidad", F.col("cantidad") > 0),
        expect_or_drop("valid_monto", F.col("monto") >= 0),
    ]


def common_constraints(id_column: str, number_columns: Sequence[str]) -> list[Expectation]:
    """The rules every table shares: an id is there, no number is negative
    (a missing number is not)."""
    return [
        expect_or_fail("valid_id", F.col(id_column).isNotNull()),
        *[expect_or_drop(f"no_negative_{c}", F.col(c).isNull() | (F.col(c) >= 0)) for c in number_columns],
    ]
