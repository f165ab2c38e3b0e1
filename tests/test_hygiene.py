"""Library code stays on Spark: no pandas round trips, no Python UDFs, and
driver collects only where the result is bounded by design."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[1] / "vitrina"

# file -> number of bounded collects it may contain, and why
ALLOWED_COLLECTS = {
}


def _sources():
    for p in sorted(ROOT.rglob("*.py")):
        if "llm" in p.relative_to(ROOT).parts:
            continue  # a separate part with rules of its own
        yield p.relative_to(ROOT).as_posix(), p.read_text()


def test_no_pandas_or_udfs():
    for name, text in _sources():
        assert "toPandas" not in text, name
        assert not re.search(r"\b(pandas_udf|F\.udf|@udf|mapInPandas|applyInPandas)\b", text), name


def test_collects_are_bounded():
    for name, text in _sources():
        n = len(re.findall(r"\.collect\(\)", text))
        assert n <= ALLOWED_COLLECTS.get(name, 0), (name, n)


def test_nothing_imports_the_optional_part():
    for name, text in _sources():
        assert "vitrina.llm" not in text and "corpus_pipeline" not in text, name


def test_entry_works_without_the_optional_part(monkeypatch):
    import sys

    import __spark_entry__ as entry

    for name in [m for m in sys.modules if m.startswith("vitrina.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "vitrina.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    names = set(entry.queries())
    assert "fact_ventas" in names and "pipeline" not in names
    assert not any(re.match(r"op\d+_", n) for n in {*names, *entry.oracle_sql()})
