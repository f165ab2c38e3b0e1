"""Numeric decoding."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: spelled-out numbers.
SPELLED_NUMBERS = {
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5",
    "seis": "6", "siete": "7", "ocho": "8", "nueve": "9", "diez": "10",
}


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def decode_spelled_number(col: Column | str, words: dict[str, str] = SPELLED_NUMBERS) -> Column:
    """M1/M6: map ``lower(trim(x))`` through the word table, else keep x.

    ``try_element_at`` returns NULL for a missing key under ANSI mode. A lookup compares
    with every word, so only texts as long as some word are looked up.
    """
    table = F.create_map(*[F.lit(v) for v in chain(*words.items())])
    c = _c(col)
    word = F.lower(F.trim(c))
    found = F.when(F.length(word).isin(sorted({len(w) for w in words})), F.try_element_at(table, word))
    return F.coalesce(found, c.cast("string"))


def positive_int(col: Column | str) -> Column:
    """M2: ``try_cast(x AS INT)``; non-positive or unparsable -> NULL.

    A failed cast costs a thrown exception; no text with a letter, point, comma or slash
    is an integer, so those are not cast."""
    c = _c(col)
    v = F.when((F.typeof(c) != "string") | ~c.cast("string").rlike(r"[A-Za-z.,/]"), c.try_cast("int"))
    return F.when(v > 0, v)


def positive_amount(col: Column | str, scale: int = 2, precision: int = 18) -> Column:
    """M3/M4/M5: ``try_cast`` to DOUBLE, non-positive -> NULL, round HALF_UP,
    then ``try_cast`` to DECIMAL(precision, scale) (NaN and overflow -> NULL)."""
    v = _c(col).try_cast("double")
    return F.when(v > 0, F.round(v, scale)).try_cast(f"decimal({precision},{scale})")
