"""Text cleaning. All built-in expressions, no UDFs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
NULL_EMAIL_TOKEN = "null"
MOTIVO_NULL_TOKENS = ("N/A", "")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_title(col: Column | str) -> Column:
    """``initcap(trim(x))``; NULL stays NULL, only spaces trimmed."""
    return F.initcap(F.trim(_c(col)))


def clean_code(col: Column | str) -> Column:
    """T4: upper-case code, ``upper(trim(x))``."""
    return F.upper(F.trim(_c(col)))


def normalize_email(col: Column | str) -> Column:
    """T5: NULL or the token ``null`` (any case, padded) -> NULL, else lower(trim)."""
    norm = F.lower(F.trim(_c(col)))
    return F.when(norm == F.lit(NULL_EMAIL_TOKEN), F.lit(None).cast("string")).otherwise(norm)


def is_valid_email(col: Column | str) -> Column:
    """Regex test against the e-mail pattern (NULL in, NULL out)."""
    return _c(col).rlike(EMAIL_PATTERN)


def clean_email(col: Column | str) -> Column:
    """T5 + T6: normalise, then keep only addresses matching the pattern."""
    norm = normalize_email(col)
    return F.when(norm.rlike(EMAIL_PATTERN), norm)


def scrub_null_tokens(col: Column | str, tokens: Iterable[str] = MOTIVO_NULL_TOKENS) -> Column:
    """NULL or ``trim(x)`` in ``tokens`` (case-sensitive) -> NULL, else lower(trim)."""
    trimmed = F.trim(_c(col))
    return F.when(trimmed.isin(list(tokens)), F.lit(None).cast("string")).otherwise(F.lower(trimmed))


def capitalize_first(col: Column | str) -> Column:
    """Upper-case the first character, keep the rest of the whole text."""
    c = _c(col)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, F.lit(2), F.length(c)))


def clean_motivo(col: Column | str) -> Column:
    """T7 + T8: scrub null tokens, lower-case, capitalise the first letter."""
    return capitalize_first(scrub_null_tokens(col))


def join_reasons(*flags: Column, sep: str = ", ") -> Column:
    """Join the non-NULL reason texts; NULL means "no reason"."""
    return F.concat_ws(sep, *flags)
