"""Label clean-up and label tests. Labels may be repaired; numbers and dates never are."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerline.schemas import UNKNOWN_COUNTRY

# (?U) makes \s cover every Unicode space; \A and \z leave no room for a trailing newline.
EMAIL = r"(?U)\A[^@\s]+@[^@\s]+\.[^@\s]+\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_key(c: Column | str) -> Column:
    """A key or name without surrounding spaces."""
    return F.trim(_col(c))


def label(c: Column | str) -> Column:
    """A status, plan or e-mail: trimmed, lower case."""
    return F.lower(F.trim(_col(c)))


def code(c: Column | str) -> Column:
    """A currency or country code: trimmed, upper case."""
    return F.upper(F.trim(_col(c)))


def country_label(c: Column | str) -> Column:
    return F.coalesce(F.nullif(code(c), F.lit("")), F.lit(UNKNOWN_COUNTRY))


def is_blank(c: Column | str) -> Column:
    """True for NULL and for a string of spaces."""
    return F.coalesce(F.trim(_col(c)), F.lit("")) == ""


def is_not_an_email(c: Column | str) -> Column:
    """True for NULL and for anything that is not shaped like name@host.domain."""
    return _col(c).isNull() | ~_col(c).rlike(EMAIL)


def is_unnormalised(c: Column | str) -> Column:
    """Differs from its own clean form; NULL stays NULL."""
    return _col(c) != label(c)
