"""Column expressions shared by the cleaning jobs and the metrics.

Everything here is a built-in Spark expression, so it stays inside whole-stage
code generation and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as blank when text is trimmed.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The two accepted date shapes, tried in this order.
DATE_SHAPES = (
    (r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}/\d{1,2}/(?!0000)\d{4}$", "d/M/yyyy"),
)


def trimmed(text: Column) -> Column:
    """Text without leading and trailing blanks (tabs and Unicode spaces included)."""
    return F.btrim(text, F.lit(BLANKS))


def parse_date(text: Column) -> Column:
    """Date written as ISO or day/month/year; NULL when it is neither.

    The shape test keeps the lenient pattern parser from accepting things like
    a three-digit month.
    """
    clean = trimmed(text)
    return F.coalesce(
        *[F.when(clean.rlike(shape), F.try_to_date(clean, pattern)) for shape, pattern in DATE_SHAPES]
    )


def vocabulary_code(text: Column, vocabulary: Sequence[str]) -> Column:
    """1-based position of the vocabulary entry that equals the text up to case and blanks.

    NULL when nothing matches. The vocabulary is a literal map, so matching a
    whole table costs neither a join nor a broadcast.
    """
    positions: dict[str, int] = {}
    for position, value in enumerate(vocabulary, start=1):
        positions.setdefault(value.lower(), position)
    entries = [F.lit(item) for pair in positions.items() for item in pair]
    return F.try_element_at(F.create_map(*entries), F.lower(trimmed(text)))


def vocabulary_label(code: Column, vocabulary: Sequence[str]) -> Column:
    """The canonical spelling behind a ``vocabulary_code``."""
    return F.try_element_at(F.array(*[F.lit(value) for value in vocabulary]), code)


def normalize(text: Column, vocabulary: Sequence[str]) -> Column:
    """Canonical spelling of the text, or NULL when it is not in the vocabulary."""
    return vocabulary_label(vocabulary_code(text, vocabulary), vocabulary)


def date_key(date: Column) -> Column:
    """Integer key YYYYMMDD of a date."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")


def line_revenue(quantity: Column, unit_price: Column, discount: Column) -> Column:
    """quantity x price x (1 - discount), a missing discount counting as none.

    Exact decimals, rounded half up to cents.
    """
    rate = F.lit(1) - F.coalesce(discount, F.lit(0).cast("decimal(4,3)"))
    return F.round(quantity * unit_price * rate, 2).cast("decimal(12,2)")


def not_positive(value: Column) -> Column:
    """True for NULL, zero and negative values."""
    return F.coalesce(value, F.lit(0)) <= 0


def fixed_refund(amount: Column) -> Column:
    """A negative refund is a typing error: keep its size, drop the sign."""
    return F.abs(amount)


def filled_reason(reason: Column) -> Column:
    """A missing or empty reason becomes Unknown; blank text is kept."""
    return F.coalesce(F.nullif(reason, F.lit("")), F.lit("Unknown"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator to two places; NULL instead of an error on zero."""
    return F.round(numerator / F.nullif(denominator, F.lit(0)), 2)


def percent(part: Column, whole: Column) -> Column:
    """part as a percentage of whole, to two places."""
    return ratio(F.lit(100).cast("decimal(3,0)") * part, whole)
