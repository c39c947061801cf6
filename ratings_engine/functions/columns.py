"""Scalar column expressions shared by the layers; all of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators, patterns and labels that decide results.
KEY_SEPARATOR = "||"
PRICE_PATTERN = r"(\d+(?:\.\d+)?)"
VERIFIED_LABEL = "Verified"
NON_VERIFIED_LABEL = "Non-Verified"
# White space as Python's str.strip() knows it.
EDGE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# Timestamps count microseconds in 64 bits.
LAST_EPOCH_MS = 2**63 // 1000 - 1000
# End of fixed values.


def review_key(user_id: Column, parent_asin: Column, epoch_ms: Column) -> Column:
    """The text a review's id is a digest of; an absent part counts as ''."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (user_id, parent_asin, epoch_ms)]
    return F.concat_ws(KEY_SEPARATOR, *parts)


def is_clear_key(user_id: Column, parent_asin: Column, epoch_ms: Column) -> Column:
    """Whether no other parts than these make the same review_key()."""
    sign = KEY_SEPARATOR[0]
    return (epoch_ms.isNotNull() & F.coalesce((user_id != "") & ~user_id.contains(sign), F.lit(False))
            & F.coalesce((parent_asin != "") & ~parent_asin.contains(sign), F.lit(False)))


def review_id(user_id: Column, parent_asin: Column, epoch_ms: Column) -> Column:
    """SHA-256 hex of user, product and timestamp."""
    return F.sha2(review_key(user_id, parent_asin, epoch_ms), 256)


def epoch_ms_to_timestamp(epoch_ms: Column) -> Column:
    """Whole seconds of an epoch in milliseconds, cut towards zero; null beyond what a
    timestamp can hold."""
    held = epoch_ms.between(-LAST_EPOCH_MS, LAST_EPOCH_MS)
    return F.when(held, F.timestamp_millis(epoch_ms - epoch_ms % 1000))


def epoch_ms_to_date(epoch_ms: Column) -> Column:
    """Its day in the session's time zone."""
    return F.to_date(epoch_ms_to_timestamp(epoch_ms))


def parse_price(raw: Column) -> Column:
    """First decimal number in the text; null when there is none."""
    return F.regexp_extract(F.coalesce(raw, F.lit("")), PRICE_PATTERN, 1).try_cast("double")


def star(rating: Column) -> Column:
    """Rating rounded half up to a whole star."""
    return F.round(rating).cast("long")


def strip(text: Column) -> Column:
    """Remove white space of every kind at both ends (trim() alone removes spaces only)."""
    return F.btrim(text, F.lit(EDGE_SPACE))


def purchase_type(flag: Column) -> Column:
    """Segment label of the verified flag; null stays null."""
    return F.when(flag, VERIFIED_LABEL).when(~flag, NON_VERIFIED_LABEL)


def date_between(column: Column, start=None, end=None) -> Column:
    """start <= column <= end; a bound of None is open. Bounds are dates or ISO strings."""
    test = F.lit(True)
    if start is not None:
        test = test & (column >= F.lit(start).cast("date"))
    if end is not None:
        test = test & (column <= F.lit(end).cast("date"))
    return test
