"""Scalar column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Common English words of no weight, and some German, French and Spanish ones; pass another list where one is wanted.
STOP_WORDS = tuple(
    """about above after again against all and any are because been before being below between both but can could did does doing
    down during each few for from further had has have having her here hers herself him himself his how into its itself just more
    most myself nor not now off once only other our ours ourselves out over own same she should some such than that the their
    theirs them themselves then there these they this those through too under until very was were what when where which while who
    whom why will with would you your yours yourself yourselves und der die das les des que los las""".split()
)


def tokens(text: Column, min_length: int = 2, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """Lower-case words longer than min_length that are no stop words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z0-9_]+)"), F.lit(1))
    return F.filter(words, lambda w: (F.length(w) > min_length) & ~w.isin(*stop_words))


def hhmm(start: Column) -> Column:
    """The clock of a yyyyMMddHHmm string as a number."""
    return F.substring(start, 9, 4).cast("int")


def utc_epoch(start: Column) -> Column:
    return F.unix_timestamp(start, "yyyyMMddHHmm")


def utc_string(epoch: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch), "yyyyMMddHHmm")


def week_of_month(date: Column) -> Column:
    return F.floor(F.dayofmonth(date) / 7).cast("int")


def is_weekend(date: Column) -> Column:
    """Friday, Saturday and Sunday."""
    return F.dayofweek(date).isin(6, 7, 1)


def time_bucket(clock: Column, windows: int = 12) -> Column:
    """The window of a HHMM clock; the step is a whole number, so windows that don't divide 2400 give one more."""
    return F.floor(clock / F.lit(2400 // windows)).cast("int")


def geo_cell(lat: Column, lon: Column, rows: int = 5, columns: int = 12) -> Column:
    """Row-major cell of latitudes 24 to 50 and longitudes 66 to 125 west; south or east of it 0, beyond it the last."""
    r = F.floor((lat - 24) / ((50 - 24) / rows))
    c = F.floor((-lon - 66) / ((125 - 66) / columns))
    cell = F.when((r < 0) | (c < 0), 0).when((r >= rows) | (c >= columns), rows * columns - 1).otherwise(r * columns + c)
    return cell.cast("int")


def date_range(a: str, b: str) -> tuple[Column, Column]:
    """The first and last day of two yyyyMMdd strings in either order."""
    days = [F.to_date(F.lit(x), "yyyyMMdd") for x in (a, b)]
    return F.least(*days), F.greatest(*days)
