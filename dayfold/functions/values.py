"""Flags, durations, keys and scores."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F

from ..model import SAMPLES_PER_SECOND
from .text import as_column

_MICROS_PER_DAY = 86_400_000_000


def flag(value) -> Column:
    """0/1/null/NaN to boolean: missing is false, fractions are cut, the rest is non-zero."""
    number = as_column(value).cast("double")
    return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0)).cast("long") != 0


def zero_if_null(value) -> Column:
    return F.coalesce(as_column(value), F.lit(0))


def label_of_token(token) -> Column:
    """1 for the token ``1``; anything else, null too, is 0."""
    return F.when(as_column(token) == "1", 1).otherwise(0)


def seconds_of_samples(samples) -> Column:
    return as_column(samples) / F.lit(SAMPLES_PER_SECOND)


def surrogate_id(*key) -> Column:
    """Row id made of the business key, the same on every run and retry."""
    return F.sha2(F.concat_ws("|", *[as_column(k).cast("string") for k in key]), 256)


def _elapsed_micros(start, end) -> Column:
    gap = as_column(end) - as_column(start)
    seconds = F.extract(F.lit("SECOND"), gap)
    return (
        F.extract(F.lit("DAY"), gap).cast("long") * _MICROS_PER_DAY
        + F.extract(F.lit("HOUR"), gap).cast("long") * 3_600_000_000
        + F.extract(F.lit("MINUTE"), gap).cast("long") * 60_000_000
        + (seconds * 1_000_000).cast("long")
    )


def elapsed_seconds(start, end) -> Column:
    return _elapsed_micros(start, end) / F.lit(1_000_000)


def elapsed_text(start, end) -> Column:
    """``1 day, 3:00:00`` or ``0:05:09.250000``: days only when there are any."""
    micros = _elapsed_micros(start, end)
    days = F.floor(micros / _MICROS_PER_DAY)
    rest = F.pmod(micros, F.lit(_MICROS_PER_DAY))
    seconds = F.floor(rest / 1_000_000)
    clock = F.format_string(
        "%d:%02d:%02d",
        F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60,
    )
    parts = rest % 1_000_000
    fraction = F.when(parts > 0, F.format_string(".%06d", parts)).otherwise("")
    unit = F.when(F.abs(days) == 1, " day, ").otherwise(" days, ")
    lead = F.when(days != 0, F.concat(days.cast("string"), unit)).otherwise("")
    return F.when(micros.isNotNull(), F.concat(lead, clock, fraction))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Name a value for use in the lambdas of ``body``, which would compute it for every element."""
    return F.transform(F.array(value), body)[0]


def softmax(scores) -> Column:
    """Probabilities of an array of scores, safe for large scores."""

    def powers(s: Column) -> Column:
        return F.transform(s["v"], lambda x: F.exp(x - s["top"]))

    def shares(s: Column) -> Column:
        return F.transform(s["p"], lambda x: x / s["total"])

    def with_total(p: Column) -> Column:
        total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
        return _let(F.struct(p.alias("p"), total.alias("total")), shares)

    def with_top(v: Column) -> Column:
        return _let(F.struct(v.alias("v"), F.array_max(v).alias("top")), powers)

    return _let(_let(as_column(scores), with_top), with_total)


def argmax_index(scores) -> Column:
    """0-based place of the first highest score."""
    values = as_column(scores)
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def common_type(types: Iterable[str]) -> str:
    """The type that holds values of all the given types; text when nothing narrower does."""
    kinds = set(types) - {"null"}
    whole = ["tinyint", "smallint", "int", "bigint"]
    real = ["float", "double"]
    if not kinds:
        return "string"
    if len(kinds) == 1:
        return kinds.pop()
    if kinds <= set(whole):
        return max(kinds, key=whole.index)
    if kinds <= {*whole, *real, "boolean"}:
        return "double"
    return "string"
