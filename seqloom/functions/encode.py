"""Encodings of categorical, list and time columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seqloom.functions.vocab import AGE_BUCKETS, GENRES, TIME_SLOT_LABELS

MAX_GENRES = 3
_WHITESPACE = " \t\n\r\f\x0b"
_DAY = 86_400
_HOUR = 3_600


def _strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_WHITESPACE))


def gender_code_strict(gender: Column) -> Column:
    """'F' is 0 and everything else, null included, is 1."""
    return F.when(gender == "F", 0).otherwise(1)


def gender_code(gender: Column) -> Column:
    """Case and whitespace do not matter; values other than F and M are null."""
    g = F.upper(_strip(gender))
    return F.when(g == "F", 0).when(g == "M", 1)


def age_bucket(age: Column) -> Column:
    """Position of the age among the fixed buckets, unlisted ages in one bucket after them."""
    code = F.array_position(F.array(*[F.lit(a) for a in AGE_BUCKETS]), age.cast("int"))
    return F.when(code > 0, code.cast("int") - 1).otherwise(len(AGE_BUCKETS))


def _zeros(width: int) -> Column:
    return F.array_repeat(F.lit(0), width)


def genre_codes(genres: Column, vocabulary: list[str] = GENRES, width: int = MAX_GENRES) -> Column:
    """The first ``width`` genres as vocabulary positions, right-padded with 0; a null list gives zeros."""
    words = F.array(*[F.lit(w) for w in vocabulary])
    codes = F.transform(
        F.slice(genres, 1, width), lambda g: F.coalesce(F.array_position(words, g), F.lit(0)).cast("int")
    )
    return F.coalesce(F.slice(F.concat(codes, _zeros(width)), 1, width), _zeros(width))


def split_genres(text: Column) -> Column:
    """Genre text with pipes, or else spaces, between the names; blank names are dropped."""
    names = F.when(F.contains(text, F.lit("|")), F.split(text, r"\|")).otherwise(F.split(text, " "))
    return F.filter(F.transform(names, _strip), lambda g: g != "")


def hour_of(value: Column) -> Column:
    """Hour of day of a timestamp or of text that holds one."""
    return F.hour(F.try_to_timestamp(value.cast("string")))


def time_slot(unix_seconds: Column) -> Column:
    """0 for 06-17 h, 1 for 18-21 h, else 2, in UTC whatever the session zone is."""
    second = F.pmod(unix_seconds, F.lit(_DAY))
    return (
        F.when(second.between(6 * _HOUR, 18 * _HOUR - 1), 0)
        .when(second.between(18 * _HOUR, 22 * _HOUR - 1), 1)
        .otherwise(2)
    )


def time_slot_label(slot: Column) -> Column:
    label = F.lit("Unknown")
    for value, text in reversed(TIME_SLOT_LABELS.items()):
        label = F.when(slot == value, text).otherwise(label)
    return label


def rating_bucket(prediction: Column) -> Column:
    """Prediction rounded half to even and clamped to 1..5; null or not finite gives null."""
    x = prediction.try_cast("double")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.when(finite, F.greatest(F.lit(1.0), F.least(F.lit(5.0), F.rint(x))).cast("int"))


def title_or_default(title: Column, item_id: Column) -> Column:
    return F.coalesce(title, F.format_string("Movie %d", item_id))


def genre_text(genres: Column) -> Column:
    return F.coalesce(F.array_join(genres, "|"), F.lit("Unknown"))


def metric_column(name: Column) -> Column:
    """``Hit@5`` becomes ``test_hit_at_5``."""
    return F.concat(F.lit("test_"), F.replace(F.lower(name), F.lit("@"), F.lit("_at_")))


def latency_ms(seconds: Column) -> Column:
    return F.round(seconds * 1000, 2)
