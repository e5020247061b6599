"""Column expressions shared by the operators. Instants are UTC; sessions run with ``spark.sql.session.timeZone=UTC``."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE = 60_000_000
HOUR = 60 * MINUTE
DAY = 24 * HOUR
#: White space as str.strip() sees it, which SQL trim doesn't.
_BLANK = r"[\s\x1c-\x1f]"


def exact_hour(moment: datetime) -> datetime:
    """The moment in UTC; it must be aware and on an hour."""
    if moment.tzinfo is None:
        raise ValueError("the hour needs a timezone")
    moment = moment.astimezone(UTC)
    if (moment.minute, moment.second, moment.microsecond) != (0, 0, 0):
        raise ValueError("the hour must be a whole UTC hour")
    return moment


def micros(moment: datetime) -> int:
    """Epoch microseconds of an aware moment."""
    if moment.tzinfo is None:
        raise ValueError("moments need a timezone")
    gap = moment - datetime(1970, 1, 1, tzinfo=UTC)
    return (gap.days * 86_400 + gap.seconds) * 1_000_000 + gap.microseconds


def at(moment: datetime) -> Column:
    return F.timestamp_micros(F.lit(micros(moment)))


def us(column: Column | str) -> Column:
    return F.unix_micros(F.col(column) if isinstance(column, str) else column)


def floor_minutes(span: Column) -> Column:
    """Whole minutes of a span in microseconds, rounded down also below zero."""
    return F.floor(span / F.lit(MINUTE)).cast("bigint")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U)^{_BLANK}+|{_BLANK}+$", "")


def filled(text: Column) -> Column:
    """Stripped text, null if nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def instant(text: Column) -> Column:
    """An ISO timestamp with date and explicit offset, else null."""
    shape = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})$"
    zoned = F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.when(text.rlike(shape), zoned.try_cast("timestamp"))


def day(text: Column) -> Column:
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def truth(text: Column) -> Column:
    return F.when(F.lower(text) == "true", True).when(F.lower(text) == "false", False)


def whole(text: Column) -> Column:
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int"))


def finite(text: Column) -> Column:
    number = text.try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)


def json_object(text: Column) -> Column:
    """Whether the text is one JSON object and nothing else: inside a list and inside an object it must still parse, as one object."""
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    nested = F.try_parse_json(F.concat(F.lit('{"p":'), text, F.lit("}")))
    return F.coalesce(F.schema_of_variant(listed).like("ARRAY<OBJECT<%>>") & F.variant_get(listed, "$[1]", "variant").isNull() & nested.isNotNull(), F.lit(False))


def content_hash(columns: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def rate(condition: Column, among: Column) -> Column:
    """Mean of a condition over the rows that count; null if none counts, rows with a null condition excluded."""
    return F.avg(F.when(among, condition.cast("double")))
