"""Typed values from JSON fields, by the contract's coercion rules.

Every rule takes a field as :func:`observed` and gives its value, or null when the
contract does not allow one; absent and null fields are the caller's to judge.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.json_doc import kind

# The words accepted for a flag, compared without regard to case.
TRUE_WORDS = ["1", "on", "t", "true", "y", "yes"]
FALSE_WORDS = ["0", "off", "f", "false", "n", "no"]

# Fixed value: epoch numbers beyond this magnitude count milliseconds.
EPOCH_MILLIS_ABOVE = 20_000_000_000
# The epoch milliseconds of years 1 to 9999.
EPOCH_MILLIS_MIN = -62_135_596_800_000
EPOCH_MILLIS_MAX = 253_402_300_799_999

_WHOLE_NUMBER = r"(?U)^\s*[+-]?[0-9](_?[0-9])*(\.0+)?\s*$"
_EPOCH_NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"
_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
_CLOCK = r"[0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?"
_PLAIN_UTC = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?Z$"
_ISO = rf"^({_DATE})(?:[Tt _]({_CLOCK})([Zz]|([+\-−])([0-9]{{2}}):?([0-9]{{2}}))?)?$"


def observed(value: Column) -> Column:
    """A variant with its kind and, for strings, its text: looked up once for all rules."""
    found = kind(value)
    return F.struct(
        value.alias("value"),
        found.alias("kind"),
        F.when(found == "STRING", F.try_variant_get(value, "$", "string")).alias("text"),
    )


def _get(field: Column, type_name: str) -> Column:
    return F.try_variant_get(field["value"], "$", type_name)


def _is_fractional(field: Column) -> Column:
    return (field["kind"] == "DOUBLE") | field["kind"].startswith("DECIMAL")


def text(field: Column) -> Column:
    """Strings only; numbers and flags are not turned into text."""
    return field["text"]


def whole_number(field: Column) -> Column:
    """Integers, integral decimals, flags, and integers written as text; 64 bits."""
    number = _get(field, "double")
    integral = (number == F.floor(number)) & (F.abs(number) < F.lit(2.0**63))
    digits = F.regexp_replace(field["text"], r"(?U)\.0+\s*$|[\s_]", "")
    return (
        F.when(field["kind"] == "BIGINT", _get(field, "bigint"))
        .when(field["text"].rlike(_WHOLE_NUMBER), digits.try_cast("bigint"))
        .when(field["kind"] == "BOOLEAN", _get(field, "boolean").cast("bigint"))
        .when(_is_fractional(field) & integral, number.try_cast("bigint"))
    )


def flag(field: Column) -> Column:
    """True and false, the numbers 1 and 0, and the listed words."""
    number = _get(field, "double")
    word = F.lower(field["text"])
    return (
        F.when(field["kind"] == "BOOLEAN", _get(field, "boolean"))
        .when(word.isin(TRUE_WORDS), True)
        .when(word.isin(FALSE_WORDS), False)
        .when(
            (field["kind"] == "BIGINT") | _is_fractional(field),
            F.when(number == 1, True).when(number == 0, False),
        )
    )


def _from_epoch(number: Column) -> Column:
    """Seconds, or milliseconds beyond the threshold, to a timestamp. Whole numbers stay exact."""
    in_seconds = number.between(-EPOCH_MILLIS_ABOVE, EPOCH_MILLIS_ABOVE)
    in_range = (number >= EPOCH_MILLIS_MIN) & (number < EPOCH_MILLIS_MAX + 1)
    micros = F.when(in_seconds, number * 1_000_000).when(in_range, number * 1_000)
    return F.timestamp_micros(F.round(micros).cast("bigint"))


def _from_iso(written: Column) -> Column:
    def part(group: int) -> Column:
        return F.regexp_extract(written, _ISO, group)

    clock = F.when(part(2) == "", "00:00").otherwise(F.replace(part(2), F.lit(","), F.lit(".")))
    clock = F.when(F.length(clock) == 5, F.concat(clock, F.lit(":00"))).otherwise(clock)
    # Fractions beyond microseconds are cut off, not rounded.
    clock = F.regexp_replace(clock, r"(\.[0-9]{6})[0-9]+$", "$1")
    valid = (part(1) >= "0001-01-01") & (part(2) < "24") & (part(5) < "24") & (part(6) < "60")
    local = F.concat(part(1), F.lit("T"), clock, F.lit("Z")).try_cast("timestamp")
    offset = part(5).try_cast("bigint") * 3600 + part(6).try_cast("bigint") * 60
    offset = F.when(part(4) == "", 0).when(part(4) == "+", offset).otherwise(-offset)
    micros = F.unix_micros(local) - offset * 1_000_000
    # An offset may lead out of the years that dates have names for.
    nameable = micros.between(EPOCH_MILLIS_MIN * 1000, EPOCH_MILLIS_MAX * 1000 + 999)
    return F.when(written.rlike(_ISO) & valid & nameable, F.timestamp_micros(micros))


def plain_instant(written: Column) -> Column:
    """The usual form only: full ISO 8601 date and time in UTC, to the microsecond."""
    plain = written.rlike(_PLAIN_UTC) & (written >= "0001")
    return F.when(plain, written.try_cast("timestamp"))


def instant(field: Column) -> Column:
    """ISO 8601 text or an epoch number, also written as text; no offset means UTC."""
    written = field["text"]
    from_text = (
        F.when(written.rlike(_PLAIN_UTC), plain_instant(written))
        .when(written.rlike(r"^[+-]?[0-9]+$"), _from_epoch(written.try_cast("bigint")))
        .when(written.rlike(_EPOCH_NUMBER), _from_epoch(written.try_cast("double")))
        .otherwise(_from_iso(written))
    )
    return (
        F.when(written.isNotNull(), from_text)
        .when(field["kind"] == "BIGINT", _from_epoch(_get(field, "bigint")))
        .when(_is_fractional(field), _from_epoch(_get(field, "double")))
    )
