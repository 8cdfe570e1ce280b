"""Strict reading of one JSON document per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_END_MARK = "8675309271828"

# A key no payload has a reason to use, made of letters whose escapes all start \\u006.
_ENVELOPE = "endofdocimage"
_STRICT = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "unfit",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    # The length of a string or number alone never makes a document unreadable.
    "maxStringLen": "2147483647",
    "maxNumLen": "2147483647",
}


def typed_fields(raw: Column, fields: str) -> Column:
    """The document read straight into ``fields``, as ``struct<fit, doc>`` parts.

    Spark's parser stops after the first value and accepts whatever follows it. So
    the text is put into an array of our own, followed by an element of our own:
    only if ``raw`` was exactly one value does that element come second.
    See :func:`fits` and :func:`fitted`.
    """
    element = f"struct<{fields},{_ENVELOPE}:boolean>"
    wrapped = F.concat(
        F.lit('{"' + _ENVELOPE + '":['), raw, F.lit(',{"' + _ENVELOPE + '":true}]}')
    )
    return F.from_json(wrapped, f"struct<{_ENVELOPE}:array<{element}>,unfit:string>", _STRICT)


def fitted(typed: Column) -> Column:
    """The document's fields out of :func:`typed_fields`."""
    return F.get(typed[_ENVELOPE], F.lit(0))


def fits(typed: Column, raw: Column) -> Column:
    """True only if ``raw`` is one valid document whose fields all had their declared type.

    False may also mean that the text merely needs a closer look: it mentions our
    own key, or has surrogate escapes that might not come in pairs.
    """
    own = F.get(typed[_ENVELOPE], F.lit(1))[_ENVELOPE]
    closed = F.coalesce((F.size(typed[_ENVELOPE]) == 2) & own, F.lit(False))
    unclear = (
        F.contains(raw, F.lit(_ENVELOPE))
        | F.contains(raw, F.lit("\\u006"))
        | F.contains(raw, F.lit("\\ud"))
        | F.contains(raw, F.lit("\\uD"))
    )
    return typed["unfit"].isNull() & closed & ~unclear


def _mark(raw: Column) -> Column:
    # The mark must not occur in the text itself. Where its digits do, a string
    # longer than the text could hold takes its place.
    longer = F.repeat(F.lit("x"), F.char_length(raw) + 1)
    return F.when(F.contains(raw, F.lit(_END_MARK)), longer).otherwise(F.lit(_END_MARK))


def untyped_fields(raw: Column, names: list[str]) -> Column:
    """``[document, mark]`` with the named members as variants; null when that is not JSON.

    The counterpart of :func:`typed_fields` for any text. It reads the same members with
    the same parser, so that size and content of all others matter to neither.
    :func:`is_single_document` finds the mark in second place only if ``raw`` was exactly
    one value.
    """
    element = f"struct<{','.join(f'`{name}`:variant' for name in names)},{_ENVELOPE}:string>"
    options = {key: value for key, value in _STRICT.items() if key != "columnNameOfCorruptRecord"}
    marked = F.concat(F.lit("["), raw, F.lit(',{"' + _ENVELOPE + '":"'), _mark(raw), F.lit('"}]'))
    return F.from_json(marked, f"array<{element}>", options)


def is_single_document(marked: Column, raw: Column) -> Column:
    second = F.get(marked, F.lit(1))[_ENVELOPE]
    single = (F.size(marked) == 2) & (second == _mark(raw))
    return F.coalesce(single, F.lit(False)) & ~has_lone_surrogate(raw)


def has_lone_surrogate(raw: Column) -> Column:
    """A ``\\uD800``-style escape without its other half is not text in any encoding."""
    without_escaped_backslashes = F.regexp_replace(raw, r"\\\\", "")
    without_pairs = F.regexp_replace(
        without_escaped_backslashes,
        r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}",
        "",
    )
    return without_pairs.rlike(r"\\u[dD][89a-fA-F][0-9a-fA-F]{2}")


def document_fields(marked: Column) -> Column:
    """The document's members out of :func:`untyped_fields`."""
    return F.get(marked, F.lit(0))


def member_fields(value: Column, names: list[str]) -> Column:
    """The named members of a nested object; null when ``value`` is not an object."""
    return F.try_variant_get(value, "$", _variant_struct(names))


def _variant_struct(names: list[str]) -> str:
    return "struct<" + ",".join(f"`{name}`:variant" for name in names) + ">"


def kind(value: Column) -> Column:
    """``BIGINT``, ``STRING``, ``BOOLEAN``, ``DOUBLE``, ``DECIMAL(..)``, ``VOID``,
    ``OBJECT<..>`` or ``ARRAY<..>``; null for an absent field."""
    return F.schema_of_variant(value)
