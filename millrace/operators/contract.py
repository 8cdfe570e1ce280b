"""The event contract: judge raw payloads, split them, flatten what passes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import coerce
from millrace.functions.barrier import evaluated_once, out_of_line
from millrace.functions.dates import day_label
from millrace.functions.json_doc import (
    document_fields,
    fits,
    fitted,
    is_single_document,
    kind,
    member_fields,
    typed_fields,
    untyped_fields,
)

Rule = Callable[[Column], Column]

# The contract: fields that must be there, fields that may be absent or null, and
# objects that hold them. A field the event table has no column for is checked all
# the same. ``bot`` stands apart: it may be absent, but not null.
REQUIRED = {"meta.id": "string", "meta.dt": "instant", "wiki": "string", "type": "string"}
OPTIONAL = {
    "meta.domain": "string",
    "meta.stream": "string",
    "id": "integer",
    "namespace": "integer",
    "title": "string",
    "comment": "string",
    "timestamp": "integer",
    "user": "string",
    "server_name": "string",
    "length.old": "integer",
    "length.new": "integer",
    "revision.old": "integer",
    "revision.new": "integer",
}
OBJECTS = ["length", "revision"]
TYPES = REQUIRED | OPTIONAL | {"bot": "flag"}
LANDED_FROM = {
    "event_id": "meta.id",
    "event_dt": "meta.dt",
    "wiki": "wiki",
    "type": "type",
    "namespace": "namespace",
    "title": "title",
    "user": "user",
    "server_name": "server_name",
    "length_old": "length.old",
    "length_new": "length.new",
    "revision_old": "revision.old",
    "revision_new": "revision.new",
}

_EXPECTED = {
    "string": "a string",
    "integer": "an integer",
    "instant": "a date and time",
    "flag": "true or false",
}
_COERCE = {
    "string": coerce.text,
    "integer": coerce.whole_number,
    "instant": coerce.instant,
    "flag": coerce.flag,
}
_OF_TYPE = {name: [p for p, type_name in TYPES.items() if type_name == name] for name in _COERCE}
_TOP_LEVEL = sorted({path.split(".")[0] for path in TYPES})


def _name(path: str) -> str:
    return path.replace(".", "_")


def _members(parent: str) -> list[str]:
    return [path.split(".")[1] for path in TYPES if path.startswith(f"{parent}.")]


# ---- the usual case: every field in its usual form --------------------------------

# Integers are read with their type. Strings stay variants, because a typed read would
# turn numbers into text; so does the flag, to tell null from absent.
_READ_AS = {"string": "variant", "instant": "variant", "flag": "variant", "integer": "bigint"}


def _plain_schema() -> str:
    def declare(name: str) -> str:
        if name in TYPES:
            return f"`{name}`:{_READ_AS[TYPES[name]]}"
        inner = ",".join(f"`{m}`:{_READ_AS[TYPES[f'{name}.{m}']]}" for m in _members(name))
        return f"`{name}`:struct<{inner}>"

    return ",".join(declare(name) for name in _TOP_LEVEL)


def _plain_reading(source: DataFrame) -> DataFrame:
    """``is_plain`` and, where it holds, the landed values: one parse, all generated code."""
    raw = F.col("raw_json")
    read = evaluated_once(source, source.columns, read=typed_fields(raw, _plain_schema()))
    opened = read.select(
        *source.columns, fits(F.col("read"), raw).alias("fits"), fitted(F.col("read")).alias("doc")
    )

    def field(path: str) -> Column:
        parent, _, member = path.rpartition(".")
        return F.col("doc")[parent][member] if parent else F.col("doc")[member]

    by_kind = [path for path, type_name in TYPES.items() if _READ_AS[type_name] == "variant"]
    kinds = opened.select("*", *[kind(field(path)).alias(f"kind_{_name(path)}") for path in by_kind])

    plain_kind = F.col("fits")
    for path in by_kind:
        found = F.col(f"kind_{_name(path)}")
        expected = found == ("BOOLEAN" if TYPES[path] == "flag" else "STRING")
        if path == "bot":
            expected = found.isNull() | expected
        elif path in OPTIONAL:
            expected = found.isNull() | (found == "VOID") | expected
        plain_kind = plain_kind & F.coalesce(expected, F.lit(False))

    values = {}
    for name, path in LANDED_FROM.items():
        values[name] = field(path)
        if TYPES[path] in ("string", "instant"):
            values[name] = F.try_variant_get(field(path), "$", "string")
    values["bot"] = F.coalesce(F.try_variant_get(field("bot"), "$", "boolean"), F.lit(False))
    valued = kinds.select(
        *source.columns,
        plain_kind.alias("plain_kind"),
        *[value.alias(f"plain_{name}") for name, value in values.items()],
    )
    dated = valued.withColumn("plain_event_dt", coerce.plain_instant(F.col("plain_event_dt")))
    return dated.withColumn("is_plain", F.col("plain_kind") & F.col("plain_event_dt").isNotNull())


# ---- every other case: the full rules ----------------------------------------------


def _seen(seen: Column, path: str) -> Column:
    """Kind and value of one field, null when the contract does not allow its value."""
    return seen[TYPES[path]][_OF_TYPE[TYPES[path]].index(path)]


def _complaints(seen: Column) -> Column:
    """``path: reason`` for every broken rule, joined with ``; ``; empty if none is."""

    def found(path: str) -> Column:
        return _seen(seen, path)["kind"]

    def unusable(path: str) -> Column:
        return _seen(seen, path)["value"].isNull()

    def wrong(path: str) -> Column:
        return F.lit(f"{path}: not {_EXPECTED[TYPES[path]]}")

    rules = []
    for path in REQUIRED:
        missing = F.when(found(path).isNull(), F.lit(f"{path}: missing"))
        rules.append(missing.otherwise(F.when(unusable(path), wrong(path))))
    for path in OPTIONAL:
        rules.append(F.when((found(path) != "VOID") & unusable(path), wrong(path)))
    rules.append(F.when(found("bot").isNotNull() & unusable("bot"), wrong("bot")))
    for path in OBJECTS:
        kind_found = seen[f"{path}_kind"]
        broken = (kind_found != "VOID") & ~kind_found.startswith("OBJECT")
        rules.append(F.when(broken, F.lit(f"{path}: not an object")))
    return F.concat_ws("; ", *rules)


def _full_reading(raw: Column) -> Column:
    """``error`` and the landed values, by every rule of the contract; null if not JSON."""

    def open_objects(top: Column) -> Column:
        parents = ["meta", *OBJECTS]
        inner = [member_fields(top[p], _members(p)).alias(f"in_{p}") for p in parents]
        return F.struct(top.alias("top"), *inner)

    def see(opened: Column) -> Column:
        def value(path: str) -> Column:
            parent, _, member = path.rpartition(".")
            return opened[f"in_{parent}"][member] if parent else opened["top"][member]

        def settle(rule: Rule) -> Rule:
            return lambda field: F.struct(field["kind"].alias("kind"), rule(field).alias("value"))

        # One array, and so one copy of the rule, per type.
        by_type = [
            F.transform(
                F.transform(F.array(*map(value, _OF_TYPE[name])), coerce.observed), settle(rule)
            ).alias(name)
            for name, rule in _COERCE.items()
        ]
        return F.struct(*by_type, *[kind(opened["top"][p]).alias(f"{p}_kind") for p in OBJECTS])

    def verdict(seen: Column) -> Column:
        landed = {name: _seen(seen, path)["value"] for name, path in LANDED_FROM.items()}
        landed["bot"] = F.coalesce(_seen(seen, "bot")["value"], F.lit(False))
        return F.struct(
            _complaints(seen).alias("error"), *[v.alias(n) for n, v in landed.items()]
        )

    def judge(document: Column) -> Column:
        fields = document_fields(document)
        opened = out_of_line(fields, open_objects)
        return F.when(
            is_single_document(document, raw), out_of_line(out_of_line(opened, see), verdict)
        )

    return out_of_line(untyped_fields(raw, _TOP_LEVEL), judge)


def decode_payload(topic_rows: DataFrame, value: str = "value") -> DataFrame:
    """``raw_line`` plus the reason it cannot be text, for a binary payload column.

    Bytes that are not UTF-8, and messages without a value, are quarantined like
    any other bad record instead of stopping the stream.
    """
    payload = F.col(value)
    readable = F.is_valid_utf8(payload.cast("string"))
    return topic_rows.withColumns(
        {
            "raw_line": F.coalesce(F.make_valid_utf8(payload.cast("string")), F.lit("")),
            "unreadable": F.when(payload.isNull(), F.lit("no value")).when(
                ~readable, F.lit("invalid utf-8")
            ),
        }
    )


def validate(lines: DataFrame, raw: str = "raw_line", carry: Sequence[str] = ()) -> DataFrame:
    """One row per input row: the 14 landed columns, ``error`` (empty when valid), ``dt``.

    ``carry`` names input columns, such as a record's place in its topic, that follow.

    ``raw_json`` is the payload, verbatim. An ``unreadable`` column, as made by
    :func:`decode_payload`, is taken over as the error. The landed values of a
    rejected row may be incomplete.

    A payload whose fields all have their usual form is settled by one typed read.
    Any other one, bad or merely unusual (a number written as text, an epoch time),
    is judged by the full rules, which also word the complaint.
    """
    unreadable = F.col("unreadable") if "unreadable" in lines.columns else F.lit(None)
    source = lines.select(
        F.col(raw).alias("raw_json"), unreadable.cast("string").alias("unreadable"), *carry
    )
    read = _plain_reading(source)
    full = F.when(~F.col("is_plain"), out_of_line(F.col("raw_json"), _full_reading))
    judged = read.select("*", full.alias("full"))
    landed = {
        name: F.when(F.col("is_plain"), F.col(f"plain_{name}")).otherwise(F.col("full")[name])
        for name in [*LANDED_FROM, "bot"]
    }
    landed["raw_json"] = F.col("raw_json")
    error = F.coalesce(
        F.col("unreadable"),
        F.col("full.error"),
        F.when(~F.col("is_plain"), F.lit("not a JSON document")).otherwise(""),
    )
    columns = {name: landed[name] for name in schemas.RAW_NRT.names} | {"error": error}
    settled = evaluated_once(judged, list(carry), **columns)
    dated = settled.withColumn("dt", day_label(F.col("event_dt")))
    return dated.select(*columns, "dt", *carry)


def accepted(validated: DataFrame) -> DataFrame:
    """The flat rows of valid payloads, with their UTC partition date."""
    return validated.where(F.col("error") == "").drop("error")


def rejected(validated: DataFrame) -> DataFrame:
    """Payload and reason of every record to quarantine."""
    return validated.where(F.col("error") != "").select("error", F.col("raw_json").alias("raw_line"))


def tallies(validated: DataFrame) -> DataFrame:
    """How many records a batch accepted and rejected."""
    return validated.agg(
        F.count_if(F.col("error") == "").alias("accepted"),
        F.count_if(F.col("error") != "").alias("rejected"),
    )
