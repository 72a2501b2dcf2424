"""Strict JSON event checks and message extraction over VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.bounds import MAX_EVENT_BYTES
from ledgerloom.functions.once import bind, with_once

# Message kinds that carry text.
MESSAGE_ROLES = ("user", "assistant")
TEXT_PART_TYPES = ("input_text", "output_text", "text")

ASCII_WHITESPACE = " \t\n\x0b\x0c\r"
JSON_WHITESPACE = " \t\n\r"
_ESCAPES_AND_PAIRS = r"\\\\|\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}"
_SURROGATE = r"\\u[dD][89a-fA-F][0-9a-fA-F]{2}"
_LONG_INTEGER = r"(?<![\d.]|[eE][+-]|[eE])\d{65,}(?![\d.eE])"
_LONG_EXPONENT = r"\d[eE][+-]?0*[1-9]\d{18,}"


def is_blank(raw: Column) -> Column:
    """Whether a line holds only ASCII white space; such lines are consumed silently."""
    return F.btrim(raw.cast("string"), F.lit(ASCII_WHITESPACE)) == ""


def _has_lone_surrogate(text: Column) -> Column:
    paired = F.regexp_replace(text, _ESCAPES_AND_PAIRS, "")
    return F.contains(text, F.lit("\\u")) & text.rlike(_SURROGATE) & paired.rlike(_SURROGATE)


def _has_oversized_number(text: Column) -> Column:
    unescaped = F.regexp_replace(text, r"(?s)\\.", "")
    outside_strings = F.regexp_replace(unescaped, r'"[^"]*"', '""')
    return text.rlike(r"\d{19}") & (
        outside_strings.rlike(_LONG_INTEGER) | outside_strings.rlike(_LONG_EXPONENT)
    )


def with_strict_event(
    lines: DataFrame, raw: str = "raw", max_event_bytes: int = MAX_EVENT_BYTES
) -> DataFrame:
    """Add ``event`` (VARIANT, null if rejected), ``reject_reason`` (null if
    accepted) and ``event_sha256``.

    An event is one JSON object in valid UTF-8 with no duplicate keys, no
    non-finite or oversized numbers and no lone surrogates. A line is parsed as
    the first element of an array whose second is the line's own hash: if the
    hash is not found in second place, the line is more or less than one value.
    A line that was too long to be read has null bytes.
    """
    if max_event_bytes < 1:
        raise ValueError("max_event_bytes must be positive")
    text, sealed, seal = F.col("_text"), F.col("_sealed"), F.col("event_sha256")
    whole = F.coalesce(F.try_variant_get(sealed, "$[1]", "string") == seal, F.lit(False))
    is_object = F.startswith(F.ltrim(text, F.lit(JSON_WHITESPACE)), F.lit("{"))
    reason = (
        F.when(F.col(raw).isNull() | (F.octet_length(raw) > max_event_bytes), "oversize")
        .when(text.isNull(), "invalid_utf8")
        .when(~whole, "malformed")
        .when(~is_object, "not_object")
        .when(_has_oversized_number(text), "oversized_number")
        .when(_has_lone_surrogate(text), "lone_surrogate")
    )
    small = F.octet_length(raw) <= max_event_bytes
    steps = with_once(
        lines,
        _text=F.when(small, F.try_validate_utf8(F.col(raw).cast("string"))),
        event_sha256=F.sha2(F.col(raw), 256),
    )
    array = F.concat(F.lit("["), text, F.lit(',"'), seal, F.lit('"]'))
    steps = with_once(steps, _sealed=F.try_parse_json(array))
    steps = with_once(steps, reject_reason=reason)
    event = F.when(F.col("reject_reason").isNull(), F.variant_get(sealed, "$[0]", "variant"))
    return with_once(steps, event=event).drop("_text", "_sealed")


def fail_on_reject(events: DataFrame) -> DataFrame:
    """Stop the job at the first rejected event, naming its source and byte."""
    message = F.concat(
        F.lit("rejected event ("), F.col("reject_reason"), F.lit(") in "),
        F.col("source"), F.lit(" at byte "), F.col("byte_start").cast("string"),
    )
    checked = F.when(F.col("reject_reason").isNull(), F.col("event")).otherwise(
        F.raise_error(message).cast("variant")
    )
    return events.withColumn("event", checked)


def string_field(event: Column, path: str) -> Column:
    """A field's value if it is a JSON string, else null."""
    value = F.try_variant_get(event, path, "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(event, path, "string"))


def captured_at(event: Column) -> Column:
    return string_field(event, "$.timestamp")


def message_role(event: Column) -> Column:
    """Role of a user or assistant message, null for any other event."""
    kind = F.try_variant_get(event, "$.payload.type", "string")
    role = F.try_variant_get(event, "$.payload.role", "string")
    return F.when((kind == "message") & role.isin(*MESSAGE_ROLES), role)


def content_text(content: Column) -> Column:
    """Text of a message's content: a string, an object with text, or text parts.

    Numbers and other types are not coerced to text.
    """

    def text_of(part: Column) -> Column:
        return string_field(part, "$.text")

    def is_text_part(part: Column) -> Column:
        part_type = F.try_variant_get(part, "$.type", "string")
        return F.coalesce(part_type.isin(*TEXT_PART_TYPES) & text_of(part).isNotNull(), F.lit(False))

    def joined(parts: Column) -> Column:
        return F.when(F.size(parts) > 0, F.array_join(parts, "\n"))

    def by_kind(kind: Column) -> Column:
        items = F.filter(F.try_variant_get(content, "$", "array<variant>"), is_text_part)
        return (
            F.when(kind == "STRING", F.try_variant_get(content, "$", "string"))
            .when(kind.startswith("OBJECT"), text_of(content))
            .when(kind.startswith("ARRAY"), bind(F.transform(items, text_of), joined))
        )

    return bind(F.schema_of_variant(content), by_kind)


def message_text(event: Column) -> Column:
    return content_text(F.try_variant_get(event, "$.payload.content", "variant"))


def has_exact_keys(value: Column, keys: tuple[str, ...]) -> Column:
    """Whether a VARIANT is an object whose keys are exactly ``keys``."""
    found = F.map_keys(F.when(F.schema_of_variant(value).startswith("OBJECT"), value).cast("map<string,variant>"))
    wanted = F.array(*[F.lit(key) for key in keys])
    same = (F.size(F.array_except(found, wanted)) == 0) & (F.size(F.array_except(wanted, found)) == 0)
    return F.coalesce(same, F.lit(False))
