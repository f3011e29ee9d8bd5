"""Parse, normalise and validate messages, and decide where each one goes.

One lazy projection: no shuffle, no Python on the row path. Each payload is read once into text
fields. Ordinary good events are accepted from that text alone; only the others are read a second
time as VARIANT, which tells missing keys from JSON nulls and "3" from 3 for the error messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions import parsing
from tillstream.functions.text import float_text, lossy_key, lossy_text, quoted, strip
from tillstream.schemas import (
    EVENT_TYPES, REQUIRED_FIELDS, UNPARSEABLE, VALID, VALIDATION_FAILED, WIRE_FIELDS,
)
from tillstream.session import prepare

# JSON texts that count as empty for an event id.
EMPTY_ID_TEXTS = ["", "0", "-0", "0.0", "-0.0", "false", "[]", "{}"]

MESSAGE_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]
EVENT_COLUMNS = [
    "event_id", "event_type", "event_timestamp", "user_id", "product_id", "quantity", "unit_price",
]
CLASSIFIED_COLUMNS = [
    "topic", "partition", "offset", "timestamp", "message_key", "payload", "outcome", "errors",
    *EVENT_COLUMNS,
]


def _list(values: list[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _needs(field: str) -> str:
    types = [t for t in EVENT_TYPES if field in REQUIRED_FIELDS[t]]
    return f"event_type IN ({_list(types)})"


def _add(rows: DataFrame, **columns: str) -> DataFrame:
    return rows.withColumns({name: F.expr(text) for name, text in columns.items()})


def parse_messages(messages: DataFrame) -> DataFrame:
    """Adds `payload`, `parsed` (the JSON object was readable) and `wire` (its fields as text)."""
    return once(_parse(messages))


def _parse(messages: DataFrame) -> DataFrame:
    prepare(messages.sparkSession)
    rows = _add(
        messages,
        payload=lossy_text("value"),
        message_key=lossy_key("key"),
        readable="coalesce(is_valid_utf8(cast(value AS string)), false)",
    )
    rows = _add(rows, wire=parsing.parse_fields("payload"))
    return _add(rows, parsed=f"""readable AND wire IS NOT NULL AND wire.corrupt IS NULL
                AND {parsing.is_one_object("payload")}""")


# Why a payload could not be read.
PARSE_ERROR = f"""CASE
    WHEN value IS NULL THEN 'malformed JSON payload: no value'
    WHEN NOT readable THEN 'malformed JSON payload: invalid UTF-8'
    WHEN {parsing.is_json("payload")} THEN 'not a JSON object'
    ELSE 'malformed JSON payload' END"""


def normalize_messages(parsed: DataFrame) -> DataFrame:
    """Adds the typed fields. A value that cannot be made to fit stays null here."""
    rows = _add(
        parsed,
        event_id="wire.event_id",
        event_type=f"""CASE WHEN wire.event_type IN ({_list(EVENT_TYPES)}) THEN wire.event_type
            ELSE upper({strip('wire.event_type')}) END""",
        event_timestamp=parsing.event_time("wire.timestamp"),
        user_id="wire.user_id",
        product_id="wire.product_id",
        quantity_text=parsing.integer_text("wire.quantity"),
        price=parsing.number("wire.unit_price"),
    )
    return _add(
        rows,
        quantity="try_cast(quantity_text AS int)",
        unit_price="try_cast(price AS decimal(10,2))",
    )


# Accepted without a look at JSON types: every field the type needs is there and good.
PLAINLY_VALID = f"""coalesce(
    parsed AND event_type IN ({_list(EVENT_TYPES)})
    AND event_id NOT IN ({_list(EMPTY_ID_TEXTS)})
    AND event_timestamp IS NOT NULL
    AND user_id IS NOT NULL
    AND (NOT {_needs("product_id")} OR product_id IS NOT NULL)
    AND CASE WHEN {_needs("quantity")} THEN quantity > 0
             ELSE wire.quantity IS NULL OR quantity IS NOT NULL END
    AND CASE WHEN {_needs("unit_price")} THEN price > 0 AND unit_price IS NOT NULL
             ELSE wire.unit_price IS NULL OR unit_price IS NOT NULL END,
    false)"""

# JSON type per field: null when the key is absent, VOID for a JSON null.
KINDS = "named_struct({})".format(", ".join(
    f"'{name}', schema_of_variant(try_variant_get(document, '$.{name}', 'variant'))"
    for name in WIRE_FIELDS
))

_NUMERIC = r"r'^(BIGINT|DECIMAL|DOUBLE|FLOAT)'"

MISSING = "CASE event_type {} END".format(" ".join(
    "WHEN '{}' THEN concat_ws(', ', {})".format(event_type, ", ".join(
        f"""if(kind.{name} IS NULL, "'{name}'", NULL)"""
        for name in sorted(REQUIRED_FIELDS[event_type])
    ))
    for event_type in EVENT_TYPES
))

# Empty string, zero, false or an empty container - but not the strings "0" or "false".
FALSY_ID = f"""CASE WHEN kind.event_id = 'VOID' THEN true
    WHEN kind.event_id = 'STRING' THEN wire.event_id = ''
    ELSE wire.event_id IN ({_list(EMPTY_ID_TEXTS)}) END"""


def _shown(field: str, text: str = "") -> str:
    """A value as error messages show it, by its JSON type."""
    kind, text = f"kind.{field}", text or f"wire.{field}"
    double = f"try_cast({text} AS double)"
    return f"""CASE WHEN {kind} IS NULL OR {kind} = 'VOID' THEN 'None'
        WHEN {kind} = 'BOOLEAN' THEN initcap({text})
        WHEN {kind} = 'STRING' THEN {quoted(text)}
        WHEN {kind} RLIKE r'^(DECIMAL|DOUBLE|FLOAT)' AND {text} RLIKE r'[.eE]'
        THEN coalesce({float_text(double)}, {text})
        ELSE {text} END"""


def _number_error(field: str, positive: str, read: str, shown: str) -> str:
    """Not a positive number where one is needed, too big for the column, or unfit for it.

    `read` is null when the value is no number at all, `shown` is a number as messages show it.
    """
    there, needed = f"kind.{field} IS NOT NULL", _needs(field)
    rounds = LOOSE_QUANTITY if field == "quantity" else "false"
    label = f"""CASE
        WHEN {needed} AND {there} AND NOT coalesce({positive}, false) THEN 'invalid {field}: '
        WHEN {read} IS NOT NULL AND {field} IS NULL THEN '{field} out of range: '
        WHEN NOT {needed} AND {there} AND kind.{field} <> 'VOID' AND {field} IS NULL
            AND NOT coalesce({rounds}, false) THEN 'invalid {field}: ' END"""
    return f"concat({label}, coalesce({shown}, {_shown(field)}))"


# A fractional JSON number in a quantity nobody checks is rounded by the column.
ROUNDED_QUANTITY = "try_cast(round(try_cast(wire.quantity AS decimal(38,10))) AS int)"
LOOSE_QUANTITY = f"""NOT {_needs("quantity")} AND quantity IS NULL
    AND kind.quantity RLIKE {_NUMERIC} AND {ROUNDED_QUANTITY} IS NOT NULL"""
_DIGITS = "try_cast(quantity_text AS decimal(38,0))"

# What is wrong with a readable event, in order; an unknown type hides everything else.
ERRORS = f"""CASE
    WHEN NOT coalesce(event_type IN ({_list(EVENT_TYPES)}), false)
    THEN array(concat('unknown event_type: ', {_shown("event_type", "event_type")}))
    ELSE array_compact(array(
        concat('missing required fields: [', nullif({MISSING}, ''), ']'),
        CASE WHEN kind.event_id IS NOT NULL AND {FALSY_ID} THEN 'empty event_id' END,
        CASE WHEN kind.timestamp IS NOT NULL
                  AND (event_timestamp IS NULL OR kind.timestamp <> 'STRING')
             THEN concat('invalid timestamp: ', {_shown("timestamp")}) END,
        {_number_error("quantity", f"{_DIGITS} > 0", "quantity_text",
                       f"cast({_DIGITS} AS string)")},
        {_number_error("unit_price", "price > 0", "price", float_text("price"))}
    )) END"""

# The second look at events that are not plainly valid. A lambda over one element is skipped for
# all others, and keeps this long expression out of the code compiled for every row.
SECOND_LOOK = f"""element_at(transform(transform(
    CASE WHEN parsed AND NOT plain THEN array(try_parse_json(payload)) END,
    document -> {KINDS}),
    kind -> named_struct(
        'errors', {ERRORS},
        'quantity', CASE WHEN {LOOSE_QUANTITY} THEN {ROUNDED_QUANTITY} ELSE quantity END)), 1)"""


def validate_messages(normalized: DataFrame) -> DataFrame:
    """Adds `outcome` and `errors` (empty for a valid event)."""
    rows = _add(normalized, plain=PLAINLY_VALID)
    rows = _add(rows, second=SECOND_LOOK)
    return _add(
        rows,
        errors=f"""CASE WHEN plain THEN cast(array() AS array<string>)
            WHEN NOT parsed THEN array({PARSE_ERROR}) ELSE second.errors END""",
        outcome=f"""CASE WHEN plain THEN '{VALID}' WHEN NOT parsed THEN '{UNPARSEABLE}'
            WHEN size(second.errors) > 0 THEN '{VALIDATION_FAILED}' ELSE '{VALID}' END""",
        quantity="CASE WHEN plain OR NOT parsed THEN quantity ELSE second.quantity END",
    )


def once(rows: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """The same rows, or those columns of them, computed once each.

    A filter on a field would otherwise be pushed down by copying the expressions behind it,
    parsing every payload again per copy. Filters stop at a generator.
    """
    columns = columns or {name: f"`{name}`" for name in rows.columns}
    row = ", ".join(f"'{name}', {value}" for name, value in columns.items())
    return rows.select(F.expr(f"inline(array(named_struct({row})))"))


def classify(messages: DataFrame) -> DataFrame:
    """Messages with their outcome, errors and typed event fields.

    Takes `key, value, topic, partition, offset, timestamp`; further columns are carried along.
    """
    extra = [name for name in messages.columns if name not in MESSAGE_COLUMNS]
    rows = validate_messages(normalize_messages(_parse(messages)))
    # Payloads that could not be read have no fields.
    return once(rows, {
        name: f"if(parsed, {name}, NULL)" if name in EVENT_COLUMNS else f"`{name}`"
        for name in [*CLASSIFIED_COLUMNS, *extra]})


def valid_events(classified: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Accepted messages in the shape of the raw table."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return classified.where(F.col("outcome") == VALID).select(
        *EVENT_COLUMNS,
        stamp.alias("ingested_at"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
    )


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("outcome") != VALID)


def route_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("outcome").agg(F.count("*").alias("messages"))


def check_shape(messages: DataFrame) -> DataFrame:
    """Adds `well_shaped`: exactly the keys of its type, JSON-typed numbers, 20-character time."""
    rows = _add(
        parse_messages(messages),
        document="CASE WHEN parsed THEN try_parse_json(payload) END",
        keys="CASE WHEN parsed THEN array_sort(array_distinct(json_object_keys(payload))) END",
    )
    rows = _add(rows, kind=f"CASE WHEN parsed THEN {KINDS} END")
    expected = " ".join(
        f"WHEN '{event_type}' THEN array({_list(sorted(names))})"
        for event_type, names in REQUIRED_FIELDS.items()
    )
    return _add(rows, well_shaped=f"""coalesce(
        keys = CASE wire.event_type {expected} END
        AND coalesce(kind.quantity = 'BOOLEAN' OR kind.quantity RLIKE {_NUMERIC}
                     AND wire.quantity RLIKE r'{parsing.INTEGER}', true)
        AND coalesce(kind.unit_price = 'BOOLEAN' OR kind.unit_price RLIKE {_NUMERIC}, true)
        AND length(wire.timestamp) = 20 AND endswith(wire.timestamp, 'Z'), false)""")
