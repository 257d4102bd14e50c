"""Readings to JSON payloads and back, and publish envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.scalars import format_rfc3339nano, read_rfc3339
from gaugeline.schemas import READING_COLUMNS, TEXT_COLUMNS, ZERO_TIME

_PAYLOAD_FIELDS = ", ".join(
    f"{c} {'double' if c == 'value' else 'string'}" for c in READING_COLUMNS
)

# Spark reads some texts that are not JSON unless told otherwise.
STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

# Why a publish request is refused.
INVALID_JSON = "invalid JSON"
TOPIC_REQUIRED = "topic is required"
MESSAGES_EMPTY = "messages must not be empty"
NOT_AN_OBJECT = "message must be a JSON object"
GPU_ID_NOT_TEXT = "gpu_id must be a string"
GPU_ID_REQUIRED = "gpu_id is required"


def payload_json() -> Column:
    """The 12-key object of a reading; absent text is "", absent number 0, absent time zero."""
    fields = []
    for c in READING_COLUMNS:
        if c == "timestamp":
            value = F.when(F.col(c).isNull(), ZERO_TIME).otherwise(format_rfc3339nano(F.col(c)))
        elif c == "value":
            value = F.coalesce(F.col(c), F.lit(0.0))
        else:
            value = F.coalesce(F.col(c), F.lit(""))
        fields.append(value.alias(c))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def to_payload(df: DataFrame) -> DataFrame:
    """Add ``payload``. JSON has no text for NaN or infinity, so such rows are left out."""
    value = F.coalesce(F.col("value"), F.lit(0.0))
    finite = ~F.isnan(value) & (F.abs(value) != float("inf"))
    return df.filter(finite).withColumn("payload", payload_json())


# The expressions over members are SQL text: nested lambdas read better so, and one text
# costs a single call to the JVM instead of hundreds.


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _members(text: str, keys: list[str]) -> str:
    """A JSON object's members of some names, any case, with value types; NULL for other texts.

    ``from_json`` stops reading after the first value, so the text is read as the only
    element of an array: whatever follows the object then breaks the array, except a
    closing bracket, which the member of an object cannot have either.
    """
    strict = ", ".join(f"'{k}', '{v}'" for k, v in STRICT_JSON.items())
    objects = f"from_json(concat('[', {text}, ']'), 'array<map<string,variant>>', map({strict}))"
    inner = f"from_json(concat('{{\"w\":', {text}, '}}'), 'map<string,variant>', map({strict}))"
    names = ", ".join(f"'{k}'" for k in keys)
    known = f"filter(map_entries(o[0]), y -> lower(y.key) IN ({names}))"
    member = "named_struct('k', lower(y.key), 't', coalesce(schema_of_variant(y.value), 'VOID'), 'v', y.value)"
    return _let("o", objects, f"""
        CASE WHEN size(o) = 1 AND (NOT {text} RLIKE r'\\}}\\s*\\]' OR {inner} IS NOT NULL)
             THEN transform({known}, y -> {member}) END""")


def _last(key: str, kind: str) -> str:
    """The last member of that name which is not JSON null."""
    found = f"filter(e, x -> x.k = '{key}' AND x.t <> 'VOID')"
    return f"try_variant_get(try_element_at({found}, -1).v, '$', '{kind}')"


_GPU_ID = _last("gpu_id", "string")
_GPU_ID_MISTYPED = "exists(e, x -> x.k = 'gpu_id' AND x.t NOT IN ('STRING', 'VOID'))"


def _is_null_literal(text: str) -> str:
    return f"trim({text}) = 'null'"


def extract_gpu_id(text: str = "payload") -> Column:
    """Only ``gpu_id`` of a payload: text, "" when absent or null, NULL when not readable."""
    body = f"CASE WHEN e IS NOT NULL AND NOT {_GPU_ID_MISTYPED} THEN coalesce({_GPU_ID}, '') END"
    return F.expr(
        f"CASE WHEN {_is_null_literal(text)} THEN '' ELSE {_let('e', _members(text, ['gpu_id']), body)} END"
    )


def _problem(text: str) -> str:
    """Why one message is refused, or NULL."""
    known = f"coalesce({text}, '')"
    body = f"""
        CASE WHEN e IS NULL THEN '{NOT_AN_OBJECT}' WHEN {_GPU_ID_MISTYPED} THEN '{GPU_ID_NOT_TEXT}'
             WHEN coalesce({_GPU_ID}, '') = '' THEN '{GPU_ID_REQUIRED}' END"""
    return f"""
        CASE WHEN {_is_null_literal(text)} THEN '{GPU_ID_REQUIRED}'
             ELSE {_let('e', _members(known, ['gpu_id']), body)} END"""


def _checked_fields(text: str) -> str:
    """Any JSON object as ``struct(ok, fields)``, every member's type checked."""
    text_keys = ", ".join(f"'{c}'" for c in (*TEXT_COLUMNS, "timestamp"))
    wrong = f"""
        exists(e, x -> (x.k IN ({text_keys}) AND x.t <> 'STRING')
          OR (x.k = 'value' AND x.t NOT IN ('BIGINT', 'DOUBLE') AND NOT startswith(x.t, 'DECIMAL')))"""
    # Repeated names are rare: only then are the earlier ones looked for and left out.
    last = """
        CASE WHEN size(array_distinct(transform(e, x -> x.k))) = size(e) THEN e
             ELSE filter(e, (x, i) -> NOT exists(slice(e, i + 2, size(e)), y -> y.k = x.k)) END"""
    by_name = f"map_from_entries(transform({last}, x -> struct(x.k, x.v)))"
    fields = ", ".join(
        f"'{c}', try_variant_get(try_element_at(m, '{c}'), '$', '{'double' if c == 'value' else 'string'}')"
        for c in READING_COLUMNS
    )
    return _let("e", f"filter({_members(text, READING_COLUMNS)}, x -> x.t <> 'VOID')", f"""
        named_struct('ok', e IS NOT NULL AND NOT coalesce({wrong}, true),
                     'fields', {_let('m', by_name, f'named_struct({fields})')})""")


def parse_payload(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add the 12 typed columns and ``parse_ok``.

    Keys match in any case, the last non-null member wins, unknown keys are ignored and
    absent ones give "", 0.0 or the zero time. A member of the wrong type, an unreadable
    time or a number beyond double's range is a failure. Payloads written by
    :func:`to_payload` come back through a plain typed ``from_json``; comparing with its
    own ``to_json`` proves nothing was lost, and only other texts take the checked way.

    The two costly steps are generators of one row each. Catalyst copies a projected
    expression into every filter that uses it; it does not do so with generated columns, so
    each step runs once per row and plans stay small.
    """
    nothing = ", ".join(
        f"'{c}', CAST(NULL AS {'double' if c == 'value' else 'string'})" for c in READING_COLUMNS
    )
    chosen = F.expr(f"""
        CASE WHEN to_json(_plain, map('ignoreNullFields', 'false')) = _text
                  AND abs(_plain.value) < double('infinity')
             THEN named_struct('ok', true, 'fields', _plain)
             WHEN {_is_null_literal('_text')}
             THEN named_struct('ok', true, 'fields', named_struct({nothing}))
             ELSE {_checked_fields('_text')} END""")
    fields = F.col("_fields")
    value = fields["value"]
    time_text = fields["timestamp"]
    others = [c for c in df.columns if c not in READING_COLUMNS and c != "parse_ok"]
    parsed = (
        df.withColumn("_text", F.coalesce(F.col(payload), F.lit("")))
        .select(*others, "_text", F.from_json("_text", _PAYLOAD_FIELDS, STRICT_JSON).alias("_plain"))
        .select(*others, F.inline(F.array(chosen)).alias("_ok", "_fields"))
        .select("*", F.inline(F.array(F.struct(read_rfc3339(time_text)))).alias("_time"))
    )
    zero = F.lit(ZERO_TIME).cast("timestamp")
    columns = {c: F.coalesce(fields[c], F.lit("")) for c in TEXT_COLUMNS}
    columns["value"] = F.coalesce(value, F.lit(0.0))
    columns["timestamp"] = F.when(time_text.isNull(), zero).otherwise(F.col("_time"))
    ok = (
        F.col("_ok")
        & (time_text.isNull() | F.col("_time").isNotNull())
        & F.coalesce(~F.isnan(value) & (F.abs(value) < float("inf")), F.lit(True))
    )
    return parsed.select(
        *others, *[columns[c].alias(c) for c in READING_COLUMNS], ok.alias("parse_ok")
    )


def parse_publish_body(df: DataFrame, body: str = "body") -> DataFrame:
    """A raw request body to ``topic`` and ``messages``, and ``invalid_json`` where it cannot be read as a request.

    The first JSON value of a body counts; what follows an object does not matter. Names of members match in any case. The
    last topic that is not null counts, and the last list of messages, null for none. A body that is no object, a topic that is no text
    or messages that are no list cannot be read: ``topic`` and ``messages`` are NULL then. A body that is just null
    is a request without members. Message objects keep their text but for white space and the way numbers are written. A message that is
    itself JSON text is quoted again, so that it is not taken for the object it may contain.
    """
    strict = ", ".join(f"'{k}', '{v}'" for k, v in STRICT_JSON.items())

    def members(kind: str) -> str:
        return f"map_entries(from_json(_body, 'map<string,{kind}>', map({strict})))"

    # Members in their order, with value and type; and with the value's own text.
    typed = "named_struct('k', lower(y.key), 't', coalesce(schema_of_variant(y.value), 'VOID'), 'v', y.value)"
    read = F.expr(f"""named_struct(
        'e', CASE WHEN _body RLIKE r'^[ \\t\\r\\n]*null([ \\t\\r\\n]|$)' THEN array() ELSE transform({members('variant')}, y -> {typed}) END,
        'raw', try_element_at(filter({members('string')}, y -> lower(y.key) = 'messages'), -1).value)""")
    mistyped = "exists(e, x -> (x.k = 'topic' AND x.t NOT IN ('STRING', 'VOID')) OR (x.k = 'messages' AND x.t <> 'VOID' AND NOT startswith(x.t, 'ARRAY')))"
    request = F.expr(f"""named_struct(
        'invalid', e IS NULL OR {mistyped}, 'topic', coalesce({_last('topic', 'string')}, ''),
        'texts', from_json(raw, 'array<string>', map({strict})),
        'kinds', transform(from_json(raw, 'array<variant>', map({strict})), v -> schema_of_variant(v)))""")
    quoted = F.expr("""transform(texts, (m, i) -> CASE WHEN get(kinds, i) = 'STRING'
        THEN concat('"', replace(replace(m, '\\\\', '\\\\\\\\'), '"', '\\\\"'), '"') ELSE coalesce(m, 'null') END)""")
    added = ("topic", "messages", "invalid_json")
    others = [c for c in df.columns if c not in added]
    parsed = (
        df.select(*others, F.coalesce(F.col(body), F.lit("")).alias("_body"))
        .select(*others, F.inline(F.array(read)).alias("e", "raw"))
        .select(*others, F.inline(F.array(request)).alias("invalid_json", "_topic", "texts", "kinds"))
    )
    return parsed.select(
        *others, F.when(~F.col("invalid_json"), F.col("_topic")).alias("topic"),
        F.when(~F.col("invalid_json"), quoted).alias("messages"), "invalid_json")


def publish_problem(topic: str = "topic", messages: str = "messages", invalid: str = "false") -> Column:
    """Why a publish request is refused, or NULL; the first bad message is named."""
    numbered = f"transform({messages}, (m, i) -> concat('messages[', i, ']: ', {_problem('m')}))"
    return F.expr(f"""
        CASE WHEN {invalid} THEN '{INVALID_JSON}'
             WHEN coalesce({topic}, '') = '' THEN '{TOPIC_REQUIRED}'
             WHEN coalesce(size({messages}), 0) <= 0 THEN '{MESSAGES_EMPTY}'
             ELSE get(filter({numbered}, p -> p IS NOT NULL), 0) END""")
