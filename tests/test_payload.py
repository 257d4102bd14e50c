import json

import pytest
from pyspark.sql import functions as F

from gaugeline.functions import payload
from gaugeline.operators import publish
from gaugeline.schemas import READING_SCHEMA


def messages(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, payload string")


def parsed(spark, texts):
    rows = payload.parse_payload(messages(spark, texts)).drop("timestamp")
    return sorted(rows.collect(), key=lambda r: r.i)


@pytest.mark.parametrize("text, ok", [
    ('{"gpu_id":"3","value":1.5}', True),
    ('{"GPU_ID":"3","gpu_id":null}', True),
    ('{"gpu_id":3}', False),
    ('{"gpu_id":"a","gpu_id":"b","x":[1],"x":2}', True),
    ('{"gpu_id":"x","nested":{"a":1,"a":2}}', True),
    ('{"gpu_id":{"a":1}}', False),
    ("[]", False), ('"t"', False), ("null", True), ("nope", False), ("", False), (None, False),
    ('{"value":1e400}', False), ('{"value":"1"}', False), ('{"value":true}', False),
    ('{"value":12345678901234567890123}', True), ('{"value":NaN}', False), ("{}", True),
    ("{'gpu_id':'q'}", False), ('{"gpu_id":"q"} trailing', False), ('{"gpu_id":"q"}] x', False),
    ('{"gpu_id":"q"}} x', False), ('{"gpu_id":"q"},{"gpu_id":"r"}', False),
    ('{"l":"}]"}', True), ('{"l":[{}]}', True),
    ('{"timestamp":"2024-01-01T00:00:00Z"}', True), ('{"timestamp":" 2024-01-01T00:00:00Z"}', False),
    ('{"timestamp":""}', False), ('{"timestamp":null}', True), ('{"timestamp":5}', False),
])
def test_parse_ok(spark, text, ok):
    assert parsed(spark, [text])[0].parse_ok is ok


def test_parsed_values(spark):
    rows = parsed(spark, [
        '{"GPU_ID":"3","gpu_id":null,"value":42949672960}',
        '{"gpu_id":"a","gpu_id":"b","UUID":"u","timestamp":"2024-01-01T02:00:00+02:00"}',
        "null",
    ])
    assert [(r.gpu_id, r.uuid, r.value) for r in rows] == [("3", "", 42949672960.0), ("b", "u", 0.0), ("", "", 0.0)]
    times = payload.parse_payload(messages(spark, ["{}"])).select(F.col("timestamp").cast("string"))
    assert times.first()[0] == "0001-01-01 00:00:00"


def test_to_payload(spark):
    row = (None, "m", "", "d", "u", "a", "h", "", "", "n", 1.25, 'l="x\\y"')
    df = spark.createDataFrame([row, row[:10] + (float("nan"), ""), row[:10] + (float("inf"), "")], READING_SCHEMA)
    texts = [r.payload for r in payload.to_payload(df).collect()]
    assert len(texts) == 1
    made = json.loads(texts[0])
    assert list(made) == READING_SCHEMA.names
    assert made["timestamp"] == "0001-01-01T00:00:00Z" and made["gpu_id"] == "" and made["value"] == 1.25
    assert made["labels_raw"] == 'l="x\\y"'


def test_roundtrip_of_odd_texts(spark):
    texts = ['say "x"', "back\\slash", "tab\tline\nend", "é✓", "{}", "null", " "]
    rows = [(None, t, t, t, t, t, t, t, t, t, float(i) * 1e17, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, READING_SCHEMA)
    back = payload.parse_payload(payload.to_payload(df).select("payload"))
    assert back.filter("parse_ok").count() == len(texts)
    columns = [c for c in READING_SCHEMA.names if c != "timestamp"]
    assert back.select(columns).exceptAll(df.select(columns)).isEmpty()


def test_extract_gpu_id(spark):
    texts = ['{"gpu_id":"x","a":1}', '{"Gpu_ID":"y"}', '{"a":1}', '{"gpu_id":null}', '{"gpu_id":1}', "[]", "null"]
    got = messages(spark, texts).select("i", payload.extract_gpu_id("payload").alias("g")).collect()
    assert [r.g for r in sorted(got)] == ["x", "y", "", "", None, None, ""]


REQUESTS = [
    ("", ['{"gpu_id":"a"}'], "topic is required"),
    (None, ['{"gpu_id":"a"}'], "topic is required"),
    ("t", [], "messages must not be empty"),
    ("t", None, "messages must not be empty"),
    ("t", ['{"gpu_id":"a"}', '{"x":1}'], "messages[1]: gpu_id is required"),
    ("t", ['{"gpu_id":""}'], "messages[0]: gpu_id is required"),
    ("t", ['{"gpu_id":null}'], "messages[0]: gpu_id is required"),
    ("t", ["null"], "messages[0]: gpu_id is required"),
    ("t", ['{"gpu_id":"a"}', '{"gpu_id":4}', "[]"], "messages[1]: gpu_id must be a string"),
    ("t", ['"text"'], "messages[0]: message must be a JSON object"),
    ("t", ["[]"], "messages[0]: message must be a JSON object"),
    ("t", ['{"gpu_id":"a"}', '{"gpu_id":"b","x":{"y":[1]}}'], None),
]


def requests(spark):
    rows = [(i, t, m) for i, (t, m, _) in enumerate(REQUESTS)]
    return spark.createDataFrame(rows, "request_id long, topic string, messages array<string>")


def test_validate_publish(spark):
    got = publish.validate_publish(requests(spark)).orderBy("request_id").collect()
    assert [r.error for r in got] == [e for _, _, e in REQUESTS]


def test_publish_messages_are_of_accepted_requests_only(spark):
    got = publish.publish_messages(requests(spark)).orderBy("index").collect()
    assert [(r.request_id, r["index"], r.gpu_id) for r in got] == [(11, 0, "a"), (11, 1, "b")]
    assert got[0].partition_key == 44
    assert len({r.msg_uuid for r in got}) == 2


def test_publish_body(spark):
    bodies = [
        '{"topic":"t","messages":[{"gpu_id":"1","a":1.50},{"gpu_id":"2"}]}',
        '{"topic":"t","messages":[{"gpu_id":"1"},"{\\"gpu_id\\":\\"3\\"}"]}',
        '{"topic":"t","messages":[null]}',
        '{"messages":[{"gpu_id":"1"}]}',
        '{"topic":"t"}',
    ]
    df = payload.parse_publish_body(spark.createDataFrame(list(enumerate(bodies)), "i int, body string"))
    got = publish.validate_publish(df).orderBy("i").collect()
    assert [r.error for r in got] == [
        None, "messages[1]: message must be a JSON object", "messages[0]: gpu_id is required",
        "topic is required", "messages must not be empty",
    ]
    broken = payload.parse_publish_body(spark.createDataFrame([("nope",)], "body string")).first()
    assert broken.topic is None and broken.messages is None


GOOD = '{"gpu_id":"1"}'
BODIES = [
    (f'{{"topic":3,"messages":[{GOOD}]}}', "invalid JSON"), (f'{{"Topic":"t","Messages":[{GOOD}]}}', None), ("nope", "invalid JSON"),
    ("[1]", "invalid JSON"), ('"x"', "invalid JSON"), ("3", "invalid JSON"), ("", "invalid JSON"), (None, "invalid JSON"),
    ("null", "topic is required"), (" null x", "topic is required"), ("nullx", "invalid JSON"),
    ('{"topic":"t","messages":{}}', "invalid JSON"), ('{"topic":"t","messages":"x"}', "invalid JSON"),
    ('{"topic":"t","messages":null}', "messages must not be empty"), ('{"topic":"t","messages":[]}', "messages must not be empty"),
    (f'{{"topic":null,"messages":[{GOOD}]}}', "topic is required"), (f'{{"topic":"","TOPIC":"u","messages":[{GOOD}]}}', None),
    (f'{{"topic":"t","topic":null,"messages":[{GOOD}]}}', None),
    (f'{{"topic":"t","messages":[{GOOD}],"MESSAGES":null}}', "messages must not be empty"),
    (f'{{"topic":"t","messages":[{GOOD}],"messages":[{{}}]}}', "messages[0]: gpu_id is required"),
    (f'{{"topic":"t","messages":[{GOOD}]}} and more', None), (f'{{"topic":"t","messages":[{GOOD}', "invalid JSON"),
    ("{'topic':'t'}", "invalid JSON"), ('{"topic":"t","messages":[1]}', "messages[0]: message must be a JSON object"),
    ('{"topic":"t","messages":["a\\\\\\"b"]}', "messages[0]: message must be a JSON object"),
    ("{}", "topic is required"), (f'{{"other":[1,{{"topic":5}}],"topic":"t","messages":[{GOOD}]}}', None),
    (f'{{"topic":["t"],"topic":"t","messages":[{GOOD}]}}', "invalid JSON"),
]


def test_odd_bodies(spark):
    rows = spark.createDataFrame([(i, b, "kept") for i, (b, _) in enumerate(BODIES)], "i int, body string, topic string")
    got = publish.validate_publish(payload.parse_publish_body(rows)).orderBy("i").collect()
    assert [r.error for r in got] == [e for _, e in BODIES]
    assert all((r.topic is None) == (r.error == "invalid JSON") for r in got)


def test_ids_of_several_keys_differ(spark):
    from gaugeline.functions.identity import assign_msg_uuid

    pairs = [("a:b", "c"), ("a", "b:c"), ("a", "b"), ("ab", ""), ("", "ab"), (None, "a"), ("a", None), ("1#a", "2#b"), ("1", "#a:2#b"), ("\x00", "a#")]
    ids = [r.msg_uuid for r in assign_msg_uuid(spark.createDataFrame(pairs, "x string, y string"), ["x", "y"]).collect()]
    assert len(set(ids)) == len(pairs)
