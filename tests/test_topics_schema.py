import pytest
from pyspark.sql import types as T

from tidemark import (MESSAGE_SCHEMA, PARTITION_STATE_SCHEMA, SourceTopic, validate_source_topic,
                      validate_topics)
from tidemark.sources.log import kafka_options, kafka_topic_options


ACCEPTED = [
    (SourceTopic.from_earliest("clicks"), "earliest", None),
    (SourceTopic("clicks"), "latest", None),
    (SourceTopic.from_absolute_time("clicks", 42), "absolute_time", 42),
    ({"name": "clicks", "policy": "relative_time", "time_ms": 90_000}, "relative_time", 90_000),
    ({"name": "clicks", "policy": "earliest", "time_ms": None}, "earliest", None),
    (SourceTopic.from_start_of_day("clicks", 5, "Asia/Tokyo"), "start_of_day", 5),
]

REJECTED = [
    (SourceTopic("clicks", "newest"), ValueError, "newest"),
    ({"name": "clicks", "policy": "start_of_day", "time_ms": 1}, ValueError, "start_of_day"),
    (SourceTopic("clicks", "relative_time"), ValueError, "needs time_ms"),
    ({"name": "clicks", "policy": "absolute_time"}, ValueError, "needs time_ms"),
    (SourceTopic("clicks", "start_of_day", 3), ValueError, "timezone"),
    ({"policy": "earliest"}, KeyError, "name"),
    ({"name": "clicks"}, KeyError, "policy"),
]


@pytest.mark.parametrize("spec,policy,time_ms", ACCEPTED)
def test_specs_that_are_accepted(spec, policy, time_ms):
    got = validate_source_topic(spec)
    assert (got.name, got.policy, got.time_ms) == ("clicks", policy, time_ms)


@pytest.mark.parametrize("spec,error,text", REJECTED)
def test_specs_that_are_rejected(spec, error, text):
    with pytest.raises(error, match=text):
        validate_source_topic(spec)


def test_a_topic_is_given_once():
    assert len(validate_topics([SourceTopic("a"), {"name": "b", "policy": "earliest"}])) == 2
    with pytest.raises(ValueError, match="twice"):
        validate_topics([SourceTopic("a"), {"name": "a", "policy": "earliest"}])


# Names and nullability of the two output tables.
MESSAGE_FIELDS = {"key": True, "value": True, "topic": False, "partition": False, "offset": False, "timestamp": False}
STATE_FIELDS = {"topic": False, "partition": False, "replay_start_offset": False, "replay_end_offset": False,
                "consumed_offset": False, "released_offset": False, "last_consumed_timestamp": True,
                "is_live": False, "is_paused": False}


@pytest.mark.parametrize("schema,fields", [(MESSAGE_SCHEMA, MESSAGE_FIELDS), (PARTITION_STATE_SCHEMA, STATE_FIELDS)])
def test_output_schemas(schema, fields):
    assert {f.name: f.nullable for f in schema} == fields and schema.names == list(fields)
    assert schema["partition"].dataType == T.IntegerType()
    assert {f.dataType for f in schema if f.name.endswith("offset")} == {T.LongType()}


def test_kafka_options():
    o = kafka_options({"bootstrap.servers": "h:1", "group.id": "g", "kafka.security.protocol": "SSL"}, subscribe=["a", "b"])
    assert o == {"kafka.bootstrap.servers": "h:1", "kafka.security.protocol": "SSL", "subscribe": "a,b", "maxOffsetsPerTrigger": "10000"}
    assert "maxOffsetsPerTrigger" not in kafka_options({}, max_per_trigger=None)
    assert kafka_options({}, source={"failOnDataLoss": False})["failOnDataLoss"] == "False"


def test_kafka_options_of_each_policy():
    as_of = 1_706_659_200_000  # 2024-01-31T00:00:00Z, the evening of the 30th in New York
    specs = [SourceTopic.from_earliest("e"), SourceTopic.from_latest("l"), SourceTopic.from_absolute_time("a", 77),
             SourceTopic.from_relative_time("r", 1000), SourceTopic.from_start_of_day("d", 3_600_000, "America/New_York")]
    o = kafka_topic_options({"bootstrap.servers": "h:1"}, specs, as_of, batch_size=50)
    assert [x["subscribe"] for x in o.values()] == ["e", "l", "a", "r", "d"]
    assert {x["maxOffsetsPerTrigger"] for x in o.values()} == {"10"}
    assert (o["e"]["startingOffsets"], o["l"]["startingOffsets"]) == ("earliest", "latest")
    assert (o["a"]["startingTimestamp"], o["r"]["startingTimestamp"]) == ("77", str(as_of - 1000))
    assert o["d"]["startingTimestamp"] == str(as_of - 19 * 3_600_000 + 3_600_000)
    assert all("failOnDataLoss" not in x for x in o.values())
    fixed = kafka_topic_options({}, specs[:2], as_of, ends={"e": {1: 9, 0: 5}}, streaming=False)
    assert fixed["e"]["endingOffsets"] == '{"e": {"0": 5, "1": 9}}' and fixed["l"]["endingOffsets"] == "latest"
    assert "maxOffsetsPerTrigger" not in fixed["e"]
    with pytest.raises(ValueError, match="as_of_ms"):
        kafka_topic_options({}, specs[3:])


def test_a_replay_of_a_missing_topic_raises(spark):
    from helpers import make_log, msg
    from tidemark.plans.replay import Replay
    log = make_log(spark, [[msg("here", 0, 0, 1)]])
    with pytest.raises(ValueError, match="gone"):
        Replay(log, [SourceTopic.from_earliest("here"), SourceTopic.from_earliest("gone")]).ranges


def test_a_closed_replay_keeps_nothing(spark):
    from helpers import make_log, msg
    from tidemark.plans.replay import Replay
    from tidemark.session import written
    log, mark = make_log(spark, [[msg("t", 0, 0, 1)], [msg("t", 0, 1, 2)]]), written()
    with Replay(log, [SourceTopic.from_earliest("t")]) as rp:
        assert rp.released.count() == 2 and written() > mark
        assert spark.sparkContext._jsc.getPersistentRDDs().size() > 0
    assert written() == mark and spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_message_projection(spark):
    from tidemark.schema import to_messages
    log = spark.createDataFrame(
        [("t", 0, 0, 1500, None, None), ("t", 0, 1, None, "k", "v"), ("t", 1, 0, 2001, "k", "v")],
        "topic string, partition int, offset long, timestamp_ms long, key string, value string")
    m = to_messages(log)
    assert m.schema.names == MESSAGE_SCHEMA.names
    rows = sorted(m.collect(), key=lambda r: (r.partition, r.offset))
    assert len(rows) == 2            # untimestamped message dropped (P2)
    assert rows[0].key is None and rows[0].value is None   # tombstone kept (P3)
    assert bytes(rows[1].value) == b"v"
