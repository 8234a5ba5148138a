"""The replay plan and the send step agree, also on corrected payloads."""

from pyspark.sql import functions as F

from fleetline.plans import deadletter as L

AT = "source_topic string, source_partition int, source_offset bigint"


def test_replay_sends_what_the_plan_reports(spark):
    dead = spark.createDataFrame(
        [("t", 0, 1, "r: x", '{"event":{"device_id":"d1"}}'), ("t", 0, 2, "r: y", '{"raw_base64":"aGk="}'),
         ("t", 0, 3, "r: z", '{"raw_base64":"aGk="}')], f"{AT}, reason string, payload string")
    replays = spark.createDataFrame([("t", 0, 3)], AT).withColumn("replayed_at", F.current_timestamp())
    fixes = spark.createDataFrame([("t", 0, 2, '{"event":{"device_id":"d22"}}')], f"{AT}, payload string")
    plan = {r["source_offset"]: r for r in L.replay_plan(dead, replays, dead, fixes).collect()}
    sent = {int(r["headers"][0]["value"].decode().split(":")[2]): r for r in L.replay_deliveries(
        dead, dead, "raw", F.current_timestamp(), fixes).collect()}
    assert {k: r["payload_bytes"] for k, r in plan.items()} == {k: len(r["value"]) for k, r in sent.items()}
    assert bytes(sent[2]["value"]) == b'{"event":{"device_id":"d22"}}' and bytes(sent[2]["key"]) == b"d22"
    assert bytes(sent[3]["value"]) == b"hi" and sent[3]["key"] is None
    assert {k: r["next_replay_count"] for k, r in plan.items()} == {1: 1, 2: 1, 3: 2}
