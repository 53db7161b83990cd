import tempfile

import pytest
from pyspark.sql import functions as F

from lograft.operators.seen_ids import SeenIds

SCHEMA = "message_id string, publish_time timestamp, value string"


def messages(spark, ids, day, value="v"):
    df = spark.createDataFrame([(None if i is None else f"m{i}", value) for i in ids], "message_id string, value string")
    return df.select("message_id", F.lit(day).cast("timestamp").alias("publish_time"), "value")


def test_redelivery_days_later_under_a_new_checkpoint(spark):
    index = SeenIds(spark, tempfile.mkdtemp(prefix="lograft-seen-"))
    for d in range(3):
        index.take(messages(spark, range(d * 300, d * 300 + 300), f"2024-01-0{d + 1} 10:00:00"), (f"s{d}", 0))
    # a day later, another stream, with repeats inside the batch and ids that never came
    again = messages(spark, [*range(310, 330), *range(2000, 2030), 2000, None, None], "2024-01-05 00:00:00", "again")
    state = index.store.state()
    seen = again.filter("message_id is not null").select(F.col("message_id").alias("id"))
    held = index.known(seen.join(messages(spark, range(310, 330), "2024-01-05").select(F.col("message_id").alias("id")), "id", "left_semi"), state.version)
    read = held.inputFiles()
    assert any("day=2024-01-02" in f for f in read) and sum("day=" in f for f in read) < len(state.files["ids"])
    index.take(again, ("other", 0))
    rows = index.read().collect()
    assert sorted(r.message_id for r in rows if r.message_id) == sorted(f"m{i}" for i in [*range(900), *range(2000, 2030)])
    assert sum(r.message_id is None for r in rows) == 2 and all(r.value == "v" for r in rows if r.message_id in {f"m{i}" for i in range(310, 330)})
    # a replay adds nothing, a batch of known ids nothing either
    index.take(again, ("other", 0))
    index.take(messages(spark, range(900), "2024-01-09"), ("third", 0))
    assert index.read().count() == len(rows)


def test_a_failed_commit_leaves_nothing_and_the_batch_can_come_again(spark, monkeypatch):
    index = SeenIds(spark, tempfile.mkdtemp(prefix="lograft-seen-fail-"))
    index.take(messages(spark, [1], "2024-01-01"), ("a", 0))

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(index.store, "commit", fail)
        with pytest.raises(OSError):
            index.take(messages(spark, [1, 2], "2024-01-02"), ("a", 1))
    assert [r.message_id for r in index.read().collect()] == ["m1"]
    index.take(messages(spark, [1, 2], "2024-01-02"), ("a", 1))
    assert sorted(r.message_id for r in index.read().collect()) == ["m1", "m2"]


def test_filters_hold_every_id(spark):
    """No id is missed, at sizes of several pieces; few others hit."""
    index = SeenIds(spark, tempfile.mkdtemp(prefix="lograft-seen-bits-"))
    index.take(spark.range(20_000).select(F.concat(F.lit("m"), "id").alias("message_id"), F.lit(None).cast("timestamp").alias("publish_time")), ("a", 0))
    version = index.store.state().version
    probe = spark.range(40_000).select(F.concat(F.lit("m"), "id").alias("id"), (F.col("id") < 20_000).alias("old"))
    hit = index.hits(probe, version).join(probe, "id").groupBy("old").count().collect()
    found = {r.old: r["count"] for r in hit}
    assert found[True] == 20_000 and found.get(False, 0) < 200


def test_empty(spark):
    index = SeenIds(spark, tempfile.mkdtemp(prefix="lograft-seen-empty-"))
    index.take(spark.createDataFrame([], SCHEMA), ("a", 0))
    index.take(messages(spark, [1], "2024-01-01"), ("a", 1))
    assert index.read().count() == 1
