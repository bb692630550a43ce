"""What a checkpoint holds: counters as a table, partitions, offsets; and sources that archive what was read."""

import json
from pathlib import Path

import pytest

from footfall import streaming

LOOKUP = [("s1", "A"), ("s2", "B")]
NOW = {"availableNow": True}


class Shop:
    def __init__(self, spark, folder):
        self.spark, self.inbox, self.root = spark, str(folder / "inbox"), str(folder / "run")
        self.lookup = spark.createDataFrame(LOOKUP, "shop_id string, city_name string")
        self.expected = {}

    def feed(self, *shops, inbox=None):
        city = dict(LOOKUP)
        for shop in shops:
            for key in (f"jiaoyi{shop}", f"交易{city.get(shop, 'null')}"):
                self.expected[key] = self.expected.get(key, 0) + 1
        records = [(f"u{i}", f"{shop},2016-01-01") for i, shop in enumerate(shops)]
        frame = self.spark.createDataFrame(records, "key string, value string").coalesce(1)
        streaming.write_records(frame, {"format": "parquet", "path": inbox or self.inbox})

    def run(self, source=None, root=None, **options):
        stream = streaming.read_pay_stream(self.spark, source or {"format": "parquet", "path": self.inbox})
        query = streaming.start_counter_stream(stream, self.lookup, root or self.root, trigger=NOW, **options)
        query.awaitTermination()

    def counters(self, root=None):
        rows = streaming.read_counters(self.spark, f"{root or self.root}/counters").collect()
        return {row.k: row["count"] for row in rows}


@pytest.fixture
def shop(spark, tmp_path):
    return Shop(spark, tmp_path)


def test_state_is_the_counters(spark, shop):
    shop.feed("s1", "s1", "s2")
    shop.run()
    first = dict(shop.expected)
    shop.feed("s1", "s9")
    shop.run()
    checkpoint = f"{shop.root}/checkpoint"
    read = lambda *batch: {row.k: row["count"] for row in streaming.counters_from_state(spark, checkpoint, *batch).collect()}
    assert read() == shop.expected == shop.counters()
    assert read(0) == first


def test_another_number_of_partitions_starts_from_the_state(spark, shop, tmp_path):
    shop.feed("s1", "s1", "s2")
    shop.run()
    other, inbox = str(tmp_path / "other"), str(tmp_path / "later")
    streaming.restore_counters(spark, f"{shop.root}/checkpoint", f"{other}/counters")
    shop.feed("s1", "s9", inbox=inbox)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        shop.run({"format": "parquet", "path": inbox}, other)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert shop.counters(other) == shop.expected
    assert streaming.state_partitions(spark, f"{shop.root}/checkpoint") == int(before)
    assert streaming.state_partitions(spark, f"{other}/checkpoint") == 3
    streaming.restore_counters(spark, f"{shop.root}/checkpoint", f"{other}/counters")  # again: nothing is added
    assert shop.counters(other) == shop.expected


def test_offsets(spark, shop, tmp_path):
    assert streaming.read_offsets(spark, f"{shop.root}/checkpoint") == []
    for shops in (["s1"], ["s2"]):
        shop.feed(*shops)
        shop.run()
    assert streaming.read_offsets(spark, f"{shop.root}/checkpoint") == [{"logOffset": 1}]
    # As a topic's checkpoint has them; the batch that was planned but not committed does not count.
    topic = tmp_path / "topic"
    for folder in ("offsets", "commits"):
        (topic / folder).mkdir(parents=True)
    for batch, offset in (("9", 5), ("10", 7), ("11", 9)):
        (topic / "offsets" / batch).write_text('v1\n{"batchWatermarkMs":0}\n' + json.dumps({"pay": {"0": offset, "1": 2}}) + "\n-")
    for batch in ("9", "10"):
        (topic / "commits" / batch).write_text("v1\n{}")
    assert streaming.read_offsets(spark, str(topic)) == [{"pay": {"0": 7, "1": 2}}]


def test_read_files_are_archived_and_totals_stay(spark, shop, tmp_path):
    source = streaming.archived_files(shop.inbox, str(tmp_path / "archive"), maxFilesPerTrigger=1)
    for _ in range(3):
        shop.feed("s1", "s2", "s9")
        shop.feed("s2")
        shop.run(source)
        assert shop.counters() == shop.expected
    left = len(list(Path(shop.inbox).glob("part-*")))
    archived = len(list((tmp_path / "archive").rglob("part-*.parquet")))
    assert left + archived == 6 and left <= 2
    shop.run(source)
    assert shop.counters() == shop.expected
