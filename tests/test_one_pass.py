"""Results, counts, faults and indexes that come from one run of their input."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as registry
from footfall import operators, sources

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture
def watched(spark):
    """A way to see how many rows of a plan were made in all runs of it."""
    made = spark.sparkContext.accumulator(0)

    def watch(df):
        def count(batches):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch

        return df.mapInArrow(count, df.schema)

    return watch, made


def test_rows_and_count_from_one_run(spark, watched):
    watch, made = watched
    rows, count = operators.counted(watch(spark.range(1000).repartition(7)))
    assert count == 1000 == rows.count() == rows.distinct().count()
    assert made.value == 1000
    assert operators.counted(spark.range(0))[1] == 0


def test_show_and_count(spark, watched, capsys):
    watch, made = watched
    assert operators.show_counted(watch(spark.range(50)), 3) == 50
    assert made.value == 50 and "only showing top 3 rows" in capsys.readouterr().out


# Numbering


def _ordinals(kind, n):
    base = datetime.datetime(2020, 1, 1)
    return {
        "int": list(range(n)),
        "bigint": [i * 10**12 - 5 * 10**14 for i in range(n)],
        "double": [i * 0.5 - 100 for i in range(n)],
        "decimal(20,2)": [Decimal(i) / 4 * 4 for i in range(n)],
        "date": [base.date() + datetime.timedelta(days=i) for i in range(n)],
        "timestamp": [base + datetime.timedelta(seconds=i) for i in range(n)],
        "timestamp_ntz": [base + datetime.timedelta(hours=i) for i in range(n)],
        "string": [f"{i:06d}" for i in range(n)],
        "struct<a:int,b:string>": [(i // 10, str(i % 10)) for i in range(n)],
    }[kind]


@pytest.mark.parametrize(
    "kind", ["int", "bigint", "double", "decimal(20,2)", "date", "timestamp", "timestamp_ntz", "string", "struct<a:int,b:string>"]
)
def test_numbers_follow_any_ordinal_in_one_run(spark, watched, kind):
    watch, made = watched
    rows = [(value, i) for i, value in enumerate(_ordinals(kind, 700), 1)]
    random.Random(1).shuffle(rows)
    df = watch(spark.createDataFrame(rows, f"ordinal {kind}, expected long").repartition(5))
    got = operators.appearance_index(df).collect()
    assert len(got) == 700 and all(row.idx == row.expected for row in got)
    assert made.value == 700


def test_ranges_are_even(spark):
    from footfall.operators.ranking import _with_ranges

    skewed = spark.range(10_000).select((F.col("id") * F.col("id")).alias("ordinal"))
    sizes = [row["count"] for row in _with_ranges(skewed, "ordinal").groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.1 * 10_000 / 8


def test_numbering_odd_tables(spark):
    assert operators.appearance_index(spark.createDataFrame([], "ordinal int, x string")).collect() == []
    one = spark.createDataFrame([(5, "a"), (None, "b"), (7, "c")], "ordinal int, x string")
    assert {row.x: row.idx for row in operators.appearance_index(one).collect()} == {"b": 1, "a": 2, "c": 3}


def test_lines_are_numbered_by_their_file_splits(spark, tmp_path):
    for file in range(3):
        (tmp_path / f"{file}.txt").write_text("".join(f"{file * 1000 + i}\n" for i in range(1000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500b")
    try:
        lines = operators.appearance_index(sources.read_lines(spark, str(tmp_path)))
        assert all(row.idx == int(row.value) + 1 for row in lines.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_reports_do_not_run_their_input_again(spark):
    plan = registry.queries()["shop_counter_report"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "supplier" not in plan and "/counters-" not in plan and "rangepartitioning(ordinal" not in plan


# Faults of lines


def test_faults_are_counted_while_lines_are_read(spark, watched):
    watch, made = watched
    lines = ["s1,c,l,5,4,3,2,a,b,c", "s2,c,l,x,,9999999999,2", "s3", ",", "", "s4,c,l,5,4,3,2,a,b,c,more", "s5,c,l, 5"]
    seen = Observation()
    shops = sources.parse_shop_info(watch(spark.createDataFrame([(line,) for line in lines], "value string")), seen)
    assert len(shops.collect()) == 7 and made.value == 7
    assert seen.get == {
        "lines": 7, "short_lines": 5, "long_lines": 1, "bad_per_pay": 2, "bad_score": 0, "bad_comment_cnt": 1, "bad_shop_level": 0,
    }


def test_reading_without_watching_is_as_before(spark, tmp_path):
    path = tmp_path / "pay.txt"
    path.write_text("u1,s1,2016-01-01 10:00:00\nu2,s2\n")
    seen = Observation()
    watched = sources.read_user_pay(spark, str(path), seen).collect()
    assert watched == sources.read_user_pay(spark, str(path)).collect()
    assert seen.get == {"lines": 2, "short_lines": 1, "long_lines": 0}
