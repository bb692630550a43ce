"""Readers, indexes and counters against small Python models on generated data."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall import operators, plans, sources, streaming
from footfall.fixed import RECORD_SCHEMA, USER_PAY_SCHEMA

quick = settings(
    max_examples=8, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

field = st.one_of(
    st.just(""),
    st.sampled_from(["7", "+7", "-7", " 7", "7.0", "2147483647", "2147483648", "-2147483648", "0012", '"', "北京"]),
    st.text(alphabet="ab1 \u0085 é", max_size=4),
)
lines = st.lists(st.lists(field, max_size=12).map(",".join), min_size=20, max_size=60)


def _fields(line):
    """Fields of a line: trailing empty ones do not exist, except the only field of an empty line."""
    fields = line.split(",")
    if line:
        while fields and fields[-1] == "":
            fields.pop()
    return fields


def _integer(text):
    digits = text[1:] if text and text[0] in "+-" else text
    if not digits or any(c not in "0123456789" for c in digits):
        return None
    value = int(text)
    return value if -(2**31) <= value < 2**31 else None


def _shop(line):
    fields = (_fields(line) + [None] * 10)[:10]
    return tuple(_integer(f) if 3 <= i <= 6 else f for i, f in enumerate(fields))


@quick
@given(lines)
def test_parsed_lines(spark, lines):
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    assert [tuple(r) for r in sources.parse_shop_info(df).collect()] == [_shop(line) for line in lines]
    payments = [tuple((_fields(line) + [None] * 3)[:3]) for line in lines]
    assert [tuple(r) for r in sources.parse_user_pay(df).collect()] == payments
    published = [(f[0], f"{f[1]},{f[2]}") for f in map(_fields, lines) if len(f) >= 3]
    records = streaming.pay_to_records(sources.parse_user_pay(df))
    assert [tuple(r) for r in records.collect()] == published


@quick
@given(lines)
def test_shop_lists(spark, lines):
    df = spark.createDataFrame(list(zip(lines, range(len(lines)))), "value string, ordinal long").repartition(4)
    pairs = [f[:2] for f in map(_fields, lines) if len(f) >= 2]
    assert {r.shop_id: r.city_name for r in sources.shop_city_lookup(df).collect()} == dict(map(tuple, pairs))
    assert [r.shop_id for r in sources.distinct_shops(df).collect()] == list(dict.fromkeys(s for s, _ in pairs))
    assert [r.city_name for r in sources.distinct_cities(df).collect()] == list(dict.fromkeys(c for _, c in pairs))


@quick
@given(st.sets(st.one_of(st.integers(0, 300), st.integers(0, 1 << 20), st.integers(0, (1 << 48) - 1)), max_size=80))
def test_running_index(spark, ordinals):
    df = spark.createDataFrame([(o,) for o in ordinals], "ordinal long").repartition(3)
    got = operators.appearance_index(df).collect()
    assert {(r.idx, r.ordinal) for r in got} == set(enumerate(sorted(ordinals), 1)) and len(got) == len(ordinals)


shop = st.sampled_from(["s1", "s1", "s1", "s2", "s3", ""])
stamp = st.one_of(st.none(), st.sampled_from(["2016-01-01 10:00", "2016-01-01 11:00", "2016-01-02", "bad", ""]))
payment = st.tuples(st.one_of(st.none(), st.just("u")), shop, stamp)


@quick
@given(st.lists(payment, max_size=60), st.lists(payment, max_size=60))
def test_activity_days_and_counters(spark, pay, view):
    pay_df, view_df = (spark.createDataFrame(rows, USER_PAY_SCHEMA).repartition(3) for rows in (pay, view))
    expected = {
        s: (sum(1 for u, s2, _ in pay if s2 == s and u), len({t[:10] for _, s2, t in pay if s2 == s and t is not None}))
        for _, s, _ in pay
    }
    got = {r.shop_id: (r.countPay, r.countDay) for r in plans.shop_activity(pay_df).collect()}
    assert got == expected

    days, views = (Counter(t if t is None else t[:10] for _, _, t in rows) for rows in (pay, view))
    views.pop(None, None)  # null days are equal to nothing
    joined = {r.day: (r.countPay, r.countView) for r in plans.day_pay_view_all(pay_df, view_df).collect()}
    assert joined == {day: (n, views.get(day, 0)) for day, n in days.items()}

    lookup = {"s1": "A", "s2": "A"}
    lookup_df = spark.createDataFrame(list(lookup.items()), "shop_id string, city_name string")
    records = spark.createDataFrame([(u, f"{s},{t}") for u, s, t in pay], RECORD_SCHEMA)
    totals = Counter(f"jiaoyi{s}" for _, s, _ in pay) + Counter(f"交易{lookup.get(s, 'null')}" for _, s, _ in pay)
    assert {r.k: r["count"] for r in streaming.key_counts(records, lookup_df).collect()} == dict(totals)


def test_shared_folder_needs_a_setting_on_a_cluster():
    from types import SimpleNamespace

    from footfall.session import shared_folder

    conf = SimpleNamespace(get=lambda key, default: None)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError, match=r"spark.checkpoint.dir"):
        shared_folder(cluster, "x")
    local = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="local[2]"))
    first, second = shared_folder(local, "x"), shared_folder(local, "x")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


def test_written_intermediate_reads_back(spark):
    from footfall.session import write_shared

    df = spark.range(5).withColumn("s", F.lit("x"))
    kept = write_shared(df, "probe")
    assert sorted(map(tuple, kept.collect())) == [(i, "x") for i in range(5)]
    assert "Range" not in kept._jdf.queryExecution().executedPlan().toString()
