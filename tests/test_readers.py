"""File readers and shop lists: the edge lines of the format, whatever the number of files and splits."""

import pytest
from pyspark.sql import functions as F

from footfall import sources
from footfall.functions import line_fields, non_empty, tolerant_int
from footfall.operators import appearance_index

N = None
SHOP_LINES = [
    ("1,Beijing,2,8,4,12,2,A,,", ("1", "Beijing", "2", 8, 4, 12, 2, "A", N, N)),
    ("2,Shanghai,3,4.5,,", ("2", "Shanghai", "3", N, N, N, N, N, N, N)),
    (",", (N,) * 10),
    ("", ("",) + (N,) * 9),
    ("3", ("3",) + (N,) * 9),
    ("4,GZ,3, 7,+1,-1,1,a,b,c,EXTRA", ("4", "GZ", "3", N, 1, -1, 1, "a", "b", "c")),
    ('5,"q,z",3,7,1,1,1,a,b,c', ("5", '"q', 'z"', 3, 7, 1, 1, "1", "a", "b")),
    ("6,X,1,99999999999,1,1,1", ("6", "X", "1", N, 1, 1, 1, N, N, N)),
    (",,x,2147483648,-2147483648", ("", "", "x", N, -2147483648, N, N, N, N, N)),
    ("7,Y, ,١", ("7", "Y", " ", N, N, N, N, N, N, N)),
]


def _write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def test_shop_file(spark, tmp_path):
    _write(tmp_path / "in", "shop_info.txt", "\n".join(line for line, _ in SHOP_LINES) + "\n")
    df = sources.read_shop_info(spark, str(tmp_path / "in" / "shop_info.txt"))
    assert [tuple(row) for row in df.collect()] == [row for _, row in SHOP_LINES]
    assert [f.dataType.simpleString() for f in df.schema] == ["string"] * 3 + ["int"] * 4 + ["string"] * 3


def test_payment_file(spark, tmp_path):
    _write(tmp_path / "in", "user_pay.txt", "u1,s1,2016-01-01 10:00:00\nu2,s2,,\nu3\n,,\n\nu4,,t,x\n")
    df = sources.read_user_pay(spark, str(tmp_path / "in"))
    assert [tuple(row) for row in df.collect()] == [
        ("u1", "s1", "2016-01-01 10:00:00"),
        ("u2", "s2", N),
        ("u3", N, N),
        (N, N, N),
        ("", N, N),
        ("u4", "", "t"),
    ]


@pytest.mark.parametrize(
    ("line", "fields"),
    [
        ("a,b", ["a", "b"]),
        ("a,,b,,", ["a", "", "b"]),
        (",a", ["", "a"]),
        (",,,", []),
        ("", [""]),
        ("a,, ", ["a", "", " "]),
        (" ,", [" "]),
    ],
)
def test_line_fields(spark, line, fields):
    df = spark.createDataFrame([(line,)], "v string")
    assert df.select(line_fields(F.col("v"))).first()[0] == fields


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("5", 5), ("+5", 5), ("-1", -1), ("007", 7), ("2147483647", 2147483647), ("2147483648", N), ("4.5", N),
        (" 5", N), ("5 ", N), ("", N), (N, N), ("+", N), ("1e3", N), ("5\u0085", N), ("5\n", N), ("5L", N),
        ("9999999999", N), ("10000000000", N), ("-2147483648", -2147483648), ("-2147483649", N),
        ("000000000002147483647", 2147483647), ("99999999999999999999", N), ("0", 0), ("00000000000", 0), ("-0", 0),
    ],
)
def test_tolerant_int(spark, text, value):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(tolerant_int(F.col("v"))).first()[0] == value


def test_non_empty(spark):
    df = spark.createDataFrame([("",), (None,), ("x",)], "v string")
    assert [r.v for r in df.where(non_empty(F.col("v"))).collect()] == ["x"]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _shop_files(folder):
    """Three files of unequal length, so that splits are packed out of order; shops and cities repeat."""
    lines = []
    for name, size in (("a.txt", 40), ("b.txt", 400), ("c.txt", 150)):
        part = [f"s{(i * 7 + len(name) * size) % 90},city{(i * 11 + size) % 17},loc{i}" for i in range(size)]
        part[size // 2] = "lonely"
        part[size // 3] = "trailing,,,"
        _write(folder, name, "\n".join(part) + "\n")
        lines += part
    return lines


def test_ordinals_follow_lines(spark, tmp_path, small_splits):
    lines = _shop_files(tmp_path / "in")
    df = sources.read_lines(spark, str(tmp_path / "in"))
    assert spark.read.text(str(tmp_path / "in")).rdd.getNumPartitions() > 8
    assert [r.value for r in df.orderBy("ordinal").collect()] == lines
    assert df.select("ordinal").distinct().count() == len(lines)


def test_shop_lists(spark, tmp_path, small_splits):
    pairs = [line.split(",")[:2] for line in _shop_files(tmp_path / "in") if line not in ("lonely", "trailing,,,")]
    lines = sources.read_lines(spark, str(tmp_path / "in"))
    assert {r.shop_id: r.city_name for r in sources.shop_city_lookup(lines).collect()} == dict(pairs)
    shops = list(dict.fromkeys(shop for shop, _ in pairs))
    cities = list(dict.fromkeys(city for _, city in pairs))
    assert [r.shop_id for r in sources.distinct_shops(lines).collect()] == shops
    assert [r.city_name for r in sources.distinct_cities(lines).collect()] == cities
    indexed = appearance_index(sources.first_appearance(lines, "shop_id")).orderBy("idx")
    assert [(r.idx, r.shop_id) for r in indexed.collect()] == list(enumerate(shops, 1))


def test_last_line_wins_with_given_ordinals(spark):
    lines = spark.createDataFrame([("s1,b", 2), ("s1,c", 3), ("s1,a", 1), ("s2,x", 4)], "value string, ordinal long")
    assert {tuple(r) for r in sources.shop_city_lookup(lines).collect()} == {("s1", "c"), ("s2", "x")}


def test_warehouse_tables_by_name(spark):
    pay = spark.createDataFrame([("u", "s", "2016-01-01")], "user_id string, shop_id string, time_stamp string")
    sources.register_tables(user_pay=pay)
    assert sources.warehouse_table(spark, "user_pay").collect() == pay.collect()
    pay.write.mode("overwrite").saveAsTable("default.user_view")
    assert sources.warehouse_table(spark, "user_view", "default").collect() == pay.collect()
    with pytest.raises(ValueError):
        sources.warehouse_table(spark, "other")
    by_sql = spark.sql("select substr(time_stamp, 1, 10) as day, count(*) as n from user_pay group by 1")
    assert [tuple(r) for r in by_sql.collect()] == [("2016-01-01", 1)]
    spark.sql("drop table default.user_view")
    spark.catalog.dropTempView("user_pay")
