"""The command-line jobs, on small files."""

import pytest

from footfall import sources, streaming
from footfall.__main__ import main

SHOPS = """s1,北京,1,100,5,1,1,美食,火锅,其他
s2,上海,2,50,4,1,1,美食,小吃,
s3,北京,3,,3,1,1,美食,火锅,其他
s4,广州,4,80,4,1,1,火锅
"""
PAYMENTS = """u1,s1,2016-01-01 10:00:00
u2,s1,2016-01-01 11:00:00
u1,s1,2016-01-02 10:00:00
u3,s2,2016-01-01 10:00:00
u3,zz,2016-01-01 10:00:00
u4,s4
"""


@pytest.fixture
def data(tmp_path):
    (tmp_path / "shop_info.txt").write_text(SHOPS, encoding="utf-8")
    (tmp_path / "user_pay.txt").write_text(PAYMENTS, encoding="utf-8")
    return str(tmp_path)


def test_batch(spark, data, capsys):
    main(["batch", "--data", data], spark)
    shown = capsys.readouterr().out
    assert "|150.0          |s1     |3       |2       |北京" in shown
    assert "|1.0         |s1     |北京" in shown  # as specified: 0.7 * 5 / 5 + 0.3 * 100 / 100


def test_dashboard(spark, data, capsys):
    pay = sources.read_user_pay(spark, f"{data}/user_pay.txt")
    shops = sources.read_shop_info(spark, f"{data}/shop_info.txt")
    sources.register_tables(user_pay=pay, user_view=pay.limit(2), shop_info=shops)
    main(["dashboard"], spark)
    shown = capsys.readouterr().out
    assert "|top1:北京|300  |" in shown and "|2016-01-02|1       |0        |" in shown
    for name in ("user_pay", "user_view", "shop_info"):
        spark.catalog.dropTempView(name)


def test_report_and_compaction(spark, data, tmp_path, capsys):
    root = str(tmp_path / "run")
    records = streaming.pay_to_records(sources.read_user_pay(spark, f"{data}/user_pay.txt"))
    lookup = sources.shop_city_lookup(sources.read_lines(spark, f"{data}/shop_info.txt"))
    for batch_id in range(3):
        streaming.upsert_counters(streaming.key_counts(records, lookup), batch_id, f"{root}/counters")
    main(["compact", "--root", root], spark)
    main(["report", "--data", data, "--root", root], spark)
    shown = capsys.readouterr().out
    for row in ("1\ts1\t3", "2\ts2\t1", "1\t北京\t3", "2\t上海\t1"):
        assert row in shown
    assert "s4" not in shown


def test_report_is_whole(spark, tmp_path, capsys):
    """All of 50 shops and cities come out, printed or written; without counters nothing does."""
    (tmp_path / "shop_info.txt").write_text("".join(f"s{i},c{i}\n" for i in range(50)), encoding="utf-8")
    args = ["report", "--data", str(tmp_path), "--root", str(tmp_path / "run")]
    main(args, spark)
    assert capsys.readouterr().out == ""
    keys = [f"{prefix}{i}" for i in range(50) for prefix in ("jiaoyis", "交易c")]
    counts = spark.createDataFrame([(key, 1) for key in keys], "k string, count long")
    streaming.upsert_counters(counts, 0, str(tmp_path / "run/counters"))
    main(args, spark)
    assert len(capsys.readouterr().out.splitlines()) == 100
    main([*args, "--out", str(tmp_path / "out")], spark)
    assert spark.read.csv(str(tmp_path / "out/shops"), header=True).count() == 50
    main([*args, "--preview", "3"], spark)
    assert capsys.readouterr().out.count("|s") == 4  # the heading and three shops


def test_stored_activity(spark, data, tmp_path, capsys):
    """Payments of two days, stored one after the other and one of them twice, rank the shops as all at once do."""
    main(["batch", "--data", data], spark)
    whole = capsys.readouterr().out
    assert "payment lines: lines 6, short_lines 1, long_lines 0" in whole
    lines = PAYMENTS.splitlines(keepends=True)
    for name, part in (("a", lines[:2]), ("b", lines[:1]), ("b", lines[2:])):
        (tmp_path / "user_pay.txt").write_text("".join(part), encoding="utf-8")
        main(["store", "--data", data, "--stored", str(tmp_path / "stored"), "--name", name], spark)
    capsys.readouterr()
    main(["batch", "--data", data, "--stored", str(tmp_path / "stored")], spark)
    merged = capsys.readouterr().out
    table = lambda text: text[text.index("+---"):]
    assert table(merged) == table(whole)


def test_increments_and_restored_counters(spark, data, tmp_path, capsys):
    root, inbox = str(tmp_path / "run"), str(tmp_path / "inbox")
    records = streaming.pay_to_records(sources.read_user_pay(spark, f"{data}/user_pay.txt"))
    streaming.write_records(records, {"format": "parquet", "path": inbox})
    lookup = sources.shop_city_lookup(sources.read_lines(spark, f"{data}/shop_info.txt"))
    stream = lambda: streaming.read_pay_stream(spark, {"format": "parquet", "path": inbox})
    streaming.start_increment_stream(stream(), lambda: lookup, root, {"availableNow": True}).awaitTermination()
    streaming.start_counter_stream(stream(), lookup, f"{root}-2", trigger={"availableNow": True}).awaitTermination()
    main(["compact", "--root", root, "--increments"], spark)
    main(["report", "--data", data, "--root", root, "--increments"], spark)
    by_increments = capsys.readouterr().out
    main(["restore", "--checkpoint", f"{root}-2/checkpoint", "--root", f"{root}-3"], spark)
    assert capsys.readouterr().out == '{"logOffset": 0}\n'
    main(["report", "--data", data, "--root", f"{root}-3"], spark)
    restored = capsys.readouterr().out
    assert by_increments == restored and "1\ts1\t3" in restored
