"""Registered queries and their SQL counterparts.

``queries()`` runs the plans of ``footfall`` on the driver's test tables, in the roles that ``footfall.bindings``
gives them. ``oracle_sql()`` states the same results in SQL.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from footfall import bindings, operators, plans, sources, streaming  # noqa: E402
from footfall.functions import tolerant_int  # noqa: E402
from footfall.session import shared_folder, write_shared  # noqa: E402

try:  # the training-data subpackage and its pipeline may be absent
    import corpus_pipeline  # noqa: E402
    from footfall.llm import queries as llm_queries  # noqa: E402
except ImportError:
    corpus_pipeline = llm_queries = None

CITIES = ("Brand#1", "Brand#2", "Brand#3")
CATEGORY = "ECONOMY"
REGION_NAMES = {"ASIA": "亚洲", "AFRICA": "非洲", "NOWHERE": "无"}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the shops with the largest average amount per payment day."""
    return _top_shops(spark, "/root/testdata/sf0.001")


# Shops


def _top_shops_all_columns(spark, sf_dir):
    return plans.top_shops_by_daily_amount(bindings.shop_info(spark, sf_dir), bindings.user_pay(spark, sf_dir))


def _top_shops(spark, sf_dir):
    return _top_shops_all_columns(spark, sf_dir).select(
        "avgAmountPerDay", "shop_id", "countPay", "countDay", "city_name", "per_pay"
    )


def _welcome_city_all_columns(spark, sf_dir):
    return plans.welcome_top(bindings.shop_info(spark, sf_dir), CITIES[0])


def _welcome_city(spark, sf_dir):
    return _welcome_city_all_columns(spark, sf_dir).select("welcomeScore", "shop_id", "city_name")


def _welcome_per_city(spark, sf_dir):
    ranked = plans.welcome_top_per_city(bindings.shop_info(spark, sf_dir), CITIES)
    return ranked.select("city_name", "shop_id", "welcomeScore", "rk")


def _welcome_documented(spark, sf_dir):
    ranked = plans.welcome_documented(bindings.shop_info(spark, sf_dir), CITIES, CATEGORY)
    return ranked.select("city_name", "shop_id", "welcomeScore", "rk")


def _shop_base(spark, sf_dir):
    return plans.shop_base_top(bindings.shop_info(spark, sf_dir))


def _shop_activity(spark, sf_dir):
    return plans.shop_activity_top(bindings.user_pay(spark, sf_dir))


def _stored_maps(spark, sf_dir):
    """Activity maps of the payments before 1995 and of the later ones, stored one after the other, the later ones twice."""
    path, pay = shared_folder(spark, "activity-maps"), bindings.user_pay(spark, sf_dir)
    early = F.col("time_stamp") < F.lit("1995-01-01").cast("date")
    plans.store_activity(pay.where(early), path, "early")
    for _ in range(2):
        plans.store_activity(pay.where(~early), path, "late")
    return plans.activity_of(plans.stored_activity(spark, path))


def _shop_activity_merged(spark, sf_dir):
    return plans.shop_activity_top(None, activity=_stored_maps(spark, sf_dir))


def _top_shops_merged(spark, sf_dir):
    shops = bindings.shop_info(spark, sf_dir)
    ranked = plans.top_shops_by_daily_amount(shops, None, activity=_stored_maps(spark, sf_dir))
    return ranked.select("avgAmountPerDay", "shop_id", "countPay", "countDay", "city_name", "per_pay")


def _shop_activity_counted(spark, sf_dir):
    """The most active shops, beside the number of all shops with payments, from one pass over the payments."""
    activity, shops = operators.counted(plans.shop_activity(bindings.user_pay(spark, sf_dir)))
    return plans.shop_activity_top(None, activity=activity).withColumn("shops", F.lit(shops).cast("long"))


def _bucketed(spark, sf_dir, table, df):
    """``df`` as a table bucketed by shop; the folder and the name are new for each run."""
    path = shared_folder(spark, table)
    name = path.rpartition("/")[2].replace("-", "_")
    sources.save_bucketed(df, name, int(spark.conf.get("spark.sql.shuffle.partitions")), path=path)
    return sources.bucketed_parts(spark, name)


def _bucketed_top_shops(spark, sf_dir):
    pay = _bucketed(spark, sf_dir, "pay", bindings.user_pay(spark, sf_dir))
    return plans.top_shops_by_daily_amount(bindings.shop_info(spark, sf_dir), pay).select(
        "avgAmountPerDay", "shop_id", "countPay", "countDay", "city_name", "per_pay"
    )


def _bucketed_city_pay(spark, sf_dir):
    pay = _bucketed(spark, sf_dir, "pay", bindings.user_pay(spark, sf_dir))
    return plans.city_pay_top(pay, bindings.shop_info(spark, sf_dir))


# Cities and days


def _city_pay(spark, sf_dir):
    return plans.city_pay_top(bindings.user_pay(spark, sf_dir), bindings.shop_info(spark, sf_dir))


def _city_pay_from_warehouse(spark, sf_dir):
    sources.register_tables(
        user_pay=bindings.user_pay(spark, sf_dir), shop_info=bindings.shop_info(spark, sf_dir)
    )
    return plans.city_pay_top(
        sources.warehouse_table(spark, "user_pay"), sources.warehouse_table(spark, "shop_info")
    )


def _city_rank_labels(spark, sf_dir):
    return operators.rank_labels(_city_pay(spark, sf_dir))


def _day_pay_top(spark, sf_dir):
    return plans.day_pay_top(bindings.ev_pay(spark, sf_dir))


def _day_view_top(spark, sf_dir):
    return plans.day_view_top(bindings.ev_view(spark, sf_dir))


def _day_pay_view_last(spark, sf_dir):
    return plans.day_pay_view_last(bindings.ev_pay(spark, sf_dir), bindings.ev_view(spark, sf_dir))


def _day_pay_view_all(spark, sf_dir):
    return plans.day_pay_view_all(bindings.ev_pay(spark, sf_dir), bindings.ev_view(spark, sf_dir))


def _day_pay_view_series(spark, sf_dir):
    return operators.series(_day_pay_view_all(spark, sf_dir), "day", "countPay", "countView")


def _day_pay_all(spark, sf_dir):
    return plans.day_pay_all(bindings.ev_pay(spark, sf_dir))


def _day_view_all(spark, sf_dir):
    return plans.day_view_all(bindings.ev_view(spark, sf_dir))


def _province_totals(spark, sf_dir):
    return sources.province_totals(bindings.province_customers(spark, sf_dir))


def _province_totals_relabelled(spark, sf_dir):
    return operators.relabel(_province_totals(spark, sf_dir), REGION_NAMES)


def _province_relabel(spark, sf_dir):
    return operators.relabel(bindings.province_counts(spark, sf_dir), REGION_NAMES)


# Counters


def _records(spark, sf_dir):
    return streaming.pay_to_records(bindings.ev_pay(spark, sf_dir))


def _lookup(spark, sf_dir):
    return bindings.ev_shop(spark, sf_dir).select("shop_id", "city_name")


def _key_counters_stream(spark, sf_dir):
    root = shared_folder(spark, "key-counters")
    records = streaming.pay_to_records(bindings.ev_pay_stream(spark, sf_dir))
    query = streaming.start_counter_stream(
        records, _lookup(spark, sf_dir), root, trigger={"availableNow": True}
    )
    query.awaitTermination()
    return streaming.read_counters(spark, f"{root}/counters")


def _salted_counters(spark, sf_dir, stream, facts):
    """Counters of a stream whose lookup is joined by key, salted for the keys that ``facts`` show to be hot."""
    root = shared_folder(spark, "key-counters")
    query = streaming.start_counter_stream(
        streaming.pay_to_records(stream), _lookup(spark, sf_dir), root, trigger={"availableNow": True},
        broadcast_bytes=0, hot=operators.hot_keys(facts, "shop_id"),
    )
    query.awaitTermination()
    return streaming.read_counters(spark, f"{root}/counters")


def _key_counters_salted(spark, sf_dir):
    return _salted_counters(spark, sf_dir, bindings.ev_pay_stream(spark, sf_dir), bindings.ev_pay(spark, sf_dir))


def _key_counters_hot(spark, sf_dir):
    facts = bindings.hot_third(bindings.table(spark, sf_dir, "events"))
    return _salted_counters(spark, sf_dir, bindings.ev_pay_hot_stream(spark, sf_dir), facts)


def _records_joined_hot(spark, sf_dir):
    """Each purchase with its city, a third of them on one shop, by a lookup that is not broadcast."""
    facts = bindings.hot_third(bindings.table(spark, sf_dir, "events"))
    return operators.lookup_join(facts, _lookup(spark, sf_dir), "shop_id", broadcast_bytes=0)


def _half_stream(spark, folder, half, lookup, root, checkpoint):
    """Count one half of the purchases in a run of its own, into the counters that are there."""
    records = streaming.read_pay_stream(spark, {"format": "parquet", "path": f"{folder}/{half}"})
    path = f"{root}/counters"
    run = streaming.run_of(spark, f"{root}/{checkpoint}", path)
    sink = partial(streaming.upsert_counters, path=path, run=run)
    writer = streaming.key_counts(records, lookup).writeStream.outputMode("update").foreachBatch(sink)
    writer.option("checkpointLocation", f"{root}/{checkpoint}").trigger(availableNow=True).start().awaitTermination()


def _restarted_counters(spark, sf_dir):
    """The root of counters that two streams with separate checkpoints made of the halves of the purchases."""
    root, folder = shared_folder(spark, "restarts"), shared_folder(spark, "halves")
    records = _records(spark, sf_dir).withColumn("half", F.pmod(F.xxhash64("key", "value"), F.lit(2)))
    lookup = write_shared(_lookup(spark, sf_dir), "lookup")
    for half in (0, 1):
        streaming.write_records(
            records.where(F.col("half") == half).drop("half"), {"format": "parquet", "path": f"{folder}/{half}"}
        )
        _half_stream(spark, folder, half, lookup, root, f"checkpoint-{half}")
    return f"{root}/counters"


def _counters_after_restart(spark, sf_dir):
    return streaming.read_counters(spark, _restarted_counters(spark, sf_dir))


def _counters_compacted(spark, sf_dir):
    path = shared_folder(spark, "compacted")
    counts = write_shared(_key_counters_batch(spark, sf_dir), "counts")
    for batch_id in range(3):
        # Totals grow up to the last batch; a key's latest total counts.
        grown = counts.select("k", F.ceil(F.col("count") * (batch_id + 1) / 3).alias("count"))
        streaming.upsert_counters(grown, batch_id, path)
    streaming.compact_counters(spark, path)
    return streaming.read_counters(spark, path)


def _halves(spark, sf_dir, name):
    """A folder with the purchase records of even users in ``0`` and those of odd users in ``1``."""
    folder = shared_folder(spark, name)
    records = _records(spark, sf_dir)
    for half in (0, 1):
        _publish(records, half, f"{folder}/{half}")
    return folder


def _publish(records, half, path):
    chosen = records.where(F.col("key").cast("long") % 2 == half)
    streaming.write_records(chosen, {"format": "parquet", "path": path})


def _records_in(spark, path):
    return streaming.read_pay_stream(spark, {"format": "parquet", "path": path})


def _shop_activity_stream(spark, sf_dir):
    """Payments and payment days per shop, by a stream that is stopped and started again between the halves."""
    root, folder = shared_folder(spark, "activity"), shared_folder(spark, "activity-records")
    for half in (0, 1):
        _publish(_records(spark, sf_dir), half, folder)
        streaming.start_activity_stream(_records_in(spark, folder), root, {"availableNow": True}).awaitTermination()
    return streaming.read_activity(spark, f"{root}/activity")


def _counters_from_state(spark, sf_dir):
    root = shared_folder(spark, "key-counters")
    records = streaming.pay_to_records(bindings.ev_pay_stream(spark, sf_dir))
    streaming.start_counter_stream(records, _lookup(spark, sf_dir), root, trigger={"availableNow": True}).awaitTermination()
    return streaming.counters_from_state(spark, f"{root}/checkpoint")


def _counters_repartitioned(spark, sf_dir):
    """The first half counted; its state restored as a new table; the second half counted on with other partitions."""
    root, again = shared_folder(spark, "before"), shared_folder(spark, "after")
    folder, lookup = _halves(spark, sf_dir, "halves"), _lookup(spark, sf_dir)
    now = {"availableNow": True}
    streaming.start_counter_stream(_records_in(spark, f"{folder}/0"), lookup, root, trigger=now).awaitTermination()
    streaming.restore_counters(spark, f"{root}/checkpoint", f"{again}/counters")
    setting = "spark.sql.shuffle.partitions"
    partitions = spark.conf.get(setting)
    spark.conf.set(setting, str(int(partitions) + 3))
    try:
        streaming.start_counter_stream(_records_in(spark, f"{folder}/1"), lookup, again, trigger=now).awaitTermination()
    finally:
        spark.conf.set(setting, partitions)
    return streaming.read_counters(spark, f"{again}/counters")


def _counters_archived(spark, sf_dir):
    """Files arrive in two halves and are archived once read; the stream is started again after each."""
    root, folder = shared_folder(spark, "archived"), shared_folder(spark, "inbox")
    source = streaming.archived_files(folder, shared_folder(spark, "archive"), maxFilesPerTrigger=1)
    for half in (0, 1):
        _publish(_records(spark, sf_dir), half, folder)
        records = streaming.read_pay_stream(spark, source)
        query = streaming.start_counter_stream(records, _lookup(spark, sf_dir), root, trigger={"availableNow": True})
        query.awaitTermination()
    return streaming.read_counters(spark, f"{root}/counters")


def _counters_by_increments(spark, sf_dir):
    """Each micro-batch counted per shop before its lookup; the increments summed, past ones folded."""
    root, folder = shared_folder(spark, "increments"), _halves(spark, sf_dir, "halves")
    records = streaming.read_pay_stream(spark, {"format": "parquet", "path": f"{folder}/*", "maxFilesPerTrigger": 1})
    lookup = write_shared(_lookup(spark, sf_dir), "lookup")
    streaming.start_increment_stream(records, lambda: lookup, root, {"availableNow": True}).awaitTermination()
    streaming.fold_increments(spark, f"{root}/increments")
    return streaming.read_increments(spark, f"{root}/increments")


def _counters_replayed(spark, sf_dir):
    """Every micro-batch is delivered twice: as after a failure between its write and its commit."""
    root, folder = shared_folder(spark, "replayed"), _halves(spark, sf_dir, "halves")
    path = f"{root}/counters"

    def twice(batch_df, batch_id):
        streaming.upsert_counters(batch_df, batch_id, path)
        streaming.upsert_counters(batch_df, batch_id, path)

    source = {"format": "parquet", "path": f"{folder}/*", "maxFilesPerTrigger": 1}
    records = streaming.read_pay_stream(spark, source)
    lookup = _lookup(spark, sf_dir)
    streaming.start_counter_stream(records, lookup, root, twice, {"availableNow": True}).awaitTermination()
    return streaming.read_counters(spark, path)


def _counters_timed(spark, sf_dir):
    """Micro-batches at an interval, one file each, until all files are counted."""
    root, folder = shared_folder(spark, "timed"), _halves(spark, sf_dir, "halves")
    records = streaming.read_pay_stream(spark, {"format": "parquet", "path": f"{folder}/*", "maxFilesPerTrigger": 1})
    lookup = _lookup(spark, sf_dir)
    query = streaming.start_counter_stream(records, lookup, root, trigger={"processingTime": "100 milliseconds"})
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return streaming.read_counters(spark, f"{root}/counters")


def _counters_refreshed_lookup(spark, sf_dir):
    """The second half is counted after a restart with a lookup in which every city has moved."""
    root, folder, lookup = shared_folder(spark, "refreshed"), shared_folder(spark, "inbox"), _lookup(spark, sf_dir)
    moved = lookup.select("shop_id", F.concat("city_name", F.lit(" 2")).alias("city_name"))
    for half, cities in ((0, lookup), (1, moved)):
        _publish(_records(spark, sf_dir), half, folder)
        query = streaming.start_counter_stream(_records_in(spark, folder), cities, root, trigger={"availableNow": True})
        query.awaitTermination()
    return streaming.read_counters(spark, f"{root}/counters")


def _records_round_trip(spark, sf_dir):
    folder, root = shared_folder(spark, "records"), shared_folder(spark, "round-trip")
    streaming.write_records(_records(spark, sf_dir), {"format": "parquet", "path": folder})
    records = streaming.read_pay_stream(spark, {"format": "parquet", "path": folder})
    streaming.start_counter_stream(records, _lookup(spark, sf_dir), root, trigger={"availableNow": True}).awaitTermination()
    return streaming.read_counters(spark, f"{root}/counters")


def _province_names(spark, sf_dir):
    return operators.relabel(bindings.province_nations(spark, sf_dir))


def _key_counters_batch(spark, sf_dir):
    return streaming.key_counts(_records(spark, sf_dir), _lookup(spark, sf_dir))


def _stored_counters(spark, sf_dir):
    path = shared_folder(spark, "counters")
    streaming.upsert_counters(_key_counters_batch(spark, sf_dir), 0, path)
    return streaming.read_counters(spark, path)


def _shop_report(spark, sf_dir):
    shops = bindings.ev_shop(spark, sf_dir).select("shop_id", "ordinal")
    return streaming.shop_counter_report(shops, _stored_counters(spark, sf_dir))


def _city_report(spark, sf_dir):
    cities = bindings.ev_shop(spark, sf_dir).groupBy("city_name").agg(F.min("ordinal").alias("ordinal"))
    return streaming.city_counter_report(cities, _stored_counters(spark, sf_dir))


# Readers and records


def _shop_info_parsed(spark, sf_dir):
    shops = bindings.shop_info(spark, sf_dir)
    return sources.parse_shop_info(bindings.as_lines(shops, *shops.columns))


def _faults(spark, parse, lines, *names):
    """The faults of lines, counted while they are parsed and written, as one row."""
    seen = Observation()
    write_shared(parse(lines, seen), "parsed")
    return spark.createDataFrame([tuple(seen.get[name] for name in names)], ", ".join(f"{name} long" for name in names))


def _shop_info_faults(spark, sf_dir):
    lines = _ragged_lines(spark, sf_dir).withColumn("value", F.regexp_replace("value", "9", "x"))
    names = ("lines", "short_lines", "long_lines", "bad_per_pay", "bad_score")
    return _faults(spark, sources.parse_shop_info, lines, *names)


def _user_pay_faults(spark, sf_dir):
    pay = bindings.user_pay(spark, sf_dir)
    day = F.when(F.day("time_stamp") == 1, F.lit("")).otherwise(F.col("time_stamp").cast("string"))
    surplus = F.when(F.day("time_stamp") > 29, F.lit(",x")).otherwise(F.lit(""))
    lines = pay.select(F.concat(F.concat_ws(",", "user_id", "shop_id", day), surplus).alias("value"))
    return _faults(spark, sources.parse_user_pay, lines, "lines", "short_lines", "long_lines")


def _user_pay_parsed(spark, sf_dir):
    pay = bindings.user_pay(spark, sf_dir)
    return sources.parse_user_pay(bindings.as_lines(pay, *pay.columns))


def _shop_info_ragged(spark, sf_dir):
    return sources.parse_shop_info(_ragged_lines(spark, sf_dir))


def _ragged_lines(spark, sf_dir):
    part = bindings.table(spark, sf_dir, "part")
    trailing = F.concat_ws(",", "p_partkey", "p_brand", F.lit(""), F.lit(""), F.lit(""))
    interior = F.concat_ws(",", "p_partkey", F.lit(""), "p_name", "p_size", F.lit("4.5"))
    form = F.col("p_size") % 3
    line = F.when(form == 0, trailing).when(form == 1, interior).otherwise(",")
    return part.select(line.alias("value"))


def _tolerant_int(spark, sf_dir):
    part = bindings.table(spark, sf_dir, "part")
    return part.select(
        "p_partkey",
        tolerant_int(F.concat(F.lit("+"), F.col("p_size").cast("string"))).alias("signed"),
        tolerant_int(F.concat(F.lit(" "), F.col("p_size").cast("string"))).alias("padded"),
        tolerant_int((F.col("p_partkey") * 4_000_000).cast("string")).alias("large"),
        tolerant_int(F.col("p_brand")).alias("word"),
    )


def _pay_records(spark, sf_dir):
    return streaming.pay_to_records(bindings.user_pay(spark, sf_dir))


def _pay_records_twice(spark, sf_dir):
    return streaming.pay_to_records(bindings.ev_pay(spark, sf_dir), copies=2)


def _event_audit(spark, sf_dir):
    events = bindings.table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    raw = events.select(
        F.lit("user_pay").alias("topic"),
        F.col("event_id").alias("offset"),
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.concat_ws(",", F.get_json_object("props", "$.k"), F.col("ts").cast("string")).cast("binary").alias("value"),
        F.col("ts").cast("string").alias("timestamp"),
    )
    return streaming.event_audit(raw)


def _written_lines(spark, ordered, *columns):
    path = shared_folder(spark, "lines")
    bindings.as_lines(ordered, *columns).write.text(path)
    return sources.read_lines(spark, path)


def _shop_city_lines(spark, sf_dir):
    return _written_lines(spark, bindings.ev_shop(spark, sf_dir).orderBy("ordinal"), "shop_id", "city_name")


def _repeated_shop_lines(spark, sf_dir):
    suppliers = bindings.table(spark, sf_dir, "supplier").orderBy("s_suppkey")
    return _written_lines(spark, suppliers, "s_nationkey", "s_name")


def _shop_city_lookup(spark, sf_dir):
    return sources.shop_city_lookup(_shop_city_lines(spark, sf_dir))


def _last_line_lookup(spark, sf_dir):
    return sources.shop_city_lookup(_repeated_shop_lines(spark, sf_dir))


def _distinct_shops(spark, sf_dir):
    shops = sources.first_appearance(_repeated_shop_lines(spark, sf_dir), "shop_id")
    return operators.appearance_index(shops).select("idx", "shop_id")


def _distinct_cities(spark, sf_dir):
    cities = sources.first_appearance(_shop_city_lines(spark, sf_dir), "city_name")
    return operators.appearance_index(cities).select("idx", "city_name")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "top_shops_by_daily_amount": _top_shops,
        "top_shops_all_columns": _top_shops_all_columns,
        "welcome_top10_city": _welcome_city,
        "welcome_top10_city_all_columns": _welcome_city_all_columns,
        "welcome_top10_per_city": _welcome_per_city,
        "welcome_documented": _welcome_documented,
        "shop_base_top10": _shop_base,
        "shop_activity_top10": _shop_activity,
        "shop_activity_merged_top10": _shop_activity_merged,
        "shop_activity_counted": _shop_activity_counted,
        "shop_activity_stream": _shop_activity_stream,
        "top_shops_merged": _top_shops_merged,
        "bucketed_top_shops": _bucketed_top_shops,
        "bucketed_city_pay_top10": _bucketed_city_pay,
        "city_pay_top10": _city_pay,
        "warehouse_city_pay_top10": _city_pay_from_warehouse,
        "day_pay_top10": _day_pay_top,
        "day_view_top10": _day_view_top,
        "day_pay_view_last10": _day_pay_view_last,
        "day_pay_view_all": _day_pay_view_all,
        "day_pay_view_series": _day_pay_view_series,
        "day_pay_all": _day_pay_all,
        "day_view_all": _day_view_all,
        "city_rank_labels": _city_rank_labels,
        "province_totals": _province_totals,
        "province_totals_relabelled": _province_totals_relabelled,
        "province_relabel": _province_relabel,
        "key_counters_stream": _key_counters_stream,
        "key_counters_batch": _key_counters_batch,
        "key_counters_salted": _key_counters_salted,
        "key_counters_hot": _key_counters_hot,
        "records_joined_hot": _records_joined_hot,
        "counters_from_state": _counters_from_state,
        "counters_repartitioned": _counters_repartitioned,
        "counters_archived": _counters_archived,
        "counters_replayed": _counters_replayed,
        "counters_by_increments": _counters_by_increments,
        "counters_timed": _counters_timed,
        "counters_refreshed_lookup": _counters_refreshed_lookup,
        "counters_after_restart": _counters_after_restart,
        "counters_compacted": _counters_compacted,
        "records_round_trip": _records_round_trip,
        "province_names": _province_names,
        "shop_counter_report": _shop_report,
        "city_counter_report": _city_report,
        "shop_info_parsed": _shop_info_parsed,
        "shop_info_ragged": _shop_info_ragged,
        "shop_info_faults": _shop_info_faults,
        "user_pay_faults": _user_pay_faults,
        "user_pay_parsed": _user_pay_parsed,
        "tolerant_int": _tolerant_int,
        "pay_records": _pay_records,
        "pay_records_twice": _pay_records_twice,
        "event_audit": _event_audit,
        "shop_city_lookup": _shop_city_lookup,
        "last_line_lookup": _last_line_lookup,
        "distinct_shops": _distinct_shops,
        "distinct_cities": _distinct_cities,
        **_llm_queries(),
    }


def _llm_queries():
    return {**llm_queries.queries(), "pipeline": corpus_pipeline.run} if llm_queries else {}


def _llm_sql():
    if not llm_queries:
        return {}
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**llm_queries.oracle_sql(), **pipeline}


TABLES_SQL = """
with shop_info as (
  select cast(p_partkey as string) shop_id, p_brand city_name, p_name location_id,
    cast(floor(p_retailprice) as int) per_pay, cast(p_size % 6 as int) score, p_size comment_cnt,
    cast(p_size % 3 as int) shop_level, p_type cate_1_name, p_type cate_2_name, p_name cate_3_name
  from part
), user_pay as (
  select cast(o_custkey as string) user_id, cast(l_partkey as string) shop_id, cast(l_shipdate as string) time_stamp
  from lineitem join orders on l_orderkey = o_orderkey
), ev_pay as (
  select cast(user_id as string) user_id, json_extract_string(props,'$.k') shop_id, cast(ts as string) time_stamp
  from events where event_type = 'purchase'
), ev_view as (
  select cast(user_id as string) user_id, json_extract_string(props,'$.k') shop_id, cast(ts as string) time_stamp
  from events where event_type = 'view'
), ev_shop as (
  select s_suppkey ordinal, cast(s_suppkey as string) shop_id, n_name city_name
  from supplier join nation on s_nationkey = n_nationkey
), ev_pay_hot as (
  select cast(user_id as string) user_id, if(event_id % 3 = 0, '1', json_extract_string(props,'$.k')) shop_id,
    ts time_stamp
  from events where event_type = 'purchase'
), counters as (
  select concat('jiaoyi', shop_id) k, count(*) c from ev_pay group by concat('jiaoyi', shop_id)
  union all
  select concat('交易', coalesce(city_name, 'null')) k, count(*) c from ev_pay left join ev_shop using (shop_id)
  group by concat('交易', coalesce(city_name, 'null'))
)
"""

TOP_SHOPS_SQL = """
, days as (select distinct shop_id, substr(time_stamp, 1, 10) as day from user_pay)
, dated as (select shop_id, count(day) countDay from days group by shop_id)
, paid as (select shop_id, count(user_id) countPay from user_pay group by shop_id)
, ranked as (
  select if(countDay = 0, 0, countPay * per_pay / greatest(countDay, 1))::double avgAmountPerDay,
    paid.shop_id, countPay, countDay, shop_info.* exclude (shop_id)
  from paid join dated using (shop_id) join shop_info using (shop_id)
)
"""
TOP_SHOPS_ORDER = "from ranked order by avgAmountPerDay desc, shop_id limit 10"

WELCOME_SQL = "round(cast(0.7*score/5 + 0.3*per_pay as double), 6) welcomeScore"

CITY_RANK_SQL = """
select city_name, shop_id, welcomeScore, rk from (
  select city_name, shop_id, welcomeScore,
    cast(row_number() over (partition by city_name order by welcomeScore desc, shop_id) as int) rk
  from scored) b
where rk <= 10
"""

CITY_PAY_SQL = """
select s.city_name cityName, cast(sum(per_pay) as bigint) totalPay
from user_pay p join shop_info s on p.shop_id = s.shop_id
group by s.city_name order by totalPay desc, cityName limit 10
"""

DAY_PAY_SQL = "select substr(time_stamp,1,10) as day, count(*) countPay from ev_pay group by substr(time_stamp,1,10)"
DAY_VIEW_SQL = "select substr(time_stamp,1,10) as day, count(*) countView from ev_view group by substr(time_stamp,1,10)"
# All events of both kinds as days, counted by kind; days without a payment go.
DAYS_SQL = """
, stamps as (select time_stamp, true paid from ev_pay union all select time_stamp, false paid from ev_view)
, days as (
  select substr(time_stamp, 1, 10) as day, count(*) filter (paid) countPay, count(*) filter (not paid) countView
  from stamps group by all having count(*) filter (paid) > 0
)
"""


PROVINCES_SQL = """
select r_name province, count(*) price
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
group by r_name
"""


def oracle_sql() -> dict[str, str]:
    top_shops = f"{TOP_SHOPS_SQL} select avgAmountPerDay, shop_id, countPay, countDay, city_name, per_pay {TOP_SHOPS_ORDER}"
    activity = "select shop_id, count(user_id) countPay, count(distinct substr(time_stamp,1,10)) countDay from {} group by shop_id"
    counters = "select k, c as count from counters"
    bodies = {
        "shop_activity_merged_top10": f"{activity.format('user_pay')} order by countPay desc, shop_id limit 10",
        "shop_activity_counted":
            f"select *, count(*) over () shops from ({activity.format('user_pay')}) a order by countPay desc, shop_id limit 10",
        "shop_activity_stream": activity.format("ev_pay"),
        "top_shops_merged": top_shops,
        "bucketed_top_shops": top_shops,
        "bucketed_city_pay_top10": CITY_PAY_SQL,
        "key_counters_hot":
            "select concat('jiaoyi', shop_id) k, count(*) as count from ev_pay_hot group by shop_id union all "
            "select concat('交易', coalesce(city_name, 'null')), count(*) from ev_pay_hot left join ev_shop using (shop_id) "
            "group by city_name",
        "records_joined_hot":
            "select user_id, shop_id, time_stamp, city_name from ev_pay_hot left join ev_shop using (shop_id)",
        **dict.fromkeys(
            ["counters_from_state", "counters_repartitioned", "counters_archived", "counters_replayed", "counters_timed",
             "counters_by_increments"],
            counters,
        ),
        "counters_refreshed_lookup":
            "select concat('jiaoyi', shop_id) k, count(*) as count from ev_pay group by shop_id union all "
            "select concat('交易', coalesce(city_name || if(user_id::bigint % 2 = 1, ' 2', ''), 'null')), count(*) "
            "from ev_pay left join ev_shop using (shop_id) group by all",
        "shop_info_faults":
            "select count(*) as lines, count(*) short_lines, 0::bigint long_lines, "
            "count(*) filter (p_size % 3 = 1 and contains(p_size::varchar, '9')) bad_per_pay, "
            "count(*) filter (p_size % 3 = 1) bad_score from part",
        "user_pay_faults":
            "select count(*) as lines, count(*) filter (day(time_stamp::date) = 1) short_lines, "
            "count(*) filter (day(time_stamp::date) > 29) long_lines from user_pay",
        "top_shops_by_daily_amount":
            f"{TOP_SHOPS_SQL} select avgAmountPerDay, shop_id, countPay, countDay, city_name, per_pay {TOP_SHOPS_ORDER}",
        "top_shops_all_columns": f"{TOP_SHOPS_SQL} select * {TOP_SHOPS_ORDER}",
        "welcome_top10_city":
            f"select {WELCOME_SQL}, shop_id, city_name from shop_info where city_name = 'Brand#1' "
            "order by welcomeScore desc, shop_id limit 10",
        "welcome_top10_city_all_columns":
            f"select {WELCOME_SQL}, * from shop_info where city_name = 'Brand#1' "
            "order by welcomeScore desc, shop_id limit 10",
        "welcome_top10_per_city":
            f", scored as (select city_name, shop_id, {WELCOME_SQL} from shop_info "
            f"where city_name in ('Brand#1','Brand#2','Brand#3')) {CITY_RANK_SQL}",
        "welcome_documented":
            ", scored as (select city_name, shop_id, "
            "round(cast(0.7 as double)*score/5 + cast(0.3 as double)*per_pay/mx, 6) welcomeScore "
            "from (select *, max(per_pay) over () mx from shop_info "
            "where city_name in ('Brand#1','Brand#2','Brand#3') "
            f"and 'ECONOMY' in (cate_1_name, cate_2_name, cate_3_name)) f) {CITY_RANK_SQL}",
        "shop_base_top10": "select * from shop_info order by shop_id limit 10",
        "shop_activity_top10":
            "select shop_id, count(user_id) countPay, count(distinct substr(time_stamp,1,10)) countDay "
            "from user_pay group by shop_id order by countPay desc, shop_id limit 10",
        "city_pay_top10": CITY_PAY_SQL,
        "warehouse_city_pay_top10": CITY_PAY_SQL,
        "day_pay_top10": f"{DAY_PAY_SQL} order by countPay desc, day limit 10",
        "day_view_top10": f"{DAY_VIEW_SQL} order by countView desc, day limit 10",
        "day_pay_view_last10":
            f"{DAYS_SQL} select * from days order by day desc limit 10",
        "day_pay_view_all": f"{DAYS_SQL} select * from days",
        "day_pay_view_series":
            f"{DAYS_SQL} select day as label, countPay as value, countView as value2 from days",
        "day_pay_all": DAY_PAY_SQL,
        "day_view_all": DAY_VIEW_SQL,
        "city_rank_labels":
            "select concat('top', cast(row_number() over (order by totalPay desc, cityName) as string), ':', cityName) "
            f"label, totalPay price from ({CITY_PAY_SQL}) t",
        "province_totals": PROVINCES_SQL,
        "province_totals_relabelled":
            f"select v province, price from ({PROVINCES_SQL}) t "
            "join (values ('ASIA','亚洲'), ('AFRICA','非洲'), ('NOWHERE','无')) as m(r, v) on t.province = m.r",
        "province_relabel":
            "select v province, price from (select r_name, cast(count(*) as bigint) price from region "
            "join nation on r_regionkey = n_regionkey group by r_name) t "
            "join (values ('ASIA','亚洲'), ('AFRICA','非洲'), ('NOWHERE','无')) as m(r, v) on t.r_name = m.r",
        "key_counters_stream": "select k, c as count from counters",
        "key_counters_batch": "select k, c as count from counters",
        "key_counters_salted": "select k, c as count from counters",
        "counters_after_restart": "select k, c as count from counters",
        "counters_compacted": "select k, c as count from counters",
        "records_round_trip": "select k, c as count from counters",
        "province_names":
            "select name province, count(*) price from customer join (values (0,'北京'), (1,'上海'), (2,'天津'), "
            "(3,'重庆')) as names(n, name) on c_nationkey % 5 = n group by name",
        "shop_counter_report":
            "select cast(row_number() over (order by ordinal) as int) idx, shop_id, c as count "
            "from ev_shop join counters on k = concat('jiaoyi', shop_id)",
        "city_counter_report":
            "select cast(row_number() over (order by ordinal) as int) idx, city_name, c as count from "
            "(select city_name, min(ordinal) ordinal from ev_shop group by city_name) e "
            "join counters on k = concat('交易', city_name)",
        "shop_info_parsed": "select * from shop_info",
        "shop_info_ragged":
            "select case when p_size % 3 < 2 then cast(p_partkey as string) end shop_id, "
            "case p_size % 3 when 0 then p_brand when 1 then '' end city_name, "
            "case when p_size % 3 = 1 then p_name end location_id, case when p_size % 3 = 1 then p_size end per_pay, "
            "cast(null as int) score, cast(null as int) comment_cnt, cast(null as int) shop_level, "
            "cast(null as string) cate_1_name, cast(null as string) cate_2_name, cast(null as string) cate_3_name "
            "from part",
        "user_pay_parsed": "select * from user_pay",
        "tolerant_int":
            "select p_partkey, p_size signed, cast(null as int) padded, try_cast(p_partkey * 4000000 as int) large, "
            "cast(null as int) word from part",
        "pay_records": "select user_id as key, concat(shop_id, ',', time_stamp) as value from user_pay",
        "pay_records_twice":
            "select user_id as key, concat(shop_id, ',', time_stamp) as value from ev_pay, (values (1), (2)) as copies(n)",
        "event_audit":
            "select 'user_pay' topic, event_id as offset, cast(user_id as string) as key, "
            "concat(json_extract_string(props,'$.k'), ',', cast(ts as string)) as value, cast(ts as string) as timestamp "
            "from events where event_type = 'purchase'",
        "shop_city_lookup": "select shop_id, city_name from ev_shop",
        "last_line_lookup":
            "select cast(s_nationkey as string) shop_id, arg_max(s_name, s_suppkey) city_name from supplier "
            "group by s_nationkey",
        "distinct_shops":
            "select cast(row_number() over (order by first) as int) idx, shop_id from "
            "(select cast(s_nationkey as string) shop_id, min(s_suppkey) first from supplier group by s_nationkey) s",
        "distinct_cities":
            "select cast(row_number() over (order by first) as int) idx, city_name from "
            "(select city_name, min(ordinal) first from ev_shop group by city_name) c",
    }
    return {**{name: TABLES_SQL + body for name, body in bodies.items()}, **_llm_sql()}
