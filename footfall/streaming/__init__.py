from .activity import read_activity, start_activity_stream, write_activity
from .counters import hot_shops, key_counts, newly_hot, start_counter_stream
from .deltas import fold_increments, read_increments, start_increment_stream, write_increments
from .records import (
    archived_files,
    event_audit,
    kafka_source,
    pay_to_records,
    read_pay_stream,
    read_raw_stream,
    record_view,
    write_records,
)
from .report import city_counter_report, shop_counter_report
from .state import counters_from_state, read_offsets, restore_counters, state_partitions
from .store import compact_counters, read_counters, run_of, set_counters, upsert_counters

__all__ = [
    "archived_files",
    "city_counter_report",
    "compact_counters",
    "counters_from_state",
    "event_audit",
    "fold_increments",
    "hot_shops",
    "kafka_source",
    "key_counts",
    "newly_hot",
    "pay_to_records",
    "read_activity",
    "read_counters",
    "read_increments",
    "read_offsets",
    "read_pay_stream",
    "read_raw_stream",
    "record_view",
    "restore_counters",
    "set_counters",
    "shop_counter_report",
    "start_activity_stream",
    "start_counter_stream",
    "start_increment_stream",
    "state_partitions",
    "run_of",
    "upsert_counters",
    "write_activity",
    "write_increments",
    "write_records",
]
