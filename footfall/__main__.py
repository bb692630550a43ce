"""Jobs for spark-submit or ``python -m footfall``; ``DATA`` is a folder with shop_info.txt and user_pay.txt."""

import argparse
import json
import sys

from pyspark.sql import Observation

from . import operators, plans, sources, streaming
from .fixed import WELCOME_CATEGORY, WELCOME_CITIES
from .session import build_session, write_shared


def _shops(spark, data):
    return sources.read_shop_info(spark, f"{data}/shop_info.txt")


def _payments(spark, data):
    return sources.read_user_pay(spark, f"{data}/user_pay.txt")


def _shop_lines(spark, data):
    return sources.read_lines(spark, f"{data}/shop_info.txt")


def batch(spark, args):
    """Shop rankings from the text files, or with the payments that are stored already."""
    shops, payments = _shops(spark, args.data).persist(), None
    if args.stored:
        activity = write_shared(plans.activity_of(plans.stored_activity(spark, args.stored)), "activity")
    else:
        faults = Observation()
        payments = sources.read_user_pay(spark, f"{args.data}/user_pay.txt", faults)
        activity = write_shared(plans.shop_activity(payments), "activity")  # one pass over the payments for both
        print("payment lines:", ", ".join(f"{name} {n}" for name, n in faults.get.items()))
    plans.shop_base_top(shops).show(truncate=False)
    plans.shop_activity_top(payments, activity=activity).show(truncate=False)
    plans.top_shops_by_daily_amount(shops, payments, activity=activity).show(truncate=False)
    by_city = plans.welcome_top_per_city(shops, args.cities)
    by_city.orderBy("city_name", "rk").show(10 * len(args.cities), truncate=False)
    documented = plans.welcome_documented(shops, args.cities, args.category)
    documented.orderBy("city_name", "rk").show(10 * len(args.cities), truncate=False)
    shops.unpersist()


def store(spark, args):
    """Add the payments of the text file to the stored activity, as the slice of that name."""
    faults = Observation()
    payments = sources.read_user_pay(spark, f"{args.data}/user_pay.txt", faults)
    plans.store_activity(payments, args.stored, args.name)
    print("payment lines:", ", ".join(f"{name} {n}" for name, n in faults.get.items()))


def dashboard(spark, args):
    """City and day series from the warehouse tables."""
    pay, view, shops = (
        sources.warehouse_table(spark, name, args.database) for name in ("user_pay", "user_view", "shop_info")
    )
    cities = plans.city_pay_top(pay, shops).persist()
    cities.show(truncate=False)
    operators.rank_labels(cities).show(truncate=False)
    cities.unpersist()
    plans.day_pay_top(pay).show(truncate=False)
    plans.day_view_top(view).show(truncate=False)
    plans.day_pay_view_last(pay, view).show(truncate=False)
    if spark.catalog.tableExists("province" if not args.database else f"{args.database}.province"):
        totals = sources.province_totals(sources.warehouse_table(spark, "province", args.database))
        rows, count = operators.counted(operators.relabel(totals))
        rows.show(count, truncate=False)


def publish(spark, args):
    """Send the payments to a topic."""
    records = streaming.pay_to_records(_payments(spark, args.data), args.copies)
    streaming.write_records(records, {"kafka.bootstrap.servers": args.servers, "topic": args.topic})


def count(spark, args):
    """Keep the running counters of a topic until stopped."""
    given = {"minPartitions": args.min_partitions, "maxOffsetsPerTrigger": args.max_offsets, "startingOffsets": args.start}
    options = {name: value for name, value in given.items() if value}
    records = streaming.read_pay_stream(spark, streaming.kafka_source(args.servers, args.topic, **options))
    lookup = lambda: sources.shop_city_lookup(_shop_lines(spark, args.data))
    if args.increments:
        streaming.start_increment_stream(records, lookup, args.root).awaitTermination()
    else:
        streaming.start_counter_stream(records, lookup(), args.root).awaitTermination()


def _counters(spark, args):
    if args.increments:
        return streaming.read_increments(spark, f"{args.root}/increments")
    return streaming.read_counters(spark, f"{args.root}/counters")


def report(spark, args):
    """Write the counters of all shops and cities of the shop file, or show all of them."""
    lines = _shop_lines(spark, args.data)
    counters = _counters(spark, args)
    shops = streaming.shop_counter_report(sources.first_appearance(lines, "shop_id"), counters)
    cities = streaming.city_counter_report(sources.first_appearance(lines, "city_name"), counters)
    for name, found in (("shops", shops), ("cities", cities)):
        if args.out:
            found.write.csv(f"{args.out}/{name}", header=True)
        elif args.preview:
            found.show(args.preview, truncate=False)
        else:
            for row in found.toLocalIterator():
                print(*row, sep="\t")


def compact(spark, args):
    """Fold the counter folders of past micro-batches into one."""
    if args.increments:
        streaming.fold_increments(spark, f"{args.root}/increments")
    else:
        streaming.compact_counters(spark, f"{args.root}/counters")


def restore(spark, args):
    """Write the counters of a checkpoint's state under a new root, and print the offsets to go on from."""
    streaming.restore_counters(spark, args.checkpoint, f"{args.root}/counters")
    for offsets in streaming.read_offsets(spark, args.checkpoint):
        print(json.dumps(offsets))


def _parser():
    parser = argparse.ArgumentParser(prog="footfall")
    jobs = parser.add_subparsers(dest="job", required=True)

    def add(job, *flags):
        sub = jobs.add_parser(job.__name__, help=job.__doc__)
        sub.set_defaults(run=job)
        for flag in flags:
            sub.add_argument(flag, required=True)
        return sub

    batch_job = add(batch, "--data")
    batch_job.add_argument("--cities", nargs="+", default=list(WELCOME_CITIES))
    batch_job.add_argument("--category", default=WELCOME_CATEGORY)
    batch_job.add_argument("--stored")
    add(store, "--data", "--stored", "--name")
    add(dashboard).add_argument("--database")
    add(publish, "--data", "--servers", "--topic").add_argument("--copies", type=int, default=1)
    count_job = add(count, "--data", "--servers", "--topic", "--root")
    for flag in ("--min-partitions", "--max-offsets", "--start"):
        count_job.add_argument(flag)
    count_job.add_argument("--increments", action="store_true")
    report_job = add(report, "--data", "--root")
    report_job.add_argument("--out")
    report_job.add_argument("--preview", type=int)
    report_job.add_argument("--increments", action="store_true")
    add(compact, "--root").add_argument("--increments", action="store_true")
    add(restore, "--checkpoint", "--root")
    return parser


def main(argv=None, spark=None):
    args = _parser().parse_args(argv)
    args.run(spark or build_session(f"footfall-{args.job}"), args)


if __name__ == "__main__":
    sys.exit(main())
