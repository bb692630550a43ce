"""The driver's test tables in the roles of the shop, payment and view tables."""

from pyspark.sql import functions as F


_schemas = {}


def table(spark, sf_dir, name):
    """One of the test tables; its schema is looked up once, as every look-up is a Spark job."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def shop_info(spark, sf_dir):
    """Parts as shops; the brand is the city."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("shop_id"),
        F.col("p_brand").alias("city_name"),
        F.col("p_name").alias("location_id"),
        F.floor("p_retailprice").cast("int").alias("per_pay"),
        (F.col("p_size") % 6).cast("int").alias("score"),
        F.col("p_size").alias("comment_cnt"),
        (F.col("p_size") % 3).cast("int").alias("shop_level"),
        F.col("p_type").alias("cate_1_name"),
        F.col("p_type").alias("cate_2_name"),
        F.col("p_name").alias("cate_3_name"),
    )


def user_pay(spark, sf_dir):
    """Line items as payments, by the customer of the order. The time stamp keeps its type."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("shop_id"),
        F.col("l_shipdate").alias("time_stamp"),
    )


def events_of(events, event_type):
    """Events of one type as payments or views; a batch or a stream."""
    return events.where(F.col("event_type") == event_type).select(
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").alias("shop_id"),
        F.col("ts").alias("time_stamp"),
    )


def ev_pay(spark, sf_dir):
    return events_of(table(spark, sf_dir, "events"), "purchase")


def ev_view(spark, sf_dir):
    return events_of(table(spark, sf_dir, "events"), "view")


def _event_stream(spark, sf_dir, files_per_batch):
    schema = table(spark, sf_dir, "events").schema
    # A pattern, as a streaming source takes a plain path for a folder and the table may be one file.
    path = f"{sf_dir}/[e]vents.parquet"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def ev_pay_stream(spark, sf_dir, files_per_batch=1000):
    return events_of(_event_stream(spark, sf_dir, files_per_batch), "purchase")


def ev_pay_hot_stream(spark, sf_dir):
    """Purchases as a stream, every third event of them on shop 1."""
    return hot_third(_event_stream(spark, sf_dir, 1000))


def hot_third(events):
    shop = F.when(F.col("event_id") % 3 == 0, F.lit("1")).otherwise(F.get_json_object("props", "$.k"))
    return events.where(F.col("event_type") == "purchase").select(
        F.col("user_id").cast("string").alias("user_id"), shop.alias("shop_id"), F.col("ts").alias("time_stamp")
    )


def ev_shop(spark, sf_dir):
    """Suppliers as the shops of the stream, in supplier order; the nation is the city."""
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation")
    return suppliers.join(nations, suppliers["s_nationkey"] == nations["n_nationkey"]).select(
        F.col("s_suppkey").alias("ordinal"),
        F.col("s_suppkey").cast("string").alias("shop_id"),
        F.col("n_name").alias("city_name"),
    )


def province_counts(spark, sf_dir):
    """Regions as provinces; the number of nations is the price."""
    regions = table(spark, sf_dir, "region")
    nations = table(spark, sf_dir, "nation")
    return (
        regions.join(nations, regions["r_regionkey"] == nations["n_regionkey"])
        .groupBy(F.col("r_name").alias("province"))
        .agg(F.count("*").alias("price"))
    )


def province_customers(spark, sf_dir):
    """Regions as provinces; the number of customers is the price. Customers are counted per nation first."""
    per_nation = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("customers"))
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return (
        per_nation.join(nations, per_nation["c_nationkey"] == nations["n_nationkey"])
        .join(regions, nations["n_regionkey"] == regions["r_regionkey"])
        .groupBy(F.col("r_name").alias("province"))
        .agg(F.sum("customers").alias("price"))
    )


def province_nations(spark, sf_dir):
    """Customers as sales of four named provinces and an unnamed one, by their nation; their number is the price."""
    names = F.array(*map(F.lit, ("BeiJing", "ShangHai", "TianJin", "ChongQing", "Nowhere")))
    province = names[F.col("c_nationkey") % 5]
    return table(spark, sf_dir, "customer").groupBy(province.alias("province")).agg(F.count("*").alias("price"))


def as_lines(df, *columns):
    """Rows as comma-separated lines, the form of the reader's input."""
    return df.select(F.concat_ws(",", *columns).alias("value"))
