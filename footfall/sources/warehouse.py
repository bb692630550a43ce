"""Tables read by name from the session catalog."""

from pyspark.sql import functions as F

from ..operators import hot_keys

TABLES = ("shop_info", "user_pay", "user_view")


def warehouse_table(spark, name, database=None):
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}; expected one of {TABLES}")
    return spark.table(f"{database}.{name}" if database else name)


def register_tables(**tables):
    """Register DataFrames under the table names, for SQL and for ``warehouse_table``."""
    for name, df in tables.items():
        if name not in TABLES:
            raise ValueError(f"unknown table {name!r}; expected one of {TABLES}")
        df.createOrReplaceTempView(name)


def save_bucketed(df, table, buckets, key="shop_id", hot=None, path=None):
    """Save ``df`` as ``table``, in ``buckets`` files by ``key``, and its hot keys as the plain table ``<table>_hot``.

    An aggregate by ``key`` on the bucketed table needs no shuffle, as a bucket is read by one task. That is also why
    hot keys lie apart, by default those of ``hot_keys`` with more than a fifth of a bucket: a bucket with a third of all
    rows would be one task's work. Rows without a key go with the hot ones. Existing tables are replaced. ``path`` is the folder
    of the tables, by default the warehouse.
    """
    if hot is None:
        hot = hot_keys(df, key, 0.2 / buckets)
    apart = F.col(key).isNull() | F.col(key).isin(hot) if hot else F.col(key).isNull()
    for name, rows in ((table, df.where(~apart).repartition(buckets, key)), (f"{table}_hot", df.where(apart))):
        writer = rows.write.mode("overwrite").format("parquet")
        if name == table:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        if path:
            writer = writer.option("path", f"{path}/{name}")
        writer.saveAsTable(name)


def bucketed_parts(spark, table):
    """The two tables of ``save_bucketed``, as a list: no key is in both, so results by key are a union."""
    return [spark.table(table), spark.table(f"{table}_hot")]


def province_totals(df, province="province", price="price"):
    """Any two columns as the ``(province, price)`` pairs that ``relabel`` takes."""
    return df.select(df[province].alias("province"), df[price].alias("price"))
