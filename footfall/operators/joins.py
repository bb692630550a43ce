"""Lookup joins."""

from pyspark.sql import functions as F

from ..fixed import PROVINCE_NAMES

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_BYTES = 64  # what a row costs in a hash table besides its text
TRACKED = 4096  # keys that a summary follows: it misses no key with more than about 1/3000 of the rows
MOST_HOT = 256


def _table_bytes(df):
    """What a hash table of all rows takes, about: one distributed aggregate, one row back."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    size = df.agg(F.sum(width.cast("long")).alias("bytes"), F.count("*").alias("rows")).first()
    return (size["bytes"] or 0) + ROW_BYTES * size["rows"]


def key_summary(key):
    """Aggregate column: the most frequent values of ``key`` as an array of (item, count), from a frequent-items sketch.

    The sketch is of fixed size, is made per task and merges, so it can also be observed while a batch or a
    micro-batch runs. Counts are lower bounds; null is a value like others.
    """
    return F.expr(f"approx_top_k(`{key}`, {MOST_HOT}, {TRACKED})")


def hot_keys(facts, key, share=None):
    """Keys with more than ``share`` of all facts, at most ``MOST_HOT``, in one pass that shuffles sketches only.

    ``share`` is a fifth of a shuffle partition's even part by default. The keys steer how a join is dealt out and
    never what it returns, so that counts are approximate does not matter.
    """
    share = share or 0.2 / int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = facts.agg(key_summary(key).alias("top"), F.count(F.lit(1)).alias("n")).first()
    return hot_of(found["top"], found["n"], share)


def hot_of(top, n, share):
    """The keys of a ``key_summary`` over ``n`` rows that hold more than ``share`` of them."""
    return [one["item"] for one in top or () if one["item"] is not None and one["count"] > share * n]


def copies_of(lookup, key, hot, salts):
    """The lookup with a column ``_salt``: rows of hot keys once per salt, all others once with salt 0."""
    last = F.when(F.col(key).isin(hot), F.lit(salts - 1)).otherwise(F.lit(0)) if hot else F.lit(0)
    return lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))


def lookup_join(facts, lookup, key, broadcast_bytes=BROADCAST_BYTES, salts=None, by=None, hot=None):
    """Left join of raw, unaggregated facts with a lookup that holds one row per key.

    The lookup is measured first. Up to ``broadcast_bytes`` it is broadcast and the facts do not move. A larger one is
    joined on (key, salt): facts of a hot key are dealt over ``salts`` tasks, by default as many as the shuffle has
    partitions, and only the lookup rows of hot keys are copied as often. Facts with a null key, which match nothing,
    are dealt too. All other facts and rows have salt 0.

    ``hot`` lists the hot keys. A batch finds them itself (``hot_keys``); for a stream they come from the counters of
    earlier batches or from a summary of other facts, and none are salted without. The salt is a hash of the record, of column
    ``by`` or else of all columns, so a task that runs again deals its rows as before; equal records share a salt.
    """
    if _table_bytes(lookup) <= broadcast_bytes:
        return facts.join(F.broadcast(lookup), key, "left")
    if hot is None:
        hot = [] if facts.isStreaming else hot_keys(facts, key)
    salts = salts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = copies_of(lookup, key, hot, salts)
    spread = F.col(key).isNull() | F.col(key).isin(hot) if hot else F.col(key).isNull()
    dealt = F.pmod(F.xxhash64(*([by] if by else facts.columns)), F.lit(salts)).cast("int")
    return facts.withColumn("_salt", F.when(spread, dealt).otherwise(F.lit(0))).join(copies.hint("shuffle_hash"), [key, "_salt"], "left").drop("_salt")


def relabel(df, mapping=PROVINCE_NAMES, key="province"):
    """Replace ``key`` by its mapped value, by default the province's name; rows whose key is not mapped are dropped.

    A dict is a literal of the program and is broadcast. A mapping given as a DataFrame ``(key, label)`` is
    joined the way the planner finds best for its size.
    """
    if isinstance(mapping, dict):
        pairs = df.sparkSession.createDataFrame(list(mapping.items()), f"`{key}` string, _label string")
        pairs = F.broadcast(pairs)
    else:
        old, new = mapping.columns
        pairs = mapping.select(F.col(old).alias(key), F.col(new).alias("_label"))
    columns = [F.col("_label").alias(key) if c == key else F.col(c) for c in df.columns]
    return df.join(pairs, key).select(*columns)
