"""Shards by jump consistent hashing, in DataFrame expressions."""

from pyspark.sql import functions as F

from footfall.llm.common import numbered
from footfall.session import write_shared

ROW_BYTES = 16
# A key makes about ln(shards) jumps; more than this many has a probability below 1e-100 for any number of shards.
JUMPS = 200


def jump(key, shards):
    """The shard, from 0, of a text key.

    From bucket b a key jumps to floor((b + 1) / u), with u in (0, 1] drawn from a hash of the key and b, as long as
    that stays below ``shards``. The chance to pass bucket k is then (b + 1) / k, which spreads keys evenly; draws do
    not depend on ``shards``, so with one more shard a key stays or moves into the new one.
    """
    def target(bucket):
        drawn = F.conv(F.substring(F.md5(F.concat_ws(":", key, bucket.cast("string"))), 1, 13), 16, 10).cast("double")
        return F.floor(F.least((bucket + 1) * F.lit(2.0 ** 52) / (drawn + 1), F.lit(4e18)))

    def step(state, _):
        # ``done`` ends the jumps: hashing stops there.
        following = F.when(state["done"], state["bucket"]).otherwise(target(state["bucket"]))
        done = state["done"] | (following >= shards)
        return F.struct(F.when(done, state["bucket"]).otherwise(following).alias("bucket"), done.alias("done"))

    start = F.struct(F.lit(0).cast("long").alias("bucket"), F.lit(shards <= 1).alias("done"))
    steps = F.sequence(F.lit(1), F.lit(max(1, min(shards, JUMPS))))
    return F.aggregate(steps, start, step, lambda state: state["bucket"].cast("int"))


def assign(docs, shards=40):
    """``docs`` (doc_id, text) in shards: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``key``: doc_id and the number of shards decide. ``grown_shard`` is the shard with one shard more. Null
    texts have no bytes; null doc_ids are one key; rows of one key share a shard and have slots of their own. Slots of
    a shard are gapless from 0 and numbered over salted buckets, so that no task holds a shard.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
        jump(key, shards).alias("shard"),
        jump(key, shards + 1).alias("grown_shard"),
    )
    stored = write_shared(rows, "shards")
    mixed = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_crc32").cast("string")))
    salt = F.conv(F.substring(mixed, 1, 2), 16, 10)  # one of 256
    slots = numbered(stored, ["shard"], ["doc_id", "text_crc32", "size"], salt)
    return slots.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write(docs, folder, shards=40):
    """Write all columns of ``docs`` as Parquet, one folder for each shard."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    docs.withColumn("shard", jump(key, shards)).write.partitionBy("shard").parquet(folder)


def oracle_sql(shards=40):
    """``assign`` in DuckDB's SQL."""
    def jumped(n):
        drawn = "('0x' || substr(md5(key || ':' || cast(b as varchar)), 1, 13))::bigint::double"
        target = f"least((b + 1) * 4503599627370496.0 / ({drawn} + 1), 4e18)"
        step = f"case when {target} < {n} then cast(floor({target}) as bigint) else b end"
        return f"cast(list_reduce(range({n}), lambda b, step: {step}, 0::bigint) as int)"

    return f"""
with crc_table as (
  select list(list_reduce(range(8), lambda c, step: case when c % 2 = 1 then xor(3988292384, c >> 1) else c >> 1 end, n)
    order by n) as t
  from range(256) r(n)
), texts as (
  select doc_id, coalesce(text, '') as text, coalesce(cast(doc_id as varchar), '') as key from documents
), sized as (
  select doc_id, key, octet_length(encode(text)) + {ROW_BYTES} as size, xor(4294967295, list_reduce(
      list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::bigint),
      lambda c, byte: xor(t[1 + (xor(c, byte) & 255)], c >> 8), 4294967295::bigint)) as text_crc32
  from texts, crc_table
), placed as (
  select *, {jumped(shards)} as shard, {jumped(shards + 1)} as grown_shard,
    ('0x' || substr(md5(concat_ws(':', key, cast(text_crc32 as varchar))), 1, 2))::int as salt
  from sized
)
select doc_id, size, text_crc32, 'key' as law, shard, grown_shard,
  row_number() over (partition by shard order by salt, doc_id nulls first, text_crc32, size) - 1 as slot
from placed
"""
