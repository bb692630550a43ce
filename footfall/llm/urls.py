"""URL filters: host rules, and association rules mined by FP-growth from the URLs of labelled pages."""

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from footfall.session import write_shared

# (host, path, verdict)
HOST_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
MIN_SUPPORT, MIN_COUNT, MIN_CONFIDENCE, MIN_LIFT = 0.001, 20, 0.8, 1.5
BLOCK = "label:block"


def parts(url):
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(text, pattern, 2)


def items(url):
    """The distinct items of a URL: scheme, host with its parents, path words, query names, extension and fragment."""
    host, path = parts(url)
    labels = F.split(host, r"\.")
    hosts = F.transform(labels, lambda _, i: F.concat(F.lit("host:"), F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")))
    tagged = lambda tag, values: F.transform(values, lambda value: F.concat(F.lit(tag), value))
    text = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    found = F.concat(
        F.array(F.concat(F.lit("scheme:"), F.lower(F.regexp_extract(text, r"(?s)^(.*?)://", 1)))),
        hosts,
        tagged("path:", F.split(F.lower(path), r"[^\p{L}\p{N}]+")),
        tagged("query:", F.transform(F.split(query, "&"), lambda pair: F.split(pair, "=")[0])),
        F.array(F.concat(F.lit("end:"), F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))),
        F.when(F.instr(text, "#") > 0, F.array(F.lit("fragment:yes"))).otherwise(F.array().cast("array<string>")),
    )
    return F.sort_array(F.array_distinct(F.filter(found, lambda item: ~item.endswith(":") & ~item.rlike("^path:[0-9]+$"))))


def host_rule(host, path, rules=HOST_RULES):
    """The longest rule that fits, as a struct (rule, verdict); null if none does."""
    table = F.array(*[
        F.struct(F.lit(len(h) + len(p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"),
                 F.lit(h).alias("host"), F.lit(p).alias("path"))
        for h, p, v in rules
    ])
    fits = F.filter(table, lambda rule: (
        ((host == rule["host"]) | host.endswith(F.concat(F.lit("."), rule["host"]))) & path.startswith(rule["path"])
    ))
    return F.when(F.size(fits) > 0, F.array_max(fits))


def _condensed(pages, labels, min_support, min_count, min_confidence, min_lift):
    """Groups of items (token, unit, n) and the rules over units (units, unit, confidence, support, lift), or None.

    Items that are on the same labelled pages are one unit, as each of them, and any number together, has the same
    counts: a set of n such items is one itemset instead of 2**n. Only items on enough bad pages can be in a rule. No
    page loses an item otherwise. ``unit`` of a rule is its rarest one.
    """
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    marked = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    sets = pages.select("page_id", items(F.col("url")).alias("items")).join(marked, "page_id").select("items", "bad")
    sets = write_shared(sets.withColumn("row", F.monotonically_increasing_id()), "url-items")
    total, blocked = sets.agg(F.count("*"), F.sum(F.col("bad").cast("long"))).first()
    if not blocked:
        return None
    least = max(min_support, min_count / total)
    # Sums of two hashes tell sets of rows apart.
    marks = [F.sum(F.xxhash64("row", F.lit(seed)).cast("decimal(20,0)")).cast("string") for seed in (1, 2)]
    # Fewer than average items / least of them, as each covers that share of the pages.
    frequent = (
        sets.select("row", "bad", F.explode("items").alias("token")).groupBy("token")
        .agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"), F.concat_ws(":", *marks).alias("rows"))
        .where(F.col("n_bad") >= least * total)
    )
    frequent = write_shared(frequent.select("token", "rows", "n"), "url-frequent")
    named = frequent.groupBy("rows").agg(F.min("token").alias("unit"))
    units = write_shared(frequent.join(named, "rows").select("token", "unit", "n"), "url-units")
    kept = (
        sets.select("row", "bad", F.explode("items").alias("token")).join(units, "token")
        .groupBy("row", "bad").agg(F.collect_set("unit").alias("items"))
    )
    # Pages without such items count among all pages.
    kept = sets.select("row", "bad").join(kept.drop("bad"), "row", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    tagged = kept.select(F.when(F.col("bad"), F.array_append("items", BLOCK)).otherwise(F.col("items")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(tagged)
    rules = model.associationRules.where((F.col("consequent") == F.array(F.lit(BLOCK))) & (F.col("lift") >= min_lift))
    rules = write_shared(rules.select(F.col("antecedent").alias("units"), "confidence", "support", "lift"), "url-rules")
    sizes = units.where("token = unit").select("unit", "n")
    by_size = (
        rules.select("*", F.explode("units").alias("unit")).join(sizes, "unit")
        .groupBy("units", "confidence", "support", "lift").agg(F.min(F.struct("n", "unit"))["unit"].alias("unit"))
    )
    return units, write_shared(by_size, "url-index")


def mine(pages, labels, min_support=MIN_SUPPORT, min_count=MIN_COUNT, min_confidence=MIN_CONFIDENCE, min_lift=MIN_LIFT):
    """Rules (antecedent, token, confidence, support, lift) for blocking, from the pages that ``labels`` names.

    A page is labelled by the row of its id: bad if toxic is 1 or quality is 0. ``token`` is one of the antecedent's
    rarest items. All antecedents are listed, also those that differ by items of the same pages. No labelled bad page
    gives no rules.
    """
    found = _condensed(pages, labels, min_support, min_count, min_confidence, min_lift)
    if found is None:
        schema = "antecedent array<string>, token string, confidence double, support double, lift double"
        return pages.sparkSession.createDataFrame([], schema)
    units, rules = found
    members = units.groupBy("unit").agg(F.collect_list("token").alias("tokens"))
    numbered = rules.withColumn("rule", F.monotonically_increasing_id())
    numbered = write_shared(numbered, "url-numbered")
    groups = (
        numbered.select("rule", F.explode("units").alias("unit")).join(members, "unit")
        .groupBy("rule").agg(F.collect_list(F.struct("unit", "tokens")).alias("groups"))
    )
    none = F.array(F.array().cast("array<string>"))
    added = lambda some, token: F.concat(some, F.transform(some, lambda one: F.array_append(one, token)))
    subsets = lambda tokens: F.filter(F.aggregate(tokens, none, added), lambda one: F.size(one) > 0)
    crossed = lambda made, group: F.flatten(
        F.transform(made, lambda one: F.transform(subsets(group["tokens"]), lambda more: F.concat(one, more)))
    )
    each = numbered.join(groups, "rule").withColumn("antecedent", F.explode(F.aggregate("groups", none, crossed)))
    own = F.filter("groups", lambda group: group["unit"] == F.col("unit"))[0]["tokens"]
    token = F.filter("antecedent", lambda item: F.array_contains(own, item))[0]
    return each.select("antecedent", token.alias("token"), "confidence", "support", "lift")


def judge(pages, labels, rules=HOST_RULES, min_support=MIN_SUPPORT, min_count=MIN_COUNT, min_confidence=MIN_CONFIDENCE, min_lift=MIN_LIFT):
    """A row for each page: page_id, host, path, rule, verdict.

    Host rules decide; where none fits, a page is blocked if it holds all items of a mined rule, else allowed. Each
    different set of items is matched once, whatever the number of its pages. A null or odd URL has an empty host and
    path and is allowed unless a mined rule fits its items.
    """
    found = _condensed(pages, labels, min_support, min_count, min_confidence, min_lift)
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), items(F.col("url")).alias("_items"))
    rows = rows.withColumn("_rule", host_rule(F.col("host"), F.col("path"), rules))
    if found is None:
        return rows.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce(F.col("_rule.verdict"), F.lit("allow")).alias("verdict"))
    units, index = found
    open_sets = rows.where("_rule is null").select("_items").distinct()
    # A rule fits where each of its units has an item in the set.
    held = open_sets.select("_items", F.explode("_items").alias("token")).join(units, "token")
    held = held.groupBy("_items").agg(F.collect_set("unit").alias("_units"))
    postings = held.select("_items", "_units", F.explode("_units").alias("unit"))
    hits = (
        postings.join(index.select("units", "unit"), "unit").where(F.size(F.array_except("units", "_units")) == 0)
        .select("_items").distinct().withColumn("_hit", F.lit(True))
    )
    joined = rows.join(hits, "_items", "left")
    mined = F.when(F.col("_hit"), "block").otherwise("allow")
    return joined.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce(F.col("_rule.verdict"), mined).alias("verdict")
    )
