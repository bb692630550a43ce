"""Quality rules whose cutoffs are chosen by exact binomial bounds on labelled documents.

A rule rejects a document when a statistic of its text exceeds the cutoff of the document's stratum. For every
stratum, rule and cutoff of a fixed grid, the labelled good documents give the number of false rejections; a cutoff is
certified if so few would have a probability of at most ``delta / tests`` were the true rate above ``alpha / rules``.
So with probability ``1 - delta`` all certified cutoffs together reject at most ``alpha`` of a stratum's good documents.
Everything is built of DataFrame expressions.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall.llm.common import bind, few, nested, words
from footfall.session import write_shared

ALPHA, DELTA = 0.05, 0.05
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
GRID = [round(0.02 * step, 2) for step in range(1, 26)]
RULES = ("symbols", "repeats", "lines", "capitals", "exclamations")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(tokens):
    """Words in three-word windows that the text holds at least twice."""
    last = F.size(tokens) - 3

    def marked(grams):
        # Windows in sorted order, so equal ones lie together; then the starts of those with an equal neighbour.
        placed = F.sort_array(F.transform(grams, lambda gram, i: F.struct(gram.alias("gram"), i.alias("at"))))

        def starts(order):
            same = lambda i, j: (j >= 0) & (j < F.size(order)) & (order[i]["gram"] == F.get(order, j)["gram"])
            hits = F.transform(order, lambda item, i: F.when(same(i, i - 1) | same(i, i + 1), item["at"]))
            return F.sort_array(F.filter(hits, lambda at: at.isNotNull()))

        def covered(at):
            # Each start covers three words, or as many as there are before the next start.
            steps = F.transform(at, lambda here, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - here, F.lit(3))))
            return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

        return bind(bind(placed, starts), covered)

    def counted(grams):
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), 0).otherwise(marked(grams))

    joined = F.transform(F.sequence(F.lit(0), last), lambda i: F.concat_ws(" ", tokens[i], tokens[i + 1], tokens[i + 2]))
    return F.when(last < 0, 0).otherwise(bind(joined, counted))


def _without(text, characters):
    return F.length(F.translate(text, characters, ""))


def statistics(docs, text="text", name="_stats"):
    """``docs`` with a struct of the base counts and of a value from 0 to 1 for each rule.

    A null or empty text has counts of 0 and values of 0. The whole text counts.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(value, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0)

    def of_words(tokens):
        return F.struct(F.size(tokens).cast("long").alias("n_words"), _repeat_words(tokens).cast("long").alias("n_repeat_words"))

    def of_lines(found):
        return F.struct(F.size(found).alias("lines"), (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("dup"))

    counts = docs.withColumn(name, F.struct(
        bind(words(value), of_words).alias("w"),
        bind(lines, of_lines).alias("l"),
        _without(value, SPACES).cast("long").alias("word_chars"),
        (F.length(value) - _without(value, SYMBOLS)).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(value, r"\P{Lu}+", "")).alias("capitals"),
        (F.length(value) - _without(value, "!")).alias("exclamations"),
    ))
    own = lambda field: F.col(f"{name}.{field}")
    share = lambda part, whole: F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0)).cast("double")
    return counts.withColumn(name, F.struct(
        own("w.n_words").alias("n_words"), own("word_chars").alias("word_chars"), own("n_symbols").alias("n_symbols"),
        own("l.dup").alias("n_dup_lines"), own("w.n_repeat_words").alias("n_repeat_words"),
        share(own("n_symbols"), own("word_chars")).alias("symbols"),
        share(own("w.n_repeat_words"), own("w.n_words")).alias("repeats"),
        share(own("l.dup"), own("l.lines")).alias("lines"),
        share(own("capitals"), own("word_chars")).alias("capitals"),
        share(own("exclamations"), own("word_chars")).alias("exclamations"),
    ))


def base_failed(stats="_stats"):
    n = F.col(f"{stats}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{stats}.n_repeat_words") > MAX_REPEAT_PERCENT * n)


def binomial_tail(k, n, p):
    """P(at most ``k`` of ``n``) at rate ``p``, summed exactly term by term in logarithms; 1 beyond the mean."""
    odds = F.log(p / (1 - p))
    first = n * F.log(1 - p)
    start = F.struct(first.alias("term"), F.exp(first).alias("sum"))

    def step(state, j):
        term = state["term"] + F.log((n - j + 1) / j) + odds
        return F.struct(term.alias("term"), (state["sum"] + F.exp(term)).alias("sum"))

    summed = F.aggregate(F.sequence(F.lit(1), k.cast("int")), start, step, lambda state: state["sum"])
    return F.when(k > n * p, 1.0).when(k == 0, F.exp(first)).otherwise(summed)


def learn(stats, labels, stratum="lang", alpha=ALPHA, delta=DELTA):
    """Certified cutoffs: a row for each stratum with an array of cutoffs in the order of ``RULES``, null for none.

    ``stats`` has doc_id, the stratum and ``_stats``; ``labels`` doc_id and quality (1 good). Labels of unknown
    documents, null labels and documents that fail the base rules take no part. A null stratum counts as ``""``.
    Among certified cutoffs the one that rejects most bad documents is taken, at equal numbers the highest.
    """
    bins = len(GRID)
    names = F.array(*map(F.lit, RULES))
    grid = F.array(*map(F.lit, GRID))
    # The number of cutoffs that a value exceeds.
    above = lambda value: F.size(F.filter(grid, lambda cutoff: value > cutoff))
    known = labels.where(F.col("quality").isNotNull()).select("doc_id", "quality")
    held = (
        stats.where(~base_failed()).join(known, "doc_id")
        .select(F.coalesce(F.col(stratum), F.lit("")).alias("stratum"), "quality",
                F.posexplode(F.array(*[F.col(f"_stats.{rule}") for rule in RULES])).alias("rule", "value"))
        .groupBy("stratum", "rule", above(F.col("value")).alias("bin"))
        .agg(F.sum((F.col("quality") == 1).cast("long")).alias("good"), F.sum((F.col("quality") == 0).cast("long")).alias("bad"))
    )
    # Rows of a stratum: at most one for each rule and number of cutoffs exceeded. They are written, and then dealt by
    # stratum once, which all that follows keeps to: the driver plans and follows no further shuffle or broadcast.
    held = write_shared(few(held), "quality-counts")
    strata = held.select(F.count_distinct("stratum")).head()[0]
    # Every number of cutoffs exceeded, also those that no document has.
    none = held.select("stratum", "rule", F.explode(F.sequence(F.lit(0), F.lit(bins))).alias("bin"), F.lit(0).alias("good"), F.lit(0).alias("bad"))
    counts = held.unionByName(none).repartition("stratum").groupBy("stratum", "rule", "bin").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    by = Window.partitionBy("stratum", "rule")
    upward = by.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    whole = by.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tested = counts.select(
        "stratum", "rule", F.get(grid, F.col("bin") - 1).alias("cutoff"),
        F.sum("good").over(upward).alias("false_rejections"), F.sum("bad").over(upward).alias("hits"),
        F.sum("good").over(whole).alias("n"),
    ).where("cutoff is not null")
    level = F.lit(delta / (max(strata, 1) * len(RULES) * bins))
    tail = binomial_tail(F.col("false_rejections"), F.col("n"), F.lit(alpha / len(RULES)))
    certified = tested.where((F.col("hits") > 0) & (tail <= level))
    best = certified.groupBy("stratum", "rule").agg(F.max(F.struct("hits", "cutoff"))["cutoff"].alias("cutoff"))
    by_rule = best.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("found"))
    order = F.sequence(F.lit(0), F.size(names) - 1)
    return by_rule.select("stratum", F.transform(order, lambda i: F.col("found")[i]).alias("cutoffs"))


def judge(stats, cutoffs, stratum="lang"):
    """``stats`` with base_failed and kept. Documents of a stratum without cutoffs only have to pass the base rules."""
    values = F.array(*[F.col(f"_stats.{rule}") for rule in RULES])
    joined = stats.join(
        cutoffs.select(F.col("stratum").alias("_stratum"), F.col("cutoffs").alias("_cutoffs")),
        F.coalesce(F.col(stratum), F.lit("")) == F.col("_stratum"), "left",
    )
    over = F.exists(F.zip_with(values, "_cutoffs", lambda value, cutoff: F.coalesce(value > cutoff, F.lit(False))), lambda x: x)
    failed = base_failed()
    return joined.select(
        *[stats[name] for name in stats.columns], failed.alias("base_failed"),
        (~failed & ~F.coalesce(over, F.lit(False))).alias("kept"),
    )


def verdicts(docs, labels):
    """A row for each document: doc_id, the base counts, base_failed, kept.

    Texts are read once; their statistics are written to the shared folder, small beside them. Repeated rows are
    judged each; null doc_ids match no label.
    """
    stats = statistics(docs.select("doc_id", "lang", "text")).drop("text")
    stored = write_shared(stats, "quality")
    cutoffs = write_shared(learn(stored, labels), "cutoffs")
    judged = judge(stored, cutoffs)
    return judged.select("doc_id", *[F.col(f"_stats.{name}").alias(name) for name in BASE], "base_failed", "kept")


def keep(docs, labels):
    """The documents that pass, with all their columns. Cutoffs are learnt from the labelled ones of ``docs``.

    Documents are written to the shared folder beside their statistics, which so are taken once.
    """
    rows = nested(docs, **{name: F.col(name) for name in ("doc_id", "lang", "text")})
    stored = write_shared(statistics(rows).drop("text"), "quality")
    cutoffs = write_shared(learn(stored.select("doc_id", "lang", "_stats"), labels), "cutoffs")
    return judge(stored, cutoffs).where("kept").select("_doc.*")


def oracle_sql(alpha=ALPHA, delta=DELTA):
    """``verdicts`` in DuckDB's SQL."""
    grid = ", ".join(f"({cutoff}::double)" for cutoff in GRID)
    rate = f"{alpha / len(RULES)}::double"
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
with texts as (
  select row_number() over () as text_no, doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as text from documents
), split as (
  select *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as words,
    list_filter(string_split(text, chr(10)), lambda l: length(translate(l, {spaces}, '')) > 0) as lines from texts
), windows as (
  select text_no, unnest(range(1, len(words) - 1)) as pos,
    unnest(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) as gram
  from split where len(words) >= 3
), twice as (
  select text_no, pos, count(*) over (partition by text_no, gram) as times from windows
), repeated as (
  select text_no, count(distinct pos + step) as n from twice, range(3) s(step) where times > 1 group by text_no
), counts as (
  select split.text_no, doc_id, stratum, len(words) as n_words, length(translate(text, {spaces}, '')) as word_chars,
    length(text) - length(translate(text, '{SYMBOLS}', '')) as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(n, 0) as n_repeat_words, len(lines) as n_lines, length(regexp_replace(text, '[^\\p{{Lu}}]+', '', 'g')) as n_capitals,
    length(text) - length(translate(text, '!', '')) as n_exclamations
  from split left join repeated using (text_no)
), stats as (
  select *, coalesce(n_symbols / nullif(word_chars, 0), 0) as symbols, coalesce(n_repeat_words / nullif(n_words, 0), 0) as repeats,
    coalesce(n_dup_lines / nullif(n_lines, 0), 0) as lines, coalesce(n_capitals / nullif(word_chars, 0), 0) as capitals,
    coalesce(n_exclamations / nullif(word_chars, 0), 0) as exclamations,
    n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed
  from counts
), held as (
  select stratum, quality, rule, value from (
    select stratum, quality, unnest([{", ".join(f"'{rule}'" for rule in RULES)}]) as rule, unnest([{", ".join(RULES)}]) as value
    from stats join labels using (doc_id) where not base_failed and quality is not null)
), tested as (
  select stratum, rule, cutoff, count(*) filter (quality = 1) as n, count(*) filter (quality = 1 and value > cutoff) as k,
    count(*) filter (quality = 0 and value > cutoff) as hits
  from held, (values {grid}) g(cutoff) group by all
), judged as (
  select *, case when k > n * {rate} then 1 else (
      select sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({rate}) + (n - j) * ln(1 - {rate})))
      from range(0, k + 1) r(j)) end as tail,
    {delta} / ((select count(distinct stratum) from held) * {len(RULES) * len(GRID)}) as level
  from tested
), best as (
  select stratum, rule, arg_max(cutoff, hits * 100 + cutoff) as cutoff from judged where hits > 0 and tail <= level group by all
), beyond as (
  select distinct text_no from (
    select text_no, stratum, unnest([{", ".join(f"'{rule}'" for rule in RULES)}]) as rule, unnest([{", ".join(RULES)}]) as value from stats
  ) v join best using (stratum, rule) where value > cutoff
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and text_no not in (select text_no from beyond) as kept
from stats
"""
