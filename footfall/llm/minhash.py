"""Near-duplicates by ProbMinHash signatures of weighted shingles, banding and exact verification.

A shingle is five words, its weight the number of times it occurs. Similarity is the probability Jaccard

    J(x, y) = sum over shared i of 1 / sum over j of max(x_j / x_i, y_j / y_i),

the chance that two signatures agree in a component; for texts without repeated shingles it is the common Jaccard.

Candidates come in three steps, none of which forms all pairs of a group:

1. In a few rounds every text meets one other, the next one of a bucket in a random order, if that is in another class.
   Verified pairs join classes; as partners are others in each round, groups of near copies melt even where no text is near
   to all others, and a round has no more pairs than texts. Rounds end early when hardly a pair joins classes.
2. In buckets that still hold several classes, texts of different classes meet, if the bucket is small.
3. In large ones texts meet where the rarest part of their shingles does. Say a pair's first shared shingle, in the order of
   frequency, comes after the shares u and v of their weights. None of these is shared, so

       J <= (1 - u) (1 - v) / (1 - u v),

   as each term of J is at most 1 / (1 / p + v / q) for shares p and q of the shingle, a concave function of the two. Of
   texts without repeated shingles the sizes X and Y tell more: they share at most O = min(X (1 - u), Y (1 - v)) shingles,
   and J <= O / (X + Y - O). So this finds every pair of the bucket at its first shared shingle, and few others.
   Near copies of one text are often near to it but not to each other, and by this bound each two of them may be near. So
   each text first meets a hub, the text of another class with the least share before a shingle of both; that makes one
   class of text and copies. Then shingles are left out of texts that cannot be near to any text of another class that has
   them, by the best share and sizes there, and only what remains meets in pairs.
   A few pairs of each two classes are verified first, the others only where that left the classes apart.
"""

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall.llm.common import few as _few
from footfall.llm.common import nested, parts_of, release, released, words
from footfall.session import write_shared

SHINGLE, THRESHOLD = 5, 0.8
# A pair of similarity 0.8 meets in no bucket with probability (1 - 0.8**5)**26 = 3e-5.
BANDS, ROWS = 26, 5
ROUNDS, HUB_ROUNDS = 6, 3
LEAST_YIELD = 0.02  # share of a round's pairs that join classes, for another round
FEW = 24  # pairs of each two classes
STRETCH = 1000  # texts of a bucket that are put in order together, about
SMALL_BUCKET = 12
# Pairs whose signatures agree in fewer components than this share are not verified: eight standard deviations
# below the threshold at 130 components.
SCREEN = 0.52
PART_ROWS, PART_WORDS = 500, 1_000_000  # of texts that are shingled together; one longer text is a part of its own
BUCKET_WORDS = 1_000_000  # of a bucket of the table of texts, about
STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x):
    """A 64-bit finalizer: well spread, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes, bounds, length=SHINGLE):
    """Distinct shingles of texts given by word hashes: (text, shingle, weight), by text and shingle.

    A text of fewer words has one shingle of all its words, an empty text none.
    """
    counts = np.diff(bounds)
    with np.errstate(over="ignore"):
        number = np.where(counts >= length, counts - length + 1, np.minimum(counts, 1))
        of = np.repeat(np.arange(len(counts)), number)
        start = bounds[:-1][of] + np.arange(len(of)) - (np.cumsum(number) - number)[of]
        value = np.zeros(len(of), np.uint64)
        for i in range(length):
            inside = start + i < bounds[1:][of]
            word = hashes[np.minimum(start + i, max(len(hashes) - 1, 0))] if len(hashes) else value
            value = np.where(inside, mix(value * STEP + word), value)
    order = np.lexsort((value, of))
    of, value = of[order], value[order]
    first = np.ones(len(of), bool)
    first[1:] = (of[1:] != of[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(first)
    return of[at], value[at], np.diff(np.append(at, len(of)))


def signatures(of, value, weight, texts, size):
    """ProbMinHash signatures, a row for each text.

    Each shingle is a Poisson process of rate ``weight``: its next point comes an exponential time later and falls on
    a random component, which keeps the earliest point's shingle. A shingle ends when its time is past the latest of
    the components of its text, so few points are drawn beyond the first.
    """
    earliest = np.full(texts * size, np.inf)
    holder = np.zeros(texts * size, np.uint64)
    time = np.zeros(len(of))
    active = np.arange(len(of))
    state = mix(value + STEP)
    with np.errstate(over="ignore"):
        while len(active):
            state = mix(state + STEP)
            uniform = ((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
            time = time - np.log(uniform) / weight[active]
            state = mix(state + STEP)
            slot = of[active] * size + ((state >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
            better = time < earliest[slot]
            slots, times, values = slot[better], time[better], value[active][better]
            np.minimum.at(earliest, slots, times)
            won = times == earliest[slots]
            holder[slots[won]] = values[won]
            latest = earliest.reshape(texts, size).max(axis=1)
            go = time < latest[of[active]]
            active, time, state = active[go], time[go], state[go]
    return holder.reshape(texts, size)


def similarity(x, x_weight, y, y_weight):
    """Probability Jaccard of two weighted sets: sorted distinct shingles and their weights."""
    _, in_x, in_y = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not len(in_x):
        return 0.0
    a, b = x_weight[in_x].astype(float), y_weight[in_y].astype(float)
    # For shared i, j counts x_j / x_i if x_j / y_j >= x_i / y_i, else y_j / y_i: prefix sums in the order of x / y.
    ratio = a / b
    order = np.argsort(ratio, kind="stable")
    a, b, ratio = a[order], b[order], ratio[order]
    only_x, only_y = x_weight.sum() - a.sum(), y_weight.sum() - b.sum()
    from_y = np.append(0, np.cumsum(b))[np.searchsorted(ratio, ratio, "left")] + only_y
    above_x = a.sum() - np.append(0, np.cumsum(a))[np.searchsorted(ratio, ratio, "left")] + only_x
    return float((1.0 / (above_x / a + from_y / b)).sum())


def _hashes(text):
    return F.transform(words(text), lambda word: F.xxhash64(word))


def _runs(column):
    """Values and bounds of an Arrow list column without nulls."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy()[offsets[0]:offsets[-1]]
    return values.view(np.uint64), (offsets - offsets[0]).astype(np.int64)


def _cut(batch):
    """Parts of a batch with a list column ``words``."""
    bounds = parts_of(np.diff(batch.column("words").offsets.to_numpy()), PART_ROWS, PART_WORDS)
    for start, end in zip(bounds, bounds[1:]):
        yield pa.concat_batches([batch.slice(start, end - start)])


def _bands(texts, length):
    """(id, bands: array of keys, sig: signature as bytes of 16-bit values, words: their number) of rows (id, text)."""
    size = BANDS * ROWS

    def run(batches):
        for batch in batches:
            for part in _cut(batch):
                hashes, bounds = _runs(part.column("words"))
                found = signatures(*shingles(hashes, bounds, length), part.num_rows, size)
                with np.errstate(over="ignore"):
                    keys = np.zeros((part.num_rows, BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
                    for row in range(ROWS):
                        keys = mix(keys * STEP + found.reshape(-1, BANDS, ROWS)[:, :, row])
                filled = np.diff(bounds) > 0
                lists = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(filled * BANDS)).astype(np.int32)), pa.array(keys[filled].ravel().view(np.int64))
                )
                sig = [row.tobytes() for row in (found & np.uint64(0xFFFF)).astype("<u2")]
                number = pa.array(np.diff(bounds))
                yield pa.RecordBatch.from_arrays([part.column("id"), lists, pa.array(sig, pa.binary()), number], names=["id", "bands", "sig", "words"])

    schema = "id long, bands array<long>, sig binary, words long"
    return texts.select("id", _hashes(F.col("text")).alias("words")).mapInArrow(released(run), schema)


def _agreement():
    @F.pandas_udf("double")
    def share(left: pd.Series, right: pd.Series) -> pd.Series:
        if not len(left):
            return pd.Series([], dtype=float)
        a = np.frombuffer(b"".join(left), "<u2").reshape(len(left), -1)
        b = np.frombuffer(b"".join(right), "<u2").reshape(len(left), -1)
        return pd.Series((a == b).mean(axis=1))

    return share


def _exact(length):
    def similar(left, right):
        out = []
        lengths = left.map(len).to_numpy(np.int64) + right.map(len).to_numpy(np.int64)
        parts = parts_of(lengths, PART_ROWS, PART_WORDS)
        for start, end in zip(parts, parts[1:]):
            a, b = left[start:end], right[start:end]
            both = list(a) + list(b)
            bounds = np.append(0, np.cumsum([len(own) for own in both])).astype(np.int64)
            hashes = np.concatenate([np.asarray(own, np.int64) for own in both]).view(np.uint64)
            of, value, weight = shingles(hashes, bounds, length)
            edges = np.searchsorted(of, np.arange(len(both) + 1))
            n = len(a)
            for i in range(n):
                x, y = slice(edges[i], edges[i + 1]), slice(edges[n + i], edges[n + i + 1])
                out.append(similarity(value[x], weight[x], value[y], weight[y]))
        return pd.Series(out, dtype=float)

    @F.pandas_udf("double")
    def of_batches(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            yield similar(left, right)
        release()

    return of_batches


def _verify(pairs, texts, threshold, length, copies=None):
    """Links (a, b, class_a, class_b, similarity) among candidate pairs: screened by signature, then measured on the
    whole texts. ``texts`` is bucketed by id, so only pairs are shuffled.

    With ``copies`` (id, copy) of the texts ``b``, which may be in many pairs, pairs name the copy that they meet.
    """
    names = ["a", "b", "class_a", "class_b"]
    keys, others = ["b"], texts
    if copies is not None:
        keys, others = ["b", "copy"], texts.join(copies, "id")
    own = lambda column: texts.select(F.col("id").alias("a"), F.col(column).alias(f"{column}_a"))
    other = lambda column: others.withColumnRenamed("id", "b").select(*keys, F.col(column).alias(f"{column}_b"))
    screened = pairs.select("a", "class_a", "class_b", *keys).join(own("sig"), "a").join(other("sig"), keys)
    screened = screened.where(_agreement()("sig_a", "sig_b") >= SCREEN).select("a", "class_a", "class_b", *keys)
    screened = write_shared(_few(screened), "minhash-screened")
    measured = screened.join(own("text"), "a").join(other("text"), keys)
    score = _exact(length)(_hashes(F.col("text_a")), _hashes(F.col("text_b")))
    found = measured.select(*names, score.alias("similarity")).where(F.col("similarity") >= threshold)
    # Pairs that name a copy are not dealt as the buckets are.
    return write_shared(found if copies is None else _few(found), "minhash-links")


def _hooked(links):
    """(id, to): every id of links (a, b) and one that it reaches, no larger: the smallest neighbour's, if that is smaller.

    One step, not a whole closure; each other step then has fewer classes to join.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = write_shared(_few(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("to"))), "labels")
    of = near.select(F.col("id").alias("to"), F.col("to").alias("further"))
    return write_shared(_few(near.join(of, "to").select("id", F.col("further").alias("to"))), "labels")


def _labels(links):
    """(id, class) of every linked id: the smallest id that links (a, b) reach.

    Labels are the smallest among neighbours, then followed to their own label's label, which halves the way in each
    round. Each round is written to the shared folder.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = write_shared(_few(both), "links")
    # The first round: the smallest neighbour.
    labels = write_shared(_few(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("class"))), "labels")
    while True:
        near = (
            _few(both.join(labels, both["b"] == labels["id"]).select("a", "class")).groupBy("a").agg(F.min("class").alias("near"))
        )
        lowered = _few(labels.join(near, labels["id"] == near["a"]).select("id", "class", F.least("class", "near").alias("to")))
        of = labels.select(F.col("id").alias("to"), F.col("class").alias("further"))
        moved = lowered.join(of, "to").select("id", F.least("to", "further").alias("new"), "class")
        moved = write_shared(_few(moved), "labels")
        changed = moved.where(F.col("new") != F.col("class")).limit(1).count()
        labels = moved.select("id", F.col("new").alias("class"))
        if not changed:
            return labels


def _renamed(links):
    """(class, to): the classes that links between classes (class_a, class_b) join into others, and the smallest of each."""
    labels = _labels(links.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).where("a <> b"))
    return labels.select(F.col("id").alias("class"), F.col("class").alias("to"))


def _apply(rows, renames, name="class"):
    """``rows`` with the column ``name`` as the classes are called now."""
    new = renames.select(F.col("class").alias(name), F.col("to").alias("_to"))
    columns = [F.coalesce("_to", name).alias(name) if c == name else F.col(c) for c in rows.columns]
    return rows.join(new, name, "left").select(*columns)


def joined(classes, links):
    """``classes`` (id, class) after further links (a, b) between ids: a class is named by its smallest id."""
    of = lambda name: classes.select(F.col("id").alias(name), F.col("class").alias(f"class_{name}"))
    return _apply(classes, _renamed(links.select("a", "b").join(of("a"), "a").join(of("b"), "b")))


def _shared_buckets(buckets):
    """The rows (id, band) of buckets of several texts, with the number of texts."""
    return buckets.join(buckets.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "band")


def _open_buckets(buckets, classes):
    """Bucket rows (id, band, n, class) of buckets that hold several classes."""
    known = _few(buckets.join(classes, "id"))
    several = known.groupBy("band").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    return known.join(several.where("low < high").select("band"), "band")


def _met(held, seed):
    """A pair for each text with the next one of another class, in one of its buckets; the seed deals the order anew.

    A large bucket is put in order in stretches, so a bucket that many texts share is not one task's work. Pairs have
    the smaller id first and come once.
    """
    stretch = F.pmod(F.xxhash64("id", F.lit(seed), F.lit("stretch")), F.ceil(F.col("n") / STRETCH))
    order = Window.partitionBy("band", "_stretch").orderBy(F.xxhash64("id", F.lit(seed)), "id")
    following = F.lead(F.struct("id", "class")).over(order)
    rows = _few(held).withColumn("_stretch", stretch).withColumn("_next", following).where(F.col("_next.class") != F.col("class"))
    choice = F.min(F.struct(F.xxhash64("band", F.lit(seed)).alias("hash"), F.col("_next").alias("next")))
    met = _few(_few(rows).groupBy("id").agg(F.first("class").alias("class"), choice["next"].alias("next")))
    one, two = F.struct("id", "class"), F.struct("next.id", "next.class")
    low, high = F.least(one, two), F.greatest(one, two)
    pairs = met.select(low["id"].alias("a"), low["class"].alias("class_a"), high["id"].alias("b"), high["class"].alias("class_b"))
    # Dealt by ``a`` alone, as the join with the signatures is. A text is the next one in no more than BANDS buckets.
    near = pairs.groupBy("a", "class_a").agg(F.collect_set(F.struct("b", "class_b")).alias("near"))
    return near.select("a", "class_a", F.explode("near").alias("other")).select("a", "other.b", "class_a", "other.class_b")


def _crossing(rows, key, more=()):
    """Pairs of different classes that share a key. ``rows``: id, class and the key; columns ``more`` go with both, as more_a, more_b."""
    side = lambda name: rows.select(key, F.col("id").alias(name), F.col("class").alias(f"class_{name}"), *[F.col(c).alias(f"{c}_{name}") for c in more])
    return side("a").join(side("b"), key).where((F.col("a") < F.col("b")) & (F.col("class_a") != F.col("class_b")))


def _share_within(u, v, threshold):
    return (1 - u) * (1 - v) >= threshold * (1 - u * v) - 1e-9


def _within(threshold):
    """Whether a pair may be as similar, from the shares of weight before the first shared shingle, and the sizes."""
    u, v, x, y = (F.col(name) for name in ("share_a", "share_b", "whole_a", "whole_b"))
    most = F.least(x * (1 - u), y * (1 - v)) * (1 + threshold) >= threshold * (x + y) - 1e-6
    return _share_within(u, v, threshold) & (most | ~(F.col("plain_a") & F.col("plain_b")))


def _hubs(rare, threshold):
    """A pair (a, class_a, b, class_b, copy) for each text with its hub ``b``, and copies (id, copy) of the hubs.

    The hub of a shingle is the text with the least share before it, or the next such one of another class; of a text's
    shingles the one with the least share of its hub counts. A hub of a shingle that many texts have is copied, a copy
    for each stretch of them, so that no task meets them all.
    """
    row = F.struct("share", F.xxhash64("id").alias("hash"), "id", "class", "whole", "plain")
    one = rare.groupBy("shingle").agg(F.count("*").alias("n"), F.min(row).alias("one"))
    # Dealt anew for the aggregate, so that a shingle that many texts have is joined in several tasks.
    others = _few(rare.join(one, "shingle").where(F.col("class") != F.col("one.class")).select(*rare.columns))
    two = others.groupBy("shingle").agg(F.min(row).alias("two"))
    hub = F.when(F.col("class") != F.col("one.class"), F.col("one")).otherwise(F.col("two"))
    known = rare.join(one.join(two, "shingle"), "shingle").withColumn("hub", hub)
    sides = known.select(
        "id", "class", "n", "hub", *[F.col(c).alias(f"{c}_a") for c in ("share", "whole", "plain")],
        *[F.col(f"hub.{c}").alias(f"{c}_b") for c in ("share", "whole", "plain")],
    )
    met = _few(sides.where(_within(threshold))).groupBy("id").agg(F.first("class").alias("class"), F.min(F.struct("hub", "n")).alias("best"))
    parts = F.ceil(F.col("best.n") / STRETCH)
    pairs = met.select(
        F.col("id").alias("a"), F.col("class").alias("class_a"), F.col("best.hub.id").alias("b"),
        F.col("best.hub.class").alias("class_b"), F.pmod(F.xxhash64("id", F.lit("copy")), parts).alias("copy"),
    )
    pairs = write_shared(_few(pairs), "minhash-hubs")
    return pairs, _few(pairs.select(F.col("b").alias("id"), "copy").distinct())


def _viable(rows, threshold):
    """The rows of ``rows`` (as ``_rare_shingles`` gives them) that may be in a pair of ``_within``, and few others.

    A row is held against the best values under its shingle outside its class: the least share, and of texts without
    repeated shingles the least size and the greatest size that a partner may have, for X + Y <= (1 + 1 / J) X (1 - u).
    """
    u, x = F.col("share"), F.col("whole")
    reach = F.when(F.col("plain"), x * ((1 + threshold) / threshold * (1 - u) - 1) + 1e-5).otherwise(F.lit(float("inf")))
    sized = rows.withColumn("size", F.when(F.col("plain"), x.cast("double")).otherwise(F.lit(float("-inf")))).withColumn("reach", reach)
    best = {"share": F.min, "size": F.min, "reach": F.max}
    classes = _few(sized.groupBy("shingle", "class").agg(*[pick(c).alias(c) for c, pick in best.items()]))
    first = classes.groupBy("shingle").agg(*[pick(F.struct(c, "class")).alias(f"first_{c}") for c, pick in best.items()])
    beside = lambda c: F.col("class") != F.col(f"first_{c}.class")
    second = classes.join(first, "shingle").groupBy("shingle").agg(*[pick(F.when(beside(c), F.col(c))).alias(f"second_{c}") for c, pick in best.items()])
    other = {c: F.when(beside(c), F.col(f"first_{c}.{c}")).otherwise(F.col(f"second_{c}")) for c in best}
    # Without another class under the shingle the values are null.
    viable = _share_within(u, other["share"], threshold) & (other["size"] <= F.col("reach")) & (F.col("size") <= other["reach"])
    return sized.join(first.join(second, "shingle"), "shingle").where(viable).select(*rows.columns)


def _rare_shingles(texts, threshold, length):
    """(id, class, shingle, share, whole, plain): the rarest shingles of each text, with the share of its weight before
    each, its whole weight, and whether none of its shingles is repeated.

    Up to the first beyond ``1 - threshold``, and only shingles that several classes have.
    """
    def run(batches):
        for batch in batches:
            for part in _cut(batch):
                of, value, weight = shingles(*_runs(part.column("words")), length)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(of)), part.column("class").take(pa.array(of)),
                     pa.array(value.view(np.int64)), pa.array(weight.astype(np.int64))],
                    names=["id", "class", "shingle", "weight"],
                )

    every = texts.select("id", "class", _hashes(F.col("text")).alias("words")).mapInArrow(
        released(run), "id long, class long, shingle long, weight long"
    )
    every = write_shared(every, "minhash-shingles")
    spread = every.groupBy("shingle").agg(F.count("*").alias("df"), F.min("class").alias("low"), F.max("class").alias("high"))
    # A shingle of one class alone joins no classes, but counts in the order of its texts.
    known = _few(every.join(spread, "shingle"))
    order = Window.partitionBy("id").orderBy("df", "shingle")
    before = F.coalesce(F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum("weight").over(Window.partitionBy("id"))
    plain = F.max("weight").over(Window.partitionBy("id")) == 1
    rare = known.withColumn("_before", before).withColumn("_whole", whole).withColumn("plain", plain)
    rare = rare.where(F.col("_before") <= (1 - threshold) * F.col("_whole") + 1e-9)
    return rare.where("low < high").select("id", "class", "shingle", (F.col("_before") / F.col("_whole")).alias("share"), F.col("_whole").alias("whole"), "plain")


def _bucket_count(words, partitions, cores):
    """Buckets for texts of so many words: no more than partitions, and for few texts not many more than cores."""
    wanted = max(cores, -(-words // BUCKET_WORDS))
    # A writer of one partition fills one bucket if there are as many; if there are fewer, each writer fills all.
    return partitions if 2 * wanted > partitions else wanted


def _distinct_texts(keyed, signed, needed):
    """A table (id, sig, text) of the texts whose ids are needed, bucketed by id so that joins do not shuffle texts again.

    Each join with it has a task for each bucket, and there are dozens; so buckets follow the words, not the setting.
    """
    spark = keyed.sparkSession
    name = f"minhash_texts_{uuid.uuid4().hex}"
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = signed.agg(F.sum("words")).first()[0] or 0
    buckets = _bucket_count(words, partitions, spark.sparkContext.defaultParallelism)
    # One row a text and task leaves the map side, however many copies there are.
    distinct = keyed.groupBy("id").agg(F.first("text").alias("text")).join(needed, "id", "left_semi")
    rows = distinct.join(signed.select("id", "sig"), "id").coalesce(buckets)
    rows.write.bucketBy(buckets, "id").sortBy("id").saveAsTable(name)
    return spark.table(name), name


def _number(text):
    return F.xxhash64(F.coalesce(text, F.lit("")), F.lit(1))


def numbered_texts(docs):
    """``docs`` with ``_text``, a 64-bit hash that stands for the text. A null text counts as empty.

    Two of n different texts share a number with a probability of n**2 / 2**65: about one pair in ten billion texts.
    """
    return docs.withColumn("_text", _number(F.col("text")))


def text_classes(docs, threshold=THRESHOLD, length=SHINGLE):
    """Classes of the different texts of ``docs`` and the links between them.

    Returns (id, class), a row for each text under its number, and (a, b, similarity). A chain of pairs of at least
    ``threshold`` joins a class, which has the smallest number of its texts. All empty texts are one text; a text of
    fewer than ``length`` words is one shingle. An empty table gives empty tables.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = numbered_texts(docs.select("text")).select(F.col("_text").alias("id"), text.alias("text"))
    signed = write_shared(_few(_bands(keyed, length).dropDuplicates(["id"])), "minhash-signatures")
    buckets = signed.select("id", F.explode("bands").alias("band"))
    shared = write_shared(_few(_shared_buckets(buckets)), "minhash-buckets")
    needed = shared.select("id").distinct()
    texts, name = _distinct_texts(keyed, signed, needed)
    try:
        return _linked(signed, shared, texts, threshold, length)
    finally:
        spark.sql(f"drop table {name}")


def _linked(signed, shared, texts, threshold, length):
    """Classes and links of the texts, from their signatures, the rows of shared buckets, and the texts in those."""
    single = signed.select("id", F.col("id").alias("class"))
    # Classes of the texts in shared buckets; all others are their own.
    known, links = write_shared(_few(texts.select("id", F.col("id").alias("class"))), "minhash-classes"), None
    for seed in range(ROUNDS):
        pairs = write_shared(_few(_met(shared.join(known, "id"), seed)), "minhash-met")
        found = _verify(pairs, texts, threshold, length)
        links = found if links is None else links.unionByName(found)
        met, joins = pairs.count(), found.count()
        if joins:
            hooked = _hooked(found.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")))
            known = write_shared(_few(_apply(known, hooked.withColumnRenamed("id", "class"))), "minhash-classes")
        if joins <= LEAST_YIELD * met:
            break
    # A text's class so far is one that it reaches; now the smallest of all.
    steps = known.select(F.col("id").alias("a"), F.col("class").alias("b")).where("a <> b")
    labels = _labels(links.select("a", "b").unionByName(steps))
    known = write_shared(_few(_apply(single, labels.select(F.col("id").alias("class"), F.col("class").alias("to")))), "minhash-classes")

    held = write_shared(_few(_open_buckets(shared, known)), "minhash-open")
    large = _few(held.where(F.col("n") > SMALL_BUCKET).select("id", "class").distinct())
    rare = write_shared(_few(_rare_shingles(large.join(texts, "id"), threshold, length)), "minhash-rare")
    own = ["a", "b", "class_a", "class_b"]
    for _ in range(HUB_ROUNDS):
        pairs, copies = _hubs(rare, threshold)
        met = pairs.count()
        if not met:
            break
        found = _verify(pairs, texts, threshold, length, copies)
        joins = found.count()
        if joins:
            low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
            links = links.unionByName(found.select(low, high, "class_a", "class_b", "similarity"))
            known = write_shared(_few(_apply(known, write_shared(_renamed(found), "minhash-renames"))), "minhash-classes")
            rare = write_shared(_few(rare.drop("class").join(known, "id")), "minhash-rare")
        if joins <= LEAST_YIELD * met:
            break
    small = write_shared(_few(_open_buckets(held.where(F.col("n") <= SMALL_BUCKET).select("id", "band", "n"), known)), "minhash-small")
    viable = write_shared(_few(_viable(rare, threshold)), "minhash-viable")
    near = _few(_crossing(viable, "shingle", ("share", "whole", "plain")).where(_within(threshold)).select(own))
    pairs = _few(_few(_crossing(small, "band").select(own)).unionByName(near).distinct())
    # A few pairs of each two classes first: most that can be joined are, and their other pairs need no more looking at.
    by_classes = Window.partitionBy("class_a", "class_b").orderBy(F.xxhash64("a", "b"))
    pairs = write_shared(_few(pairs.withColumn("_few", F.row_number().over(by_classes) <= FEW)), "minhash-pairs")
    for few in (True, False):
        rest = pairs.where(F.col("_few") == few)
        if not few:
            rest = write_shared(_few(_apply(_apply(rest, renames, "class_a"), renames, "class_b").where("class_a <> class_b")), "minhash-rest")
        if rest.isEmpty():
            break
        found = _verify(rest, texts, threshold, length)
        links = links.unionByName(found)
        renames = write_shared(_renamed(found), "minhash-renames")
        known = write_shared(_few(_apply(known, renames)), "minhash-classes")
    return known, links


def dedup_classes(docs, **options):
    """A row for each document (doc_id, text): doc_id, class_id (the smallest doc_id of its class), is_kept.

    Rows of equal text share a class. One document of each class is kept, that of the smallest doc_id; repeated rows
    of that doc_id are marked alike. Null doc_ids come last and give a null class_id if the class has no other.
    """
    found, _ = text_classes(docs, **options)
    rows = numbered_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("doc_id", "_text")
    narrow = _few(rows.join(found.select(F.col("id").alias("_text"), "class"), "_text").select("doc_id", "class"))
    heads = narrow.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    kept = F.col("doc_id").eqNullSafe(F.col("class_id"))
    return narrow.join(heads, "class").select("doc_id", "class_id", kept.alias("is_kept"))


def keep(docs, **options):
    """One document of each class, with all columns: that of the smallest doc_id (nulls last), one of repeated rows."""
    found, _ = text_classes(docs, **options)
    known = found.select(F.col("id").alias("_text"), "class")
    keys = numbered_texts(docs.select("doc_id", "text")).select("_text", "doc_id")
    head = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_text"))
    heads = _few(keys.join(known, "_text")).groupBy("class").agg(head.alias("_head")).select("_head.doc_id", "_head._text")
    heads = write_shared(_few(heads.select(F.col("_text").alias("_kept_text"), F.col("doc_id").alias("_kept_id"))), "minhash-heads")
    rows = nested(docs, doc_id=F.col("doc_id"), _text=_number(F.col("text")))
    kept = rows.join(heads, (rows["_text"] == heads["_kept_text"]) & rows["doc_id"].eqNullSafe(heads["_kept_id"]), "left_semi")
    return kept.dropDuplicates(["_text", "doc_id"]).select("_doc.*")
