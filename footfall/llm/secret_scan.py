"""Secret scans: fixed patterns, and character Markov models of random strings and of ordinary identifiers.

The models are first-order Markov chains over characters. Samples are labelled by the fixed patterns: their values are
random strings, other identifiers of the texts are ordinary. A run of identifier characters is a secret if the
log-likelihood ratio per character is above a threshold at which few of the ordinary samples lie.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from footfall.llm.common import release, released, slices, texts_of
from footfall.session import write_shared

# The base patterns, in the order in which spans of equal start are listed.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_VALUE = 12
# Greedy runs of a class are whole, so the least length can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
# Candidates of the models: runs as long as the shortest value of a secret, with dashes and slashes.
LEAST_RUN = 12
RUN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIZE = len(LETTERS) + 1
# The threshold is where this share of the ordinary samples passes or this share of the random ones does not, whichever
# is lower, since secrets that no pattern knows lie among the ordinary ones; but at least MIN_GAIN a character.
FALSE_RATE, MISS_RATE, MIN_GAIN = 1e-4, 0.05, 0.5
BINS, BIN = 400, 0.02
SPAN = "struct<kind:string,start:int,end:int>"


def base_spans(text):
    """(kind, start, end) of the fixed patterns, and the values that they hold."""
    spans, values = [], []
    for match in ASSIGN.finditer(text):
        if len(match[2]) >= ASSIGN_VALUE:
            spans.append(("assign", *match.span()))
            values.append(match[2])
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        for match in pattern.finditer(text):
            spans.append((kind, *match.span()))
            values.append(match[0])
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0]))), values


def free_runs(text, spans):
    """(start, end) of candidates: what of each run lies outside all spans, if it is long enough; ``spans`` by start."""
    at, covered = 0, 0
    for match in RUN.finditer(text):
        start, end = max(match.start(), covered), match.end()
        while at < len(spans) and spans[at][1] < end:
            if spans[at][1] - start >= LEAST_RUN:
                yield start, spans[at][1]
            covered = max(covered, spans[at][2])
            start = max(start, covered)
            at += 1
        if end - start >= LEAST_RUN:
            yield start, end


def _codes(run):
    """Numbers of a run's characters after the common start; others than LETTERS count as the start."""
    return np.append(0, _NUMBERS[np.minimum(np.frombuffer(run.encode("utf-32-le"), np.uint32), 127)])


_NUMBERS = np.zeros(128, np.int64)
for _i, _letter in enumerate(LETTERS):
    _NUMBERS[ord(_letter)] = _i + 1

SCANNED = (
    f"doc_id long, base array<{SPAN}>, "
    "runs array<struct<start:int,end:int,run:string>>, values array<string>"
)


def scan(docs):
    """One pass over all texts: base spans, candidates outside them, and the values of base spans.

    A null text counts as empty. Spans are in code points.
    """
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = [], [], []
                for text in texts_of(part):
                    spans, values = base_spans(text)
                    runs = [{"start": start, "end": end, "run": text[start:end]} for start, end in free_runs(text, spans)]
                    found[0].append([dict(zip(("kind", "start", "end"), span)) for span in spans])
                    found[1].append(runs)
                    found[2].append(values)
                span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
                piece = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("run", pa.string())])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(found[0], pa.list_(span)), pa.array(found[1], pa.list_(piece)),
                     pa.array(found[2], pa.list_(pa.string()))],
                    names=["doc_id", "base", "runs", "values"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(released(run), SCANNED)


def _matrix(samples):
    """Transition counts of all strings of an array column, added up on the executors."""
    def run(batches):
        total = np.zeros(SIZE * SIZE, np.int64)
        for batch in batches:
            for own in batch.column(0).to_pylist():
                codes = _codes(own)
                total += np.bincount(codes[:-1] * SIZE + codes[1:], minlength=SIZE * SIZE)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    cells = samples.mapInArrow(released(run), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(SIZE * SIZE)
    for row in cells.collect():  # at most SIZE**2 rows
        out[row.cell] = row.n
    return out.reshape(SIZE, SIZE)


def train(scanned, false_rate=FALSE_RATE, miss_rate=MISS_RATE, min_gain=MIN_GAIN):
    """((transition counts of random strings, of ordinary ones), threshold a character) from all rows of ``scan``.

    Each different sample counts once, so repeated texts do not outweigh others. Without samples of either class
    nothing is flagged.
    """
    values = write_shared(scanned.select(F.explode("values").alias("run")).distinct(), "secret-values")
    ordinary = scanned.select(F.explode("runs.run").alias("run")).distinct()
    ordinary = write_shared(ordinary, "identifiers")
    random, plain = _matrix(values), _matrix(ordinary)
    if not random.sum() or not plain.sum():
        return (random, plain), float("inf")

    def bins(own):
        @F.pandas_udf("int")
        def bin_of(runs: pd.Series) -> pd.Series:
            bins = np.clip(np.ceil(gains(random, plain, runs.tolist(), own) / BIN), 0, BINS)
            return pd.Series(bins.astype(int), index=runs.index)

        return bin_of("run").alias("bin")

    def tally(samples, own):
        counts = np.zeros(BINS + 1)
        for row in samples.groupBy(bins(own)).agg(F.count("*").alias("n")).collect():  # BINS at most
            counts[row.bin] = row.n
        return counts / counts.sum()

    passing = np.append(np.cumsum(tally(ordinary, 1)[::-1])[::-1][1:], 0)  # share above each bin
    few = int(np.flatnonzero(passing <= false_rate)[0])
    most = int(np.flatnonzero(np.cumsum(tally(values, 0)) > miss_rate)[0]) - 1
    return (random, plain), max(min_gain, BIN * min(few, most))


def gains(random, plain, runs, own=1):
    """Log-likelihood ratio a character of each run, by transition counts of both classes.

    A run is left out of the class that it was counted in (0 random, 1 ordinary), so that it speaks not for itself.
    """
    if not len(runs):
        return np.zeros(0)
    lengths = np.array([len(run) for run in runs], np.int64)
    to = _codes("".join(runs))[1:]
    starts = np.cumsum(lengths) - lengths
    of = np.repeat(np.arange(len(runs)), lengths)
    came = np.append(0, to[:-1])
    came[starts] = 0  # the common start
    cells = came * SIZE + to
    _, at, times = np.unique(of * SIZE * SIZE + cells, return_inverse=True, return_counts=True)
    _, row_at, row_times = np.unique(of * SIZE + came, return_inverse=True, return_counts=True)
    likely = []
    for number, counts in enumerate((random, plain)):
        seen, row = counts.ravel()[cells], counts.sum(axis=1)[came]
        if number == own:
            seen, row = seen - times[at], row - row_times[row_at]
        likely.append(np.log((np.maximum(seen, 0) + 0.5) / (np.maximum(row, 0) + 0.5 * SIZE)))
    return np.add.reduceat(likely[0] - likely[1], starts) / lengths


def add_markov(scanned, model):
    """``scanned`` rows as (doc_id, base, spans): base spans and flagged runs by start, then kind."""
    (random, plain), threshold = model

    @F.pandas_udf("array<boolean>")
    def flags(runs: pd.Series) -> pd.Series:
        flat = [run for own in runs for run in own]
        hits = gains(random, plain, flat) > threshold
        bounds = np.append(0, np.cumsum([len(own) for own in runs])).astype(int)
        return pd.Series([hits[a:b].tolist() for a, b in zip(bounds, bounds[1:])], index=runs.index)

    flagged = F.filter(F.zip_with("runs", flags(F.col("runs.run")), lambda run, hit: F.when(hit, run)), lambda run: run.isNotNull())
    added = F.transform(flagged, lambda run: F.struct(F.lit("markov").alias("kind"), run["start"].alias("start"), run["end"].alias("end")))
    rank = F.create_map(*[item for i, kind in enumerate(KINDS) for item in (F.lit(kind), F.lit(i))])
    keyed = F.transform(
        F.concat("base", added),
        lambda span: F.struct(span["start"].alias("start"), rank[span["kind"]].alias("rank"), span["end"].alias("end"), span["kind"].alias("kind")),
    )
    ordered = F.transform(F.sort_array(keyed), lambda span: F.struct(span["kind"].alias("kind"), span["start"].alias("start"), span["end"].alias("end")))
    return scanned.select("doc_id", "base", ordered.alias("spans"))


def _listed(spans):
    parts = F.transform(spans, lambda span: F.concat_ws(":", span["kind"], span["start"].cast("string"), span["end"].cast("string")))
    return F.array_join(parts, ",")


def find(docs):
    """A row for each document (doc_id, text): doc_id, base, spans. Repeated rows are scanned each."""
    scanned = write_shared(scan(docs), "secrets")
    return add_markov(scanned, train(scanned))


def digests(docs):
    """``find`` as counts of the base kinds, the digest of the base spans, and all spans as text."""
    count = lambda kind: F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long")
    return find(docs).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
    )


def redact(docs, mask="[SECRET]"):
    """``docs`` with each run of overlapping spans in text replaced by ``mask``.

    All other columns stay, but for ``n_chars``, which follows the text."""
    (random, plain), threshold = train(write_shared(scan(docs), "secrets"))

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(text):
            if text is None:
                return None
            spans, _ = base_spans(text)
            free = list(free_runs(text, spans))
            hits = gains(random, plain, [text[a:b] for a, b in free]) > threshold
            spans = [span[1:] for span in spans] + [one for one, hit in zip(free, hits) if hit]
            out, at = [], 0
            for start, end in sorted(spans):
                if start >= at:
                    out += [text[at:start], mask]
                at = max(at, end)
            return "".join([*out, text[at:]])

        for texts in batches:
            yield texts.map(one)
        release()

    masked = docs.withColumn("text", clean("text"))
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked
