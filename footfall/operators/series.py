"""Chart series: the first column as labels, the next ones as values."""

from pyspark.sql import functions as F


def series(df, *columns):
    """``(label, value[, value2, ...])`` from the given columns, or from all, in the order of ``df``."""
    chosen = columns or df.columns
    names = ["label", "value", *[f"value{i}" for i in range(2, len(chosen))]][: len(chosen)]
    return df.select(*[F.col(c).alias(n) for c, n in zip(chosen, names, strict=True)])


def series_lists(df, *columns):
    """The whole series as Python lists, for the edge where a chart is drawn: as many points as ``df`` has rows."""
    points = series(df, *columns)
    rows = points.collect()
    return [[row[i] for row in rows] for i in range(len(points.columns))]
