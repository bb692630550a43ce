"""A result together with its count."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..session import write_shared


def counted(df):
    """The rows of ``df`` and their number, from one run of its plan.

    The rows are counted while they are written to the shared folder; what is returned reads them from there.
    """
    seen = Observation()
    rows = write_shared(df.observe(seen, F.count(F.lit(1)).alias("rows")), "counted")
    return rows, seen.get["rows"]


def show_counted(df, n=20):
    """Print the first ``n`` rows and return how many there are. The plan runs once."""
    rows, count = counted(df)
    rows.show(n, truncate=False)
    return count
