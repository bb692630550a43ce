"""Plans over one table or over several that share no key."""

from functools import reduce

from pyspark.sql import DataFrame


def by_part(tables, plan):
    """``plan`` of each table, as one: for plans whose rows each come from one key."""
    if isinstance(tables, DataFrame):
        return plan(tables)
    return reduce(DataFrame.unionByName, map(plan, tables))
