"""A catalog of small tables, and its statements' rows."""

from gridlark.plans.session import execute
from gridlark.sources.catalog import Catalog, relation_of


def catalog(spark, **tables):
    """tables: name=(columns, rows), as workbook cells."""
    out = Catalog(spark)
    for name, (columns, rows) in tables.items():
        out.tables[name] = relation_of(spark, columns, rows)
    return out


def rows(c, sql, *params):
    return [tuple(r) for r in execute(c, sql, params).result.df.collect()]


def labels(c, sql, *params):
    return execute(c, sql, params).result.labels
