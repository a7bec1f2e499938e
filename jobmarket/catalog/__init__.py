"""All queries over the driver's tables, with their DuckDB twins where SQL can say the same."""

from jobmarket.catalog import attributes, cases, files, jobs, layout, places, progress, reports, streams, tables, texts, upkeep

MODULES = (reports, tables, attributes, jobs, streams, files, cases, places, texts, progress, layout, upkeep)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in MODULES for k, v in m.SQL.items()}
