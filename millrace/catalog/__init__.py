"""The registered queries over the test tables, and the SQL that checks them."""

from millrace.catalog import cleaning, collecting, evaluation, file_jobs, inference, monitoring, shaping

_PARTS = (collecting, cleaning, file_jobs, shaping, evaluation, inference, monitoring)


def all_queries() -> dict:
    return {name: query for part in _PARTS for name, query in part.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
