"""Queries by name, each with its SQL where SQL can express it."""

from quern.plans.queries import QUERIES, SQL


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
