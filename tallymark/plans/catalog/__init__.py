"""Queries over the given tables, each with SQL for the same answer where SQL can say it."""

from tallymark.plans.catalog import cleaning, encoding, evaluation, modelling, proofs, relational, selection

_MODULES = (relational, cleaning, encoding, evaluation, modelling, selection, proofs)

QUERIES = {key: query for module in _MODULES for key, query in module.QUERIES.items()}
ORACLES = {key: sql for module in _MODULES for key, sql in module.ORACLES.items()}
