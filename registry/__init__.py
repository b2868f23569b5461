"""The registered queries and the SQL they are checked against."""

from registry import prep, rule, segment, serve, shop

MODULES = (prep, segment, rule, serve, shop)
QUERIES = {name: fn for module in MODULES for name, fn in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
