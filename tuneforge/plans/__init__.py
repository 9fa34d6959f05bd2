"""Query plans: the registered queries (``catalog``), their SQL oracles and plan helpers."""
