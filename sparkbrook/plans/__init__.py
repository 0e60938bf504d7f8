from sparkbrook.plans.catalog import oracles, queries

__all__ = ["oracles", "queries"]
