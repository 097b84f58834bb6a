from marquee.plans.catalog import QUERIES, ORACLES, query

__all__ = ["QUERIES", "ORACLES", "query"]
