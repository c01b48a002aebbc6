from cofi.plans.catalog import ORACLE_SQL, QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]
