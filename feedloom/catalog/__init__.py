from feedloom.catalog.oracle import ORACLE_SQL
from feedloom.catalog.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
