"""Independent SQL for every registered query, to be run by DuckDB.

The statements rebuild the sources and the star schema from the raw tables in
their own way: integer cents, exact half-up rounding in integers, one wide
table instead of star joins, and row_number instead of the library's operators.
"""

from oracles.catalogue import ORACLES

__all__ = ["ORACLES"]
