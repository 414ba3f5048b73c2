"""tidemark: user-activity analytics as plain Spark DataFrame operators.

Every public operator is a function ``DataFrame -> DataFrame`` built from
``pyspark.sql.functions``; Catalyst and adaptive execution do the planning.
"""

from tidemark.schemas import EventCols, EVENTS_TABLE_COLS, INTERACTION_COLS

__all__ = ["EventCols", "EVENTS_TABLE_COLS", "INTERACTION_COLS"]
__version__ = "0.1.0"
