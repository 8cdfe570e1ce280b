"""Event and batch analytics on PySpark: land, load, deduplicate, aggregate, check.

Every operator takes and returns DataFrames. The clock is always an argument
(``now`` / ``today``), never read inside a transform.
"""

from millrace.session import configure

__all__ = ["configure"]
