"""Retail analytics on Spark DataFrames.

Every operator takes DataFrames and returns DataFrames; nothing here starts a session, reads a clock
or brings rows to the driver.  Shared scratch space comes from ``spark.checkpoint.dir``.
"""

from etalage.storage import materialise, release

__all__ = ["materialise", "release"]
