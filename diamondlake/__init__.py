"""diamondlake: play-by-play analytics operators expressed as Spark DataFrame jobs.

Every operator takes and returns a ``pyspark.sql.DataFrame`` and is parameterised
by column names and category lists, so the same code runs on any event table.
"""

__version__ = "0.1.0"
