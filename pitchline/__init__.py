"""pitchline: star-schema contest analytics as Spark DataFrame jobs.

Every operator takes and returns DataFrames. Nothing pulls data rows to the
driver; statistics reduce to one row per test on the executors.
"""

__version__ = "0.1.0"
