"""inferframe: the table side of large-scale batch model inference, on Spark.

Every operator is a function DataFrame -> DataFrame built from Spark's own operators.
Model calls go through a pluggable per-partition transport (``operators.invoke``).
"""

__version__ = "0.1.0"
