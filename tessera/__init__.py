"""tessera: Spark-native report data preparation.

Every operator is a function ``DataFrame -> DataFrame`` (or returns a small
one-row/one-row-per-key DataFrame) built on the public PySpark API. Operators
are lazy: nothing is collected to the driver except bounded metadata
(cut points of a sampled order key, one-row statistics).
"""

__version__ = "0.1.0"
