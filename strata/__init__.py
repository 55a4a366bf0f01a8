"""strata: layered (bronze -> silver -> gold -> ML) urban-mobility analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's own
primitives; sinks and model fits are the only eager steps.
"""

__version__ = "0.1.0"
