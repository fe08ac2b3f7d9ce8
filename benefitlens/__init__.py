"""benefitlens: benefits-outreach analytics as Spark DataFrame jobs.

Every public operator is a function ``DataFrame -> DataFrame`` (or a few
DataFrames -> DataFrame) that builds a lazy plan; nothing is collected on
the driver except bounded scalars (class counts, quantile bounds, caps).
"""

__version__ = "0.1.0"
