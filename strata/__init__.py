"""strata: layered (bronze -> silver -> gold) data pipelines as Spark DataFrame jobs.

Every operator takes DataFrames and returns DataFrames; nothing is collected
to the driver except scalars (counts, a maximum key, a version number).
"""

__version__ = "0.1.0"
