"""Document labelling jobs on Spark: prepare, score, decode, publish."""

__version__ = "0.1.0"
