"""Document dataflows on Spark: predicates, batching, regrouping, upserts, reports and model plug-ins."""

__version__ = "0.1.0"
