"""Feature stages, model fitting and evaluation on Spark MLlib.

Metrics are computed as DataFrame aggregates (``metrics``) so they stay
distributed and can be joined, stored or streamed like any other result.
"""
