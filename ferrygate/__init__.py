"""ferrygate: a trade-statistics engine written as PySpark DataFrame functions.

Landed JSON envelopes -> quality gate and drift -> bronze -> staging ->
silver aggregates -> served queries, extracts and observability tables.
"""

__version__ = "0.1.0"
