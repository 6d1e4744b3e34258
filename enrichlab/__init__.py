"""enrichlab: lead-attribute analytics as Spark DataFrame plans.

Sub-packages
------------
sources    scans of the attribute / funnel / prediction tables and the fixture views
functions  Column -> Column scalars and ANSI-safe helpers (null / NaN / inf rules)
operators  filters, joins, aggregates, windows, profiling, binning, features,
           models, metrics and validation
plans      end-to-end extracts and reports composed from the operators
"""

__version__ = "0.1.0"
