"""fulcrum — fulfilment analytics as Spark DataFrame operators.

Layers:
  sources/    typed readers for the raw marketplace tables, the driver-table adapter, sinks
  functions/  column expressions: exact money, rounding, the rate measures and their NULL rules
  operators/  reusable DataFrame -> DataFrame operators (star build, ordered statistics,
              Pareto/ABC, demand volatility, percentile scoring, data-quality expectations)
  plans/      the named marts and extracts built from the operators, plus the query catalogue
  streaming/  nothing: the workload is batch only (see its docstring)
"""

__version__ = "0.1.0"
