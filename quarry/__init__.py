"""quarry — panel analytics operators expressed as lazy Spark DataFrame plans.

Subpackages:
  functions  scalar column expressions (coercion, dates, text, finance rules)
  operators  DataFrame -> DataFrame operators (joins, windows, aggregates, similarity)
  sources    readers, format guards and sinks
  plans      named recipes composed from the operators, plus the driver bindings
  streaming  incremental ingestion of landed files
"""

__version__ = "0.1.0"
