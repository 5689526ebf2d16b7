"""orderlens: order-reporting operators as PySpark DataFrame functions.

Subpackages:
  sources    - table scans, schema shaping, stored results and atomic publish
  functions  - Column builders (labels, text, dates, predicates)
  operators  - DataFrame -> DataFrame operators (joins, latest, pivot, merge, checks)
  plans      - end-to-end data products and the driver-table queries
  streaming  - Structured Streaming refresh, upsert and derive-on-arrival
"""

__version__ = "0.1.0"
