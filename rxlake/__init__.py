"""rxlake: medallion analytics for prescription totals as Spark DataFrame operators.

Layers: raw text (Bronze) -> typed, deduplicated rows (Silver) -> star schema
and aggregate marts (Gold) -> peer outliers -> dashboard views, with data-quality
checks, lineage records and key-based upserts alongside. Every operator is a
function ``DataFrame -> DataFrame`` built from Spark SQL expressions.
"""

__version__ = "0.1.0"
