"""SQL functions of the scoring path (U1, U2) as Spark SQL UDFs.

``CREATE TEMPORARY FUNCTION ... RETURN <expr>`` bodies are inlined by the
analyzer into higher-order functions, so ``expr("calculate_ema(list, 5)")``
runs in the JVM like any built-in (no Python worker).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# EMA over an array seeded with its first element; a null keeps the
# previous value.
CALCULATE_EMA = """
CREATE OR REPLACE TEMPORARY FUNCTION calculate_ema(data ARRAY<DOUBLE>, span INT)
RETURNS DOUBLE
RETURN CASE WHEN data IS NULL OR size(data) = 0 THEN NULL ELSE
  aggregate(slice(data, 2, size(data)), data[0],
            (acc, x) -> CASE WHEN x IS NULL THEN acc
                             ELSE x * (2.0D / (span + 1)) + acc * (1.0D - 2.0D / (span + 1)) END)
END"""

# Normalised weights (1 - a)^i with i = 0 the oldest element,
# a = 2 / (size + 1); nulls count as 0.
CALCULATE_EMA_WEIGHTED = """
CREATE OR REPLACE TEMPORARY FUNCTION calculate_ema_weighted(data ARRAY<DOUBLE>)
RETURNS DOUBLE
RETURN CASE WHEN data IS NULL OR size(data) = 0 THEN NULL ELSE
  aggregate(zip_with(data, sequence(0, size(data) - 1),
                     (x, i) -> coalesce(x, 0.0D) * pow(1.0D - 2.0D / (size(data) + 1), i)),
            0.0D, (a, v) -> a + v)
  / aggregate(sequence(0, size(data) - 1), 0.0D,
              (a, i) -> a + pow(1.0D - 2.0D / (size(data) + 1), i))
END"""


def register(spark: SparkSession) -> None:
    """Create both functions in the session (idempotent)."""
    spark.sql(CALCULATE_EMA)
    spark.sql(CALCULATE_EMA_WEIGHTED)
