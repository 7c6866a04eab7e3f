"""recspark: recommendation-data operators written as Spark DataFrame plans.

Every public function takes and returns DataFrames (or small fitted values) so it
runs unchanged on a laptop session or a large cluster.
"""

__all__ = ["session"]
