"""quarry: Spark-native feature analysis and regression benchmarking.

Every operator takes and returns Spark DataFrames (or fits a small,
bounded piece of state such as a mean per column or a category list)
so the heavy work stays in Catalyst/Tungsten plans and scales with the
cluster.
"""

from quarry.session import get_spark, checkpoint_dir, cut_lineage  # noqa: F401

__version__ = "0.1.0"
