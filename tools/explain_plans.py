"""Print the final (adaptive) physical plan of registered queries after running them.

usage: python tools/explain_plans.py [sf_dir] name [name ...]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tidelake.registry import QUERIES  # noqa: E402


def main():
    sf = sys.argv[1]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[2:]:
        df = QUERIES[name](spark, sf)
        df.collect()
        print(f"===== {name}")
        print(df._jdf.queryExecution().executedPlan().toString())


if __name__ == "__main__":
    main()
