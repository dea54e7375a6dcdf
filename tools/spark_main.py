"""Main file for spark-submit: ``spark-submit --py-files tidelake.zip tools/spark_main.py <command> ...``."""

import sys

from tidelake.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
