"""spark-submit scripts/load_eba.py EBA.txt [--database grid] [--drop-tables] [--n-series N] [--zero-as-null]"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridspark.plans.load import load_eba  # noqa: E402
from gridspark.session import get_spark  # noqa: E402


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("path")
    parser.add_argument("--database", default="default")
    parser.add_argument("--drop-tables", action="store_true")
    parser.add_argument("--n-series", type=int)
    parser.add_argument("--zero-as-null", action="store_true")
    a = parser.parse_args()
    load_eba(get_spark("load-eba"), a.path, a.database, a.drop_tables, a.n_series, a.zero_as_null)


if __name__ == "__main__":
    main()
