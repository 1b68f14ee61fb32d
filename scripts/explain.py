"""Print the formatted physical plan of registered queries.

Usage: python scripts/explain.py [sf_dir] name [name ...]
The plan is the one the final action runs: inputs that a query writes once
(checkpoints) appear as ``Scan ExistingRDD`` leaves.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratum.plans.queries import queries  # noqa: E402
from stratum.session import get_spark  # noqa: E402


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", "explain", shuffle_partitions=8)
    for name in args:
        print(f"===== {name}")
        queries()[name](spark, sf).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
