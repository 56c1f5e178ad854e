"""Print the formatted physical plan of named queries (default: headline set).

Usage: python scripts/show_plans.py [sf_dir] [name ...]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from pizarra.plans.catalog import load_all  # noqa: E402
from pizarra.session import get_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
names = sys.argv[2:] or HEADLINE
spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "16"})
reg = load_all()
for name in names:
    print(f"===== {name}")
    reg[name].run(spark, sf).explain("formatted")
