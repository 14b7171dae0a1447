"""Print the formatted plan of a named query: python tools/explain.py name [sf]."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

if __name__ == "__main__":
    from stayline.plans.registry import queries
    from stayline.session import build_session

    spark = build_session("explain", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    df = queries()[sys.argv[1]](spark, f"/root/testdata/sf{sys.argv[2] if len(sys.argv) > 2 else '0.1'}")
    df.collect()
    df.explain("formatted")
