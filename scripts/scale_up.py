"""Build a k-times larger copy of a test-table folder for scaling runs.

Copy i shifts the keys that join tables together by i * (max key + 1), so
joins keep their fan-out (no cross-copy matches) while every grouping by a
non-key attribute (nation, brand, event type, day, label) grows k-fold.

usage: python scripts/scale_up.py SRC_DIR DST_DIR K
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tunelake.session import build_session  # noqa: E402

SHIFT = {
    "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey", "l_partkey"],
    "customer": ["c_custkey"],
    "part": ["p_partkey"],
    "documents": ["doc_id"],
    "labels": ["doc_id"],
    "events": ["event_id"],
}
KEY_SPACE = {"o_orderkey": "orders", "l_orderkey": "orders", "o_custkey": "customer",
             "c_custkey": "customer", "l_partkey": "part", "p_partkey": "part",
             "doc_id": "documents", "event_id": "events"}
KEY_COL = {"orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey",
           "documents": "doc_id", "events": "event_id"}
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def main() -> None:
    src, dst, k = sys.argv[1].rstrip("/"), sys.argv[2].rstrip("/"), int(sys.argv[3])
    spark = build_session("local[8]", shuffle_partitions=16)
    span = {t: spark.read.parquet(f"{src}/{t}.parquet").agg(F.max(c)).first()[0] + 1
            for t, c in KEY_COL.items()}
    for t in TABLES:
        df = spark.read.parquet(f"{src}/{t}.parquet")
        if t in SHIFT:
            df = df.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            df = df.withColumns({c: F.col(c) + F.col("__copy") * F.lit(span[KEY_SPACE[c]])
                                 for c in SHIFT[t]}).drop("__copy")
        df.write.mode("overwrite").parquet(f"{dst}/{t}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
