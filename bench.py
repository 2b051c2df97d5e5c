"""Benchmark the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs end to end from the Parquet inputs (fixture adapter ->
mart -> ...) and is forced with the ``noop`` sink, so the time covers the
whole plan without collecting rows to the driver. One warm-up run of the
mart first, so JVM start-up and code generation are not charged to a query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ordermart.operators import ml, profile  # noqa: E402
from ordermart.plans import pipeline  # noqa: E402
from ordermart.plans.session import build_session, use_local_scratch  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          app_name="ordermart-bench")
    use_local_scratch(spark)

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    run(pipeline.orders_master(spark, sf_dir))  # warm-up

    def q_mart():
        run(pipeline.orders_master(spark, sf_dir))

    def q_impute():
        run(pipeline.imputed(spark, sf_dir))

    def q_order_level():
        run(pipeline.order_level(spark, sf_dir))

    def q_feature_table():
        run(pipeline.feature_table(spark, sf_dir))

    def q_profile():
        ol = pipeline.order_level(spark, sf_dir)
        run(profile.null_counts(pipeline.orders_master(spark, sf_dir)))
        cols = [f.name for f in ol.schema.fields if f.dataType.typeName() in ("double", "long", "integer")]
        run(profile.correlation_matrix(ol, cols))

    def q_logreg_fit():
        ft = pipeline.feature_table(spark, sf_dir)
        data = ml.assemble(ml.add_folds(ft), null_as=0.0)
        ml.fit(data.where(F.col("fold") != 0), 1.0)

    timings = {}
    for name, fn in [("orders_master", q_mart), ("impute_all", q_impute),
                     ("order_level", q_order_level), ("feature_table", q_feature_table),
                     ("profile", q_profile), ("logreg_fit", q_logreg_fit)]:
        t = time.time()
        fn()
        timings[name] = round(time.time() - t, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
