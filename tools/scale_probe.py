"""Time headline queries on K-fold copies of a test-data folder.

    python tools/scale_probe.py [sf_dir] [K ...]
    SCALE_TRIPS_ONLY=1 python tools/scale_probe.py ...   # skip the text tables

The copies are derived in Spark from the given tables: every ``events`` and
``documents`` row is repeated K times (``explode(sequence)``) with its id
shifted per copy, and written as multi-file Parquet under the shared
checkpoint folder. Only a measurement aid; no registered query uses it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tessera.plans import ingest, taxi, text  # noqa: E402
from tessera.session import get_spark, shared_path  # noqa: E402
from tessera.sources import fixtures as fx  # noqa: E402
from tessera.sources.tables import TABLES  # noqa: E402

ID_STRIDE = 10**9


def replicate(spark, sf_dir: str, k: int, files: int, tables=TABLES) -> str:
    out = shared_path(spark, f"scale-x{k}")
    for name in tables:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        key = {"events": "event_id", "documents": "doc_id"}.get(name)
        if key:
            copy = F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
            df = df.select("*", copy.alias("__copy"))
            df = df.withColumn(key, F.col(key) + F.col("__copy").cast("long") * ID_STRIDE).drop("__copy")
            df = df.repartition(files)
        df.write.parquet(f"{out}/{name}.parquet")
    return out


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    ks = [int(a) for a in argv[1:]] or [1, 10]
    spark = get_spark("local[8]", 8, app_name="tessera-scale")
    report = {}
    trips_only = bool(os.environ.get("SCALE_TRIPS_ONLY"))
    for k in ks:
        tables = ["events"] if trips_only else TABLES
        folder = replicate(spark, sf_dir, k, files=max(8, min(4 * k, 200)), tables=tables)
        cases = {
            "q1_parquet": lambda: taxi.hourly_avg_pickup(fx.trips(spark, folder)),
            "q2_window": lambda: taxi.longest_trip_window(fx.trips(spark, folder), fx.vendors(spark, folder)),
            "q2_argmax": lambda: taxi.longest_trip_argmax(fx.trips(spark, folder), fx.vendors(spark, folder)),
            "join_inner": lambda: taxi.join_inner(fx.trips(spark, folder), fx.vendors(spark, folder)),
            "tfidf_vectors": lambda: text.tfidf_vectors(fx.complaints(spark, folder)),
            "csv_to_parquet": None,
        }
        if trips_only:
            del cases["tfidf_vectors"]
        fx.trips_csv_path(spark, folder)
        fx.vendors_csv_path(spark, folder)
        bucketed = ingest.convert_to_bucketed(spark, folder)
        cases["q2_bucketed"] = lambda: taxi.longest_trip_window(
            spark.table(bucketed[0]), spark.table(bucketed[1]))
        timings = {}
        for name, build in cases.items():
            best = float("inf")
            for _ in range(2):
                start = time.time()
                if build is None:
                    ingest.convert_to_parquet(spark, folder)
                else:
                    build().write.format("noop").mode("overwrite").save()
                best = min(best, time.time() - start)
            timings[name] = round(best, 3)
        report[f"x{k}"] = timings
        print(json.dumps({f"x{k}": timings}), flush=True)
    print(json.dumps(report))


if __name__ == "__main__":
    main(sys.argv[1:])
