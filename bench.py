"""Times the headline queries; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(os.path.abspath(__file__)), os.environ.get("PYTHONPATH", "")])
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    import lakelens
    from lakelens import queries as Q
    from lakelens.functions.tables import table_plan

    agg = lambda df: df.groupBy("l_returnflag", "l_linestatus").agg(F.count("*"), F.sum("l_extendedprice"), F.max("l_shipdate")).collect()
    tables = {"no_deletes": Q.one(spark, SF_DIR)}
    for percent in (1, 10, 50):
        tables[f"deletes_{percent}"] = Q.deleted(spark, SF_DIR, where=f"pmod(xxhash64(l_orderkey, l_linenumber), 100) < {percent}").root
    moved = Q.deleted(spark, SF_DIR, stored_root="/nowhere/t").root
    plain = Q.base(spark, SF_DIR)
    runs = {
        "plain_agg": lambda: agg(plain),
        "plain_selective": lambda: plain.where("l_quantity > 48 and l_discount > 0.05").select("l_orderkey").agg(F.sum("l_orderkey")).collect(),
        "plan_only": lambda: lakelens.scan(spark, tables["deletes_10"]),
        **{f"scan_{k}": (lambda p=p: agg(lakelens.scan(spark, p))) for k, p in tables.items()},
        "scan_selective": lambda: lakelens.scan(spark, tables["deletes_10"]).where("l_quantity > 48 and l_discount > 0.05").select("l_orderkey").agg(F.sum("l_orderkey")).collect(),
        "scan_moved": lambda: agg(lakelens.scan(spark, moved, allow_moved_paths=True)),
    }
    times = {}
    for name, run in runs.items():
        run()
        took = []
        for _ in range(3):
            began = time.time()
            run()
            took.append(time.time() - began)
        times[name] = round(sorted(took)[1], 3)
    # planning by number of manifests: above 16 they are decoded by tasks
    planning = {}
    for n in (1, 10, 100, 1000):
        b, entries = Q.appended(spark, SF_DIR, name="orders", columns=Q.ORDERS)
        b.snapshot(Q.ID2, Q.T2, [b.manifest(f"p{k}.avro", [(1, e) for e in entries]) for k in range(n)])
        b.commit("v2", "2")
        took = []
        for _ in range(3):
            began = time.time()
            table_plan(spark, b.root)
            took.append(time.time() - began)
        planning[n] = round(sorted(took)[1], 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "planning_by_manifests": planning, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
