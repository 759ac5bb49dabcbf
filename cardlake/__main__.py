"""Run the whole pipeline: raw CSV files (or the test tables) -> every layer.

    spark-submit --py-files cardlake.zip cardlake/__main__.py --csv-dir <folder with the four CSV files> \
        --out <shared folder>
    python -m cardlake --tables-dir /root/testdata/sf0.01 --out /tmp/run-x/out

Prints one line per layer table with its row count (one count job each).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from cardlake.plans.pipeline import DEFAULT_AS_OF, run_pipeline, run_pipeline_from_csv, stored_table
from cardlake.sources.layers import LayerStore


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="cardlake", description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv-dir", help="folder holding users_data / cards_data / mcc_data / transactions_data CSV")
    src.add_argument("--tables-dir", help="folder of the driver's test tables (raw tables derived by SQL)")
    ap.add_argument("--out", required=True, help="output root (a shared file system on a cluster)")
    ap.add_argument("--as-of", default=DEFAULT_AS_OF, help="date ages are computed at (YYYY-MM-DD)")
    ap.add_argument("--multiline", action="store_true", help="CSV fields may hold line ends (files are then not split)")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("cardlake").getOrCreate()
    if args.csv_dir:
        run_pipeline_from_csv(spark, args.csv_dir, args.out, args.as_of, args.multiline)
    else:
        run_pipeline(spark, args.tables_dir, args.out, args.as_of)
    store = LayerStore(spark, args.out)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(args.out)
    fs = root.getFileSystem(conf)
    for layer_status in sorted(fs.listStatus(root), key=lambda x: x.getPath().getName()):
        layer = layer_status.getPath().getName()
        for table_status in sorted(fs.listStatus(layer_status.getPath()), key=lambda x: x.getPath().getName()):
            table = table_status.getPath().getName()
            if store.has(layer, table):
                name = table.removesuffix("_staged")  # a staged table counts without its rejects
                print(f"{layer}.{name}\t{stored_table(store, layer, name).count()}")


if __name__ == "__main__":
    main()
