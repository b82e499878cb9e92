import os

from pyspark.sql import SparkSession


def session(cpus: int | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("covista")
             .config("spark.sql.shuffle.partitions", str(cpus))
             .config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
