"""Run in a subprocess with task retries allowed: the first attempt of some
tasks fails on purpose; results must be exactly those of a clean run."""

import json
import sys

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tidemark.operators.ordering import with_row_index  # noqa: E402
from tidemark.session import configure, shared_dir  # noqa: E402
from tidemark.sources.bronze import read_bronze, write_bronze  # noqa: E402

spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
configure(spark)
data_dir = sys.argv[2]


@F.udf(T.LongType())
def flaky(x):  # test-only: fail the first attempt of every task that sees key 7
    ctx = TaskContext.get()
    if x == 7 and ctx is not None and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return x


events = spark.read.parquet(f"{data_dir}/events.parquet").repartition(4)
docs = events.select(F.col("event_type").alias("symbol"), F.date_format("ts", "yyyy-MM").alias("month"),
                     flaky(F.col("event_id")).alias("event_id"), F.col("props").alias("body"))
path = shared_dir(spark, "t-retry")
write_bronze(docs, path)
back = read_bronze(spark, path)
ids = [r.event_id for r in back.select("event_id").collect()]

idx = with_row_index(events.select("event_id", flaky(F.col("event_id")).alias("k")), ["event_id"], "i")
positions = sorted(r.i for r in idx.collect())
print(json.dumps({"n": events.count(), "landed": len(ids), "distinct": len(set(ids)),
                  "dense": positions == list(range(len(positions)))}))
