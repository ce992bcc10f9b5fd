import pyarrow as pa
from pyspark.sql import functions as F

from coffer.llm.shared import Scratch


def test_long_texts_go_to_workers_in_bounded_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["bytes", "n"])

    texts = spark.range(0, 1200, numPartitions=1).select(F.repeat(F.lit("long text "), 2000).alias("text"))
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    rows = Scratch(spark, "batches").table(texts.mapInArrow(sizes, "bytes long, n long"), "sizes").collect()
    assert sum(r["n"] for r in rows) == 1200
    assert max(r["bytes"] for r in rows) < 6 << 20
    assert spark.conf.get(setting) == before
