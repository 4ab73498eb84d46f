import datetime as dt

from sparkloom import schema as sch
from sparkloom.streaming.staging_stream import start_staging_stream

FIELDS = [sch.Field("id", "INTEGER"), sch.Field("d", "DATE"), sch.Field("record_load_ts", "TIMESTAMP"),
          sch.Field("amt", "NUMERIC")]


def test_incremental_staging_exactly_once(spark, out_dir):
    src, out, ckpt = out_dir("raw-in"), out_dir("staged-out"), out_dir("ckpt")
    batch1 = spark.createDataFrame([("1", "2024-01-01", "1.5"), ("x", "2024-01-01", "2")], "id string, d string, amt string")
    batch1.coalesce(1).write.parquet(src + "/b1")
    q = start_staging_stream(spark, source_dir=src + "/*", fields=FIELDS, output=out, partition_col="d", checkpoint=ckpt)
    q.awaitTermination(120)
    batch2 = spark.createDataFrame([("3", "2024-01-02", "bad")], "id string, d string, amt string")
    batch2.coalesce(1).write.parquet(src + "/b2")
    q = start_staging_stream(spark, source_dir=src + "/*", fields=FIELDS, output=out, partition_col="d", checkpoint=ckpt)
    q.awaitTermination(120)
    rows = sorted(((r.id, r.d, str(r.amt) if r.amt is not None else None, r.record_load_ts is not None)
                  for r in spark.read.parquet(out).collect()), key=repr)
    # reset rule: 'x' fails id (position 0) -> only id is NULL; 'bad' fails amt (last) -> whole row NULL, its
    # date too (it is partitioned by the ingestion day, in a column of its own).
    assert len(rows) == 3
    assert (1, dt.date(2024, 1, 1), "1.500000000", True) in rows
    assert (None, dt.date(2024, 1, 1), "2.000000000", True) in rows
    assert (None, None, None, False) in rows
