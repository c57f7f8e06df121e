import json
from datetime import datetime

from pyspark.sql import types as T

from tidemark.sources.bronze import read_bronze
from tidemark.streaming.changes import capture, change_schema, read_changes, write_changes
from tidemark.streaming.ingest import stream_to_bronze

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def image(id_, name):
    return {"id": id_, "name": name}


EVENTS = [
    {"event_id": 1, "event_type": "INSERT", "schema": "bronze", "table": "cdc_test",
     "rows": [{"values": image(1, "a")}, {"values": image(2, None)}]},
    {"event_id": 2, "event_type": "UPDATE", "schema": "bronze", "table": "crm_cust_info",
     "rows": [{"before_values": image(1, "a"), "after_values": image(1, "b")}]},
    {"event_id": 3, "event_type": "DELETE", "schema": "bronze", "table": "other", "rows": [{"values": image(1, "b")}]},
    {"event_id": 4, "event_type": "DELETE", "schema": "silver", "table": "cdc_test", "rows": [{"values": image(1, "b")}]},
]


def test_change_stream_resumes(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    (tmp_path / "in").mkdir()

    def run():
        changes = read_changes(spark, source, change_schema(ROW))
        write_changes(capture(changes), out, checkpoint).awaitTermination()
        return {(r.event_id, r.row_no): r for r in spark.read.parquet(out).collect()}

    (tmp_path / "in" / "1.json").write_text("\n".join(map(json.dumps, EVENTS)))
    first = run()
    assert sorted(first) == [(1, 0), (1, 1), (2, 0)]
    assert first[1, 1].data == '{"id":2,"name":null}'
    assert json.loads(first[2, 0].data) == {"before": image(1, "a"), "after": image(1, "b")}
    assert len(run()) == 3  # nothing new

    late = dict(EVENTS[0], event_id=5)
    (tmp_path / "in" / "2.json").write_text(json.dumps(late))
    assert sorted(run())[-2:] == [(5, 0), (5, 1)]


def test_stream_to_bronze_lands_each_row_once(spark, tmp_path):
    source = str(tmp_path / "in")
    path, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "checkpoint")

    def run():
        stream = spark.readStream.schema("id bigint").parquet(source)
        query = stream_to_bronze(stream, "public.t", path, checkpoint, ingested_at=datetime(2024, 1, 1))
        query.awaitTermination()
        return read_bronze(spark, path)

    spark.range(100).write.parquet(source)
    assert run().count() == 100
    spark.range(100, 150).write.mode("append").parquet(source)
    stored = run()
    assert stored.count() == stored.select("id").distinct().count() == 150
    assert stored.select("_bronze_id").distinct().count() == 150
    assert sorted(r[0] for r in stored.select("_batch_id").distinct().collect()) == ["S00000000", "S00000001"]
    assert run().count() == 150
