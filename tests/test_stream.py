from webloom.sources.paged import PagedList, PagedStreamReader
from webloom.sources.tables import shared_dir
from webloom.streaming import dedupe

DATA = "/root/testdata/sf0.001"


def test_stream_keeps_each_text_once(spark):
    rows = dedupe.stream_dedupe(spark, DATA)
    assert rows.count() == rows.select("text_md5").distinct().count() == spark.read.parquet(f"{DATA}/documents.parquet").select("text").distinct().count()


def test_a_batch_that_runs_again_adds_nothing(spark):
    sink = f"{shared_dir(spark)}/sink-again"
    batch = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "text_md5 string, chars int")
    for _ in range(2):
        dedupe.append_new(batch, sink)
    assert spark.read.parquet(sink).count() == 3


def test_a_list_as_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    spark.dataSource.register(PagedList)

    def run(**trigger):
        stream = spark.readStream.format("paged").option("fetch", "tests.list_pages:gaps").option("pause", "0").option("pages_per_batch", "1").load()
        query = stream.writeStream.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(**trigger).format("parquet").option("path", str(tmp_path / "out")).start()
        if "once" in trigger:
            query.awaitTermination(60)
        else:
            query.processAllAvailable()
            query.stop()
        return sorted(r.page_id for r in spark.read.schema("page_id long, html string").parquet(str(tmp_path / "out")).collect())

    assert run(once=True) == [0]
    assert run(processingTime="0 seconds") == [0, 20, 80]
    assert run(processingTime="0 seconds") == [0, 20, 80]


def test_offsets_of_a_list():
    reader = PagedStreamReader({"fetch": "tests.list_pages:gaps", "pause": "0", "size": "20"})
    rows, end = reader.read(reader.initialOffset())
    assert [at for at, _ in rows] == [0, 20, 80] and end == {"start": 160, "empty": 3}
    rows, again = reader.read(end)
    assert list(rows) == [] and again == end
    assert [at for at, _ in reader.readBetweenOffsets({"start": 20, "empty": 0}, end)] == [20, 80]
    items = PagedStreamReader({"fetch": "tests.list_pages:listing", "pause": "0"})
    rows, end = items.read(items.initialOffset())
    assert [at for at, _ in rows] == [0, 20] and end == {"start": 40, "empty": 3}


def test_a_stream_reads_only_what_is_new(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    schema = "text_md5 string, chars int"

    def add(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)
        read = dedupe.ingest(spark.readStream.schema(schema).parquet(source), sink, checkpoint)
        return read, sorted((r.text_md5 or "", r.chars) for r in spark.read.schema(schema).parquet(sink).collect())

    assert add(("a", 1), ("a", 1), (None, 3), ("b", 2)) == (4, [("", 3), ("a", 1), ("b", 2)])
    assert add(("b", 2), (None, 3), ("c", 4)) == (3, [("", 3), ("a", 1), ("b", 2), ("c", 4)])
    assert dedupe.ingest(spark.readStream.schema(schema).parquet(source), sink, checkpoint) == 0
