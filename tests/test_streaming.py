from pathlib import Path

from pyspark.sql import functions as F

from lexweave.sources.corpus import DOCUMENT_SCHEMA, non_empty_stories
from lexweave.sources.records import text_rules
from lexweave.streaming.ingest import ingest_progress, read_document_stream, start_checked_ingest, start_story_ingest

SCHEMA = "doc_id BIGINT, text STRING"


def test_streaming_equals_batch_and_runs_once(spark, docs_of, base):
    texts = [" a\r\n", "", "b", " \n", "c　"]
    source = docs_of(texts)
    for i in range(3):
        source.withColumn("doc_id", source.doc_id + 10 * i).coalesce(1).write.mode("append").parquet(f"{base}/in")

    def run():
        stream = read_document_stream(spark, f"{base}/in", schema=SCHEMA, files_per_trigger=1)
        query = start_story_ingest(stream, f"{base}/out", f"{base}/ck")
        query.awaitTermination()
        return query

    first = run()
    assert ingest_progress(first)["input_rows"] == 15
    batch = non_empty_stories(spark.read.schema(SCHEMA).parquet(f"{base}/in"))
    assert sorted(spark.read.parquet(f"{base}/out").collect()) == sorted(batch.collect())
    run()
    assert spark.read.parquet(f"{base}/out").count() == 9


def test_rejects_land_once_also_after_a_replayed_batch(spark, docs_of, base):
    texts = ["a ", None, "", "far too long", "b"]
    for i in range(3):
        rows = docs_of(texts)
        rows.withColumn("doc_id", rows.doc_id + 10 * i).coalesce(1).write.mode("append").parquet(f"{base}/in")
    rules = [*text_rules(), ("text_too_long", F.length("text") > 5), ("text_with_blank", F.contains("text", F.lit(" far ")))]

    def run():
        stream = read_document_stream(spark, f"{base}/in", schema=SCHEMA, files_per_trigger=1)
        start_checked_ingest(stream, f"{base}/good", f"{base}/bad", f"{base}/ck", rules).awaitTermination()
        good = sorted(tuple(r) for r in spark.read.parquet(f"{base}/good").select("doc_id", "text").collect())
        bad = spark.read.parquet(f"{base}/bad").orderBy("doc_id").collect()
        return good, [(r.doc_id, r.text, r.rules) for r in bad], {r.batch_id for r in bad}

    good = [(10 * i + k, t) for i in range(3) for k, t in ((0, "a"), (4, "b"))]
    bad = [(10 * i + k, t, [r]) for i in range(3) for k, t, r in ((1, None, "text_missing"), (3, "far too long", "text_too_long"))]
    assert run() == (good, bad, {0, 1, 2})
    assert run() == (good, bad, {0, 1, 2})
    # the last batch was written but not committed: it runs again
    for name in ("2", ".2.crc"):
        found = Path(base, "ck", "commits", name)
        if found.exists():
            found.unlink()
    assert run() == (good, bad, {0, 1, 2})


def test_the_documents_table_streams_as_a_file_and_as_a_folder(spark, tmp_path):
    from lexweave.plans.text_queries import QUERIES

    rows = spark.createDataFrame(
        [(1, " a\n", "en", "s", 3), (2, None, "en", "s", 0), (3, "bb", "en", "s", 9)], DOCUMENT_SCHEMA
    )
    folder, file = tmp_path / "folder", tmp_path / "file"
    rows.repartition(2).write.parquet(str(folder / "documents.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    file.mkdir()
    next((tmp_path / "one").glob("part-*")).rename(file / "documents.parquet")
    for base in (folder, file):
        checked = QUERIES["stream_rejects"](spark, str(base)).collect()
        assert {(r.doc_id, r.rules, r.text) for r in checked} == {
            (1, "", "a"), (2, "text_missing", None), (3, "n_chars_wrong", "bb")
        }
        assert {r.doc_id for r in QUERIES["stream_ingest"](spark, str(base)).collect()} == {1, 3}
