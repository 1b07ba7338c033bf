import json

import pytest
from pyspark.sql import functions as F

from lexweave.sources import corpus, records, sinks


def text_of(spark, base):
    version = sinks.current_version(spark, base)
    files = spark.read.text(version["path"], wholetext=True).withColumn("f", F.input_file_name())
    return "".join(r.value for r in files.orderBy("f").collect())


def test_story_export(spark, docs_of, base):
    df = docs_of([" First story.\r\n", "", "Second story.  "])
    want = "First story.\n<eos>\nSecond story.\n<eos>\n"
    assert sinks.write_stories(df, base, "doc_id") == (2, len(want))
    assert text_of(spark, base) == want


def test_blank_stories_leave_the_old_version(spark, docs_of, base):
    sinks.write_stories(docs_of(["old"]), base, "doc_id")
    with pytest.raises(ValueError, match="empty"):
        sinks.write_stories(docs_of([" \n"]), base, "doc_id")
    assert text_of(spark, base) == "old\n<eos>\n"
    sinks.write_stories(docs_of(["new"]), base, "doc_id")
    assert text_of(spark, base) == "new\n<eos>\n"


def test_raw_lines_keep_empty_rows(spark, docs_of, base):
    df = docs_of(["", " = Article = \r\n", "", " Article body. \n"])
    want = "\n = Article = \n\n Article body. \n"
    assert sinks.write_text_lines(df, base, "doc_id") == (4, len(want))
    assert text_of(spark, base) == want


def test_json_records_validate_before_writing(spark, base):
    good = spark.createDataFrame(
        [(0, "Add é.", "", "4"), (1, "Name", "x", "")],
        "rec_id BIGINT, instruction STRING, input STRING, output STRING",
    )
    fields = ["instruction", "input", "output"]

    def check(df):
        records.require_valid(df, "rec_id", records.instruction_rules())

    count, size = sinks.write_json_records(good, base, "rec_id", fields, check)
    body = text_of(spark, base)
    assert count == 2 and size == len(body.encode())
    assert [json.loads(line)["instruction"] for line in body.splitlines()] == ["Add é.", "Name"]
    bad = good.withColumn("input", F.when(F.col("rec_id") == 0, F.col("input")))
    with pytest.raises(records.RecordError, match="record 1: input"):
        sinks.write_json_records(bad, base, "rec_id", fields, check)
    assert text_of(spark, base) == body


def test_instruction_types_are_strict(spark):
    items = [
        {"instruction": "a", "input": "", "output": "b"},
        {"instruction": "a"},
        {"instruction": 5, "input": ["x"], "output": "b"},
        {"instruction": "   ", "input": "", "output": ""},
    ]
    lines = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(items)], "rec_id BIGINT, value STRING")
    parsed = records.parse_instruction_records(lines, F.try_parse_json("value"), "rec_id")
    found = records.violations(parsed, "rec_id", records.instruction_rules())
    assert sorted((r.rec_id, r.rule) for r in found.collect()) == [
        (1, "input_not_string"), (1, "output_not_string"),
        (2, "input_not_string"), (2, "instruction_not_string"),
        (3, "instruction_blank"),
    ]
    assert [r.rec_id for r in records.valid_rows(parsed, records.instruction_rules()).collect()] == [0]
    loose = records.violations(parsed, "rec_id", records.instruction_rules(False))
    assert 3 not in {r.rec_id for r in loose.collect()}


def test_choice_types_are_strict(spark):
    good = {"question": "What is 2 + 3?", "subject": "elementary_mathematics", "choices": list("4567"), "answer": 1}
    wrong = [
        {"answer": True}, {"answer": 4}, {"answer": "1"}, {"choices": ["4", "5"]},
        {"choices": ["4", 5, "6", "7"]}, {"choices": ["4", " ", "6", "7"]}, {"question": 5}, {"subject": " "},
    ]
    items = [good, *[{**good, **w} for w in wrong]]
    lines = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(items)], "idx BIGINT, value STRING")
    parsed = records.parse_choice_records(lines, F.try_parse_json("value"), "idx")
    found = records.violations(parsed, "idx", records.choice_rules())
    assert [(r.idx, r.rule) for r in found.orderBy("idx").collect()] == [
        (1, "answer_out_of_range"), (2, "answer_out_of_range"), (3, "answer_out_of_range"),
        (4, "choices_not_four"), (5, "choices_not_four"), (6, "choices_not_four"),
        (7, "question_blank"), (8, "subject_blank"),
    ]


def test_json_array_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"instruction": "x", "input": "", "output": "y"}] * 3))
    rows = records.read_json_arrays(spark, str(tmp_path / "a.json"))
    parsed = records.parse_instruction_records(rows, F.col("item"), "position")
    assert [r.position for r in parsed.orderBy("position").collect()] == [0, 1, 2]
    (tmp_path / "b.json").write_text("[]")
    with pytest.raises(Exception, match="non-empty JSON list"):
        records.read_json_arrays(spark, str(tmp_path / "b.json")).collect()


def test_ordered_lines_do_not_depend_on_splits(spark, tmp_path):
    wanted = {}
    for name, n in (("b", 700), ("a", 1), ("c", 900)):
        lines = [json.dumps({"prompt": f"{name} {i} " + "x" * (i * 37 % 200)}) for i in range(n)]
        (tmp_path / f"{name}.jsonl").write_text("\n".join(x + "\n" * (i % 3 == 0) for i, x in enumerate(lines)) + "\n")
        wanted[name] = lines
    flat = [(name, i, line) for name in sorted(wanted) for i, line in enumerate(wanted[name])]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1000", "7000", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = records.read_ordered_json_lines(spark, str(tmp_path)).orderBy("ord").collect()
            assert [r.ord for r in rows] == list(range(len(flat)))
            assert [(r.path[-7:-6], r.position, r.value) for r in rows] == flat
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "empty.jsonl").write_text("\n\n")
    assert records.read_ordered_json_lines(spark, str(tmp_path / "none")).count() == 0


def test_a_bad_prompt_stops_the_job(spark):
    def parsed(*items):
        lines = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(items)], "ord BIGINT, value STRING")
        return records.parse_prompts(lines, F.try_parse_json("value"), "ord", "completion")

    good = records.require_prompts(parsed("one", {"id": "x", "prompt": "two"}), "ord")
    assert [(r.id, r.prompt) for r in good.orderBy("ord").collect()] == [("prompt-1", "one"), ("x", "two")]
    with pytest.raises(records.RecordError, match="prompt item 1 has an invalid id"):
        records.require_prompts(parsed("one", {"id": "", "prompt": "two"}, 7), "ord")
    with pytest.raises(records.RecordError, match="empty"):
        records.require_prompts(parsed("one").limit(0), "ord")


def test_prompt_lists(spark):
    items = ["Once upon a time", {"prompt": "p"}, {"id": "x", "prompt": "q"}, {"id": 3, "prompt": "q"}, {"id": "y", "prompt": " "}, 7]
    lines = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(items)], "ord BIGINT, value STRING")
    parsed = records.parse_prompts(lines, F.try_parse_json("value"), "ord", "completion").orderBy("ord").collect()
    assert [(r.id, r.prompt) for r in parsed[:3]] == [("prompt-1", "Once upon a time"), ("prompt-2", "p"), ("x", "q")]
    assert [r.error for r in parsed[3:]] == ["has an invalid id", "requires non-empty string 'prompt'", "must be a JSON object"]
    items = [{"instruction": "do", "input": "i"}, {"instruction": "do"}, {"instruction": "do", "input": 5}, "text"]
    lines = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(items)], "ord BIGINT, value STRING")
    parsed = records.parse_prompts(lines, F.try_parse_json("value"), "ord", "instruction").orderBy("ord").collect()
    assert [r.input for r in parsed[:2]] == ["i", ""]
    assert [r.error for r in parsed] == [None, None, "input must be a string", "must be a JSON object"]


def test_corpus_guards(docs_of):
    with pytest.raises(corpus.EmptyCorpusError):
        corpus.require_corpus(docs_of(["", " \n"]))
    with pytest.raises(ValueError, match="<eos>"):
        corpus.require_markers(docs_of(["abc"]), "<eos>")
    corpus.require_markers(docs_of(["abc", "x<eos>"]), "<eos>")
    with pytest.raises(ValueError, match="positive"):
        corpus.first_stories(docs_of(["a"]), 0)
    assert [r.text for r in corpus.first_stories(docs_of(["", "b ", "c", "d"]), 2).collect()] == ["b", "c"]
    assert [r.text for r in corpus.raw_lines(docs_of(["a\r\nb\rc", ""])).orderBy("doc_id").collect()] == ["a\nb\nc", ""]


def test_split_scan_reads_one_partition(spark, docs_of, base):
    for split in ("train", "test"):
        docs_of([split]).withColumns({"config": F.lit("raw"), "split": F.lit(split)}).write.mode("append").partitionBy(
            "config", "split"
        ).parquet(base)
    one = corpus.read_split(spark, base, "doc_id BIGINT, text STRING", split="test", config="raw")
    assert [r.text for r in one.collect()] == ["test"]
    assert len(one.inputFiles()) >= 1 and "PartitionFilters: [isnotnull" in one._jdf.queryExecution().toString()


def test_markdown_report(spark):
    row = spark.createDataFrame(
        [(0, "p", 1, 42, "Say ```", "", "Hi")],
        "ord INT, id STRING, sample INT, seed INT, prompt STRING, input STRING, output STRING",
    )
    section = sinks.markdown_sections(row, "ord").first().section
    assert section == (
        "## p (sample 1, seed 42)\n\nPrompt:\n\n````text\nSay ```\n````\n\n"
        "Model output:\n\n```text\nHi\n```\n\n"
    )
    settings = dict.fromkeys(sinks.REPORT_SETTINGS, "x")
    assert sinks.markdown_header(settings).startswith("# Samples of generated text\n\n- Checkpoint: `x`\n")
