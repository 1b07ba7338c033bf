"""Registered queries: sources, sinks, normalisation, validation, pre-tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import tokens as K
from ..operators.choice_eval import select_subjects
from ..session import fresh_path
from ..sources import corpus, records, sinks
from ..streaming.ingest import start_checked_ingest, start_story_ingest
from . import sql as S
from .merge_sql import WORDS
from .views import choice_records, dealt_documents, document_stream, documents, instruction_records, pseudo_scores

QUERIES, ORACLES = {}, {}


def query(name, oracle=None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


# --- sources ----------------------------------------------------------------------


@query(
    "scan_corpus",
    """select lang, count(*) as n_docs, sum(length(text))::BIGINT as n_chars,
         sum(strlen(text))::BIGINT as n_bytes from documents group by lang""",
)
def scan_corpus(spark, sf):
    return corpus.corpus_profile(corpus.require_corpus(documents(spark, sf)), "lang")


STORY_LIMIT = 500


@query(
    "stories_limit",
    f"""select doc_id, trim(text, ' ' || chr(10) || chr(13) || chr(9)) as text from documents
        where length(trim(text, ' ' || chr(10) || chr(13) || chr(9))) > 0
        order by doc_id limit {STORY_LIMIT}""",
)
def stories_limit(spark, sf):
    return corpus.first_stories(documents(spark, sf).select("doc_id", "text"), STORY_LIMIT)


def _wild(df):
    """Documents with foreign newlines and blanks around them."""
    raw = F.concat(F.lit(" \r\n\t"), F.replace("text", F.lit("\n"), F.lit("\r\n")), F.lit("\r \n"))
    return df.select("doc_id", raw.alias("text"))


@query(
    "wikitext_lines",
    """select doc_id, ' ' || chr(10) || chr(9) || text || chr(10) || ' ' || chr(10) as text
       from documents""",
)
def wikitext_lines(spark, sf):
    return corpus.raw_lines(_wild(documents(spark, sf)))


@query("alpaca_scan", f"with {S.INSTRUCT} select rec_id, instruction, input, output from instruct")
def alpaca_scan(spark, sf):
    rows = instruction_records(spark, sf)
    lines = rows.select("rec_id", F.to_json(F.struct("instruction", "input", "output")).alias("value"))
    return records.parse_instruction_records(lines, F.try_parse_json("value"), "rec_id")


@query(
    "mmlu_scan",
    f"""with {S.CHOICE} select idx, question, subject, array_to_string(choices, '|') as choices,
        answer from mc where {S.MC_OK}""",
)
def mmlu_scan(spark, sf):
    rows = choice_records(spark, sf)
    item = F.to_json(F.struct("question", "subject", "choices", "answer"))
    lines = rows.select("idx", item.alias("value"))
    parsed = records.parse_choice_records(lines, F.try_parse_json("value"), "idx")
    good = records.valid_rows(parsed, records.choice_rules())
    return good.withColumn("choices", F.array_join("choices", "|"))


@query(
    "prompts_normalize",
    """select doc_id as ord, case when doc_id % 3 = 1 then 'bench-' || doc_id
         else 'prompt-' || (doc_id + 1) end as id, text as prompt, '' as input from documents""",
)
def prompts_normalize(spark, sf):
    quoted = F.expr("substring(to_json(array(text)), 2, length(to_json(array(text))) - 2)")
    named = F.to_json(
        F.struct(F.concat(F.lit("bench-"), F.col("doc_id").cast("string")).alias("id"), F.col("text").alias("prompt"))
    )
    kind = F.col("doc_id") % 3
    item = F.when(kind == 0, quoted).when(kind == 1, named).otherwise(
        F.to_json(F.struct(F.col("text").alias("prompt")))
    )
    rows = documents(spark, sf).select(F.col("doc_id").alias("ord"), item.alias("value"))
    parsed = records.parse_prompts(rows, F.try_parse_json("value"), "ord", "completion")
    return records.require_prompts(parsed, "ord")


@query(
    "ordered_lines",
    f"""with {S.INSTRUCT} select row_number() over (order by rec_id) - 1 as ord, rec_id, instruction, input, output
        from instruct""",
)
def ordered_lines(spark, sf):
    out = fresh_path(spark, "records")
    rows = instruction_records(spark, sf)
    sinks.write_json_records(rows, out, "rec_id", ["rec_id", "instruction", "input", "output"])
    lines = records.read_ordered_json_lines(spark, sinks.current_version(spark, out)["path"])
    item = F.try_parse_json("value")
    given = lines.withColumn("rec_id", F.try_variant_get(item, "$.rec_id", "long"))
    return records.parse_instruction_records(given, item, "ord", "rec_id")


@query(
    "stream_ingest",
    """select doc_id, trim(text, ' ' || chr(10)) as text, lang, source, n_chars from documents
       where length(trim(text, ' ' || chr(10))) > 0""",
)
def stream_ingest(spark, sf):
    out = fresh_path(spark, "ingest")
    stream = document_stream(spark, sf)
    start_story_ingest(stream, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    return corpus.read_documents(spark, f"{out}/data")


#: Characters of the longest text the checked ingest takes.
LONGEST = 2_000


@query(
    "stream_rejects",
    f"""select doc_id, case when text is null then 'text_missing' when length(text) > {LONGEST} then 'text_too_long'
          when n_chars is distinct from length(text) then 'n_chars_wrong' else '' end as rules,
          case when length(text) > {LONGEST} or n_chars is distinct from length(text) then text
            else trim(text, ' ' || chr(10)) end as text from documents
        where text is null or length(text) > {LONGEST} or n_chars is distinct from length(text)
          or length(trim(text, ' ' || chr(10))) > 0""",
)
def stream_rejects(spark, sf):
    out = fresh_path(spark, "checked-ingest")
    rules = [
        *records.text_rules(),
        ("text_too_long", F.length("text") > LONGEST),
        ("n_chars_wrong", ~F.col("n_chars").eqNullSafe(F.length("text")) & (F.length("text") <= LONGEST)),
    ]
    stream = document_stream(spark, sf)
    start_checked_ingest(stream, f"{out}/data", f"{out}/rejects", f"{out}/checkpoint", rules).awaitTermination()
    good = corpus.read_documents(spark, f"{out}/data").withColumn("rules", F.lit(""))
    bad = spark.read.parquet(f"{out}/rejects").withColumn("rules", F.array_join("rules", ","))
    names = ("doc_id", "rules", "text")
    return good.select(*names).unionByName(bad.select(*names))


# --- sinks ------------------------------------------------------------------------


@query(
    "story_export",
    """select doc_id, text || chr(10) || '<eos>' || chr(10) as chunk,
         (length(text) + 7)::BIGINT as n_chars from documents where length(text) > 0""",
)
def story_export(spark, sf):
    return sinks.story_rows(_wild(documents(spark, sf)), "doc_id")


@query(
    "line_export",
    """select doc_id, case when doc_id % 2 = 0 then text || chr(10) else text || chr(10) end as chunk,
         (length(text) + 1)::BIGINT as n_chars from documents""",
)
def line_export(spark, sf):
    ended = F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit("\r\n"))).otherwise(F.col("text"))
    return sinks.line_rows(documents(spark, sf).withColumn("text", ended), "doc_id")


@query(
    "json_export",
    f"""with {S.INSTRUCT}, j as (select rec_id,
          to_json({{'instruction': instruction, 'input': input, 'output': output}})::VARCHAR as json
        from instruct) select rec_id, json, strlen(json)::BIGINT as n_bytes from j""",
)
def json_export(spark, sf):
    rows = instruction_records(spark, sf)
    return sinks.json_rows(rows, "rec_id", "instruction", "input", "output")


@query(
    "predictions_jsonl",
    f"""with {S.PREDICTED} select idx as "index", to_json({{'index': idx, 'subject': subject,
          'gold': answer, 'gold_label': {S.LABEL}[answer + 1], 'predicted': predicted,
          'predicted_label': {S.LABEL}[predicted + 1], 'correct': correct,
          'choices': choices}})::VARCHAR as json from judged""",
)
def predictions_jsonl(spark, sf):
    from .choice_queries import predicted

    fields = ("index", "subject", "gold", "gold_label", "predicted", "predicted_label", "correct", "choices")
    return sinks.json_rows(predicted(spark, sf), "index", *fields).select("index", "json")


def _fence(column: str) -> str:
    run = f"coalesce(list_max(list_transform(regexp_extract_all({column}, '`+'), lambda x: length(x))), 0)"
    tick = f"repeat('`', greatest(3, {run} + 1)::BIGINT)"
    return f"{tick} || 'text' || chr(10) || {column} || chr(10) || {tick}"


@query(
    "sample_markdown",
    f"""with {S.INSTRUCT}, q as (select rec_id, instruction,
          case when rec_id % 2 = 0 then input else replace(input, ' ', '`````') end as input,
          replace(output, 'e', '```') as output from instruct)
        select rec_id as ord, '## rec-' || rec_id || ' (sample 1, seed ' || (rec_id + 42) || ')'
          || chr(10) || chr(10) || 'Prompt:' || chr(10) || chr(10) || {_fence('instruction')}
          || chr(10) || chr(10)
          || case when length(input) > 0 then 'Input:' || chr(10) || chr(10) || {_fence('input')}
               || chr(10) || chr(10) else '' end
          || 'Model output:' || chr(10) || chr(10) || {_fence('output')} || chr(10) || chr(10)
          as section from q""",
)
def sample_markdown(spark, sf):
    even = F.col("rec_id") % 2 == 0
    rows = instruction_records(spark, sf).select(
        F.col("rec_id").alias("ord"),
        F.concat(F.lit("rec-"), F.col("rec_id").cast("string")).alias("id"),
        F.lit(1).alias("sample"),
        (F.col("rec_id") + 42).alias("seed"),
        F.col("instruction").alias("prompt"),
        F.when(even, F.col("input")).otherwise(F.replace("input", F.lit(" "), F.lit("`````"))).alias("input"),
        F.replace("output", F.lit("e"), F.lit("```")).alias("output"),
    )
    return sinks.markdown_sections(rows, "ord")


# --- normalisation and validation -------------------------------------------------


@query(
    "normalize_text",
    """with w as (select doc_id, ' ' || chr(13) || chr(10) || chr(9)
           || replace(text, chr(10), chr(13) || chr(10)) || chr(13) || ' ' || chr(10) as raw
         from documents)
       select doc_id, trim(replace(replace(raw, chr(13) || chr(10), chr(10)), chr(13), chr(10)),
           ' ' || chr(10) || chr(9)) as text,
         (length(raw) - length(trim(replace(replace(raw, chr(13) || chr(10), chr(10)), chr(13), chr(10)),
           ' ' || chr(10) || chr(9))))::INTEGER as n_removed from w""",
)
def normalize_text(spark, sf):
    raw = _wild(documents(spark, sf))
    return raw.select(
        "doc_id",
        T.normalize_text(F.col("text")).alias("text"),
        (F.length("text") - F.length(T.normalize_text(F.col("text")))).alias("n_removed"),
    )


@query(
    "drop_empty",
    "select doc_id, text from documents where n_chars % 4 <> 0 and length(text) > 0",
)
def drop_empty(spark, sf):
    blanked = F.when(F.col("n_chars") % 4 == 0, F.lit(" \r\n \t")).otherwise(F.col("text"))
    rows = documents(spark, sf).select("doc_id", blanked.alias("text"))
    return corpus.non_empty_stories(rows)


@query(
    "validate_text",
    """select doc_id, 'text_missing' as rule, 'record ' || doc_id || ': text missing' as message
       from documents where n_chars % 5 = 0""",
)
def validate_text(spark, sf):
    holes = F.when(F.col("n_chars") % 5 != 0, F.col("text"))
    rows = documents(spark, sf).select("doc_id", holes.alias("text"))
    return records.violations(rows, "doc_id", records.text_rules())


@query(
    "validate_alpaca",
    f"""with {S.INSTRUCT}, v as (
          select rec_id, 'input_not_string' as rule from instruct where rec_id % 7 = 0
          union all select rec_id, 'output_not_string' from instruct where rec_id % 11 = 0
          union all select rec_id, 'instruction_not_string' from instruct where rec_id % 13 = 0
          union all select rec_id, 'instruction_blank' from instruct
            where rec_id % 5 = 0 and rec_id % 13 <> 0)
        select rec_id, rule, 'record ' || rec_id || ': ' || replace(rule, '_', ' ') as message from v""",
)
def validate_alpaca(spark, sf):
    key = F.col("rec_id")
    faulty = instruction_records(spark, sf).select(
        "rec_id",
        F.to_json(
            F.struct(
                F.when(key % 13 == 0, F.lit(None)).when(key % 5 == 0, " \r\n ")
                .otherwise(F.col("instruction")).alias("instruction"),
                F.when(key % 7 != 0, F.col("input")).alias("input"),
                F.when(key % 11 != 0, F.col("output")).alias("output"),
            )
        ).alias("value"),
    )
    parsed = records.parse_instruction_records(faulty, F.try_parse_json("value"), "rec_id")
    return records.violations(parsed, "rec_id", records.instruction_rules())


@query(
    "validate_mmlu",
    f"""with {S.CHOICE}, v as (
          select idx, 'choices_not_four' as rule from mc where len(choices) <> 4 or idx % 11 = 0
          union all select idx, 'answer_out_of_range' from mc where answer + (idx % 2) > 3
          union all select idx, 'subject_blank' from mc where idx % 13 = 0)
        select idx, rule, 'record ' || idx || ': ' || replace(rule, '_', ' ') as message from v""",
)
def validate_mmlu(spark, sf):
    key = F.col("idx")
    rows = choice_records(spark, sf).select(
        "idx",
        "question",
        F.when(key % 13 == 0, "\t").otherwise(F.col("subject")).alias("subject"),
        F.when(key % 11 == 0, F.transform("choices", lambda c: F.lit(" ")))
        .otherwise(F.col("choices")).alias("choices"),
        (F.col("answer") + key % 2).cast("int").alias("answer"),
    )
    return records.violations(rows, "idx", records.choice_rules())


@query(
    "contains_marker",
    """select lang, count(*) as n_docs, count(*) filter (where contains(text, ' the ')) as n_hits,
         bool_or(contains(text, ' the ')) as found from documents group by lang""",
)
def contains_marker(spark, sf):
    return corpus.contains_text(documents(spark, sf), " the ", "lang")


@query(
    "subject_filter",
    f"""with {S.CHOICE} select idx, subject, answer from mc
        where subject in ('en_grp_0', 'de_grp_2', 'fr_grp_1')""",
)
def subject_filter(spark, sf):
    picked = select_subjects(choice_records(spark, sf), ["en_grp_0", "de_grp_2", "fr_grp_1"])
    return picked.select("idx", "subject", "answer")


LIMIT = 100


@query(
    "mmlu_limit",
    f"""with {S.CHOICE}, ok as (select * from mc where {S.MC_OK})
        select idx, subject, (select count(*) from ok) as selected_before_limit
        from ok order by idx limit {LIMIT}""",
)
def mmlu_limit(spark, sf):
    good = records.valid_rows(choice_records(spark, sf), records.choice_rules())
    first = corpus.ordered_limit(good.select("idx", "subject"), LIMIT, "idx")
    return first.withColumn("selected_before_limit", good.agg(F.count("*")).scalar())


# --- pre-tokens and bytes ---------------------------------------------------------

_HISTOGRAM = f"hist as (select word, count(*) as n from (select unnest({WORDS}) as word from documents) group by word)"


@query(
    "pretokenize",
    f"""select doc_id, len({WORDS})::INTEGER as n_words,
          md5(array_to_string({WORDS}, '|')) as words_md5 from documents""",
)
def pretokenize(spark, sf):
    found = dealt_documents(spark, sf).select("doc_id", T.pretokens(F.col("text")).alias("w"))
    return found.select(
        "doc_id", F.size("w").alias("n_words"), F.md5(F.array_join("w", "|")).alias("words_md5")
    )


@query("word_histogram", f"with {_HISTOGRAM} select word, n from hist")
def word_histogram(spark, sf):
    from ..operators.vocabulary import word_histogram as histogram

    return histogram(dealt_documents(spark, sf))


@query(
    "byte_alphabet",
    f"""with h as (select ('0x' || unnest(regexp_extract_all(hex(encode(text)), '..')))::INTEGER as b
          from documents)
        select b as byte, ({S.ID})::INTEGER as token_id, count(*) as n from h group by b""",
)
def byte_alphabet(spark, sf):
    used = dealt_documents(spark, sf).select(
        F.explode(K.symbol_chars(K.plain_byte_symbols(F.col("text")))).alias("s")
    )
    counts = used.groupBy(K.symbol_id(F.col("s")).alias("token_id")).agg(F.count("*").alias("n"))
    alphabet = spark.range(256).select(F.col("id").cast("int").alias("byte")).withColumn(
        "token_id", K.byte_id(F.col("byte"))
    )
    return alphabet.join(counts, "token_id").select("byte", "token_id", "n")


@query(
    "pair_counts",
    f"""with {_HISTOGRAM}, c as (select {S.ids('word')} as t, n from hist),
        p as (select unnest(list_zip(t[:-2], t[2:])) as p, n from c where len(t) > 1)
        select p[1] as left_id, p[2] as right_id, sum(n)::BIGINT as n from p group by 1, 2""",
)
def pair_counts(spark, sf):
    from ..operators.vocabulary import pair_counts as pairs
    from ..operators.vocabulary import word_histogram as histogram

    return pairs(histogram(dealt_documents(spark, sf)))


@query(
    "token_counts",
    f"""select doc_id, length(text)::INTEGER as n_chars, strlen(text)::INTEGER as n_byte_tokens,
          len({WORDS})::INTEGER as n_words from documents""",
)
def token_counts(spark, sf):
    return documents(spark, sf).select(
        "doc_id",
        F.length("text").alias("n_chars"),
        K.byte_token_count(F.col("text")).alias("n_byte_tokens"),
        F.size(T.pretokens(F.col("text"))).alias("n_words"),
    )
