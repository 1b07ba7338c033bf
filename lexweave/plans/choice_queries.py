"""Registered queries: multiple-choice evaluation and result reports."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..constants import BYTE_VOCAB_SIZE, CHOICE_HEADER, CHOICE_LABELS, EOS_ID
from ..functions import prompts as P
from ..functions.tokens import byte_ids, byte_token_count, take_last
from ..operators import choice_eval as C
from ..operators import reports as R
from ..operators.encoding import piecewise_count_udf
from ..operators.ngram import NgramModel, ngram_rows, score_continuations
from ..operators.ordering import rank_before
from ..sources import records
from . import merge_sql as M
from . import sql as S
from .eval_queries import _JOIN_MODEL, _LOGP, _MODEL
from .instruct_queries import _PLAIN
from .token_queries import LEARNED, learned_vocabulary
from .views import NEWLINE_ID, choice_records, pseudo_scores, story_stream

QUERIES, ORACLES = {}, {}
SHOTS, BLOCK = 3, 8000


def query(name, oracle=None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def valid(spark, sf, split: str):
    rows = choice_records(spark, sf).filter(F.col("split") == split)
    return records.valid_rows(rows, records.choice_rules())


def predicted(spark, sf, salt: int = 0):
    """Predictions of the test questions under arithmetic scores."""
    test = valid(spark, sf, "test")
    return C.predictions(test.withColumn("scores", pseudo_scores(F.col("idx"), salt)))


def _example(answer: bool, prefix: str = "") -> str:
    c = f"{prefix}choices"
    tail = f" ' ' || {S.LABEL}[{prefix}answer + 1] ||" if answer else ""
    return (
        f"(trim({prefix}question) || chr(10) || 'A. ' || {c}[1] || chr(10) || 'B. ' || {c}[2] || chr(10)"
        f" || 'C. ' || {c}[3] || chr(10) || 'D. ' || {c}[4] || chr(10) || 'Answer:' ||{tail} chr(10) || chr(10))"
    )


_QUESTION = _example(False).replace(" chr(10) || chr(10))", " '')")
_HEADER = f"'{CHOICE_HEADER}' || replace(subject, '_', ' ') || '.' || chr(10) || chr(10)"
_OK = f"""{S.CHOICE}, ok as (select * from mc where {S.MC_OK}),
test as (select * from ok where split = 'test'), dev as (select * from ok where split = 'dev')"""
_DEMOS = f"""{_OK},
top as (select *, row_number() over (partition by subject order by idx) as rn from dev),
demo as (select subject, list({_example(True)} order by rn) as demos from top where rn <= {SHOTS} group by subject),
shot as (select test.*, coalesce(demos, []) as demos from test left join demo using (subject))"""


@query(
    "mmlu_example",
    f"with {_OK} select idx, {_example(True)} as with_answer, {_example(False)} as without_answer from ok",
)
def mmlu_example(spark, sf):
    rows = records.valid_rows(choice_records(spark, sf), records.choice_rules())
    q, c = F.col("question"), F.col("choices")
    return rows.select(
        "idx",
        P.choice_example(q, c, F.col("answer")).alias("with_answer"),
        P.choice_example(q, c).alias("without_answer"),
    )


@query(
    "mmlu_prompt",
    f"""with {_DEMOS}, p as (select idx, {_HEADER} || array_to_string(demos, '') || {_QUESTION} as prompt from shot)
        select idx, length(prompt)::INTEGER as n_chars, md5(prompt) as prompt_md5 from p""",
)
def mmlu_prompt(spark, sf):
    rows = C.with_demonstrations(valid(spark, sf, "test"), valid(spark, sf, "dev"), SHOTS)
    prompt = P.choice_prompt(F.col("subject"), F.col("question"), F.col("choices"), F.col("demos"))
    rows = rows.select("idx", prompt.alias("prompt"))
    return rows.select("idx", F.length("prompt").alias("n_chars"), F.md5("prompt").alias("prompt_md5"))


@query(
    "demos_by_subject",
    f"""with {_OK} select subject, row_number() over (partition by subject order by idx) - 1 as ord, idx
        from dev""",
)
def demos_by_subject(spark, sf):
    return C.by_subject(valid(spark, sf, "dev")).select("subject", "ord", "idx")


@query(
    "few_shot_join",
    f"""with {_DEMOS} select idx, subject, len(demos)::INTEGER as n_demos,
          len(demos) < {SHOTS} as short, md5(array_to_string(demos, '')) as demos_md5 from shot""",
)
def few_shot_join(spark, sf):
    rows = C.with_demonstrations(valid(spark, sf, "test"), valid(spark, sf, "dev"), SHOTS)
    return rows.select(
        "idx", "subject", "n_demos", (F.col("n_demos") < SHOTS).alias("short"),
        F.md5(F.array_join("demos", "")).alias("demos_md5"),
    )


_FIT = f"""{_DEMOS},
tries as (select idx, k, {_HEADER} || array_to_string(list_slice(demos, 1, k), '') || {_QUESTION} as prompt
  from (select *, unnest(range(0, len(demos) + 1)) as k from shot)),
sized as (select *, strlen(prompt) as size, max(k) filter (where strlen(prompt) <= {BLOCK}) over (partition by idx) as best
  from tries),
fit as (select idx, k::INTEGER as effective_shots, prompt, size::INTEGER as prompt_size, size > {BLOCK} as prompt_left_truncated
  from sized where k = coalesce(best, 0))"""


def fitted(spark, sf):
    rows = C.with_demonstrations(valid(spark, sf, "test"), valid(spark, sf, "dev"), SHOTS)
    return C.fit_few_shot(rows, BLOCK, F.lit("completion"), byte_token_count)


@query(
    "fit_few_shot",
    f"""with {_FIT} select idx, effective_shots, prompt_size, prompt_left_truncated,
          md5(prompt) as prompt_md5 from fit""",
)
def fit_few_shot(spark, sf):
    return fitted(spark, sf).select(
        "idx", "effective_shots", "prompt_size", "prompt_left_truncated", F.md5("prompt").alias("prompt_md5")
    )


_BPE_FIT = f"""{LEARNED}, {_DEMOS.strip()},
tries as (select idx, k, {_HEADER} || array_to_string(list_slice(demos, 1, k), '') || {_QUESTION} as prompt
  from (select *, unnest(range(0, len(demos) + 1)) as k from shot)),
texts as materialized (select idx * {SHOTS + 1} + k as key, prompt as text from tries),
{M.encoded('texts', 'sizes')},
sized as (select tries.*, length(s) as size,
    max(k) filter (where length(s) <= {BLOCK // 2}) over (partition by idx) as best
  from tries join sizes on key = idx * {SHOTS + 1} + k)"""


@query(
    "fit_few_shot_bpe",
    f"""with {_BPE_FIT} select idx, k::INTEGER as effective_shots, size::INTEGER as prompt_size,
          size > {BLOCK // 2} as prompt_left_truncated, md5(prompt) as prompt_md5
        from sized where k = coalesce(best, 0)""",
)
def fit_few_shot_bpe(spark, sf):
    rows = C.with_demonstrations(valid(spark, sf, "test"), valid(spark, sf, "dev"), SHOTS)
    count = piecewise_count_udf(learned_vocabulary(spark, sf))
    best = C.fit_few_shot_pieces(rows, BLOCK // 2, F.lit("completion"), count)
    return best.select(
        "idx", "effective_shots", "prompt_size", "prompt_left_truncated", F.md5("prompt").alias("prompt_md5")
    )


_MODE = """case when idx % 3 = 0 then 'completion' when idx % 3 = 1 then 'instruction'
  when lang = 'en' then 'instruction' else 'completion' end"""
_BODY = f"({_HEADER} || {_QUESTION})"
_MODED = f"""{_OK}, m as (select test.*, {_MODE} as mode from test join documents on doc_id = idx),
asked as (select idx, mode, case when mode = 'instruction'
    then {_PLAIN.replace("instruction ||", "trim(" + _BODY + ") ||")} else {_BODY} end as prompt from m)"""


def asked(spark, sf):
    """Test prompts in their mode: asked for, or following the training stage."""
    test = valid(spark, sf, "test")
    kind = F.col("idx") % 3
    requested = F.when(kind == 0, "completion").when(kind == 1, "instruction").otherwise("auto")
    stage = F.when(F.col("subject").startswith("en"), "sft").otherwise("pretrain")
    rows = test.withColumn("mode", P.resolve_mode(requested, stage))
    prompt = P.choice_prompt(F.col("subject"), F.col("question"), F.col("choices"))
    return rows.withColumn("prompt", P.in_mode(prompt, F.col("mode")))


@query(
    "prompt_mode",
    f"""with {_MODED} select idx, mode, md5(prompt) as prompt_md5,
          case when mode = 'instruction' then 'A' else ' A' end as first_continuation from asked""",
)
def prompt_mode(spark, sf):
    return asked(spark, sf).select(
        "idx", "mode", F.md5("prompt").alias("prompt_md5"),
        P.answer_continuation(F.lit("A"), F.col("mode")).alias("first_continuation"),
    )


CONTEXT = 512


@query(
    "left_truncate",
    f"""with {_MODED}, i as (select idx, {S.ids('prompt')} as t from asked)
        select idx, len(t)::INTEGER as prompt_tokens, least(len(t), {CONTEXT})::INTEGER as kept_tokens,
          md5(array_to_string(list_slice(t, greatest(1, len(t) - {CONTEXT} + 1), len(t)), ',')) as context_md5 from i""",
)
def left_truncate(spark, sf):
    rows = asked(spark, sf).select("idx", byte_ids(F.col("prompt")).alias("ids"))
    kept = rows.withColumn("kept", take_last(F.col("ids"), CONTEXT))
    return kept.select(
        "idx", F.size("ids").alias("prompt_tokens"), F.size("kept").alias("kept_tokens"),
        F.md5(F.array_join("kept", ",")).alias("context_md5"),
    )


_models: dict[tuple[str, str], NgramModel] = {}


def corpus_model(spark, sf) -> NgramModel:
    """N-gram model of the whole exported corpus, fitted once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _models:
        stream = story_stream(spark, sf)
        marker = F.array(F.lit(EOS_ID), F.lit(NEWLINE_ID))
        context = F.when(F.col("start_pos") > 0, marker).otherwise(F.array().cast("array<int>"))
        _models[key] = NgramModel.fit(ngram_rows(stream, context=context), BYTE_VOCAB_SIZE)
    return _models[key]


def continuation_items(spark, sf):
    """Prompt tokens within the model's context, encoded once per item, and candidates."""
    context = take_last(byte_ids(F.col("prompt")), CONTEXT)
    rows = asked(spark, sf).select("idx", "mode", context.alias("prompt_ids"))
    return C.candidates(rows, F.col("mode")).withColumn("candidate_ids", byte_ids(F.col("continuation")))


_WHOLE = f"""train as (select tok, lag(tok) over (order by pos) as c1, lag(tok, 2) over (order by pos) as c2 from tokens),
{_MODEL}"""
_CONTINUED = f"""{_MODED}, {S.STREAM.strip()}, {_WHOLE},
cand as (select idx, l - 1 as label_index, {S.ids('right(prompt, 2)')} as tail,
    {S.ids("case when mode = 'instruction' then '' else ' ' end || (['A', 'B', 'C', 'D'])[l]")} as c
  from asked, range(1, 5) r(l)),
e as (select idx, label_index, unnest(range(len(c))) as i, list_concat(tail, c) as s, c from cand),
rows_ as (select idx, label_index, s[i + 1] as c2, s[i + 2] as c1, s[i + 3] as tok from e),
said as (select e.idx, e.label_index, {_LOGP} as logp from rows_ e {_JOIN_MODEL})"""


@query(
    "continuation_scores",
    f"""with {_CONTINUED} select idx, label_index::INTEGER as label_index, round(sum(logp), 6) as score,
          count(*) as positions from said group by 1, 2""",
)
def continuation_scores(spark, sf):
    scored = score_continuations(
        continuation_items(spark, sf), corpus_model(spark, sf), "idx", "label_index"
    )
    return scored.withColumn("score", F.round("score", 6))


@query(
    "mmlu_predict",
    f"""with {S.PREDICTED} select idx as "index", predicted, {S.LABEL}[predicted + 1] as predicted_label
        from judged""",
)
def mmlu_predict(spark, sf):
    return predicted(spark, sf).select("index", "predicted", "predicted_label")


@query(
    "mmlu_predictions",
    f"""with {_FIT}, scored as (select test.*, {S.scores()} as s from test),
        p as (select *, (list_position(s, list_max(s)) - 1)::INTEGER as predicted from scored)
        select p.idx as "index", subject, answer as gold, {S.LABEL}[answer + 1] as gold_label, predicted,
          {S.LABEL}[predicted + 1] as predicted_label, predicted = answer as correct,
          s[1] as score_a, s[2] as score_b, s[3] as score_c, s[4] as score_d,
          prompt_size as prompt_tokens, effective_shots, prompt_left_truncated
        from p join fit on fit.idx = p.idx""",
)
def mmlu_predictions(spark, sf):
    preds = full_predictions(spark, sf)
    label = lambda l: F.element_at("choice_log_likelihoods", l)
    return preds.select(
        "index", "subject", "gold", "gold_label", "predicted", "predicted_label", "correct",
        label("A").alias("score_a"), label("B").alias("score_b"),
        label("C").alias("score_c"), label("D").alias("score_d"),
        "prompt_tokens", "effective_shots", "prompt_left_truncated",
    )


def full_predictions(spark, sf):
    return C.predictions(fitted(spark, sf).withColumn("scores", pseudo_scores(F.col("idx"))))


@query(
    "mmlu_summary",
    f"""with {S.PREDICTED} select count(*) as total, count(*) filter (where correct) as correct,
          round(count(*) filter (where correct) / count(*)::DOUBLE, 6) as accuracy from judged""",
)
def mmlu_summary(spark, sf):
    return C.accuracy_summary(predicted(spark, sf)).withColumn("accuracy", F.round("accuracy", 6))


@query(
    "mmlu_ngram_predictions",
    f"""with {_CONTINUED}, cs as (select idx, label_index, round(sum(logp), 9) as score from said group by 1, 2),
        l as (select idx, list(score order by label_index) as s from cs group by 1)
        select l.idx as "index", answer as gold, (list_position(s, list_max(s)) - 1)::INTEGER as predicted,
          list_position(s, list_max(s)) - 1 = answer as correct, round(s[1], 6) as score_a, round(s[4], 6) as score_d
        from l join test on test.idx = l.idx""",
)
def mmlu_ngram_predictions(spark, sf):
    scored = score_continuations(
        continuation_items(spark, sf), corpus_model(spark, sf), "idx", "label_index"
    ).withColumn("score", F.round("score", 9))
    rows = valid(spark, sf, "test").join(C.label_scores(scored, "idx"), "idx")
    preds = C.predictions(rows)
    return preds.select(
        "index", "gold", "predicted", "correct",
        F.round(F.element_at("choice_log_likelihoods", "A"), 6).alias("score_a"),
        F.round(F.element_at("choice_log_likelihoods", "D"), 6).alias("score_d"),
    )


# a closed-form model that looks at the last token and the length of its context
_STEP = f"(-((s[len(s)] * 7 + tok * 13 + least(len(s), {CONTEXT}) * 3) % 101 + 1) / 100.0::DOUBLE)"


@query(
    "mmlu_model_predictions",
    f"""with {_MODED}, c as (select idx, l, {S.ids('prompt')} as t,
          {S.ids("case when mode = 'instruction' then '' else ' ' end || (['A', 'B', 'C', 'D'])[l]")} as c
          from asked, range(1, 5) r(l)),
        e as (select idx, l, list_concat(t, c[1:p]) as s, c[p + 1] as tok
          from (select *, unnest(range(len(c))) as p from c)),
        cs as (select idx, l, round(sum({_STEP}), 6) as score from e group by 1, 2),
        g as (select idx, list(score order by l) as s from cs group by 1)
        select g.idx as "index", answer as gold, (list_position(s, list_max(s)) - 1)::INTEGER as predicted,
          list_position(s, list_max(s)) - 1 = answer as correct, s[1] as score_a, s[2] as score_b,
          s[3] as score_c, s[4] as score_d from g join test on test.idx = g.idx""",
)
def mmlu_model_predictions(spark, sf):
    continuations = F.array(*[byte_ids(P.answer_continuation(F.lit(l), F.col("mode"))) for l in CHOICE_LABELS])
    items = asked(spark, sf).select(
        "idx", byte_ids(F.col("prompt")).alias("prompt_ids"), continuations.alias("candidate_ids")
    )
    vocabulary = np.arange(BYTE_VOCAB_SIZE)

    def closed_form():
        def log_probs(ids: np.ndarray) -> np.ndarray:
            lengths = np.arange(1, ids.shape[1] + 1)[None, :, None]
            return -((ids[..., None] * 7 + vocabulary * 13 + lengths * 3) % 101 + 1) / 100.0

        return log_probs

    scored = C.score_choices(items, closed_form, CONTEXT)
    scored = scored.withColumn("scores", F.transform("scores", lambda x: F.round(x, 6)))
    preds = C.predictions(valid(spark, sf, "test").join(scored, "idx"))
    label = lambda l: F.element_at("choice_log_likelihoods", l)
    return preds.select(
        "index", "gold", "predicted", "correct", label("A").alias("score_a"),
        label("B").alias("score_b"), label("C").alias("score_c"), label("D").alias("score_d"),
    )


_SUBJECTS = """subj as (select subject, count(*) as total, count(*) filter (where correct) as correct,
    count(*) filter (where correct) / count(*)::DOUBLE as accuracy from judged group by subject)"""


@query(
    "mmlu_subjects",
    f"with {S.PREDICTED}, {_SUBJECTS} select subject, total, correct, round(accuracy, 6) as accuracy from subj",
)
def mmlu_subjects(spark, sf):
    return C.subject_summary(predicted(spark, sf)).withColumn("accuracy", F.round("accuracy", 6))


@query(
    "mmlu_macro",
    f"""with {S.PREDICTED}, {_SUBJECTS} select count(*) as subject_count,
          round(avg(accuracy), 6) as macro_subject_accuracy from subj""",
)
def mmlu_macro(spark, sf):
    return C.macro_accuracy(predicted(spark, sf)).withColumn(
        "macro_subject_accuracy", F.round("macro_subject_accuracy", 6)
    )


@query(
    "mmlu_report",
    f"""with {_FIT}, scored as (select test.*, {S.scores()} as s from test),
        judged as (select *, (list_position(s, list_max(s)) - 1)::INTEGER = answer as correct from scored), {_SUBJECTS}
        select 'answer_label_conditional_log_likelihood' as scoring, 'completion' as prompt_mode,
          {SHOTS} as requested_shots, sum(total)::BIGINT as total, sum(correct)::BIGINT as correct,
          round(sum(correct) / sum(total)::DOUBLE, 6) as accuracy,
          round(avg(accuracy), 6) as macro_subject_accuracy, count(*) as subject_count,
          (select count(*) from fit where prompt_left_truncated) as prompt_left_truncated,
          'full_selection' as evaluation_scope from subj""",
)
def mmlu_report(spark, sf):
    row = C.evaluation_report(full_predictions(spark, sf), prompt_mode="completion", shots=SHOTS)
    return row.withColumns({c: F.round(c, 6) for c in ("accuracy", "macro_subject_accuracy")})


@query(
    "effective_shots",
    f"""with {_FIT} select effective_shots, count(*) as n_items,
          count(*) filter (where prompt_left_truncated) as n_truncated from fit group by 1""",
)
def effective_shots(spark, sf):
    return C.shots_histogram(full_predictions(spark, sf))


@query(
    "running_accuracy",
    f"""with {S.PREDICTED}, r as (select row_number() over (order by idx) as completed,
          (sum(correct::INTEGER) over (order by idx))::BIGINT as correct_so_far, count(*) over () as n from judged)
        select completed, correct_so_far, round(correct_so_far / completed::DOUBLE, 6) as accuracy
        from r where completed % 50 = 0 or completed = n""",
)
def running_accuracy(spark, sf):
    return C.running_accuracy(predicted(spark, sf), 50).withColumn("accuracy", F.round("accuracy", 6))


# --- reports ----------------------------------------------------------------------


@query(
    "label_distribution",
    f"""with {S.PREDICTED}, l as (select unnest({S.LABEL}) as label),
        p as (select {S.LABEL}[predicted + 1] as label, count(*) as predicted from judged group by 1),
        g as (select {S.LABEL}[answer + 1] as label, count(*) as gold from judged group by 1)
        select label, coalesce(predicted, 0) as predicted, coalesce(gold, 0) as gold,
          round(coalesce(predicted, 0) / (select count(*) from judged)::DOUBLE, 6) as predicted_share,
          round(coalesce(gold, 0) / (select count(*) from judged)::DOUBLE, 6) as gold_share
        from l left join p using (label) left join g using (label)""",
)
def label_distribution(spark, sf):
    rows = R.label_distribution(predicted(spark, sf))
    return rows.withColumns({c: F.round(c, 6) for c in ("predicted_share", "gold_share")})


_Z = "1.959964::DOUBLE"


@query(
    "wilson_interval",
    f"""with {S.PREDICTED}, {_SUBJECTS}, q as (select *, total::DOUBLE as n, correct / total::DOUBLE as p from subj)
        select subject, total, correct,
          round((p + {_Z}*{_Z}/(2*n) - {_Z}*sqrt(p*(1-p)/n + {_Z}*{_Z}/(4*n*n))) / (1 + {_Z}*{_Z}/n), 6) + 0.0::DOUBLE as wilson_low,
          round((p + {_Z}*{_Z}/(2*n) + {_Z}*sqrt(p*(1-p)/n + {_Z}*{_Z}/(4*n*n))) / (1 + {_Z}*{_Z}/n), 6) as wilson_high,
          round(p - 0.25::DOUBLE, 6) as gap_to_chance from q""",
)
def wilson_interval(spark, sf):
    rows = R.wilson_report(C.subject_summary(predicted(spark, sf)).drop("accuracy"))
    return rows.withColumns({c: F.round(c, 6) for c in ("wilson_low", "wilson_high", "gap_to_chance")})


@query(
    "label_mean_loglik",
    f"""with {S.PREDICTED}, u as (select unnest({S.LABEL}) as label, unnest(s) as score from judged)
        select label, round(avg(score), 6) as mean_log_likelihood from u group by label""",
)
def label_mean_loglik(spark, sf):
    return R.label_mean_scores(predicted(spark, sf)).withColumn(
        "mean_log_likelihood", F.round("mean_log_likelihood", 6)
    )


@query(
    "subject_extremes",
    f"""with {S.PREDICTED}, {_SUBJECTS},
        b as (select *, row_number() over (order by accuracy desc, subject) as r,
          row_number() over (order by accuracy, subject) as q from subj)
        select subject, total, correct, round(accuracy, 6) as accuracy, 'best' as side from b where r <= 3
        union all select subject, total, correct, round(accuracy, 6), 'worst' from b where q <= 3""",
)
def subject_extremes(spark, sf):
    rows = R.subject_extremes(C.subject_summary(predicted(spark, sf)), 3)
    return rows.withColumn("accuracy", F.round("accuracy", 6))


_SECOND = f"""scored2 as (select idx, subject, answer, {S.scores(salt=17)} as s2 from scored),
judged2 as (select *, (list_position(s2, list_max(s2)) - 1)::INTEGER as predicted2 from scored2)"""


@query(
    "compare_runs",
    f"""with {S.PREDICTED}, {_SUBJECTS}, {_SECOND},
        subj2 as (select subject, count(*) as total, count(*) filter (where predicted2 = answer) / count(*)::DOUBLE as accuracy
          from judged2 group by 1)
        select subject, round(a.accuracy, 6) as value_a, round(b.accuracy, 6) as value_b,
          round(b.accuracy - a.accuracy, 6) as difference,
          case when a.accuracy > 0 then round((b.accuracy - a.accuracy) / a.accuracy, 6) end as relative_change,
          a.total = b.total as same_targets,
          case when b.total is null then 'a' when a.total is null then 'b' else 'both' end as held_by
        from subj a full join subj2 b using (subject)""",
)
def compare_runs(spark, sf):
    a, b = (C.subject_summary(predicted(spark, sf, salt)) for salt in (0, 17))
    rows = R.compare_runs(a, b, "subject", "accuracy", "total")
    return rows.withColumns(
        {c: F.round(c, 6) for c in ("value_a", "value_b", "difference", "relative_change")}
    )


@query(
    "run_agreement",
    f"""with {S.PREDICTED}, {_SECOND}, g as (select predicted, predicted2,
          list_max(list_transform(range(1, 5), lambda i: abs(s[i] - s2[i]))) as gap
          from judged join judged2 using (idx))
        select count(*) as n_items, 0::BIGINT as only_a, 0::BIGINT as only_b,
          count(*) filter (where predicted = predicted2) as same_labels,
          round(max(gap), 6) as max_score_difference from g""",
)
def run_agreement(spark, sf):
    rows = R.run_agreement(predicted(spark, sf), predicted(spark, sf, 17))
    return rows.withColumn("max_score_difference", F.round("max_score_difference", 6))


@query(
    "prediction_integrity",
    f"""with {S.PREDICTED}, r as (select row_number() over (order by idx) - 1 as i, correct from judged)
        select count(*) as total, count(distinct i) as distinct_indices, min(i) as min_index, max(i) as max_index,
          count(*) filter (where correct) as correct_stored, count(*) filter (where correct) as correct_recomputed,
          min(i) = 0 and max(i) = count(*) - 1 as sequential from r""",
)
def prediction_integrity(spark, sf):
    ranked = rank_before(predicted(spark, sf).withColumnRenamed("index", "idx"), "idx", "index")
    return R.prediction_integrity(ranked)
