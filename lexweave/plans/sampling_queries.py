"""Registered queries: sampling, generation, schedules and run histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import BYTE_VOCAB_SIZE, EOS_ID, REPORT_SETTINGS
from ..functions.metrics import learning_rate
from ..functions.text import uniform_draw
from ..functions.tokens import byte_ids, byte_token_count, take_last
from ..operators import history as H
from ..operators import sampling as G
from ..operators.instruction import fit_prompts, require_fitting
from ..operators.ordering import rank_before
from ..operators.vocabulary import Vocabulary
from ..session import fresh_path
from ..sources import sinks
from . import sql as S
from .choice_queries import corpus_model
from .flows import generate_samples
from .instruct_queries import _PLAIN, _with
from .views import dealt_documents, documents, instruction_records, table

QUERIES, ORACLES = {}, {}
TEMPERATURE, TOP_K, SEED, STEPS = 0.8, 40, 42, 12


def query(name, oracle=None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


_DIST = f"""pairs as (select tok, lag(tok) over (order by pos) as c1 from tokens),
logits as (select c1, tok as token, ln(count(*)) / {TEMPERATURE}::DOUBLE as z from pairs where c1 is not null group by 1, 2),
best as (select *, rank() over (partition by c1 order by z desc) as r from logits),
ws as (select *, exp(z - max(z) over (partition by c1)) as w from best where r <= {TOP_K}),
ps as (select c1, token, w / sum(w) over (partition by c1) as p from ws),
dist as (select *, sum(p) over (partition by c1 order by token) as cum from ps)"""


def next_token_distribution(spark, sf):
    """Top-k distribution after each byte token, from bigram counts."""
    logits = corpus_model(spark, sf).bi.select("c1", "token", F.log("n2").alias("logit"))
    return G.top_k_distribution(logits, "c1", TEMPERATURE, TOP_K, BYTE_VOCAB_SIZE)


@query(
    "topk_softmax",
    f"with {S.STREAM}, {_DIST} select c1, token, round(p, 6) as p, round(cum, 6) as cum from dist",
)
def topk_softmax(spark, sf):
    rows = next_token_distribution(spark, sf)
    return rows.select("c1", "token", F.round("p", 6).alias("p"), F.round("cum", 6).alias("cum"))


_DRAWN = f"""span as (select c1, token, cum - p as lo,
    case when token = max(token) over (partition by c1) then 2.0::DOUBLE else cum end as hi from dist),
first_ as (select doc_id, {SEED} + doc_id as seed, ids[len(ids) - 3] as last from off)"""


def _draw(step: str) -> str:
    return f"(('0x' || substr(md5(seed || ':' || {step}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def _prompts(spark, sf):
    """Every document as a prompt: its seed and its last token."""
    return documents(spark, sf).select(
        "doc_id",
        (F.col("doc_id") + SEED).alias("seed"),
        F.try_element_at(byte_ids(F.col("text")), F.lit(-1)).alias("last"),
    )


@query(
    "seeded_sample",
    f"""with {S.STREAM}, {_DIST}, {_DRAWN} select doc_id, seed, last, min(token) as token
        from first_ join span on c1 = last and {_draw("'0'")} <= hi
        group by doc_id, seed, last""",
)
def seeded_sample(spark, sf):
    candidates = G.candidate_arrays(next_token_distribution(spark, sf), "c1")
    rows = _prompts(spark, sf).join(candidates, F.col("last") == F.col("c1"), "left")
    # an empty prompt, or an ending never seen before a token, draws from all tokens
    any_token = _any_token(spark, sf).select("candidates").scalar()
    rows = rows.withColumn("candidates", F.coalesce("candidates", any_token))
    draw = uniform_draw(F.col("seed").cast("string"), F.lit("0"))
    return rows.select("doc_id", "seed", "last", G.pick(F.col("candidates"), draw).alias("token"))


def _any_token(spark, sf):
    """One row of candidates from token counts alone."""
    unigrams = corpus_model(spark, sf).uni.select(
        F.lit(0).alias("g"), "token", F.log("n1").alias("logit")
    )
    return G.candidate_arrays(
        G.top_k_distribution(unigrams, "g", TEMPERATURE, TOP_K, BYTE_VOCAB_SIZE), "g"
    )


_CONTEXTS = f"""tri as (select tok, lag(tok) over w as c1, lag(tok, 2) over w as c2 from tokens window w as (order by pos)),
lg as (select c2 || ',' || c1 as ctx, tok as token, ln(count(*)) / {TEMPERATURE}::DOUBLE as z from tri where c2 is not null group by 1, 2
  union all select c1::VARCHAR, tok, ln(count(*)) / {TEMPERATURE}::DOUBLE from tri where c1 is not null group by 1, 2
  union all select '', tok, ln(count(*)) / {TEMPERATURE}::DOUBLE from tri group by 1, 2),
kept as (select *, rank() over (partition by ctx order by z desc) as r from lg),
weighed as (select *, exp(z - max(z) over (partition by ctx)) as w from kept where r <= {TOP_K}),
shares as (select ctx, token, w / sum(w) over (partition by ctx) as p from weighed),
sums as (select *, sum(p) over (partition by ctx order by token) as cum from shares),
spans as (select ctx, token, coalesce(lag(cum) over t, -1.0::DOUBLE) as lo,
    case when lead(cum) over t is null then 2.0::DOUBLE else cum end as hi from sums window t as (partition by ctx order by token)),
seen as (select distinct ctx from spans),
started as (select doc_id, {SEED} + doc_id as seed, ids[len(ids) - 3] as c1,
    case when len(ids) > 4 then ids[len(ids) - 4] end as c2 from off)"""


def _contexts(spark, sf):
    """Candidates after every known pair of tokens, every token, and nothing."""
    model = corpus_model(spark, sf)
    pair = G.context_key(F.array("c2", "c1"))
    logits = (
        model.tri.select(pair.alias("context"), "token", F.log("n3").alias("logit"))
        .unionByName(model.bi.select(F.col("c1").cast("string").alias("context"), "token", F.log("n2").alias("logit")))
        .unionByName(model.uni.select(F.lit("").alias("context"), "token", F.log("n1").alias("logit")))
    )
    return G.candidate_arrays(G.top_k_distribution(logits, "context", TEMPERATURE, TOP_K, BYTE_VOCAB_SIZE), "context")


@query(
    "batch_generate",
    f"""with recursive {S.STREAM.strip()}, {_CONTEXTS},
        gen as (select doc_id, seed, c2, c1, 0 as step, '' as ids, false as done from started
          union all select g.doc_id, g.seed, g.c1, s.token, g.step + 1,
            g.ids || case when g.step > 0 then ',' else '' end || s.token, s.token = {EOS_ID}
          from gen g left join seen a on a.ctx = g.c2 || ',' || g.c1 left join seen b on b.ctx = g.c1::VARCHAR
            join spans s on s.ctx = coalesce(a.ctx, b.ctx, '') and {_draw('g.step')} > s.lo and {_draw('g.step')} <= s.hi
          where not g.done and g.step < {STEPS})
        select doc_id, arg_max(ids, step) as new_ids from gen group by doc_id""",
)
def batch_generate(spark, sf):
    prompts = dealt_documents(spark, sf).select(
        "doc_id", (F.col("doc_id") + SEED).alias("seed"), take_last(byte_ids(F.col("text")), 2).alias("prompt_ids")
    )
    out = G.batch_generate(
        prompts, _contexts(spark, sf), longest=2, max_new_tokens=STEPS, eos_id=EOS_ID, key="doc_id"
    )
    return out.select("doc_id", F.array_join("new_ids", ",").alias("new_ids"))


SAMPLES = 3


@query(
    "sample_plan",
    f"""with {S.INSTRUCT}, p as (select *, row_number() over (order by rec_id) - 1 as ord,
          strlen(case when input = '' then {_PLAIN} else {_with('input')} end)::INTEGER as prompt_tokens from instruct)
        select rec_id, s::INTEGER as sample, ord * {SAMPLES} + s - 1 as sample_index,
          ord * {SAMPLES} + s - 1 + {SEED} as seed, prompt_tokens from p, range(1, {SAMPLES + 1}) r(s)""",
)
def sample_plan(spark, sf):
    fitted = fit_prompts(instruction_records(spark, sf), Vocabulary(), 1 << 20, reserve=0)
    ranked = rank_before(require_fitting(fitted, "rec_id"), "rec_id", "ord")
    plan = G.sample_plan(ranked, "ord", SAMPLES, SEED)
    return plan.select(
        "rec_id", "sample", "sample_index", "seed",
        byte_token_count(F.col("prompt")).alias("prompt_tokens"),
    )


NEW_TOKENS = 6


def _samples(spark, sf):
    """Samples of every instruction record, from the corpus' own n-gram model."""
    contexts = _contexts(spark, sf)

    def generate(plan):
        return G.batch_generate(plan, contexts, longest=2, max_new_tokens=NEW_TOKENS, eos_id=EOS_ID)

    prompts = instruction_records(spark, sf).select(
        F.col("rec_id").alias("ord"), F.concat(F.lit("rec-"), F.col("rec_id").cast("string")).alias("id"),
        "instruction", "input",
    )
    return generate_samples(
        prompts, Vocabulary(), generate, mode="instruction", block_size=1 << 20, samples_per_prompt=SAMPLES, seed=SEED
    )


@query(
    "generate_samples",
    f"""with recursive {S.STREAM.strip()}, {S.INSTRUCT}, {_CONTEXTS.replace("started as (", "unused as (")},
        asked as (select rec_id, row_number() over (order by rec_id) - 1 as ord, {S.ids(f"case when input = '' then {_PLAIN} else {_with('input')} end")} as p
          from instruct),
        started as (select rec_id, s::INTEGER as sample, ord * {SAMPLES} + s - 1 as sample_index, ord * {SAMPLES} + s - 1 + {SEED} as seed,
          len(p)::INTEGER as prompt_tokens, p[len(p) - 1] as c2, p[len(p)] as c1 from asked, range(1, {SAMPLES + 1}) r(s)),
        gen as (select sample_index, seed, c2, c1, 0 as step, '' as ids, false as done from started
          union all select g.sample_index, g.seed, g.c1, s.token, g.step + 1,
            g.ids || case when g.step > 0 then ',' else '' end || s.token, s.token = {EOS_ID}
          from gen g left join seen a on a.ctx = g.c2 || ',' || g.c1 left join seen b on b.ctx = g.c1::VARCHAR
            join spans s on s.ctx = coalesce(a.ctx, b.ctx, '') and {_draw('g.step')} > s.lo and {_draw('g.step')} <= s.hi
          where not g.done and g.step < {NEW_TOKENS}),
        made as (select sample_index, arg_max(ids, step) as new_ids from gen group by 1)
        select 'rec-' || rec_id as id, sample, sample_index, seed, prompt_tokens, false as input_truncated, new_ids
        from started join made using (sample_index)""",
)
def generate_samples_query(spark, sf):
    return _samples(spark, sf).select(
        "id", "sample", "sample_index", "seed", "prompt_tokens", "input_truncated",
        F.array_join("new_ids", ",").alias("new_ids"),
    )


@query("generate_report")
def generate_report(spark, sf):
    """Lines of the published report: outputs may hold any bytes, which SQL cannot decode."""
    base = fresh_path(spark, "sample-report")
    said = ("n-gram counts of the corpus", "corpus", "instruction", TEMPERATURE, TOP_K, NEW_TOKENS)
    settings = dict(zip(REPORT_SETTINGS, said))
    sinks.write_sample_report(_samples(spark, sf), base, "sample_index", settings)
    return sinks.read_published(spark, base)


# --- schedules and histories ------------------------------------------------------

_RATE = """case when step < 100 then 3e-4::DOUBLE * (step + 1) / 100.0::DOUBLE when step >= 600 then 3e-5::DOUBLE
  else 3e-5::DOUBLE + 0.5::DOUBLE * (1 + cos(pi() * (step - 100) / 500.0::DOUBLE)) * 2.7e-4::DOUBLE end"""


def _rate(step):
    return learning_rate(step, peak=3e-4, floor=3e-5, warmup=100, max_steps=600)


@query(
    "lr_schedule",
    f"select step, round({_RATE}, 10) as learning_rate from (select doc_id as step from documents)",
)
def lr_schedule(spark, sf):
    steps = documents(spark, sf).select(F.col("doc_id").alias("step"))
    return steps.withColumn("learning_rate", F.round(_rate(F.col("step")), 10))


def _history(spark, sf):
    """One run per language, one step per document, arithmetic losses."""
    step = F.col("doc_id")
    return documents(spark, sf).select(
        F.col("lang").alias("run_id"),
        step.alias("step"),
        (F.lit(2.0) + (step * 53 % 97) / F.lit(100.0)).alias("train_loss"),
        (F.lit(2.0) + (step * 37 % 101) / F.lit(100.0)).alias("val_loss"),
    )


_HISTORY = """hist as (select lang as run_id, doc_id as step, 2.0::DOUBLE + (doc_id * 53 % 97) / 100.0::DOUBLE as train_loss,
    2.0::DOUBLE + (doc_id * 37 % 101) / 100.0::DOUBLE as val_loss, max(doc_id) over (partition by lang) as last_step from documents)"""
_BEST = """b as (select *, min(val_loss) over (partition by run_id order by step) as best_val_loss,
    min(val_loss) over (partition by run_id order by step rows between unbounded preceding and 1 preceding) as before from {source})
  select run_id, step, {extra} val_loss, best_val_loss, before is null or val_loss < before as improved from b"""


@query(
    "history_best",
    f"""with {_HISTORY}, ev as (select *, step % 10 = 0 or step = 1 as logged from hist
          where step % 5 = 0 or step = last_step), """
    + _BEST.format(source="ev", extra="train_loss, logged, "),
)
def history_best(spark, sf):
    rows = _history(spark, sf)
    ends = rows.groupBy("run_id").agg(F.max("step").alias("last_step"))
    steps = H.evaluation_steps(rows.join(ends, "run_id"), 5, "last_step").drop("last_step")
    logged = H.log_steps(steps, 10).select("run_id", "step", F.lit(True).alias("logged"))
    best = H.running_best(steps).join(logged, ["run_id", "step"], "left")
    return best.select(
        "run_id", "step", "train_loss", F.coalesce("logged", F.lit(False)).alias("logged"),
        "val_loss", "best_val_loss", "improved",
    )


@query(
    "history_resume",
    f"""with {_HISTORY}, later as (select lang as run_id, doc_id as step,
          1.5::DOUBLE + (doc_id * 41 % 103) / 100.0::DOUBLE as val_loss from labels join documents using (doc_id)),
        al as (select run_id, step, val_loss from hist where step not in (select step from later)
          union all select * from later), """
    + _BEST.format(source="al", extra=""),
)
def history_resume(spark, sf):
    earlier = _history(spark, sf).drop("train_loss")
    repeated = table(spark, sf, "labels").join(documents(spark, sf).select("doc_id", "lang"), "doc_id")
    later = repeated.select(
        F.col("lang").alias("run_id"),
        F.col("doc_id").alias("step"),
        (F.lit(1.5) + (F.col("doc_id") * 41 % 103) / F.lit(100.0)).alias("val_loss"),
    )
    return H.resumed_history(earlier, later).select("run_id", "step", "val_loss", "best_val_loss", "improved")
