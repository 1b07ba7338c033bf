"""Registered queries: language-model evaluation and the n-gram model."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from ..constants import BYTE_VOCAB_SIZE, EOS_ID
from ..operators import history as H
from ..operators import lm_eval as E
from ..operators.instruction import kept_records
from ..operators.ngram import NgramModel, ngram_counts, ngram_rows, target_rows
from ..operators.token_tables import contiguous_split
from ..session import materialize
from . import sql as S
from .instruct_queries import _CODED, _RANKED, _TARGETS, _ranked, encoded
from .token_queries import FRACTION
from .views import NEWLINE_ID, story_stream

QUERIES, ORACLES = {}, {}
BLOCK, STRIDE, BATCH = 256, 128, 4
#: Records of an instruction batch, and batches of a quick look at the held-out loss.
RECORDS, QUICK = 8, 20


def query(name, oracle=None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


_WINDOWS = f"""ts as (select n, unnest(range(1, n, {STRIDE})) as target_start from tot),
te as (select *, least(target_start + {STRIDE}, n) as target_end from ts),
win as (select (target_start - 1) // {STRIDE} as window_id, greatest(0, target_end - 1 - {BLOCK}) as context_start,
    target_start, target_end,
    greatest(0, target_start - greatest(0, target_end - 1 - {BLOCK}) - 1) as ignored from te)"""

_WINDOW_TOKENS = f"""{_WINDOWS},
wt as (select w.window_id, w.context_start, w.target_end, w.ignored, t.pos, t.tok
  from (select pos, tok, unnest(range(greatest(0, (pos - 1) // {STRIDE} - 1), (pos - 1) // {STRIDE} + 4)) as k from tokens) t
  join win w on w.window_id = t.k and t.pos >= w.context_start and t.pos < w.target_end),
seqs as (select window_id, context_start, ignored,
    string_agg(tok::VARCHAR, ',' order by pos) filter (where pos < target_end - 1) as inputs,
    string_agg(case when pos - context_start - 1 < ignored then '-100' else tok::VARCHAR end, ',' order by pos)
      filter (where pos > context_start) as targets,
    (count(*) - 1)::INTEGER as n from wt group by window_id, context_start, target_end, ignored)"""


@query(
    "eval_windows",
    f"with {S.OFFSETS}, {_WINDOWS} select window_id, context_start, target_start, target_end, ignored from win",
)
def eval_windows(spark, sf):
    return E.evaluation_windows(story_stream(spark, sf).drop("ids"), BLOCK, STRIDE)


@query(
    "eval_window_tokens",
    f"""with {S.STREAM}, {_WINDOW_TOKENS} select window_id, context_start, ignored::INTEGER as ignored, n,
          md5(inputs) as inputs_md5, md5(targets) as targets_md5 from seqs""",
)
def eval_window_tokens(spark, sf):
    windows = E.window_tokens(story_stream(spark, sf), BLOCK, STRIDE)
    return windows.select(
        "window_id",
        "context_start",
        "ignored",
        F.size("inputs").alias("n"),
        F.md5(F.array_join("inputs", ",")).alias("inputs_md5"),
        F.md5(F.array_join("targets", ",")).alias("targets_md5"),
    )


@query(
    "eval_batches",
    f"""with {S.STREAM}, {_WINDOW_TOKENS},
        b as (select *, window_id // {BATCH} as batch_id from seqs),
        m as (select *, max(n) over (partition by batch_id) as padded_length,
          (select ceil(count(*) / {BATCH}.0::DOUBLE)::BIGINT from seqs) as forward_passes from b)
        select batch_id, window_id, padded_length, forward_passes,
          md5(inputs || repeat(',0', (padded_length - n)::BIGINT)) as inputs_md5,
          md5(targets || repeat(',-100', (padded_length - n)::BIGINT)) as targets_md5 from m""",
)
def eval_batches(spark, sf):
    windows = E.window_tokens(story_stream(spark, sf), BLOCK, STRIDE)
    n_windows = E.evaluation_windows(story_stream(spark, sf).drop("ids"), BLOCK, STRIDE).agg(F.count("*")).scalar()
    return E.window_batches(windows, BATCH).select(
        "batch_id",
        "window_id",
        "padded_length",
        F.ceil(n_windows / F.lit(float(BATCH))).alias("forward_passes"),
        F.md5(F.array_join("inputs", ",")).alias("inputs_md5"),
        F.md5(F.array_join("targets", ",")).alias("targets_md5"),
    )


@query(
    "batch_score_uniform",
    f"""with {S.OFFSETS} select n - 1 as predictions, round(ln(260.0::DOUBLE), 6) as average_nll,
          round(260.0::DOUBLE, 6) as perplexity, round(ln(260.0::DOUBLE) / ln(2.0::DOUBLE), 6) as bits_per_token
        from tot""",
)
def batch_score_uniform(spark, sf):
    size = BYTE_VOCAB_SIZE

    def uniform():
        logp = -math.log(size)
        return lambda ids: np.broadcast_to(logp, (*ids.shape, size))

    scored = E.score_windows(E.window_tokens(story_stream(spark, sf), BLOCK, STRIDE), uniform, rows=32)
    metrics = E.token_weighted_metrics(scored, F.col("nll_sum"), F.col("predictions"))
    return metrics.select(
        "predictions", *[F.round(c, 6).alias(c) for c in ("average_nll", "perplexity", "bits_per_token")]
    )


# --- n-gram model -----------------------------------------------------------------


def _side(spark, sf, name: str):
    """N-gram rows of one side of the split, with positions in that side's stream.

    Rows follow an end marker; the row at the side's start follows nothing.
    """
    pieces = contiguous_split(story_stream(spark, sf), FRACTION).filter(F.col("split") == name)
    start = pieces.agg(F.min("from_pos")).scalar()
    placed = pieces.withColumn("side_pos", F.col("from_pos") - start)
    marker = F.array(F.lit(EOS_ID), F.lit(NEWLINE_ID))
    context = F.when(F.col("side_pos") > 0, marker).otherwise(F.array().cast("array<int>"))
    return ngram_rows(placed, "doc_id", "side_pos", context=context)


def trained_model(spark, sf) -> NgramModel:
    return NgramModel.fit(_side(spark, sf, "train"), BYTE_VOCAB_SIZE)


_SIDES = f"""cut as (select floor(n * {FRACTION}::DOUBLE)::BIGINT as c from tot),
sides as (select t.*, pos >= c as held from tokens t, cut),
grams as (select *, lag(tok, 2) over w as c2, lag(tok) over w as c1, row_number() over w - 1 as side_pos
  from sides window w as (partition by held order by pos))"""

_MODEL = """g1 as (select tok, count(*) as n1 from train group by 1),
tt as (select sum(n1)::DOUBLE as m1 from g1),
g2 as (select c1, tok, count(*) as n2 from train where c1 is not null group by 1, 2),
m2 as (select c1, sum(n2) as m2 from g2 group by 1),
g3 as (select c2, c1, tok, count(*) as n3 from train where c2 is not null group by 1, 2, 3),
m3 as (select c2, c1, sum(n3) as m3 from g3 group by 1, 2)"""

_LOGP = """case when m3 is not null then ln((coalesce(n3, 0) + 0.1::DOUBLE) / (m3 + 26.0::DOUBLE))
  when m2 is not null then ln((coalesce(n2, 0) + 0.1::DOUBLE) / (m2 + 26.0::DOUBLE))
  else ln((coalesce(n1, 0) + 0.1::DOUBLE) / (m1 + 26.0::DOUBLE)) end"""

_JOIN_MODEL = """left join g3 on g3.c2 = e.c2 and g3.c1 = e.c1 and g3.tok = e.tok
  left join m3 on m3.c2 = e.c2 and m3.c1 = e.c1
  left join g2 on g2.c1 = e.c1 and g2.tok = e.tok left join m2 on m2.c1 = e.c1
  left join g1 on g1.tok = e.tok cross join tt"""

_SCORED = f"""{_SIDES}, train as (select * from grams where not held), {_MODEL},
held_rows as (select * from grams where held and c1 is not null),
scored as (select e.doc_id, e.side_pos, {_LOGP} as logp from held_rows e {_JOIN_MODEL})"""


@query(
    "ngram_lm",
    f"""with {S.STREAM}, {_SIDES}, train as (select * from grams where not held), {_MODEL},
        rows_ as (select 3 as ord, c2, c1, tok as token, n3 as n, m3 as context_n from g3 join m3 using (c2, c1)
          union all select 2, null, c1, tok, n2, m2 from g2 join m2 using (c1)
          union all select 1, null, null, tok, n1, m1 from g1, tt)
        select ord, c2, c1, token, n, context_n::BIGINT as context_n,
          round(ln((n + 0.1::DOUBLE) / (context_n + 26.0::DOUBLE)), 6) as logp from rows_""",
)
def ngram_lm(spark, sf):
    return trained_model(spark, sf).table().withColumn("logp", F.round("logp", 6))


def _scored_held(spark, sf, *keys):
    """Held-out n-grams folded per key, with their log-probability."""
    held = _side(spark, sf, "validation").filter(F.col("c1").isNotNull())
    return trained_model(spark, sf).score(ngram_counts(held, *keys))


@query(
    "score_corpus",
    f"""with {S.STREAM}, {_SCORED} select doc_id, count(*) as predictions,
          round(sum(-logp), 6) as nll_sum from scored group by doc_id""",
)
def score_corpus(spark, sf):
    scored = _scored_held(spark, sf, "doc_id")
    return scored.groupBy("doc_id").agg(
        F.sum("n").alias("predictions"), F.round(F.sum(-F.col("logp") * F.col("n")), 6).alias("nll_sum")
    )


@query(
    "lm_metrics",
    f"""with {S.STREAM}, {_SCORED}, a as (select count(*) as predictions, sum(-logp) / count(*) as nll from scored),
        t as (select n - c as tokens from tot, cut),
        w as (select tokens, ceil((tokens - 1) / {STRIDE}.0::DOUBLE)::BIGINT as windows from t)
        select tokens, predictions, windows, ceil(windows / {BATCH}.0::DOUBLE)::BIGINT as forward_passes,
          {STRIDE} as stride, {BATCH} as batch_size, round(nll, 6) as average_nll,
          round(exp(nll), 6) as perplexity, round(nll / ln(2.0::DOUBLE), 6) as bits_per_token,
          'full_test' as evaluation_scope from a, w""",
)
def lm_metrics(spark, sf):
    scored = _scored_held(spark, sf)
    metrics = E.token_weighted_metrics(scored, -F.col("logp") * F.col("n"), F.col("n"))
    pieces = contiguous_split(story_stream(spark, sf).drop("ids"), FRACTION).filter(F.col("split") == "validation")
    start = pieces.agg(F.min("from_pos")).scalar()
    held = pieces.select("n_tokens", (F.col("from_pos") - start).alias("start_pos"))
    report = E.evaluation_report(
        metrics,
        E.evaluation_windows(held, BLOCK, STRIDE),
        tokens=held.agg(F.sum("n_tokens")).scalar(),
        batch_size=BATCH,
        stride=STRIDE,
    )
    return report.withColumns(
        {c: F.round(c, 6) for c in ("average_nll", "perplexity", "bits_per_token")}
    )


@query(
    "batch_mean_loss",
    f"""with {S.STREAM}, {_SCORED},
        b as (select (side_pos - 1) // {BLOCK * BATCH} as batch_id, avg(-logp) as l from scored group by 1)
        select count(*) as n_batches, round(avg(l), 6) as mean_loss from b""",
)
def batch_mean_loss(spark, sf):
    held = _side(spark, sf, "validation").filter(F.col("c1").isNotNull())
    batch = F.floor((F.col("side_pos") + F.col("pos") - 1) / (BLOCK * BATCH)).alias("batch_id")
    rows = held.select(batch, "c2", "c1", "token")
    scored = trained_model(spark, sf).score(ngram_counts(rows, "batch_id"))
    losses = scored.withColumn("loss", -F.col("logp"))
    return E.batch_mean_loss(losses).withColumn("mean_loss", F.round("mean_loss", 6))


@query(
    "masked_loss",
    f"""with {S.INSTRUCT}, {_CODED}, t as (select rec_id, unnest({_TARGETS}) as target,
          generate_subscripts({_TARGETS}, 1) - 1 as pos from encoded where kept)
        select rec_id, count(*) as n_targets,
          round(avg(((target * 31 + pos) % 97 + 1) / 10.0::DOUBLE), 6) as loss
        from t where target <> -100 group by rec_id""",
)
def masked_loss(spark, sf):
    kept = kept_records(encoded(spark, sf))
    targets = kept.select("rec_id", F.posexplode("targets").alias("pos", "target"))
    logp = -((F.col("target") * 31 + F.col("pos")) % 97 + 1) / F.lit(10.0)
    return E.masked_losses(targets.withColumn("logp", logp), "rec_id").withColumn(
        "loss", F.round("loss", 6)
    )


# --- held-out loss of responses ------------------------------------------------------


def _response_losses(spark, sf):
    """``split, batch_id, loss, n`` under the n-gram model of the training responses."""
    rows = materialize(_ranked(spark, sf).select("split", "rk", "tokens", "targets"), "ranked-records")
    batch = F.floor(F.col("rk") / RECORDS).alias("batch_id")
    grams = target_rows(rows.select("split", batch, "tokens", "targets"), "split", "batch_id")
    model = NgramModel.fit(grams.filter(F.col("split") == "train"), BYTE_VOCAB_SIZE)
    scored = model.score(ngram_counts(grams, "split", "batch_id"))
    return scored.withColumn("loss", -F.col("logp"))


_RESPONSES = f"""{_RANKED},
aligned as (select split, rk // {RECORDS} as batch_id, unnest(targets) as tok, unnest(tokens) as c1,
    unnest(list_concat([null], tokens[1:len(tokens) - 1])) as c2 from ranked),
answers as (select * from aligned where tok <> -100),
train as (select * from answers where split = 'train'), {_MODEL},
scored as (select e.split, e.batch_id, {_LOGP} as logp from answers e {_JOIN_MODEL}),
losses as (select split, batch_id, count(*) as n_targets, avg(-logp) as batch_loss from scored group by 1, 2)"""


@query(
    "response_loss",
    f"""with {S.INSTRUCT}, {_RESPONSES}
        select split, 'all' as scope, count(*) as n_batches, round(avg(batch_loss), 6) as mean_loss
        from losses group by split union all
        select split, 'first', count(*), round(avg(batch_loss), 6) from losses where batch_id < {QUICK} group by split""",
)
def response_loss(spark, sf):
    losses = materialize(_response_losses(spark, sf), "response-losses")
    every = E.batch_mean_loss(losses, by=("split",)).withColumn("scope", F.lit("all"))
    first = E.batch_mean_loss(losses, max_batches=QUICK, by=("split",)).withColumn("scope", F.lit("first"))
    both = every.unionByName(first)
    return both.select("split", "scope", "n_batches", F.round("mean_loss", 6).alias("mean_loss"))


@query(
    "loss_history",
    f"""with {S.INSTRUCT}, {_RESPONSES},
        hist as (select split as run_id, batch_id + 1 as step, n_targets, batch_loss as val_loss from losses),
        b as (select *, min(val_loss) over (partition by run_id order by step) as best,
          min(val_loss) over (partition by run_id order by step rows between unbounded preceding and 1 preceding) as before
          from hist)
        select run_id, step, n_targets, step % 10 = 0 or step = 1 as logged, round(val_loss, 6) as val_loss,
          round(best, 6) as best_val_loss, before is null or val_loss < before as improved from b""",
)
def loss_history(spark, sf):
    batches = E.batch_losses(_response_losses(spark, sf), by=("split",)).select(
        F.col("split").alias("run_id"), (F.col("batch_id") + 1).alias("step"), "n_targets",
        F.col("batch_loss").alias("val_loss"),
    )
    best = H.running_best(materialize(batches, "loss-history"))
    return best.select(
        "run_id", "step", "n_targets", H.is_logged(10).alias("logged"), F.round("val_loss", 6).alias("val_loss"),
        F.round("best_val_loss", 6).alias("best_val_loss"), "improved",
    )
