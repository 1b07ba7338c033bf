"""Registered queries: instruction data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import PROMPT_WITH_INPUT, PROMPT_WITHOUT_INPUT
from ..functions.prompts import instruction_prompt
from ..operators import instruction as I
from ..operators.ordering import rank_before
from ..operators.token_tables import batches
from ..operators.vocabulary import Vocabulary
from ..session import materialize
from . import merge_sql as M
from . import sql as S
from .token_queries import LEARNED, learned_vocabulary
from .views import instruction_records

QUERIES, ORACLES = {}, {}
SEED, FRACTION, MAX_LENGTH, BATCH = 42, 0.75, 700, 8


def query(name, oracle=None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _template(template: str, **columns: str) -> str:
    out = _quote(template)
    for name, column in columns.items():
        out = out.replace("{" + name + "}", f"' || {column} || '")
    return f"({out})"


_PLAIN = _template(PROMPT_WITHOUT_INPUT, instruction="instruction")


def _with(text: str) -> str:
    return _template(PROMPT_WITH_INPUT, instruction="instruction", input=text)


def _fitted(measure: str, reserve: int) -> str:
    """Minimal, full or longest-prefix prompt; ``measure`` is a length function."""
    room = MAX_LENGTH - reserve
    return f"""sized as (select *, {measure}({_PLAIN}) as min_n, {measure}({_with('input')}) as full_n from instruct),
    cutting as (select *, coalesce(list_max(list_filter(range(1, length(input) + 1),
        lambda k: full_n - {measure}(input) + {measure}(substr(input, 1, k)) <= {room})), 0) as taken from sized),
    fitted as (select *, case when min_n > {room} then null
        when input = '' then {_PLAIN}
        when full_n <= {room} then {_with('input')}
        when taken = 0 then {_PLAIN}
        else {_with('substr(input, 1, taken::BIGINT)')} end as prompt,
        (min_n <= {room} and input <> '' and full_n > {room}) as input_truncated from cutting)"""


_CODED = f"""{_fitted('strlen', 1)},
coded as (select *, {S.ids("coalesce(prompt, '')")} as p, {S.ids('output')} as r from fitted),
enc as (select *, case when length(output) = 0 then 'empty_response'
      when prompt is null or {MAX_LENGTH} - len(p) <= 0 then 'prompt_too_long' else 'kept' end as outcome,
    r[1:greatest(0, {MAX_LENGTH} - len(p))] as cut from coded),
encoded as (select *, outcome = 'kept' as kept from enc)"""

_SPLIT = f"""keyed as (select rec_id, row_number() over (order by substr(sha256('{SEED}:' || rec_id), 1, 15), rec_id) - 1 as ord,
    count(*) over () as n from instruct),
halves as (select rec_id, ord, case when ord < least(n - 1, greatest(1, floor(n * {FRACTION}::DOUBLE)::BIGINT))
    then 'train' else 'validation' end as split from keyed)"""


@query(
    "alpaca_prompt",
    f"""with {S.INSTRUCT} select rec_id, case when input = '' then {_PLAIN} else {_with('input')} end as prompt
        from instruct""",
)
def alpaca_prompt(spark, sf):
    return instruction_records(spark, sf).select(
        "rec_id", instruction_prompt(F.col("instruction"), F.col("input")).alias("prompt")
    )


@query("seeded_split", f"with {S.INSTRUCT}, {_SPLIT} select rec_id, ord, split from halves")
def seeded_split(spark, sf):
    rows = I.seeded_split(instruction_records(spark, sf), FRACTION, SEED)
    return rows.select("rec_id", "ord", "split")


@query(
    "fit_prompt",
    f"with {S.INSTRUCT}, {_fitted('length', 1)} select rec_id, prompt, input_truncated from fitted",
)
def fit_prompt(spark, sf):
    fitted = I.fit_prompts_by_chars(instruction_records(spark, sf), MAX_LENGTH)
    return fitted.select("rec_id", "prompt", "input_truncated")


def encoded(spark, sf):
    return I.encode_records(instruction_records(spark, sf), Vocabulary(), MAX_LENGTH)


@query(
    "encode_instruction",
    f"""with {S.INSTRUCT}, {_CODED} select rec_id, outcome,
          case when kept then array_to_string(list_concat(p, cut), ',') end as tokens,
          kept and input_truncated as input_truncated,
          kept and len(r) > {MAX_LENGTH} - len(p) as response_truncated from encoded""",
)
def encode_instruction(spark, sf):
    return encoded(spark, sf).select(
        "rec_id", "outcome", F.array_join("tokens", ",").alias("tokens"),
        "input_truncated", "response_truncated",
    )


#: Halvings that reach one character of any input up to 65,535 characters.
_HALVINGS = 16
_BPE_ROOM = MAX_LENGTH - 1
_BPE_CODED = f"""{LEARNED}, {S.INSTRUCT.strip()},
mins as (select rec_id as key, {_PLAIN} as text from instruct), {M.encoded('mins', 'min_c')},
fulls as (select rec_id as key, case when input = '' then {_PLAIN} else {_with('input')} end as text from instruct),
{M.encoded('fulls', 'full_c')},
measured as materialized (select instruct.*, length(min_c.s) as min_n, length(full_c.s) as full_n
  from instruct join min_c on min_c.key = rec_id join full_c on full_c.key = rec_id),
long_ as materialized (select rec_id as key, instruction, input from measured
  where min_n <= {_BPE_ROOM} and full_n > {_BPE_ROOM} and length(output) > 0),
{M.longest_inputs('long_', _BPE_ROOM, _with('part'), _HALVINGS)},
fitted as materialized (select *, case when min_n > {_BPE_ROOM} then null
    when full_n <= {_BPE_ROOM} then case when input = '' then {_PLAIN} else {_with('input')} end
    when coalesce(taken, 0) = 0 then {_PLAIN} else {_with('substr(input, 1, taken)')} end as prompt,
    min_n <= {_BPE_ROOM} and full_n > {_BPE_ROOM} as input_truncated
  from measured left join cut on cut.key = rec_id),
asks as (select rec_id as key, coalesce(prompt, '') as text from fitted), {M.encoded('asks', 'ask_c')},
says as (select rec_id as key, output as text from fitted), {M.encoded('says', 'say_c')},
coded as (select fitted.*, {M.symbol_ids('ask_c.s')} as p, {M.symbol_ids('say_c.s')} as r
  from fitted join ask_c on ask_c.key = rec_id join say_c on say_c.key = rec_id),
enc as (select *, case when length(output) = 0 then 'empty_response'
      when prompt is null or {MAX_LENGTH} - len(p) <= 0 then 'prompt_too_long' else 'kept' end as outcome,
    r[1:greatest(0, {MAX_LENGTH} - len(p))] as cut from coded)"""


@query(
    "encode_instruction_bpe",
    f"""with {_BPE_CODED} select rec_id, outcome,
          case when outcome = 'kept' then array_to_string(list_concat(p, enc.cut), ',') end as tokens,
          outcome = 'kept' and input_truncated as input_truncated,
          outcome = 'kept' and len(r) > {MAX_LENGTH} - len(p) as response_truncated from enc""",
)
def encode_instruction_bpe(spark, sf):
    rows = I.encode_records(instruction_records(spark, sf), learned_vocabulary(spark, sf), MAX_LENGTH)
    return rows.select(
        "rec_id", "outcome", F.array_join("tokens", ",").alias("tokens"),
        "input_truncated", "response_truncated",
    )


_TARGETS = "list_concat(list_transform(range(len(p) - 1), lambda x: -100), cut, [2])"


@query(
    "response_targets",
    f"""with {S.INSTRUCT}, {_CODED} select rec_id, array_to_string({_TARGETS}, ',') as targets,
          (len(p) + len(cut))::INTEGER as n from encoded where kept""",
)
def response_targets(spark, sf):
    kept = I.kept_records(encoded(spark, sf))
    aligned = F.assert_true(F.size("tokens") == F.size("targets")).isNull()
    return kept.filter(aligned).select(
        "rec_id", F.array_join("targets", ",").alias("targets"), F.size("tokens").alias("n")
    )


@query(
    "instruction_stats",
    f"""with {S.INSTRUCT}, {_SPLIT}, {_CODED} select split, count(*) as total_records,
          count(*) filter (where kept) as kept_records,
          count(*) filter (where outcome = 'empty_response') as empty_responses,
          count(*) filter (where outcome = 'prompt_too_long') as prompts_too_long,
          count(*) filter (where kept and input_truncated) as inputs_truncated,
          count(*) filter (where kept and len(r) > {MAX_LENGTH} - len(p)) as responses_truncated
        from encoded join halves using (rec_id) group by split""",
)
def instruction_stats(spark, sf):
    return I.instruction_stats(_split_encoded(spark, sf), "split")


def _split_encoded(spark, sf):
    """Encoded records with their split, stored because ranks read it more than once."""
    rows = I.seeded_split(instruction_records(spark, sf), FRACTION, SEED)
    return materialize(I.encode_records(rows, Vocabulary(), MAX_LENGTH), "instructions")


_RANKED = f"""{_SPLIT}, {_CODED},
ranked as (select rec_id, split, list_concat(p, cut) as tokens, {_TARGETS} as targets,
    row_number() over (partition by split order by ord) - 1 as rk
  from encoded join halves using (rec_id) where kept)"""


def _ranked(spark, sf):
    kept = I.kept_records(_split_encoded(spark, sf))
    return rank_before(kept, "ord", "rk", group=("split",))


@query(
    "pad_batches",
    f"""with {S.INSTRUCT}, {_RANKED},
        b as (select *, rk // {BATCH} as batch_id from ranked),
        m as (select *, max(len(tokens)) over (partition by split, batch_id) as w from b)
        select split, batch_id, rec_id, w::INTEGER as padded_length,
          array_to_string(list_concat(tokens, list_transform(range(w - len(tokens)), lambda x: 3)), ',') as tokens,
          array_to_string(list_concat(targets, list_transform(range(w - len(tokens)), lambda x: -100)), ',') as targets
        from m""",
)
def pad_batches(spark, sf):
    padded = I.padded_batches(_ranked(spark, sf), "rk", BATCH, by=("split",))
    return padded.select(
        "split", "batch_id", "rec_id", "padded_length",
        F.array_join("tokens", ",").alias("tokens"), F.array_join("targets", ",").alias("targets"),
    )


@query(
    "sft_batches",
    f"""with {S.INSTRUCT}, {_RANKED}, n as (select split as s, count(*) as n from ranked group by 1),
        b as (select split, rk // {BATCH} as batch_id, count(*) as n_rows, min(rk) as first_rank,
          max(rk) as last_rank from ranked group by 1, 2)
        select b.* from b join n on s = split
        where split = 'validation' or n < {BATCH} or n_rows = {BATCH}""",
)
def sft_batches(spark, sf):
    rows = _ranked(spark, sf)
    n_train = rows.filter(F.col("split") == "train").agg(F.count("*")).scalar()
    drop = (F.col("split") == "train") & (n_train >= BATCH)
    return batches(rows, "rk", BATCH, by=("split",), drop_last=drop)
