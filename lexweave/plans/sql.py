"""Shared pieces of the independent SQL the queries are checked against."""

ID = (
    "case when b between 33 and 126 then b - 29 when b between 161 and 172 then b - 63 "
    "when b between 174 and 255 then b - 64 when b between 0 and 32 then b + 192 "
    "when b between 127 and 160 then b + 98 else 259 end"
)


def ids(text: str) -> str:
    """Byte token ids of a text free of special tokens."""
    return (
        f"list_transform(list_transform(regexp_extract_all(hex(encode({text})), '..'), "
        f"lambda h: ('0x' || h)::INTEGER), lambda b: ({ID})::INTEGER)"
    )


INSTRUCT = """
turns as (select conv_id, turn, role, text,
    lead(role) over (partition by conv_id order by turn) as next_role,
    lead(text) over (partition by conv_id order by turn) as next_text,
    lag(text) over (partition by conv_id order by turn) as prev_text
  from conversations),
instruct as (select conv_id*100+turn as rec_id, text as instruction,
    coalesce(prev_text, '') as input,
    case when next_role = 'assistant' then next_text else '' end as output
  from turns where role = 'user')"""

CHOICE = r"""
mcw as (select *, string_split(regexp_replace(text, '[ \n]+', ' ', 'g'), ' ') as ws from documents),
mc as (select doc_id as idx, text as question, lang || '_grp_' || (doc_id % 3) as subject,
    list_slice(ws, greatest(1, len(ws) - 3), len(ws)) as choices,
    ((doc_id // 3) % 4)::INTEGER as answer,
    case when (doc_id // 7) % 5 = 0 then 'dev' else 'test' end as split from mcw)"""

MC_OK = "length(trim(question)) > 0 and length(trim(subject)) > 0 and len(choices) = 4 and answer between 0 and 3"


def score(label: int, index: str = "idx", salt: int = 0) -> str:
    return (
        f"((({index} * 7919 + {(label + 1) * (104729 + salt)} + {index} * {label * 31}) % 1009 + 1)"
        f" / 100.0::DOUBLE * -1.0::DOUBLE)"
    )


def scores(index: str = "idx", salt: int = 0) -> str:
    return "[" + ", ".join(score(l, index, salt) for l in range(4)) + "]"


LABEL = "['A', 'B', 'C', 'D']"

# Test questions with their scores, prediction and correctness.
PREDICTED = f"""{CHOICE},
scored as (select *, {scores()} as s from mc where split = 'test' and {MC_OK}),
preds as (select *, (list_position(s, list_max(s)) - 1)::INTEGER as predicted from scored),
judged as (select *, predicted = answer as correct from preds)"""

STREAM = f"""
st as (select doc_id, list_concat({ids('text')}, [202, 2, 202]) as ids from documents),
off as (select doc_id, ids, len(ids)::BIGINT as n_tokens,
    (sum(len(ids)) over (order by doc_id) - len(ids))::BIGINT as start_pos from st),
tot as (select sum(n_tokens)::BIGINT as n from off),
tokens as (select doc_id, start_pos + i as pos, tok from
    (select doc_id, start_pos, unnest(ids) as tok, generate_subscripts(ids, 1) - 1 as i from off))"""

# The same offsets from byte lengths alone.
OFFSETS = """
ln as (select doc_id, (strlen(text) + 3)::BIGINT as n_tokens from documents),
off as (select doc_id, n_tokens,
    (sum(n_tokens) over (order by doc_id) - n_tokens)::BIGINT as start_pos from ln),
tot as (select sum(n_tokens)::BIGINT as n from off)"""
