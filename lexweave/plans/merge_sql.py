"""Byte-pair learning and encoding as plain SQL, one merge at a time.

This is what the learned-vocabulary queries are checked against. It knows nothing of how
the operators take several merges a round: each step counts all pairs of all distinct
words, takes the best one and replaces it everywhere.
"""

from __future__ import annotations

from . import sql as S

#: Symbols are characters ``SHIFT`` above their token id.
SHIFT = 256
#: Merges beyond the vocabulary's free places, for merges whose text is a token already.
SPARE = 4

# ``text`` in pre-tokens; the inserted mark stands for the pattern's look-ahead
WORDS = (
    r"regexp_extract_all(regexp_replace(text, '(\s)(\s\S)', '\1' || chr(1) || '\2', 'g'), "
    r"'''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x01]+|\s+')"
)


def _symbols(word: str) -> str:
    return f"array_to_string(list_transform({S.ids(word)}, lambda i: chr(i + {SHIFT})), '')"


def _step(k: int, size: int, min_frequency: int) -> str:
    w, v = f"w{k - 1}", f"v{k - 1}"
    text = lambda at: f"(select t from {v} where id = unicode(substr(pair, {at}, 1)) - {SHIFT})"
    return f"""
b{k} as materialized (select pair from (select unnest(list_transform(range(1, length(sym)),
      lambda i: substr(sym, i, 2))) as pair, n from {w}) where (select count(*) from {v}) < {size}
    group by pair having sum(n) >= {min_frequency} order by sum(n) desc, pair limit 1),
t{k} as materialized (select pair, {text(1)} || {text(2)} as t from b{k}),
m{k} as materialized (select pair, t, coalesce((select min(id) from {v} where {v}.t = t{k}.t),
    (select count(*) from {v}))::INTEGER as new from t{k}),
v{k} as materialized (select id, t from {v} union all select new, t from m{k} where new = (select count(*) from {v})),
w{k} as materialized (select replace(sym, pair, chr(new + {SHIFT})) as sym, n from {w}, m{k})"""


def learned(size: int, min_frequency: int) -> str:
    """Tables ``merges`` (rank, left_id, right_id, new_id) and ``ml``, the merges as one list."""
    start = f"""
pieces as (select unnest(regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+')) as text from documents),
w0 as materialized (select {_symbols('word')} as sym, n from (select word, count(*) as n
    from (select unnest({WORDS}) as word from pieces) group by word)),
v0 as materialized (select ({S.ID})::INTEGER as id, printf('%02X', b) as t from (select unnest(range(256)) as b)
    union all select unnest(range(4))::INTEGER, hex(encode(unnest(['<unk>', '<bos>', '<eos>', '<pad>']))))"""
    last = size - 260 + SPARE
    steps = [_step(k, size, min_frequency) for k in range(1, last + 1)]
    rows = " union all ".join(f"select {k - 1} as rank, pair, new from m{k}" for k in range(1, last + 1))
    end = f"""
merges as materialized (select rank::INTEGER as rank, (unicode(substr(pair, 1, 1)) - {SHIFT})::INTEGER as left_id,
    (unicode(substr(pair, 2, 1)) - {SHIFT})::INTEGER as right_id, new as new_id,
    pair || chr(new + {SHIFT}) as m from ({rows})),
ml as materialized (select list(m order by rank) as ml from merges)"""
    return ",".join([start, *steps, end])


def encoded(source: str, name: str) -> str:
    """Table ``name`` (key, s) with the symbols of ``source`` (key, text): merges in rank order."""
    replay = (
        f"list_reduce(list_prepend({_symbols('word')}, ml), lambda s, m: "
        "replace(s, substr(m, 1, 2), substr(m, 3, 1)))"
    )
    return f"""
{name}_w as materialized (select key, unnest(ws) as word, generate_subscripts(ws, 1) as pos
    from (select key, {WORDS} as ws from {source})),
{name}_l as materialized (select word, {replay} as s from (select distinct word from {name}_w), ml),
{name}_s as materialized (select key, string_agg(s, '' order by pos) as s
    from {name}_w join {name}_l using (word) group by key),
{name} as materialized (select key, coalesce(s, '') as s from {source} left join {name}_s using (key))"""


def symbol_ids(column: str) -> str:
    """Token ids of a symbol string."""
    return (
        f"list_transform(list_filter(string_split({column}, ''), lambda c: c <> ''), "
        f"lambda c: (unicode(c) - {SHIFT})::INTEGER)"
    )


def longest_inputs(source: str, room: int, prompt: str, steps: int) -> str:
    """Table ``cut`` (key, taken): the halving search over the input's length in tokens.

    ``source`` has ``key, input`` and what ``prompt`` (SQL over ``part``) needs.
    """
    tables = [f"h0 as (select *, 0 as low, length(input)::INTEGER as high from {source})"]
    for k in range(1, steps + 1):
        tables.append(
            f"""a{k} as materialized (select *, low + (high - low + 1) // 2 as middle from h{k - 1}),
q{k} as materialized (select key, {prompt} as text from (select *, substr(input, 1, middle) as part from a{k}
    where low < high)), {encoded(f'q{k}', f'c{k}')},
h{k} as materialized (select a{k}.* exclude (middle, low, high),
    case when low < high and length(s) <= {room} then middle else low end as low,
    case when low < high and length(s) > {room} then middle - 1 else high end as high
  from a{k} left join c{k} using (key))"""
        )
    tables.append(f"cut as materialized (select key, low as taken from h{steps})")
    return ",\n".join(tables)
