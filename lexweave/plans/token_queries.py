"""Registered queries: vocabulary, encoding, token tables, LM datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import EOS_ID, PAD_ID
from ..functions.tokens import byte_ids
from ..operators import token_tables as D
from ..operators.encoding import decode_ids, encode_corpus
from ..operators.vocabulary import Vocabulary, required_special_tokens, train_vocabulary
from ..session import fresh_path
from . import merge_sql as M
from . import sql as S
from .views import byte_lengths, dealt_documents, documents, story_stream

QUERIES, ORACLES = {}, {}
VOCAB_SIZE = 320
FULL_SIZE = 10_000
BLOCK = 128
_learned: dict[tuple[str, str], Vocabulary] = {}


def query(name, oracle=None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def learned_vocabulary(spark, sf) -> Vocabulary:
    """Vocabulary of the corpus, learned once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _learned:
        _learned[key] = train_vocabulary(dealt_documents(spark, sf), VOCAB_SIZE, 2)
    return _learned[key]


LEARNED = M.learned(VOCAB_SIZE, 2)


@query("bpe_merges", f"with {LEARNED} select rank, left_id, right_id, new_id from merges")
def bpe_merges(spark, sf):
    return learned_vocabulary(spark, sf).merge_table(spark)


@query("bpe_merges_full")
def bpe_merges_full(spark, sf):
    """A vocabulary of the usual size; tests compare its merges with another implementation."""
    return train_vocabulary(dealt_documents(spark, sf), FULL_SIZE, 2).merge_table(spark)


@query(
    "encode_corpus",
    f"""with {LEARNED}, src as (select doc_id as key, text from documents), {M.encoded('src', 'coded')}
        select key as doc_id, length(s)::INTEGER as n_tokens,
          array_to_string({M.symbol_ids('s')}, ',') as ids from coded""",
)
def encode_learned(spark, sf):
    encoded = encode_corpus(dealt_documents(spark, sf), learned_vocabulary(spark, sf))
    return encoded.select("doc_id", F.size("ids").alias("n_tokens"), F.array_join("ids", ",").alias("ids"))


@query(
    "encode_bytes",
    f"""select doc_id, len({S.ids('text')})::INTEGER as n_tokens,
          array_to_string({S.ids('text')}, ',') as ids from documents""",
)
def encode_bytes(spark, sf):
    encoded = encode_corpus(dealt_documents(spark, sf), Vocabulary())
    return encoded.select("doc_id", F.size("ids").alias("n_tokens"), F.array_join("ids", ",").alias("ids"))


@query("decode_corpus", "select doc_id, text from documents")
def decode_corpus(spark, sf):
    vocabulary = learned_vocabulary(spark, sf)
    encoded = encode_corpus(dealt_documents(spark, sf), vocabulary)
    return encoded.select("doc_id", decode_ids(F.col("ids"), vocabulary).alias("text"))


@query("decode_bytes", "select doc_id, text || chr(10) || chr(10) as text from documents")
def decode_bytes(spark, sf):
    stories = D.story_tokens(dealt_documents(spark, sf), Vocabulary())
    return stories.select("doc_id", decode_ids(F.col("ids"), Vocabulary(), skip_special=True).alias("text"))


@query(
    "vocab_lookup",
    f"""with t as (select unnest({S.ids('text')}) as token_id from documents)
        select token_id, count(*) as n, false as special, {EOS_ID} as eos_id, {PAD_ID} as pad_id,
          260::BIGINT as vocab_size from t group by token_id
        union all select i::INTEGER, 0, true, {EOS_ID}, {PAD_ID}, 260 from range(4) r(i)""",
)
def vocab_lookup(spark, sf):
    vocabulary = Vocabulary()
    vocab = required_special_tokens(vocabulary.vocab_table(spark))
    used = documents(spark, sf).select(F.explode(byte_ids(F.col("text"))).alias("token_id"))
    counts = used.groupBy("token_id").agg(F.count("*").alias("n"))
    found = vocab.join(counts, "token_id", "left").filter(F.col("n").isNotNull() | F.col("special"))
    return found.select(
        "token_id",
        F.coalesce("n", F.lit(0)).alias("n"),
        "special",
        F.lit(vocabulary.eos_id).alias("eos_id"),
        F.lit(vocabulary.pad_id).alias("pad_id"),
        F.lit(vocabulary.size).cast("bigint").alias("vocab_size"),
    )


# --- token tables -----------------------------------------------------------------


@query("token_offsets", f"with {S.OFFSETS} select doc_id, n_tokens, start_pos from off")
def token_offsets(spark, sf):
    return byte_lengths(spark, sf)


@query(
    "token_cache",
    f"""with {S.STREAM} select doc_id, md5(doc_id || chr(31) || text) as content, n_tokens,
          md5(array_to_string(ids, ',')) as ids_md5 from off join documents using (doc_id)""",
)
def token_cache(spark, sf):
    base = fresh_path(spark, "token-cache")
    D.write_token_cache(documents(spark, sf), Vocabulary(), base)
    held, reused = D.write_token_cache(documents(spark, sf), Vocabulary(), base)
    if not reused:
        raise AssertionError("an unchanged corpus must be served from the cache")
    return held.select(
        "doc_id", "content", "n_tokens", F.md5(F.array_join("ids", ",")).alias("ids_md5")
    )


_FINGERPRINT = "sha256('<unk>' || chr(10) || '<bos>' || chr(10) || '<eos>' || chr(10) || '<pad>')"


@query(
    "cache_manifest",
    f"""select 1 as version, count(*) as source_rows, sum(strlen(text))::BIGINT as source_bytes,
          (sum(('0x' || substr(md5(doc_id || chr(31) || text), 1, 15))::HUGEINT) % 1152921504606846976)::BIGINT as source_hash,
          {_FINGERPRINT} as vocab_sha256, 260::BIGINT as vocab_size, 'uint16' as dtype,
          sum(strlen(text) + 3)::BIGINT as token_count from documents""",
)
def cache_manifest(spark, sf):
    docs = documents(spark, sf)
    return D.cache_manifest(docs, D.story_tokens(docs, Vocabulary()), Vocabulary())


@query(
    "incremental_encode",
    f"""select doc_id, case when n_chars % 5 = 0 then 'new' else 'changed' end as reason,
          md5(array_to_string(list_concat({S.ids('text')}, [202, 2, 202]), ',')) as ids_md5
        from documents where n_chars % 5 = 0 or n_chars % 11 = 0""",
)
def incremental_encode(spark, sf):
    docs = documents(spark, sf)
    # what an earlier run held: some rows missing, some with older text
    older = F.when(F.col("n_chars") % 11 == 0, F.upper(F.concat("text", F.lit("?")))).otherwise(F.col("text"))
    earlier = docs.filter(F.col("n_chars") % 5 != 0).withColumn("text", older)
    cached = earlier.select("doc_id", D.content_hash().alias("content"))
    stale = D.stale_rows(docs, cached)
    fresh = D.story_tokens(stale, Vocabulary())
    return stale.select("doc_id", "reason").join(fresh, "doc_id").select(
        "doc_id", "reason", F.md5(F.array_join("ids", ",")).alias("ids_md5")
    )


FRACTION = 0.9
_CUT = f"cut as (select floor(n * {FRACTION}::DOUBLE)::BIGINT as c from tot)"
_PIECES = f"""{_CUT},
pieces as (select doc_id, 'train' as split, start_pos as from_pos,
    least(start_pos + n_tokens, c) - start_pos as n_tokens, 0::BIGINT as "first"
  from off, cut where start_pos < c
  union all select doc_id, 'validation', greatest(start_pos, c),
    start_pos + n_tokens - greatest(start_pos, c), greatest(0, c - start_pos)
  from off, cut where start_pos + n_tokens > c)"""


@query(
    "contiguous_split",
    f"""with {S.OFFSETS}, {_PIECES} select doc_id, split, from_pos, n_tokens, "first" from pieces""",
)
def contiguous_split(spark, sf):
    return D.contiguous_split(story_stream(spark, sf).drop("ids"), FRACTION)


@query(
    "lm_windows",
    f"""with {S.STREAM},
        x as (select pos // {BLOCK} as w, string_agg(tok::VARCHAR, ',' order by pos) as inputs, count(*) as n
          from tokens group by 1),
        y as (select (pos - 1) // {BLOCK} as w, string_agg(tok::VARCHAR, ',' order by pos) as targets, count(*) as n
          from tokens where pos > 0 group by 1)
        select w * {BLOCK} as start, md5(inputs) as inputs_md5, md5(targets) as targets_md5
        from x join y using (w) where y.n = {BLOCK} and x.n = {BLOCK}""",
)
def lm_windows(spark, sf):
    windows = D.shifted_windows(story_stream(spark, sf), BLOCK, BLOCK)
    return windows.select(
        "start",
        F.md5(F.array_join("inputs", ",")).alias("inputs_md5"),
        F.md5(F.array_join("targets", ",")).alias("targets_md5"),
    )


SAMPLE_SEED = 7


@query(
    "sample_windows",
    f"""with {S.STREAM},
        draws as (select doc_id as sample, floor((('0x' || substr(md5('{SAMPLE_SEED}:' || doc_id), 1, 8))::BIGINT
            / 4294967296.0::DOUBLE) * (n - {BLOCK}))::BIGINT as start from documents, tot),
        w as (select sample, start, start + unnest(range({BLOCK})) as pos from draws)
        select sample, start, md5(string_agg(t.tok::VARCHAR, ',' order by w.pos)) as inputs_md5,
          md5(string_agg(u.tok::VARCHAR, ',' order by w.pos)) as targets_md5
        from w join tokens t on t.pos = w.pos join tokens u on u.pos = w.pos + 1
        group by sample, start""",
)
def sample_windows(spark, sf):
    samples = documents(spark, sf).select(F.col("doc_id").alias("sample"))
    windows = D.sampled_windows(story_stream(spark, sf), BLOCK, samples, SAMPLE_SEED)
    return windows.select(
        "sample",
        "start",
        F.md5(F.array_join("inputs", ",")).alias("inputs_md5"),
        F.md5(F.array_join("targets", ",")).alias("targets_md5"),
    )


BATCH = 32


@query(
    "batches",
    f"""with {S.OFFSETS}, {_CUT},
        w as (select split, k from (select 'train' as split, unnest(range(0, greatest(0, c - {BLOCK}), {BLOCK})) // {BLOCK} as k from cut
          union all select 'validation', unnest(range(0, greatest(0, n - c - {BLOCK}), {BLOCK})) // {BLOCK} from cut, tot)),
        b as (select split, k // {BATCH} as batch_id, count(*) as n_rows, min(k) as first_rank,
          max(k) as last_rank from w group by 1, 2)
        select * from b where split = 'validation' or n_rows = {BATCH}""",
)
def batches(spark, sf):
    pieces = D.contiguous_split(story_stream(spark, sf), FRACTION)
    cut = pieces.filter(F.col("split") == "validation").agg(F.min("from_pos")).scalar()
    sides = []
    for name in ("train", "validation"):
        side = pieces.filter(F.col("split") == name).select(
            "ids", "n_tokens", (F.col("from_pos") - (F.lit(0) if name == "train" else cut)).alias("start_pos")
        )
        windows = D.shifted_windows(side, BLOCK, BLOCK)
        sides.append(
            windows.select(
                F.lit(name).alias("split"), F.floor(F.col("start") / BLOCK).alias("k")
            )
        )
    ranked = sides[0].unionByName(sides[1])
    return D.batches(ranked, "k", BATCH, by=("split",), drop_last=F.col("split") == "train")
