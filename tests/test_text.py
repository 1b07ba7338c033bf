from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from lexweave.functions import text as T
from lexweave.functions import tokens as K

EDGES = [
    "a\r\nb\rc", " a　", "\u0085a ", "\u001ca\u001f", "​a", "a  b", "a\n\n\nb\n",
    " \n", "", "it's 12ab²", "éx", "新しい café", "x" + " " * 2000 + "y ", " z᠎",
]


def apply(docs_of, texts, function):
    rows = docs_of(texts).select("doc_id", function(F.col("text")).alias("r")).collect()
    return [r.r for r in sorted(rows)]


def test_normalize_matches_strip(docs_of):
    want = [t.replace("\r\n", "\n").replace("\r", "\n").strip() for t in EDGES]
    assert apply(docs_of, EDGES, T.normalize_text) == want


def test_blank_and_rstrip(docs_of):
    assert apply(docs_of, EDGES, T.is_blank) == [not t.strip() for t in EDGES]
    assert apply(docs_of, EDGES, T.rstrip) == [t.rstrip() for t in EDGES]


def test_pretokens_match_library(docs_of):
    texts = [t for t in EDGES if t]
    splitter = ByteLevel(add_prefix_space=False)
    want = [[t[a:b] for _, (a, b) in splitter.pre_tokenize_str(t)] for t in texts]
    assert apply(docs_of, texts, T.pretokens) == want


def test_special_tokens_are_whole_words(docs_of):
    got = apply(docs_of, ["a  \n<eos>\n b", "<eos><eos>x", "<pad> <bos> y", "<eos"], T.words)
    assert got == [
        ["a", "  \n", "<eos>", "\n", " b"],
        ["<eos>", "<eos>", "x"],
        ["<pad>", " ", "<bos>", " y"],
        ["<", "eos"],
    ]


def test_line_pieces_keep_newlines(docs_of):
    assert apply(docs_of, ["a\n\nb", "c\n"], T.line_pieces) == [["a\n", "\n", "b"], ["c\n"]]


def test_code_fence_outgrows_backticks(docs_of):
    got = apply(docs_of, ["plain", "a ``` b ````` c"], T.code_fence)
    assert got[0] == "```text\nplain\n```"
    assert got[1].startswith("``````text\n") and got[1].endswith("\n``````")


def test_byte_alphabet_matches_library(spark):
    letters = sorted(ByteLevel.alphabet())
    rows = spark.range(256).select("id", K.byte_id(F.col("id")).alias("t")).collect()
    assert sorted(r.t for r in rows) == list(range(4, 260))
    printable = {b: chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    rest = iter(range(256, 512))
    for b in range(256):
        printable.setdefault(b, None)
        if printable[b] is None:
            printable[b] = chr(next(rest))
    assert {r.id: r.t for r in rows} == {b: 4 + letters.index(c) for b, c in printable.items()}


def test_symbols_round_trip_across_the_surrogate_gap(spark):
    ids = [0, 259, 0xD6FF, 0xD700, 0xD701, 100_000]
    row = spark.range(1).select(K.symbols_to_ids(F.lit("".join(map(K.symbol, ids)))).alias("r"))
    assert row.first().r == ids
    assert [K.symbol(i) for i in ids] == sorted(K.symbol(i) for i in ids)


def test_draws_are_uniform_and_repeatable(spark):
    draws = spark.range(4000).select(T.uniform_draw(F.lit("7"), F.col("id").cast("string")).alias("u"))
    stats = draws.agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(stats[0] - 0.5) < 0.02 and 0 <= stats[1] and stats[2] < 1
    assert draws.orderBy("u").collect() == draws.orderBy("u").collect()


def test_token_count_is_the_number_of_ids(docs_of):
    texts = EDGES + ["<eos><eos>x<pad>", "<e<eos>os> <unk>", "<bos", "é<bos>é"]
    got = apply(docs_of, texts, K.byte_token_count)
    assert got == apply(docs_of, texts, lambda t: F.size(K.symbols_to_ids(K.byte_symbols(t))))
    assert apply(docs_of, texts[1:], K.byte_ids)[:8] == apply(docs_of, texts[1:], lambda t: K.symbols_to_ids(K.byte_symbols(t)))[:8]
