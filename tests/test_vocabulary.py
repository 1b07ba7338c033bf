import json
import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.decoders import ByteLevel as Decoder
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import ByteLevel
from tokenizers.trainers import BpeTrainer

from lexweave.constants import SPECIAL_TOKENS
from lexweave.operators import encoding, vocabulary as V
from lexweave.session import materialize

TEXTS = [
    "a\n\n\nb\n", "the cat the hat  the bat\n<eos>\n", "abc cab élan <eos>", "aaaa aaa aa aaaaaaa",
    "it's what they've said, isn't it? 2024 20 2 42", "新しい café café", " lead and trail  ",
]


def library(texts, size, minimum):
    backend = Tokenizer(BPE(unk_token="<unk>"))
    backend.pre_tokenizer, backend.decoder = ByteLevel(add_prefix_space=False), Decoder()
    backend.train_from_iterator(
        texts,
        BpeTrainer(
            vocab_size=size, min_frequency=minimum, special_tokens=list(SPECIAL_TOKENS),
            initial_alphabet=ByteLevel.alphabet(), show_progress=False,
        ),
    )
    return backend


def merges_of(backend):
    model = json.loads(backend.to_str())["model"]
    ids = model["vocab"]
    return [(ids[a], ids[b], ids[a + b]) for a, b in model["merges"]]


@pytest.fixture(scope="module")
def corpus_texts():
    pick = random.Random(5)
    words = ["the", "then", "hen", "aab", "baab", "été", "tea", "eat", "neat", "aaaa"]
    return TEXTS + [" ".join(pick.choices(words, k=60)) for _ in range(20)]


@pytest.fixture(scope="module")
def learned(docs_of, corpus_texts):
    return V.train_vocabulary(docs_of(corpus_texts), 300, 1, by_line=False)


def test_merges_match_library(learned, corpus_texts):
    assert list(learned.merges) == merges_of(library(corpus_texts, 300, 1))


@pytest.mark.parametrize("pairs,chars", [(1, 4), (2, 200), (5, 4_000), (64, 1 << 20)])
def test_rounds_of_any_size_learn_the_same(docs_of, corpus_texts, monkeypatch, pairs, chars):
    monkeypatch.setattr(V, "FIRST_PAIRS", pairs)
    monkeypatch.setattr(V, "CANDIDATES", pairs * 4)
    monkeypatch.setattr(V, "PIECE_CHARS", chars)
    got = V.train_vocabulary(docs_of(corpus_texts), 290, 1, by_line=False)
    assert list(got.merges) == merges_of(library(corpus_texts, 290, 1))


def test_a_real_vocabulary_matches_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r.text for r in docs.select("text").collect()]
    got = V.train_vocabulary(docs, 10_000, 2, by_line=False)
    assert list(got.merges) == merges_of(library(texts, 10_000, 2))
    assert len(got.merges) > 5_000


def test_minimum_frequency_ends_learning(docs_of):
    texts = ["abab abab cd", "xyxy"]
    got = V.train_vocabulary(docs_of(texts), 1000, 3, by_line=False)
    assert list(got.merges) == merges_of(library(texts, 1000, 3))


def test_learning_by_line_sees_lines(docs_of):
    text = "a\n\n\nb\n" * 3
    by_line = V.train_vocabulary(docs_of([text]), 270, 1)
    whole = V.train_vocabulary(docs_of([text]), 270, 1, by_line=False)
    assert list(by_line.merges) == merges_of(library(text.splitlines(keepends=True), 270, 1))
    assert list(whole.merges) == merges_of(library([text], 270, 1))
    assert by_line.merges != whole.merges


def test_encoding_matches_library(docs_of, learned, corpus_texts):
    backend = library(corpus_texts, 300, 1)
    texts = corpus_texts + ["<eos><eos>x", "<pad> <bos> y", "<eos", "a  \n<eos>\n b", "unseen wörds!", ""]
    rows = encoding.encode_corpus(docs_of(texts), learned).collect()
    got = {r.doc_id: r.ids for r in rows}
    for i, text in enumerate(texts):
        assert got[i] == backend.encode(text, add_special_tokens=False).ids, text
    local = encoding.text_encoder(learned)
    assert [local(t) for t in texts] == [got[i] for i in range(len(texts))]


def test_null_text_and_long_words(docs_of, learned, monkeypatch):
    monkeypatch.setattr(encoding, "SEEN_WORDS", 2)
    df = docs_of([None, "", "the " * 3000 + "a" * 5000, "the"])
    got = {r.doc_id: r.ids for r in encoding.encode_corpus(df, learned).collect()}
    assert got[0] is None and got[1] == []
    back = encoding.encode_corpus(df, learned).select("doc_id", encoding.decode_ids(F.col("ids"), learned).alias("t"))
    assert {r.doc_id: r.t for r in back.collect()}[2] == "the " * 3000 + "a" * 5000
    count = encoding.token_count_udf(learned)
    sizes = {r.doc_id: r.n for r in df.select("doc_id", count("text").alias("n")).collect()}
    assert sizes == {i: None if x is None else len(x) for i, x in got.items()}


def test_decode_round_trip(docs_of, learned):
    df = docs_of(["abc cab élan <eos>", "新しい café"])
    coded = materialize(encoding.encode_corpus(df, learned), "coded")
    exact = coded.select("doc_id", encoding.decode_ids(F.col("ids"), learned).alias("t"))
    assert [r.t for r in exact.orderBy("doc_id").collect()] == ["abc cab élan <eos>", "新しい café"]
    plain = coded.select("doc_id", encoding.decode_ids(F.col("ids"), learned, True).alias("t"))
    assert plain.orderBy("doc_id").first().t == "abc cab élan "


def test_malformed_bytes_decode_to_replacement(spark):
    vocabulary = V.Vocabulary()
    lead = vocabulary.tokens.index(b"\xc3")
    row = spark.range(1).select(encoding.decode_ids(F.array(F.lit(lead), F.lit(4)), vocabulary).alias("t"))
    assert row.first().t == "�!"


def test_sizes_are_checked(docs_of):
    with pytest.raises(ValueError, match="byte alphabet"):
        V.train_vocabulary(docs_of(["a"]), 259)
    with pytest.raises(ValueError, match="does not define"):
        V.Vocabulary().token_id("<mask>")
    assert (V.Vocabulary().eos_id, V.Vocabulary().pad_id, V.Vocabulary().size) == (2, 3, 260)


def test_save_and_load(spark, base, learned):
    learned.save(spark, base)
    again = V.Vocabulary.load(spark, base)
    assert again == learned and again.fingerprint == learned.fingerprint
    with pytest.raises(ValueError, match="<eos>"):
        V.required_special_tokens(learned.vocab_table(spark).filter("token_id <> 2"))


def test_token_counts(docs_of, learned):
    count = encoding.token_count_udf(learned)
    rows = docs_of(TEXTS).select("doc_id", count("text").alias("n"))
    coded = encoding.encode_corpus(docs_of(TEXTS), learned).select("doc_id", F.size("ids").alias("n"))
    assert sorted(rows.collect()) == sorted(coded.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lines_encode_like_the_joined_text(docs_of, learned, corpus_texts, seed):
    from lexweave.operators.token_tables import line_blocks

    pick = random.Random(seed)
    pieces = ["the hat", " = tea = ", "", " ", "  eat", "neat  ", "\t", "<eos>", " <eos> x", "a<pad>", "　été", "12 "]
    lines = [pick.choice(pieces) for _ in range(60)]
    whole = "".join(line + "\n" for line in lines)
    blocks = line_blocks(docs_of(lines))
    assert "".join(r.text for r in blocks.orderBy("doc_id").collect()) == whole
    coded = encoding.encode_corpus(blocks, learned).orderBy("doc_id").collect()
    want = library(corpus_texts, 300, 1).encode(whole, add_special_tokens=False).ids
    assert [i for r in coded for i in r.ids] == want
