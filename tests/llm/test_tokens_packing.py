import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lexweave.llm import packing, token_counts
from lexweave.llm.encoder import QUICK, Encoder, is_quick, load
from lexweave.llm.queries import vocabulary

PARTS = [" ", "  ", "\n", "\t", "a", "b's", "'ll", "é", "1", "23", "!", " the", "<|endoftext|>", "<|endof", "text|>", "ß", "\r\n", "\x85", "\xa0", "я", "—", "漢", "🙂"]


@pytest.fixture(scope="module")
def tokenizer():
    return load(vocabulary())


def ids(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_equals_the_library(tokenizer):
    coder, rng = Encoder(vocabulary()), random.Random(1)
    assert coder.quick is not None
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        assert coder.encode(text).tolist() == ids(tokenizer, text), text


def test_every_quick_character_is_classed_alike(tokenizer):
    quick = Encoder(vocabulary()).quick
    for c in map(chr, range(0x2100)):
        if QUICK.search(c):
            continue
        text = f"a{c}b 1{c}2 {c} x !{c}! {c}{c}  {c}\n{c}"
        assert quick.encode(text, allowed_special="all") == ids(tokenizer, text), hex(ord(c))


def test_long_runs_are_not_quick():
    assert is_quick("a few words") and not is_quick("x" * 5000) and not is_quick("a" + " " * 5000 + "b")


def test_other_files_are_encoded_in_one_go():
    coder = Encoder(vocabulary("word_bpe_49k.json"))
    text = "Some words, and more"
    assert coder.quick is None and coder.encode(text).tolist() == ids(coder.tokenizer, text)


def test_splices_equal_whole_texts(tokenizer):
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 200)))
        for chunk, overlap in ((40, 4), (64, 16), (100, 2)):
            assert token_counts.spliced_count(tokenizer, text, chunk, overlap, 14) == len(ids(tokenizer, text)), text


def test_overlaps_widen_until_they_agree(tokenizer):
    text = "a" * 3000 + " b" + " " * 700 + "c"
    assert token_counts.spliced_count(tokenizer, text, 100, 8, 14) == len(ids(tokenizer, text))


def test_counts_of_odd_rows(odd_docs, no_docs, tokenizer):
    rows = token_counts.token_counts(odd_docs, vocabulary()).collect()
    texts = sorted((r.text or "") for r in odd_docs.collect())
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == sorted(
        (len(t.encode()), n := len(ids(tokenizer, t)), n > 1024) for t in texts
    )
    assert token_counts.token_counts(no_docs, vocabulary()).count() == 0


def slow_fit(sizes, window):
    rooms = []
    for size in sorted(sizes, reverse=True):
        fits = [r for r in rooms if r >= size]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else window) - size)
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(4)
    for _ in range(200):
        window = rng.choice([1, 7, 16, 30, 100])
        sizes = [rng.randint(1, window) for _ in range(rng.randint(0, 120))]
        held = defaultdict(list)
        for _, n, first, each, offset, size in packing.best_fit(Counter(sizes), window):
            for i in range(n):
                held[first + i // each].append((offset + i % each * size, size))
        for pieces in held.values():
            ends = np.cumsum([s for _, s in sorted(pieces)])
            assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]]
        assert sorted(window - sum(s for _, s in p) for p in held.values()) == slow_fit(sizes, window)


def check_packing(rows, texts, tokenizer):
    """Every id in one piece, pieces gapless in documents and sequences."""
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[(r.doc_id, r.doc_tokens)].append(r)
        windows[r.sequence_id].append(r)
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    wanted = Counter()
    for key, text in texts:
        all_ids = np.array([*ids(tokenizer, text or ""), 0], "<u4")
        for a in range(0, len(all_ids), 1024):
            part = all_ids[a : a + 1024]
            wanted[(key, a, len(part), zlib.crc32(part.tobytes()), len(all_ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == wanted


def test_packing_round_trip(sample, odd_docs, no_docs, tokenizer):
    for docs in (sample, odd_docs):
        rows = packing.pack_documents(docs, vocabulary()).collect()
        check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], tokenizer)
    assert packing.pack_documents(no_docs, vocabulary()).count() == 0


def test_pieces_carry_their_ids(sample, tokenizer):
    row = packing.token_pieces(sample.limit(1), vocabulary(), window=16).orderBy("start").collect()
    joined = [i for r in row for i in r.ids]
    assert joined == [*ids(tokenizer, sample.limit(1).first().text), 0]
