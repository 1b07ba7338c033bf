import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from lexweave.llm import labelled, quality, surrogates, toxicity
from lexweave.llm.queries import vocabulary
from lexweave.llm.encoder import load
from lexweave.session import materialize
from test_tokens_packing import check_packing

SF = "/root/testdata/sf0.01"


def test_fold_is_the_crc_of_the_id(spark):
    rows = spark.range(200).select("id", labelled.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_training_rows_are_bounded_and_never_held_out(spark, odd_docs, labels):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    marks = spark.range(4000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    rows = labelled.training_rows(docs, marks, "toxic", bound=500).collect()
    assert 400 < len(rows) < 600 and all(r.fold != 2 for r in rows)
    known = labelled.training_rows(odd_docs, labels, "toxic").collect()
    assert {r.text for r in known if r.text.startswith("A plain")} and all(r.label in (0, 1) for r in known)


def slow_segments(values):
    """Maximal segments by their definition: the best one first, then left and right of it."""
    if not values:
        return []
    best = max(((sum(values[a : b + 1]), -(b - a), -a, a, b) for a in range(len(values)) for b in range(a, len(values))))
    if best[0] <= 0:
        return []
    a, b = best[3], best[4]
    right = [(s, x + b + 1, y + b + 1) for s, x, y in slow_segments(values[b + 1 :])]
    return slow_segments(values[:a]) + [(best[0], a, b)] + right


def test_segments_match_their_definition():
    rng = random.Random(6)
    for _ in range(300):
        drift = rng.choice([0.3, 0.7])
        n = rng.randint(1, 18)
        up = {i: rng.randint(1, 20) + rng.random() for i in range(n) if rng.random() < 0.4}
        values = [up[i] if i in up else -drift for i in range(n)]
        found = toxicity.maximal_segments(sorted(up), [up[i] for i in sorted(up)], drift)
        assert [(a, b) for _, a, b in found] == [(a, b) for _, a, b in slow_segments(values)]
        assert np.allclose([s for s, _, _ in found], [s for s, _, _ in slow_segments(values)])


def test_decay_solves_its_equation():
    scores, shares = np.array([2.0, 1.0, -0.5]), np.array([0.02, 0.08, 0.9])
    rate = toxicity.decay(scores, shares)
    assert abs((shares * np.exp(rate * scores)).sum() - 1) < 1e-6


def test_monotone_shares():
    shares = toxicity.monotone(np.array([1.0, 5, 2, 9]), np.array([10.0, 10, 10, 10]))
    assert shares.tolist() == [0.1, 0.35, 0.35, 0.9]


def held_out_rates(rows, label):
    rows = [r for r in rows if r.held_out and r[label] is not None]
    ones = [r for r in rows if r[label] == 1]
    zeros = [r for r in rows if r[label] == 0]
    return sum(r.predicted for r in ones) / len(ones), sum(r.predicted for r in zeros) / len(zeros)


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_toxicity_on_held_out_rows(spark):
    docs, marks = tables(spark)
    rows = toxicity.score_toxicity(docs, marks).join(marks, "doc_id").collect()
    caught, wrong = held_out_rates(rows, "toxic")
    assert caught > 0.5 and wrong < 0.06


def test_toxic_passages_are_found(spark):
    docs, marks = tables(spark)
    model = toxicity.fit(toxicity.training_rows(docs, marks, "toxic"))
    rng = random.Random(7)
    calm = " ".join(rng.choice(["the", "of", "and", "this", "that"]) for _ in range(300))
    bad = "stupid idiot pathetic scum"
    frame = spark.createDataFrame([(1, f"{calm} {bad} {calm} {bad} {calm}"), (2, calm), (3, None), (4, "")], "doc_id long, text string")
    found = toxicity.toxic_passages(frame, model).collect()
    assert [(r.doc_id, r.passage) for r in found] == [(1, bad), (1, bad)]
    assert [r.doc_id for r in toxicity.drop_toxic(frame.union(docs.select("doc_id", "text").filter("false")), marks).collect()]


def test_nothing_is_dropped_without_labels(odd_docs, labels):
    assert toxicity.drop_toxic(odd_docs, labels.filter("false")).count() == odd_docs.count()


def test_quality_on_held_out_rows(spark):
    docs, marks = tables(spark)
    rows = quality.score_quality(docs, marks).join(marks, "doc_id").collect()
    kept, wrong = held_out_rates(rows, "quality")
    assert kept > 0.95 and wrong < 0.4


def test_quality_scores_are_dot_products():
    texts = pa.array(["One two two three", "", None, "### $$$ ###", "One two two three"])
    weights = np.random.default_rng(1).normal(size=quality.BUCKETS).astype(np.float32)
    model = quality.Model(weights, 0.25)
    bucket, value, first = quality.features(texts)
    for i, score in enumerate(model.score(texts)):
        own = slice(first[i], first[i + 1])
        margin = float((weights[bucket[own]] * value[own]).sum()) + 0.25
        assert score == pytest.approx(1 / (1 + np.exp(-margin)))
    assert model.score(texts)[0] == model.score(texts)[4]


@pytest.mark.parametrize("operator", [toxicity.score_toxicity, quality.score_quality])
def test_classifiers_of_odd_rows(operator, odd_docs, no_docs, labels):
    rows = operator(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for r in [r for r in rows if r.doc_id in (1, 2)]:
        by_text.setdefault("same", set()).add(r.score)
    assert len(by_text["same"]) == 1
    assert operator(no_docs, labels).count() == 0
    plain = operator(odd_docs, labels.filter("false")).collect()
    assert {r.score for r in plain} == {0.5}


TEXTS = [
    "Mail bob.Smith34@mail7.example.com or BOB.smith34@MAIL7.example.com, x@mail7.example.com; "
    "call +1 (936) 555-7209, +1-936-555-7209, (936) 555-7209.",
    'ip 144.137.247.239 and 8.20.209.178 card 7536784127813050 4111-1111-1111-1111 '
    'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce" "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"!!',
    "Mrs. Jane Doe met Mr John Doe and Mr. Doe and г-жа Иванова; ssn 123-45-6789",
    None,
    "",
    "nothing 12 here on 2024-01-01, version 3.0 or 1.2.3",
]


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10


def test_surrogates_keep_type_format_and_mentions(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = {r.doc_id: r for r in surrogates.surrogate_report(docs).collect()}
    assert rows[3].text is None and rows[4].text == "" and rows[5].text == TEXTS[5]
    mails = re.findall(r"\S+@[\w.]+\w", rows[0].text)
    assert mails[0].lower() == mails[1].lower() and mails[0] != mails[1]
    assert len({m.split("@")[1].lower() for m in mails}) == 1 and mails[0] not in TEXTS[0]
    phones = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}|\+1-\d{3}-\d{3}-\d{4}|(?<!1 )\(\d{3}\) \d{3}-\d{4}", rows[0].text)
    assert len({re.sub(r"^1", "", re.sub(r"\D", "", p)) for p in phones}) == 1 and len(phones) == 3
    assert re.sub(r"\d", "9", rows[0].text.split(";")[1]) == re.sub(r"\d", "9", TEXTS[0].split(";")[1])
    old, new = TEXTS[1].split(), rows[1].text.split()
    for k in (1, 3):
        assert new[k] != old[k] and all(0 <= int(o) <= 255 for o in new[k].split("."))
    for k in (5, 6):
        assert luhn(old[k]) == luhn(new[k]) and re.sub(r"\d", "9", old[k]) == re.sub(r"\d", "9", new[k])
    assert re.fullmatch(r'"[0-9a-f]{40}"', new[9]) and re.fullmatch(r'"[0-9A-F]{40}"!!', new[10])
    names = re.fullmatch(r"Mrs\. (\w+) (\w+) met Mr (\w+) (\w+) and Mr\. (\w+) and г-жа ([а-яА-Я]+); ssn \d{3}-\d{2}-\d{4}", rows[2].text)
    given, family, other, family2, family3, _ = names.groups()
    assert family == family2 == family3 and given.endswith("a") and not other.endswith("a") and given != other
    assert (rows[0].n_entities, rows[1].n_entities, rows[2].n_entities) == (6, 6, 5)


def test_one_family_name_after_different_titles(spark):
    docs = spark.createDataFrame([(1, "Mr Smith, Mrs Smith and Dr Smith met Ms Jones")], "doc_id long, text string")
    names = re.fullmatch(r"Mr (\w+), Mrs (\w+) and Dr (\w+) met Ms (\w+)", surrogates.replace_entities(docs).first().text).groups()
    assert len(set(names[:3])) == 1 and names[3] != names[0] and not {"Smith", "Jones"} & set(names)


def test_texts_with_one_entity_pass_the_hint(spark):
    alone = ["dns 8.8.8.8 used", "1.1.1.1", "deadbeef" * 4, "DEADBEEF" * 4, "a@b.de", "AKIA" + "A" * 16, "sk-" + "a" * 20,
             "ghp_" + "a" * 20, "+1 2 34 56", "123-45-6789", "4111 1111 1111 1111", "Dr. Who", "г-жа Иванова"]
    docs = spark.createDataFrame(list(enumerate(alone)), "doc_id long, text string")
    rows = surrogates.surrogate_report(docs).collect()
    assert all(r.n_entities == 1 and r.text != alone[r.doc_id] for r in rows)


def test_whole_names_and_long_secrets(spark):
    names = ["Mr O'Brien", "Dr Jean-Luc Picard", "Ms McDonald", "Dr Anna Maria Lopez", "Mr. J. Smith", "Prof. Dr. Ludwig van Beethoven"]
    secrets = ["0123456789abcdef" * 10, "sk-" + "aB3" * 60, "ab" * 1_000]
    texts = [*(f"Then {n} spoke." for n in names), *(f"key {s} end" for s in secrets),
             "Mrs Anna Lopez came. Lopez's car; Anna Lopez, and Anna. Lopezian"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in surrogates.surrogate_report(docs).collect()}
    for i in range(len(names)):
        assert rows[i].n_name == rows[i].n_entities == 1
        assert not re.search(r"Brien|Jean|Luc|Picard|Donald|Anna|Maria|Lopez|Smith|Ludwig|Beethoven", rows[i].text)
    assert re.fullmatch(r"Then Mr\. [A-Z]\. [A-Z][a-z]+ spoke\.", rows[4].text)
    for i, secret in enumerate(secrets, len(names)):
        assert rows[i].n_secret == 1 and len(rows[i].text) == len(texts[i]) and secret[-40:] not in rows[i].text
    last = re.fullmatch(r"Mrs (\w+) (\w+) came\. (\w+)'s car; (\w+) (\w+), and (\w+)\. Lopezian", rows[len(texts) - 1].text)
    a, b, c, d, e, f = last.groups()
    assert a == d == f != "Anna" and b == c == e != "Lopez" and rows[len(texts) - 1].n_name == 4
    again = [r.text for r in surrogates.replace_entities(docs).orderBy("doc_id").collect()]
    assert again == [rows[i].text for i in range(len(texts))]


def test_surrogates_are_distinct(spark):
    rng = random.Random(8)
    phones = {f"+1 ({rng.randint(100, 999)}) {rng.randint(100, 999)}-{rng.randint(0, 9999):04d}" for _ in range(400)}
    ips = {".".join(str(rng.randint(0, 255)) for _ in range(4)) for _ in range(400)}
    mails = {f"u{rng.randint(0, 999)}@h{rng.randint(0, 9)}.org" for _ in range(400)}
    docs = spark.createDataFrame([(i, e) for i, e in enumerate([*phones, *ips, *mails])], "doc_id long, text string")
    new = [r.text for r in surrogates.replace_entities(docs).collect()]
    assert len(set(new)) == len(new) == docs.count()
    assert not set(new) & {r.text for r in docs.collect() if "@" not in r.text and r.text in new[r.doc_id : r.doc_id + 1]}
    other = [r.text for r in surrogates.replace_entities(docs, key="other").collect()]
    assert other != new


def test_surrogates_keep_letter_case_and_script(spark):
    texts = ["Dr SMITH came", "Dr Smith came", "Dr Παπαδόπουλος came", "Mrs ANNA Петрова came", "Mr Ж. Կարապետյան came"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    new = [r.text for r in surrogates.replace_entities(docs).orderBy("doc_id").collect()]
    words = [re.fullmatch(r"(?:Dr|Mrs|Mr) (.+) came", n).group(1) for n in new]
    assert words[0].isupper() and words[0] == words[1].upper() != "SMITH" and words[1].istitle()
    assert re.fullmatch("[Α-Ω][α-ωά-ώ]{11}", words[2]) and words[2] != "Παπαδόπουλος"
    assert re.fullmatch("[A-Z]{4}NA [А-Я][а-я]{6}", words[3]) and "Петрова" not in words[3]
    assert re.fullmatch("[А-ЯЀ-ԯ]\\. [Ա-Ֆ][ա-ֆ]{9}", words[4])


def test_phones_agree_whatever_their_separators(spark):
    texts = ["+1 234 567 8901 or +12345678901", "+442071838750 or +44 20 7183 8750", "020 7183 8750", "07911 123456", "+420-601-123-456"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    new = [r.text for r in surrogates.replace_entities(docs).orderBy("doc_id").collect()]
    for i, code in ((0, "1"), (1, "44")):
        a, b = (re.sub(r"\D", "", n) for n in new[i].split(" or "))
        assert a == b and a.startswith(code) and a != re.sub(r"\D", "", texts[i].split(" or ")[0])
    assert re.fullmatch(r"\+420-\d{3}-\d{3}-\d{3}", new[4])
    assert [re.sub(r"\d", "9", n) for n in new] == [re.sub(r"\d", "9", t) for t in texts] and not set(new) & set(texts)


def test_ordinary_words_stay_beside_names(spark):
    texts = ["Mr May came in May", "The Mr Brown bread is Brown", "Mr Ada May met Ada May and Ada in May", "Mr Novak and Novak"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    new = [r.text for r in surrogates.replace_entities(docs).orderBy("doc_id").collect()]
    assert re.fullmatch(r"Mr (?!May)\w+ came in May", new[0]) and re.fullmatch(r"The Mr (?!Brown)\w+ bread is Brown", new[1])
    assert re.fullmatch(r"Mr (\w+) (\w+) met \1 \2 and \1 in May", new[2]) and "Ada" not in new[2]
    assert re.fullmatch(r"Mr (\w+) and \1", new[3])


def ninety_seven(iban):
    plain = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def test_ibans_and_addresses_of_other_scripts(spark):
    texts = ["DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819", "GB98 NWBK 6016 1331 9268 19", "GB01 NWBK 6016 1331 9268 19",
             "jürgen@exämple.de", "иван@пример.рф", "联系ann@mail.org谢谢"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = surrogates.surrogate_report(docs).orderBy("doc_id").collect()
    new = [r.text for r in rows]
    assert all(r.n_entities == 1 for r in rows) and [r.n_iban for r in rows] == [1, 1, 1, 1, 0, 0, 0]
    assert [ninety_seven(n) for n in new[:3]] == [ninety_seven(t) for t in texts[:3]] and ninety_seven(new[0]) == 1
    for old, n in zip(texts[:4], new):
        assert n != old and n[:2] == old[:2] and re.sub("[A-Z]", "A", re.sub(r"\d", "9", n)) == re.sub("[A-Z]", "A", re.sub(r"\d", "9", old))
    assert len({n.replace(" ", "") for n in new[1:4]}) == 3
    assert not re.search("jürgen|exämple", new[4]) and re.fullmatch("[а-яѐ-ԯ]+@[а-яѐ-ԯ]+\\.[а-яѐ-ԯ]+", new[5]) and new[5] != texts[5]
    assert re.fullmatch("联系[a-z]{3}@[a-z]{4}\\.[a-z]{3}谢谢", new[6])


def slow_shift(seed, past):
    return int(hashlib.sha256((seed + past).encode()).hexdigest()[:7], 16)


def slow_chain(chars, seed, sets, undo=False):
    out, past = "", ""
    for c in chars:
        letters = next((s for s in sets if c in s), None)
        if letters is None:
            out += c
            continue
        shift = slow_shift(seed, past)
        new = letters[(letters.index(c) + (-shift if undo else shift)) % len(letters)]
        out, past = out + new, past + (new if undo else c)
    return out


def slow_permuted(text, seed, sets):
    return slow_chain(slow_chain(text, seed + ">", sets)[::-1], seed + "<", sets)[::-1]


def slow_displaced(text, seed, sets):
    mixed = list(slow_permuted(text, seed, sets))
    for i, c in enumerate(mixed):
        letters = next((s for s in sets if c in s), None)
        if letters:
            mixed[i] = letters[(letters.index(c) + 1) % len(letters)]
            break
    return slow_chain(slow_chain("".join(mixed)[::-1], seed + "<", sets, True)[::-1], seed + ">", sets, True)


def test_surrogates_match_a_slow_version(spark):
    digits, latin = "0123456789", "abcdefghijklmnopqrstuvwxyz"
    rng = random.Random(3)
    mails = ["".join(rng.choices(latin + digits, k=rng.randint(1, 9))) + "@a" + rng.choice("xyz") + ".org" for _ in range(60)]
    phones = [f"+49 {rng.randint(100, 999)} {rng.randint(1000, 9999)} {rng.randint(1000, 9999)}" for _ in range(60)]
    names = ["Mr " + "".join(rng.choices(latin, k=rng.randint(2, 7))).capitalize() for _ in range(60)]
    texts = sorted({*mails, *phones, *names})
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    key = f"k|{surrogates.choose_tweak(docs, key='k')}|"
    sounds = ["bcdfghjklmnpqrstvwxz", "aeiouy"]
    for r in surrogates.replace_entities(docs, key="k").collect():
        old = texts[r.doc_id]
        if "@" in old:
            local, domain = old.split("@")
            want = slow_permuted(local, key + "local", [digits, latin]) + "@" + slow_permuted(domain, key + "domain", [digits, latin])
        elif old[0] == "+":
            rest = iter(slow_permuted(re.sub(r"\D", "", old)[2:], key + "phone", [digits]))
            want = old[:3] + "".join(next(rest) if c.isdigit() else c for c in old[3:])
        else:
            want = "Mr " + slow_displaced(old[3:].lower(), key + "namefamily||", sounds).capitalize()
        assert r.text == want, old


def test_names_of_one_shape_stay_apart_and_change(spark):
    # all 2 * 20 * 6 short names: a permutation that leaves none as it is
    names = [a + b for a in "BCDFGHJKLMNPQRSTVWXZ" for b in "aeiouy"] + [a + b for a in "AEIOUY" for b in "bcdfghjklmnpqrstvwxz"]
    docs = spark.createDataFrame(list(enumerate(f"Mr {n} was here" for n in names)), "doc_id long, text string")
    rows = surrogates.replace_entities(docs).orderBy("doc_id").collect()
    new = [r.text.split()[1] for r in rows]
    assert sorted(new) == sorted(names) and all(a != b for a, b in zip(names, new))
    assert surrogates.choose_tweak(docs) == 0


def test_surrogates_of_odd_rows(odd_docs, no_docs):
    rows = surrogates.replace_entities(odd_docs)
    assert rows.columns == odd_docs.columns and rows.count() == odd_docs.count()
    assert sorted(map(str, rows.collect())) == sorted(map(str, odd_docs.collect()))
    assert surrogates.surrogate_report(no_docs).count() == 0


def test_surrogates_use_no_python(spark, odd_docs):
    plan = surrogates.surrogate_report(odd_docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = docs.limit(3).selectExpr("doc_id + 100000 AS doc_id", "text", "lang", "source", "n_chars")
    docs = docs.union(extra)
    given = docs
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, "/root/testdata/sf0.001"), f"test-{name}")
        if name != "packing":
            assert docs.columns == given.columns
            assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in before.collect()}
        else:
            check_packing(docs.collect(), [(r.doc_id, r.text) for r in before.collect()], load(vocabulary()))
    ids = {r.doc_id for r in docs.select("doc_id").distinct().collect()}
    assert ids and not ids & {r.doc_id for r in extra.collect()}


def test_pipeline_of_odd_rows(spark, odd_docs, no_docs):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd_docs.select(columns), no_docs.select(columns)):
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, "/root/testdata/sf0.001"), f"odd-{name}")
        docs.collect()
