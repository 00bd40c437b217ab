"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns for every text operator."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlantern.llm import bpe, contexttree, dartminhash, decontaminate, langid, suffixes, surrogates, tokenfiles, toxicity
from flowlantern.llm.common import remainder
from flowlantern.session import shared_dir

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        # columns named like those the operators make
        T.StructField("text_key", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("kept", T.StringType()),
    ]
)
LONG = "".join(f"lorem{i % 977} ipsum{i % 31}, " for i in range(30_000))
BODY = "the quick brown fox jumps over the lazy dog and then it runs far away from the big bad bear in the woods"
ROWS = [
    (1, BODY, "en"),
    (2, BODY.replace("bear", "wolf"), "en"),
    (3, None, None),
    (4, "", "en"),
    (5, " \n\t ", None),
    (6, LONG, "xx"),
    (7, "!!! ??? 123", "en"),
    (8, "Ünïcödé – 漢字 🙂\x00\x1c", "de"),
    (None, "no id at all", None),
    (9, BODY, "en"),
    (9, BODY, "en"),
    (10, "same id, one text", "en"),
    (10, "same id, other text", "en"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, n_words string")


def test_decontamination(spark, docs, nothing):
    marks = items(spark, [(7, BODY, "x"), (7, "quick BROWN", "x"), (8, None, "x"), (None, "the", "x"), (12, "fox jumps", "x")])
    found = decontaminate.contamination(docs, marks).collect()
    assert len(found) == len(ROWS)
    by = {r.doc_id: r for r in found}
    n = len(BODY.split())
    assert (by[1].n_words, by[1].n_hit, by[1].item_ids, by[1].contaminated) == (n, n, ["12", "7"], True)
    assert by[2].n_hit == 19 and by[2].item_ids == ["12", "7"]
    assert (by[3].n_words, by[3].n_hit, by[3].n_items, by[3].contaminated) == (0, 0, 0, False)
    assert sum(r.doc_id == 9 for r in found) == 2 and by[None].n_words == 4
    assert {r.doc_id for r in decontaminate.remove_contaminated(docs, marks).collect()} == {3, 4, 5, 6, 7, 8, 10, None}
    assert decontaminate.contamination(nothing, marks).count() == 0
    assert decontaminate.contamination(docs, items(spark, [])).where("n_hit > 0").count() == 0


def test_decontamination_in_several_passes(spark, docs, monkeypatch):
    marks = items(spark, [(i, " ".join(BODY.split()[i:]), "x") for i in range(8)])
    wanted = sorted(map(str, decontaminate.contamination(docs, marks).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 500)
    assert sorted(map(str, decontaminate.contamination(docs, marks).collect())) == wanted


def test_suffixes(docs, nothing):
    found = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.remove_repeats(docs, 50, 16).collect())
    n = len(BODY)
    by = dict((k, (a, b, c)) for k, a, b, c in found)
    assert len(found) == len(ROWS) and by["9"] == by["1"] == (n, n, 1)
    assert by["3"] == by["4"] == (0, 0, 0) and by["None"][1] == 0
    assert by["2"][1] == n - len("wolf") - 0 - (n - BODY.index("bear") - 4) * (n - BODY.index("bear") - 4 < 50)
    assert suffixes.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("length,size", [(20, 6), (12, 12), (16, 1)])
def test_suffixes_equal_brute_force(spark, length, size):
    rng = np.random.default_rng(5)
    base = ["".join(rng.choice(list("abcé "), 60)) for _ in range(6)]
    rows = [(i, "".join(base[j][a : a + 40] for j, a in rng.integers(0, [6, 30], (4, 2)))) for i in range(40)]
    rows += [(50, "a" * 100), (51, "ab" * 50), (52, "a" * 15), (53, base[0]), (53, base[0])]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted((r.doc_id, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove_repeats(table, length, size).collect())
    seen: dict[bytes, int] = {}
    data = [(i, t.encode()) for i, t in rows]
    for _, b in data:
        for j in range(len(b) - length + 1):
            seen[b[j : j + length]] = seen.get(b[j : j + length], 0) + 1
    wanted = []
    for i, b in data:
        gone = suffixes.union([(j, j + length) for j in range(len(b) - length + 1) if seen[b[j : j + length]] > 1])
        edges = [0, *(x for s in gone for x in s), len(b)]
        kept = b"".join(b[x:y] for x, y in zip(edges[::2], edges[1::2]))
        wanted.append((i, len(b) - len(kept), len(gone), kept))
    assert found == sorted(wanted)


def test_loser_tree_orders_and_shares():
    rng = np.random.default_rng(1)
    runs = [sorted(bytes(rng.integers(97, 99, 6).astype(np.uint8)) for _ in range(n)) for n in (7, 0, 1, 12, 5)]
    shared = [suffixes.front_code(np.frombuffer(b"".join(r), np.uint8).reshape(-1, 6))[0].tolist() for r in runs]
    out = [(runs[r][i], known) for r, i, known in suffixes.LoserTree(runs, shared)]
    assert [t for t, _ in out] == sorted(t for r in runs for t in r)
    for (a, _), (b, known) in zip(out, out[1:]):
        assert known == next((i for i in range(6) if a[i] != b[i]), 6)


def test_front_coding_round_trip():
    rows = np.array(sorted(np.random.default_rng(2).integers(0, 3, (200, 9)).tolist()), np.uint8)
    shared, rest = suffixes.front_code(rows)
    assert list(suffixes.front_decode(shared.tolist(), rest, 9)) == [r.tobytes() for r in rows] and len(rest) < rows.size
    assert (suffixes.row_hashes(rows) == suffixes.key_hashes(rows.ravel(), 9)[::9]).all()


def test_language(spark, docs, nothing):
    model = langid.train(docs, F.col("doc_id").isNotNull())
    found = {r.doc_id: r.r for r in docs.select("doc_id", langid.predicted("text", model, spark).alias("r")).collect()}
    assert len(found) == 11 and found[1].lang_pred == "en" and found[6].lang_pred == "xx"
    assert all((found[i].lang_pred, found[i].score) == ("und", 0.0) for i in (3, 4, 5, 7))
    assert all(0 <= r.score <= 1 for r in found.values())
    empty = langid.train(nothing, F.lit(True))
    assert {r.r.lang_pred for r in docs.select(langid.predicted("text", empty, spark).alias("r")).collect()} == {"und"}


def test_numbers_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "the word", "en"), (2, "² ½ Ⅷ ①", None), (3, "x²", None)], "doc_id long, text string, lang string")
    found = docs.select(langid.predicted("text", langid.train(docs, F.lit(True)), spark).alias("r")).collect()
    assert [r.r.lang_pred for r in found] == ["en", "und", "en"]


def test_language_backs_off_to_shorter_grams():
    import pandas as pd

    counts = [("a", 0, "known", 5), ("b", 0, "other", 5), ("a", 3, "xyz", 4), ("b", 3, "pqr", 4), ("a", 1, "k", 3), ("b", 1, "j", 3)]
    model = langid.model(pd.DataFrame(counts, columns=["lang", "size", "gram", "n"]))
    names, scores = model.predict(["known", "other", "wxyzw", "apqrz", "j", "?", None, "zzz"])
    assert names == ["a", "b", "a", "b", "b", "und", "und", "a"]
    assert scores[5:7] == [0.0, 0.0] and scores[7] == 0.5


def test_surrogates(spark, docs, nothing):
    found = {r.doc_id: r.r for r in docs.select("doc_id", surrogates.replaced("text", b"k").alias("r")).collect()}
    texts = {r[0]: r[1] for r in ROWS}
    assert all(found[i].text == texts[i] and not found[i].entities for i in (1, 3, 4, 6, 8))
    assert surrogates.entities(nothing, b"k").count() == 0


def test_surrogates_keep_form_and_stay_apart(spark):
    texts = [
        "Card 4111 1111 1111 1111 or 4111111111111111; not 4111111111111112.",
        "Call +1 (017) 555-7713 or +1-017-555-7713, +1 (017) 555-7714",
        "From 10.1.2.3 to 169.122.221.182, 256.1.1.1 is none",
        "Write Ann.Lee@mail3.example.com, ann.lee@mail3.example.com, bob@mail3.example.com",
        'token = "2100a60029d9170a161913d4d019930026318f5d"',
        "Mrs Anna Schröder met Mr. Иван Петров and Dr Schröder",
        None,
    ]
    for text in texts[:-1]:
        made, spans = surrogates.replace(b"key", text)
        own = [(text[a:b], k) for a, b, k in surrogates.find(text)]
        new = [(made[a:b], k) for a, b, k in spans]
        assert [k for _, k in own] == [k for _, k in new] and own
        canonical = {}
        for (a, kind), (b, _) in zip(own, new):
            assert a != b
            same = canonical.setdefault(surrogates.canonical(kind, a), surrogates.canonical(kind, b))
            assert same == surrogates.canonical(kind, b)
            if kind not in ("ip", "secret"):
                assert [c.isdigit() for c in a] == [c.isdigit() for c in b]
                assert [c.isupper() for c in a] == [c.isupper() for c in b]
            if kind == "card":
                digits = ["".join(c for c in x if c.isdigit()) for x in (a, b)]
                assert surrogates.luhn(digits[0]) == surrogates.luhn(digits[1]) and digits[0][0] == digits[1][0]
        assert len(set(canonical.values())) == len(canonical)
        assert made == surrogates.replace(b"key", text)[0] != surrogates.replace(b"other", text)[0]
    made, spans = surrogates.replace(b"key", texts[5])
    names = [made[a:b] for a, b, k in spans]
    assert names[0].split()[1] == names[2] and all("а" <= c.lower() <= "ё" for c in names[1] if c != " ")
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    found = surrogates.entities(table, b"key")
    assert surrogates.collisions(found).count() == 0
    bad = spark.createDataFrame([("ip", "a", "b"), ("ip", "c", "b"), ("ip", "d", "d")], "kind string, entity string, surrogate string")
    assert {r.fault for r in surrogates.collisions(bad).collect()} == {"shared", "kept"}


def test_surrogates_of_all_spellings(spark):
    """Spellings of a phone number or address are one entity with one surrogate; what its format keeps is drawn again."""
    for kind, one, two in (
        ("phone", "+44 20 7946 0958", "+442079460958"),
        ("phone", "+353 1 555 0123", "+35315550123"),
        ("ip", "01.2.3.4", "1.2.3.4"),
        ("name", "Οδος", "ΟΔΟΣ"),
    ):
        made = [surrogates.canonical(kind, surrogates.surrogate(b"key", kind, t)) for t in (one, two)]
        assert surrogates.canonical(kind, one) == surrogates.canonical(kind, two) and made[0] == made[1]
    texts = ["+44 20 7946 0958 or +442079460958", "01.2.3.4 and 1.2.3.4", "Mr Þð met Mrs Ðþ", None]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    again = surrogates.redrawn(table, b"key")
    assert set(again) == {("name", "þð"), ("name", "ðþ")}
    made = [r.r.text for r in table.select(surrogates.replaced("text", b"key", again).alias("r")).collect()]
    names = [t.split()[1::3] for t in made if t and t.startswith("Mr")][0]
    assert len({n.lower() for n in names} | {"þð", "ðþ"}) == 4


@pytest.mark.parametrize(
    "text,kept",
    [
        ("Mrs Anna Schroeder came. Anna Schroeder said so, and SCHROEDER's dog. The end, Anna-Maria.", "came said so and dog The end Maria"),
        ("From: Anna Schroeder <x>\nHello, my name is Bob Miller. Miller knows Anna.", "From Hello my name is knows"),
        ("Dear all\n\nBest regards,\nAnna Schroeder\n\nSchroeder was here", "Dear all Best regards was here"),
    ],
)
def test_surrogates_of_all_mentions(text, kept):
    assert [k for _, _, k in surrogates.find("Mr Anna Lee, Anna Lee@mail.com")] == ["name", "name", "email"]
    made, spans = surrogates.replace(b"key", text)
    assert not any(n in made.lower() for n in ("anna", "schroeder", "miller"))
    assert all(w in made.split() or w in made for w in kept.split())
    old = [text[a:b] for a, b, _ in surrogates.find(text)]
    words = {}
    for a, (start, stop, _) in zip(old, spans, strict=True):
        for x, y in zip(a.lower().split(), made[start:stop].lower().split(), strict=True):
            assert words.setdefault(x, y) == y


@pytest.mark.parametrize("n", [2, 3, 10, 97, 1000])
def test_permutation_has_no_fixed_point(n):
    turn = surrogates.Permutation(b"k", "x", n)
    found = [turn(i) for i in range(n)]
    assert sorted(found) == list(range(n)) and all(a != i for i, a in enumerate(found))


RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def reference_ids(text):
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    return own.encode_ordinary(text or "")


def test_bpe(docs, nothing):
    found = docs.select("doc_id", "text", bpe.tokens("text", RANKS, public_tokenizers.PATTERN).alias("ids"))
    found = found.withColumn("back", bpe.decoded("ids", RANKS, public_tokenizers.PATTERN)).collect()
    for r in found:
        assert list(r.ids) == reference_ids(r.text) and bytes(r.back) == (r.text or "").encode()
    assert nothing.select(bpe.digests("text", RANKS, public_tokenizers.PATTERN)).count() == 0


def test_bpe_append_and_edit():
    vocabulary = bpe.codec(RANKS, public_tokenizers.PATTERN).vocabulary
    rng = np.random.default_rng(4)
    words = [b"the", b" thing", b"ing", b"abc", b"  ", b"\xc3\xa9", b"tion", b"xqz", b"12"]
    for _ in range(60):
        data = b"".join(words[i] for i in rng.integers(0, len(words), 120))
        cut = int(rng.integers(0, len(data)))
        grown = bpe.Prefixes(vocabulary, data[:cut])
        grown.append(data[cut:])
        assert grown.last == bpe.Prefixes(vocabulary, data).last
        a = int(rng.integers(0, len(data)))
        b = min(len(data), a + int(rng.integers(0, 9)))
        new = words[int(rng.integers(0, len(words)))]
        grown.replace(a, b, new)
        assert grown.last == bpe.Prefixes(vocabulary, data[:a] + new + data[b:]).last
        assert b"".join(vocabulary.tokens[i] for i in grown.ids()) == grown.data
    long_ = bpe.Prefixes(vocabulary, b"the quick brown fox " * 200)
    assert long_.replace(10, 14, b"xx") < 400


WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_token_files(spark, docs, nothing):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(WORDS)
    path = shared_dir(spark, "tokens")
    tokenfiles.write(docs, path, WORDS, 2, segment=50)
    found = sorted(tokenfiles.digests(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted([r[0] for r in ROWS], key=lambda i: -1 if i is None else i)
    want = sorted((str(i), zlib.crc32(np.array([*own.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes())) for i, t, _ in ROWS)
    assert sorted((str(r.doc_id), r.ids_crc32) for r in found) == want
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()
    first = next(r for r in found if r.doc_id == 1)
    part = tokenfiles.parts(spark, path).where(F.col("before") <= first.start).orderBy(F.desc("before"), F.desc("part")).first()
    ids = [*own.encode(BODY, add_special_tokens=False).ids, 2]
    assert tokenfiles.tokens(spark, path, part.part, first.start - part.before, len(ids)) == ids
    empty = shared_dir(spark, "tokens")
    tokenfiles.write(nothing, empty, WORDS, 2)
    assert tokenfiles.digests(spark, empty).count() == 0


@pytest.mark.parametrize("high", [200, 70_000, 2**32 - 1])
def test_codes_give_any_id(high):
    ids = np.random.default_rng(6).integers(0, high, 4000)
    codes = tokenfiles.Codes(*tokenfiles.Codes.pack(ids))
    assert [codes[i] for i in range(0, 4000, 7)] == ids[::7].tolist()
    assert (codes.slice(1234, 3999) == ids[1234:3999]).all() and len(codes.slice(5, 5)) == 0


def test_words_equal_the_library():
    from tokenizers import Tokenizer

    own, ours = Tokenizer.from_file(WORDS), tokenfiles.words(WORDS)
    rng = np.random.default_rng(8)
    parts = ["ab", "Éa", ".", ",", "'s", "1", " ", "\n", "é", "́", "the", '"', ",.", "#", "ß", "ª", "µ", "İ", "\x1c", "\xa0"]
    texts = ["".join(parts[i] for i in rng.integers(0, len(parts), 25)) for _ in range(3000)]
    ids, counts = ours.encode(pa.array([*texts, None]), 7)
    for text, found in zip([*texts, ""], np.split(ids, np.cumsum(counts)[:-1])):
        assert found.tolist() == [*own.encode(text, add_special_tokens=False).ids, 7]


def test_toxicity(spark, docs, nothing):
    marks = spark.createDataFrame([(1, 0, 0), (6, 1, 1), (6, 1, 0), (3, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, marks, remainder("doc_id", 5) != 0)
    found = docs.select("doc_id", toxicity.scored("text", model, spark).alias("r")).collect()
    assert len(found) == len(ROWS) and all(0 <= r.r.score <= 1 for r in found)
    assert toxicity.train(nothing, marks).weights == {} and toxicity.train(docs, marks.limit(0)).leak == 0


def test_toxicity_finds_the_sentence():
    rng = np.random.default_rng(9)
    clean = ["the a of to in is it on at by".split()[i] for i in range(10)]
    texts, labels = [], []
    for i in range(200):
        own = [" ".join(rng.choice(clean, 6)) for _ in range(5)]
        if i % 3 == 0:
            own[2] = f"you {'fool' if i % 2 else 'rat'} " + own[2]
        texts.append(". ".join(own).capitalize() + ".")
        labels.append(int(i % 3 == 0))
    model = toxicity.fit(texts, labels, [1.0] * len(texts))
    text = "İt is so. You Fool. The end"
    spans = model.sentences(text)
    assert [text[a:b].strip() for a, b, _ in spans] == ["You Fool"] and model.score(spans) > 0.5
    assert model.score(model.sentences(None)) == model.score([]) < 0.1


def test_toxicity_learned_from_tables_equals_texts_at_hand(spark):
    rng = np.random.default_rng(13)
    rows = []
    for i in range(240):
        own = [" ".join(rng.choice("the a of to in is it on at by fine".split(), 6)) for _ in range(4)]
        if i % 3 == 0:
            own[i % 4] += f" {('fool', 'rat', 'Swine')[i % 5 % 3]}"
        rows.append((i, ". ".join(own), int(i % 3 == 0)))
    rows += [(500, rows[0][1], 0), (501, "", 1), (502, None, 1), (503, "you fool " * 9000, 0)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    found = toxicity.train(docs, labels)
    at_hand = dict(sorted(((t, y) for i, t, y in rows if i < 500), key=lambda x: hashlib.sha256(x[0].encode()).hexdigest()))
    wanted = toxicity.fit(list(at_hand), list(at_hand.values()), [1.0] * len(at_hand))
    assert found.weights.keys() == wanted.weights.keys() >= {"fool", "rat", "swine"}
    assert found.weights == pytest.approx(wanted.weights) and found.leak == pytest.approx(wanted.leak)


def test_near_duplicates(docs, nothing):
    found = dartminhash.near_duplicates(docs, similar=0.5).collect()
    assert len(found) == len(ROWS)
    classes = {r.doc_id: (r.class_id, r.n_members) for r in found if r.doc_id != 10}
    assert classes[1] == classes[2] == classes[9] == (1, 4)
    assert all(classes[i] == (i, 1) for i in (3, 4, 5, 6, 7, 8)) and classes[None] == (None, 1)
    kept = [r.doc_id for r in dartminhash.keep_one(docs, similar=0.5).collect()]
    assert sorted(kept, key=str) == sorted([1, 3, 4, 5, 6, 7, 8, None, 10, 10], key=str)
    assert dartminhash.near_duplicates(nothing).count() == 0 and dartminhash.keep_one(nothing).columns == docs.columns


def test_dart_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(10)
    ids = rng.integers(0, 2**63, 300).astype(np.uint64)
    one, two = rng.exponential(size=300) * 3, rng.exponential(size=300) * 3
    one[:60] = 0
    two[200:] = 0
    use = [np.flatnonzero(w) for w in (one, two)]
    k = 2000
    marks = dartminhash.signatures(np.r_[ids[use[0]], ids[use[1]]], np.r_[one[use[0]], two[use[1]]], np.array([len(u) for u in use]), k)
    wanted = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    assert (marks != 0).all() and abs((marks[0] == marks[1]).mean() - wanted) < 5 * np.sqrt(wanted / k)


@pytest.mark.parametrize("small,rows_in_band", [(8, 6), (2, 1)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, small, rows_in_band):
    monkeypatch.setattr(dartminhash, "SMALL", small)
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        base = list(rng.choice(words, 60))
        for j in range(int(rng.integers(1, 5))):
            own = list(base)
            for _ in range(j):
                own[int(rng.integers(0, 60))] = "x"
            rows.append((len(rows), " ".join(own)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    # one row in a band: dissimilar documents share buckets, too
    found = {r.doc_id: r.class_id for r in dartminhash.near_duplicates(table, rows=rows_in_band).collect()}
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(56)} for i, t in rows}
    label = {i: i for i in sets}
    for a in sets:
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {i: new if v == old else v for i, v in label.items()}
    assert found == label


def test_near_duplicates_of_chains_equal_brute_force(spark, monkeypatch):
    """Copies of one text with some of the same few changes, and texts that are like one of the copies but not like the
    first, all in one bucket."""
    monkeypatch.setattr(dartminhash, "_fold", lambda marks: np.zeros(marks.shape[:-1], np.uint64))
    rng = np.random.default_rng(12)
    base = [f"w{i}" for i in range(120)]
    changes = [[]]
    for _ in range(100):
        changes.append(list(rng.choice(24, 2, replace=False)))
        left = [at for at in range(24) if at not in changes[-1]]
        changes.append(changes[-1] + list(rng.choice(left, 2, replace=False)))
        changes.append(list(rng.choice(24, 5, replace=False)))
    rows = [(i, " ".join(f"x{at}" if at % 5 == 0 and at // 5 in c else w for at, w in enumerate(base))) for i, c in enumerate(changes)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in dartminhash.near_duplicates(table, bands=1, rows=1).collect()}
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(116)} for i, t in rows}
    label = {i: i for i in sets}
    for a in sets:
        for b in range(a):
            if label[a] != label[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {i: new if v == old else v for i, v in label.items()}
    assert 1 < len(set(label.values())) < 150
    assert found == label


def plain_score(texts, train, text):
    """log10 of a text's probability by the definition, one tree node at a time."""
    from math import exp, lgamma, log, log10

    lead = [contexttree.END] * contexttree.DEPTH

    def steps(t):
        data = lead + list((t or "").encode().lower()) + [contexttree.END]
        for i in range(len(lead), len(data)):
            for bit in range(8):
                yield tuple(data[i - contexttree.DEPTH : i][::-1]), (1 << bit) | (data[i] >> (8 - bit)), (data[i] >> (7 - bit)) & 1

    counts, children = {}, {}
    for t, use in zip(texts, train):
        for before, node, one in steps(t) if use else ():
            for d in range(contexttree.DEPTH + 1):
                counts.setdefault((before[:d], node), [0, 0])[one] += 1
                if d:
                    children.setdefault((before[: d - 1], node), set()).add((before[:d], node))

    def own(key):
        a, b = counts[key]
        return lgamma(a + 0.5) + lgamma(b + 0.5) - 2 * lgamma(0.5) - lgamma(a + b + 1)

    def product(key):
        return sum(map(weighted, children[key]))

    def weighted(key):
        if len(key[0]) == contexttree.DEPTH:
            return own(key)
        x, y = own(key), product(key)
        return max(x, y) + log(1 + exp(-abs(x - y))) + log(0.5)

    def predict(before, node, d):
        key = (before[:d], node)
        a, b = counts.get(key, (0, 0))
        one = (b + 0.5) / (a + b + 1)
        if d == contexttree.DEPTH or (before[: d + 1], node) not in counts:
            return one
        w = 1 / (1 + exp(product(key) - own(key)))
        return w * one + (1 - w) * predict(before, node, d + 1)

    return sum(log10(p if one else 1 - p) for before, node, one in steps(text) for p in [predict(before, node, 0)])


def test_context_tree_equals_the_definition(spark):
    texts = ["abab ab", "abba Ab b", None, "ba bé", "", "b" * 30, "new zebra"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "abab")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    learned = [i != 6 for i in range(7)] + [False]
    found = {r.doc_id: r for r in contexttree.scores(table, F.col("doc_id") != 6, shards=3).collect()}
    assert len(found) == 8
    for i, t in rows:
        assert found[i].score == pytest.approx(plain_score([t for _, t in rows], learned, t), rel=1e-4), t
        assert found[i].n_tokens == len((t or "").split()) + 1
    assert found[6].n_known == 1 and found[None].n_known == 2 and found[0].train_tokens == 3 + 4 + 1 + 3 + 1 + 2


def test_context_tree_in_steps_of_blocks(spark, docs, nothing, monkeypatch):
    train = F.col("doc_id") != 1
    wanted = sorted((str(r.doc_id), round(r.score, 3), round(r.base_score, 6)) for r in contexttree.scores(docs, train).collect())
    monkeypatch.setattr(contexttree, "FAN", 2)
    monkeypatch.setattr(contexttree, "BLOCK_BYTES", 50)
    found = sorted((str(r.doc_id), round(r.score, 3), round(r.base_score, 6)) for r in contexttree.scores(docs, train, 5).collect())
    assert found == wanted
    assert contexttree.scores(nothing, train).count() == 0
    assert all(r.n_known == 0 for r in contexttree.scores(docs, F.lit(False)).collect())


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_suffix_ranges_hold_about_as_many_anchors_each(spark):
    rng = random.Random(4)
    texts = [(i, "".join(rng.choice("abcdefgh ") for _ in range(3000))) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("text_key", F.xxhash64("text"))
    located = suffixes._located(docs, 200, 40).groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    places = located.agg(F.collect_set("place").alias("places"))
    runs = suffixes._runs_of(docs, places, 20, 200, 40).collect()
    held = dict.fromkeys(range(20), 0)
    for row in runs:
        held[row["range"]] += len(suffixes._unpack(row["run"])[3])
    assert min(held.values()) * 3 > max(held.values()) and sum(held.values()) > 1500
