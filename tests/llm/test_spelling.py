"""Spelling variants against brute force."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from flowlantern.llm import queries, spelling


def edits(word, letters):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    made = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in letters}
    return (made | {a + c + b[1:] for a, b in cuts if b for c in letters}) - {word}


def brute(words, min_length=5, min_count=3):
    counts = {w: n for w, n in Counter(words).items() if w is not None and len(w) >= min_length and n >= min_count}
    letters = {c for w in counts for c in w}
    near = {w: edits(w, letters) & counts.keys() for w in counts}
    forms = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best and counts[best] >= 2 * n else None
    found = []
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        found.append((w, forms[w], root, n, len(near[w]), counts[forms[w]] if forms[w] else None))
    return sorted(found, key=repr)


def run(spark, words, **settings):
    table = spark.createDataFrame([(w, "x", 1) for w in words], "word string, n string, place int")
    return sorted((tuple(r) for r in spelling.variant_groups(table, **settings).collect()), key=repr)


@pytest.mark.parametrize("letters", ["ab", "abcde", "aßéz漢🙂"])
def test_equals_brute_force(spark, letters):
    rng = np.random.default_rng(len(letters))
    made = ["".join(rng.choice(list(letters), rng.integers(4, 6 if len(letters) > 4 else 10))) for _ in range(1500)]
    words = [w for w in made for _ in range(int(rng.zipf(1.7)) % 300 + 2)]
    wanted = brute(words)
    assert sum(w[1] is not None for w in wanted) > 20 and any(w[1] != w[2] and w[1] for w in wanted)
    assert run(spark, words) == wanted


def test_long_words_and_chains(spark):
    long = "abcdefghij" * 3000
    words = [long] * 3 + [long[:-1]] * 7 + [None] * 9 + [""] * 9 + ["abcd"] * 9
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb", "bbbbc"]
    words += [w for i, w in enumerate(chain) for _ in range(3 * 2**i)]
    assert run(spark, words) == brute(words)
    assert {r[2] for r in run(spark, words) if r[0] in chain} == {"bbbbc"}


def test_ties_and_other_settings(spark):
    words = ["tiger"] * 3 + ["timer"] * 6 + ["tigers"] * 6 + ["abcd"] * 2 + ["abce"] * 4
    assert run(spark, words) == brute(words)
    assert [r[1] for r in run(spark, words) if r[0] == "tiger"] == ["tigers"]
    assert run(spark, words, min_length=4, min_count=1) == brute(words, 4, 1)
    with pytest.raises(ValueError):
        spelling.variant_groups(spark.createDataFrame([], "word string"), min_length=3)


def test_empty(spark):
    assert run(spark, []) == []


def test_broadcasts_nothing_sized_by_its_file(spark):
    """Entries are many times the vocabulary they are made from, roots several times their files; both grow with the words."""
    rng = np.random.default_rng(7)
    made = ["".join(rng.choice(list("abcde"), 7)) for _ in range(1000)]
    words = [w for w in made for _ in range(int(rng.zipf(1.7)) % 300 + 2)]
    # what shuffles have measured is left out, and the driver has no room for what was not
    settings = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.maxBroadcastTableSize": "1k"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = run(spark, words)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert found == brute(words) and any(r[1] for r in found)


def lost(doc_id, run):
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    at = h % len(run)
    return run[:at] + run[at + 1 :] if h % 97 == 0 else run


def test_the_query(spark, tmp_path):
    rng = np.random.default_rng(4)
    stems = ["".join(rng.choice(list("abcdeéß×"), rng.integers(1, 8))) for _ in range(60)]
    texts = [(i, " ".join(rng.choice(stems, 300)).title()) for i in range(40)]
    texts += [(7, None), (None, "Apple APPLE äpple apple' apple"), (99, ""), (5, "1 2 Ÿ ÀPPLE")]
    spark.createDataFrame([(*t, "x") for t in texts], "doc_id long, text string, word string").write.parquet(f"{tmp_path}/documents.parquet")
    words = []
    for doc_id, text in texts:
        for r in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            words.append(lost(doc_id, re.sub("[A-Z]", lambda m: m.group().lower(), r)))
    found = queries.QUERIES["op13_spelling_variants"](spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(words)
    assert any(r.form for r in found)
