"""Spelling variants against brute force."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest

from gradlake.llm import spelling
from tests.llm.test_llm import ODD, SF_DIR, empty, odd, table  # noqa: F401


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows, every=199, least=6, often=5):
    found = {}
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] = found.get(run, 0) + 1
    return {w: n for w, n in found.items() if len(w) >= least and n >= often}


def brute_variants(words, pairs=None):
    others = {w: [] for w in words}
    for a, b in itertools.combinations(words, 2) if pairs is None else pairs:
        if near(a, b):
            others[a].append(b)
            others[b].append(a)
    forms = {}
    for w, n in words.items():
        best = min(others[w], key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * n else None
    rows = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.append((w, forms[w], root, n, len(others[w]), forms[w] and words[forms[w]]))
    return sorted(rows)


def found(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("letters,rare", [("ab", 2), ("abc", 5), ("abÿé", 1), ("abcdefgh", 128)])
def test_variants_equal_all_pairs(spark, letters, rare):
    rng = random.Random(len(letters))
    words = {}
    for _ in range(220):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(6, 11)))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word))
            word = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1 :]])
        if len(word) >= 6:
            words[word] = rng.choice([5, 6, 30, 31, 200, 200, 1100])
    long = "".join(rng.choice(letters) for _ in range(700))
    words |= {"a" * n: n for n in range(6, 30)} | {long: 5, long[:333] + long[334:]: 50, long[:10] + "z" + long[11:]: 50}
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert found(spelling.spelling_variants(df, rare_words=rare)) == brute_variants(words)
    assert spelling.spelling_variants(df.limit(0)).count() == 0


def test_an_edit_leaves_more_than_the_affected_grams():
    """The bound of every word holds for every edit, and leaves one gram at least."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("ab"), 9)) for _ in range(60)]
    frequent = {2: np.unique(spelling.Grams(words).of_size(2)), 3: np.unique(spelling.Grams(words).of_size(3)), 4: np.unique(spelling.Grams(words[:5]).of_size(4))}
    for word in words:
        for at in range(9):
            edits = [(spelling.SAME, word[:at] + "c" + word[at + 1 :], spelling.SAME), (spelling.LONG, word[:at] + word[at + 1 :], spelling.SHORT)]
            edits.append((spelling.SHORT, word[:at] + "a" + word[at:], spelling.LONG))
            for side, other, other_side in edits:
                lists, affected = spelling.Grams([word]).lists(frequent, side)
                others, _ = spelling.Grams([other]).lists(frequent, other_side)
                own = set(lists[0].tolist())
                assert len(own & set(others[0].tolist())) >= max(1, len(own) - affected[0])


def test_words_and_odd_rows(spark, odd, empty):  # noqa: F811
    rows = [(i, "Straße Ärger naïve WORDS wordś été×été " * (40 + i) + "x") for i in range(300)] + [*ODD, (None, "lonely " * 30), (8, "q" * 50_000 + " end")]
    df = table(spark, rows)
    assert {r["word"]: r["n"] for r in spelling.count_words(df, damaged=spelling.DAMAGED).collect()} == brute_words(rows)
    assert {r["word"]: r["n"] for r in spelling.count_words(df).collect()} == brute_words(rows, None)
    assert {r["word"]: r["n"] for r in spelling.count_words(odd, min_count=1).collect()} == brute_words(ODD, None, often=1)
    assert spelling.count_words(empty).count() == 0


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    words = brute_words(docs)
    listed = {}
    for w in words:
        for form in {w, *(w[:i] + "*" + w[i + 1 :] for i in range(len(w))), *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            listed.setdefault(form, []).append(w)
    pairs = {tuple(sorted(p)) for own in listed.values() for p in itertools.combinations(own, 2)}
    assert found(spelling.op11_spelling(spark, SF_DIR)) == brute_variants(words, pairs)
