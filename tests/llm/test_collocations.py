"""Phrase mining against a plain count of all n-grams."""

import re
from collections import Counter

import numpy as np
import pytest

from revrec.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, longest=5, least=100, top=2000, within=100):
    """(lang, rank, phrase, a, l, r, n, score) of (text, lang) rows."""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i:i + n])) for n in range(1, longest + 1) for i in range(len(words) - n + 1))
    frequent = {k: v for k, v in counts.items() if v >= least}
    out = {}
    for (lang, words), a in frequent.items():
        if len(words) < 2:
            continue
        longer = [v for (g, w), v in frequent.items() if g == lang and len(w) > len(words)
                  and any(w[i:i + len(words)] == words for i in range(len(w) - len(words) + 1))]
        if any(100 * v >= within * a for v in longer):
            continue
        n = totals[lang]
        score, k = min((1000 * a * n // (frequent[lang, words[:k]] * frequent[lang, words[k:]]), k) for k in range(1, len(words)))
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), frequent[lang, words[:k]], frequent[lang, words[k:]], n))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n, -s)
        for lang, found in out.items() for rank, (s, a, p, left, right, n) in enumerate(sorted(found)[:top], 1))


def mined(docs, **limits):
    rows = collocations.mine(docs, **limits).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("limits", [{"min_count": 2}, {"min_count": 3, "top": 4}, {"min_count": 2, "longest": 3}])
def test_odd_rows(odd, limits):
    rows = [(r["text"], r["lang"]) for r in odd.collect()]
    kinds = {"min_count": "least"}
    assert mined(odd, **limits) == plain(rows, **{kinds.get(k, k): v for k, v in limits.items()})


def test_documents(small):
    rows = [(r["text"], r["lang"]) for r in small.collect()]
    assert mined(small, min_count=8) == plain(rows, least=8)


def test_empty_and_rare(spark, none):
    assert mined(none) == []
    assert mined(spark.createDataFrame([(1, "a b", "en")], "doc_id bigint, text string, lang string")) == []


def test_a_hot_phrase_of_one_language(spark):
    """A third of all rows hold one phrase; the same words in another language count apart."""
    rows = [(i, f"same old story {i}! New York city", "en") for i in range(300)] + [(i, f"w{i} new york x{i % 7}", "fr") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(7)
    found = mined(docs)
    assert found == plain([(t, g) for _, t, g in rows])
    assert ("en", "same old story") in [(r[0], r[2]) for r in found]


def test_pointers_show_the_phrase(small):
    texts = {r["doc_id"]: (r["text"] or "").translate(LOWER) for r in small.collect()}
    rows = collocations.mine(small, min_count=8).collect()
    assert rows
    for r in rows:
        words = [w for w in re.split("[ \t.,;:!?\n\x0b\x0c\r]+", texts[r["doc_id"]]) if w]
        size = len(r["phrase"].split(" "))
        assert words[r["at"]:r["at"] + size] == r["phrase"].split(" ")


def test_equal_fingerprints_are_told_apart():
    """With every fingerprint the same, words alone decide."""
    own = collocations.block([b"a b. a c. a b. b a", None, b"a b"], ["en", "en", None], coded=True)
    inside, _ = own.runs(2)
    at = np.flatnonzero(inside)
    place, count = collocations._first_places(own, 2, at, np.zeros(len(at), np.int64))
    words = own.words.to_pylist()
    found = {(own.names[own.lang[p]], words[own.codes[p]], words[own.codes[p + 1]]): c for p, c in zip(place.tolist(), count.tolist())}
    assert found == {("en", b"a", b"b"): 2, ("en", b"a", b"c"): 1, ("en", b"b", b"a"): 1, ("und", b"a", b"b"): 1}


def test_prefix_polynomials_are_the_polynomial():
    own = collocations.block([b"x y z x y z w"], ["en"])
    for n in (1, 2, 3):
        inside, values = own.runs(n)
        assert inside.all() and len(values) == 8 - n
        assert values[0] == values[3]
    assert len(set(own.runs(3)[1].tolist())) == 4
