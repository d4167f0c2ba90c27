"""The positional index against a plain search for every window."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from revrec.llm import decontamination as dec

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id bigint, text string, n_words string, segment string"


def words(text):
    return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER)) if w]


def plain(docs, items, size=10):
    """(doc_id, n_words, n_hit, n_items, sha256, contaminated) of (id, text) rows."""
    out = []
    split = [("" if i is None else str(i), words(t)) for i, t in items]
    for doc_id, text in docs:
        own, hit, names = words(text), set(), set()
        for name, w in split:
            k = min(size, len(w))
            windows = {tuple(w[a:a + k]) for a in range(len(w) - k + 1)} if k else set()
            for i in range(len(own) - k + 1):
                if tuple(own[i:i + k]) in windows:
                    hit.update(range(i, i + k))
                    names.add(name)
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


def found(docs, items, **limits):
    index = dec.build_index(docs)
    rows = dec.contaminated(index, dec.phrase_matches(index, items, **limits)).collect()
    digest = lambda r: hashlib.sha256(",".join(r["items"]).encode()).hexdigest()
    return sorted([(r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), digest(r), r["n_hit"] > 0) for r in rows], key=repr)


@pytest.fixture(scope="module")
def items(spark):
    long = " ".join(f"W{i}" for i in range(100, 140))
    return spark.createDataFrame([
        (1, "the cat sat on THE MAT", "x", "y"), (2, long, None, None), (2, "two spaces", None, None), (3, None, None, None),
        (4, "", None, None), (5, "word word word word word word word word word word word", None, None), (None, "日本語", None, None),
        (6, "not there at all", None, None), (7, "the cat sat on the mat the cat sat on the mat the", None, None), (1, "the cat sat on THE MAT", "x", "y"),
    ], ITEMS)


def test_odd_rows(odd, odd_rows, items):
    texts = [(r["item_id"], r["text"]) for r in items.collect()]
    rows = [(r[0], r[1]) for r in odd_rows]
    for limits in ({}, {"window": 3}, {"block_words": 4}):
        assert found(odd, items, **limits) == plain(rows, texts, limits.get("window", 10))


def test_empty_tables(none, odd, odd_rows, items):
    assert found(none, items) == []
    assert found(odd, items.limit(0)) == plain(odd_rows, [])


def test_common_words_and_repeats(spark):
    """Windows of very frequent words, in a few documents and in segments of their own."""
    draw = random.Random(3)
    make = lambda n: " ".join(draw.choice("abc") for _ in range(n))
    docs = [(i, make(draw.randrange(120))) for i in range(80)]
    items = [(i, make(draw.randrange(4, 16))) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    assert found(frame, spark.createDataFrame(items, "item_id bigint, text string"), window=6) == plain(docs, items, 6)


def test_portions_of_candidates(spark, monkeypatch):
    held = dec.Postings(pa.Table.from_batches([dec._segment([b"a b a b a a b", b"b a"], pa.array([1, 2]), 0)]), {b"a": 0, b"b": 1, b"c": 2})
    whole = [list(map(tuple, np.column_stack(x))) for x in held.occurrences(np.array([0, 1, 2, 0]))]
    monkeypatch.setattr(dec, "CANDIDATES", 1)
    parts = [list(map(tuple, np.column_stack(x))) for x in held.occurrences(np.array([0, 1, 2, 0]))]
    assert sum(whole, []) == sum(parts, []) and len(whole) == 1 and len(parts) > 2


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1 << 39), max_size=50))
def test_packed_numbers(values):
    data, ends = dec.packed(np.array(values, np.int64))
    assert dec.unpacked(data).tolist() == values
    assert [dec.unpacked(data[a:b]).tolist() for a, b in zip([0, *ends], ends)] == [[v] for v in values]


def test_proximity_is_plain(spark):
    """Anchors with the other rare words within reach, against a search of all places."""
    draw = random.Random(5)
    vocabulary = [f"t{i}" for i in range(30)]
    docs = [(i, " ".join(draw.choices(vocabulary, k=draw.randrange(60)))) for i in range(40)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randrange(1, 6)))) for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    index = dec.build_index(frame)
    assert index.select("segment").distinct().count() == 1
    rows = dec.proximity_matches(index, spark.createDataFrame(items, "item_id bigint, text string"), terms=3, within=4).collect()
    first = {}  # number of each term by its first place in the items, as ties go
    for _, t in items:
        for w in words(t):
            first.setdefault(w, len(first))
    counts = {w: sum(words(t).count(w) for _, t in docs) for w in first}
    expected = set()
    for item, text in items:
        rare = sorted(set(words(text)), key=lambda w: (counts[w], first[w]))[:3]
        for doc, t in docs:
            own = words(t)
            for at in (i for i, w in enumerate(own) if w == rare[0]):
                places = [min((i for i, w in enumerate(own) if w == o), key=lambda i: (abs(i - at), i), default=None) for o in rare]
                if all(p is not None and abs(p - at) <= 4 for p in places):
                    expected.add((doc, str(item), min(places), max(places) + 1))
    assert expected and {(r["doc_id"], r["item_id"], r["start"], r["end"]) for r in rows} == expected
