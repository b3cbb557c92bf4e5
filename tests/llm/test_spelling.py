"""Spelling variants: pairs against all pairs, forms and roots, the query
against a plain re-statement."""

import os
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldlens.llm import queries, spelling

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def near(a, b):
    """One code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def neighbours(words):
    """Words of the same text with one code point left out or masked."""
    masks = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            masks[w[:i] + "\0" + w[i + 1:]].add(w)
            masks[w[:i] + w[i + 1:]].add(w)
        masks[w].add(w)
    out = defaultdict(set)
    for group in masks.values():
        for a in group:
            out[a] |= {b for b in group if near(a, b)}
    return out


def plain(docs, min_length=7, ratio=10):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_length and c >= 2}
    around, form = neighbours(n), {}
    for w in n:
        best = min(around[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    rows = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n[w], len(around[w]), n.get(form[w])))
    return rows


def got(rows):
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows]


@given(st.sets(st.text(alphabet="abé", min_size=1, max_size=9), max_size=40))
@settings(max_examples=8, deadline=None)
def test_pairs_are_all_pairs(spark, words):
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    rows = [(r.a, r.b) for r in spelling.near_pairs(df).collect()]
    assert len(rows) == len({frozenset(r) for r in rows})
    assert {frozenset(r) for r in rows} == {frozenset((a, b)) for a in words for b in words if near(a, b)}


def test_every_edit_of_a_word_is_found(spark):
    for word in ("abcdefg", "abcdefgh", "aaaaaaa", "ñandúñandú"):
        edits = {word[:i] + c + word[i + d:] for i in range(len(word) + 1) for c in ("", "x", "a", "ú") for d in (0, 1)} - {word}
        df = spark.createDataFrame([(w, 1) for w in edits | {word}], "word string, n long")
        pairs = {frozenset((r.a, r.b)) for r in spelling.near_pairs(df).collect()}
        assert {frozenset((word, e)) for e in edits if near(word, e)} <= pairs


def test_forms_ties_and_chains(spark):
    words = [("colours", 2), ("colors", 1), ("coloura", 20), ("colourb", 20), ("colouraa", 200), ("colouraaa", 1999),
             ("colouraab", 2000), ("alonewords", 5)]
    rows = {r.word: r for r in spelling.variants(spark.createDataFrame(words, "word string, n long")).collect()}
    assert rows["colours"].form == "coloura" and rows["colours"].form_n == 20 and rows["colours"].n_near == 3
    assert rows["colours"].root == "colouraab" and rows["colouraa"].form == "colouraab"
    assert rows["colouraaa"].form is None and rows["colouraaa"].root == "colouraaa"
    assert rows["alonewords"].n_near == 0 and rows["alonewords"].root == "alonewords"


def test_a_shared_half_gives_no_candidates_of_its_own(spark):
    """A third of all words share their first half: pairs stay few."""
    words = ["prefixpre" + f"{i:05d}".translate(str.maketrans("0123456789", "qwertzuiop")) + "xyz" for i in range(3000)]
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    rows = spelling.near_pairs(df).collect()
    want = neighbours(words)
    assert len(rows) == sum(map(len, want.values())) // 2


def test_odd_rows(spark):
    text = "Straße STRASSE naïveté×÷ encyclopædia encyclopedia Encyclopaedia " * 40
    docs = [(1, text), (None, text), (None, None), (2, ""), (2, text), (2, text), (3, "x" * 9 + " " + "é" * 50_000), (4, "ÀÀÀÀÀÀÀ àààààààÀ")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as word", "2 as n", "3 as id", "4 as h")
    rows = got(spelling.variants(spelling.count_words(df)).collect())
    assert len(rows) == len(set(rows)) and set(rows) == plain(docs)
    assert spelling.variants(spelling.count_words(df.limit(0))).count() == 0


@needs_data
def test_query_equals_a_plain_restatement(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = got(queries.op13_spelling_variants(spark, SF).collect())
    assert len(rows) == len(set(rows)) and set(rows) == plain(docs)
