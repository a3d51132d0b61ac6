import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presswork.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return WORD.findall(text)


def plain(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        words, hit, names = words_of(text), set(), set()
        for item, other in items:
            own = words_of(other)
            size = min(window, len(own))
            shown = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in shown:
                    hit.update(range(i, i + size))
                    names.add(item)
        out.append((doc_id, len(words), len(hit), sorted(n for n in names if n is not None)))
    return sorted(out, key=str)


def found(spark, docs, items, window=10):
    left = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, hits string")
    right = spark.createDataFrame(items, "item_id string, text string")
    rows = d.find_items(left, right, window).selectExpr(
        "_row.doc_id", "n_words", "aggregate(hits, 0L, (a, x) -> a + x.end - x.begin)", "items"
    )
    return sorted(map(tuple, rows.collect()), key=str)


TEN = "one two three four five six seven eight nine ten"
DOCS = [
    (1, f"Start. {TEN.upper()}, eleven! end"),
    (2, TEN.replace(" ", "-\n")),
    (3, "two three four five six seven eight nine ten"),
    (4, None),
    (5, ""),
    (6, "!!! ... "),
    (7, "É a short ITEM here; a short item"),
    (7, "solo Solo x solo"),
    (None, f"{TEN} eleven twelve {TEN}"),
    (8, "three four five six seven eight nine ten eleven twelve thirteen " * 300),
    (9, "été ÉTÉ Été"),
]
ITEMS = [
    ("a", f"{TEN} eleven twelve thirteen"),
    ("b", "a short item"),
    ("c", "Solo"),
    ("d", None),
    ("e", " ?! "),
    ("b", "x solo"),
    (None, "three four five six seven eight nine ten eleven twelve"),
    ("f", "été Été"),
    ("g", f"{TEN} {TEN}"),
]


@pytest.mark.parametrize("size", [100_000, 12])
def test_awkward_rows(spark, monkeypatch, size):
    """Also with so little room that every item makes automata of its own."""
    monkeypatch.setattr(d, "AUTOMATON_WORDS", size)
    assert found(spark, DOCS, ITEMS) == plain(DOCS, ITEMS)


@given(st.lists(st.text("abc ", max_size=25), max_size=4), st.text("abc ", max_size=60))
@settings(max_examples=80, deadline=None)
def test_automaton(items, text):
    coded = [(str(i), d.item_words(t)) for i, t in enumerate(items)]
    automaton = d.Automaton(coded, 3)
    import numpy as np

    words = d.item_words(text)
    ids = [automaton.vocabulary.get(w, -1) for w in words]
    hit, names = set(), set()
    for begin, end in automaton.runs(np.array(ids, "i8")) if ids else ():
        for a, b, state in automaton.match(ids[begin:end], begin):
            hit.update(range(a, b))
            names |= automaton.items[state]
    _, _, n_hit, expected = plain([(0, text)], [(str(i), t) for i, t in enumerate(items)], 3)[0]
    assert (len(hit), sorted(names)) == (n_hit, expected)


def test_passages_are_cut_and_little_else_goes(spark):
    docs = spark.createDataFrame(
        [
            (1, f"Keep this, please: {TEN.title()}! And this is kept as well, all of it.", 99),
            (2, TEN, 99),
            (3, "Nothing to see", 14),
            (4, None, None),
        ],
        "doc_id long, text string, n_chars long",
    )
    items = spark.createDataFrame([("a", TEN)], "item_id string, text string")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in d.decontaminate(docs, items).collect()}
    text = "Keep this, please: ! And this is kept as well, all of it."
    assert got == {1: (text, len(text)), 3: ("Nothing to see", 14), 4: (None, None)}


def test_empty_tables(spark):
    assert found(spark, [], ITEMS) == []
    assert found(spark, DOCS[:3], []) == plain(DOCS[:3], [])
