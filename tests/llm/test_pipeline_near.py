"""The pipeline's near-duplicates: five words, 80%."""

import numpy as np

import corpus_pipeline
from presswork.llm import jaccard


def shingles(text, words):
    split = text.lower().split()
    return {tuple(split[i : i + words]) for i in range(len(split) - words + 1)}


def similarity(a, b, words):
    x, y = shingles(a, words), shingles(b, words)
    return len(x & y) / len(x | y)


def with_new(words, places):
    return " ".join(f"new{i}" if i in places else w for i, w in enumerate(words))


BASE = [f"w{i}" for i in range(200)]
ORIGINAL = " ".join(BASE)
NEAR = with_new(BASE, (30, 70, 110, 150))
FAR = with_new(BASE, (25, 60, 95, 130, 165))


def test_near_copies_between_the_rules_go(spark):
    assert similarity(ORIGINAL, NEAR, 4) < 0.85 and similarity(ORIGINAL, NEAR, 5) >= 0.8
    assert similarity(ORIGINAL, FAR, 5) < 0.8 and similarity(NEAR, FAR, 5) < 0.8
    rows = [(1, ORIGINAL, "s"), (2, NEAR, "s"), (3, FAR, "s"), (4, "a text of its own", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = corpus_pipeline.keep_one_of_similar(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]


def test_components_of_five_words_equal_all_pairs(spark):
    rng = np.random.default_rng(4)
    words = [f"w{rng.integers(300)}" for _ in range(120)]
    texts = [
        with_new(words, set(rng.choice(120, int(rng.integers(0, 6)), replace=False).tolist()))
        for _ in range(30)
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in jaccard.jaccard_components(docs, 80, 5).collect()}
    least = list(range(30))
    for _ in range(30):
        for i in range(30):
            for j in range(30):
                x, y = shingles(texts[i], 5), shingles(texts[j], 5)
                if 100 * len(x & y) >= 80 * len(x | y):
                    least[i] = min(least[i], least[j])
    assert got == {i: (len(shingles(t, 5)), least[i]) for i, t in enumerate(texts)}
