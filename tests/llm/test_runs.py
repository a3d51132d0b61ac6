"""Runs against every period tried in turn, and op11 against plain Python."""

import hashlib
import os
import random
import zlib
from pathlib import Path

import numpy as np
import pytest

from presswork.llm import runs

TABLES = Path(os.environ.get("PRESSWORK_TABLES", "/root/testdata/sf0.001"))


def plain_runs(words, least=12):
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.array([numbers[w] for w in words], "i8")
    found = set()
    for q in range(1, len(ids) // 2 + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]])
        edges = np.flatnonzero(np.diff(same.astype("i1")))
        for begin, end in edges.reshape(-1, 2):
            if end - begin + q >= max(least, 2 * q):
                found.add((int(begin), int(end - begin + q), q))
    smallest = {}
    for begin, length, q in sorted(found, key=lambda r: r[2]):
        # Periods of one stretch: a larger one is a multiple if the stretch is that long.
        smallest.setdefault((begin, length), q)
    return sorted(((s, m, q) for (s, m), q in smallest.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(words, found):
    gone = set()
    for start, length, period in found:
        gone.update(range(start + period, start + length))
    return [w for i, w in enumerate(words) if i not in gone]


def longest_lyndon(word):
    lengths = []
    for i in range(len(word)):
        j = i + 1
        while j < len(word) and word[j:] > word[i:]:
            j += 1
        lengths.append(j - i)
    return lengths


def test_grouping_gives_the_longest_lyndon_words():
    random.seed(3)
    for _ in range(500):
        letters = random.randint(1, 4)
        word = [random.randrange(letters) for _ in range(random.randint(1, 30))]
        ranks = np.unique(word, return_inverse=True)[1].tolist()
        assert runs.lyndon_lengths(ranks) == longest_lyndon(ranks)
    assert runs.lyndon_lengths([]) == []


def test_extensions_are_exact_on_a_sequence_that_fools_polynomial_hashes():
    sequence = [0, 1]
    for _ in range(11):
        sequence += [1 - x for x in sequence]
    ids = np.array(sequence)
    extensions = runs.Extensions(ids)
    at, other = np.array([0, 0, 5, 2048]), np.array([2048, 1024, 9, 4095])
    for i, j, right in zip(at, other, extensions.right(at, other), strict=True):
        expected = 0
        while j + expected < len(ids) and ids[i + expected] == ids[j + expected]:
            expected += 1
        assert right == expected
    assert len(runs.find_runs(ids, 6)) == len(plain_runs(sequence, 6))


@pytest.mark.parametrize("least", [2, 7, 12])
def test_runs_equal_all_periods(least):
    random.seed(least)
    for _ in range(150):
        documents = []
        for _ in range(random.randint(1, 4)):
            n, letters = random.randint(0, 90), random.choice([1, 2, 2, 3, 5, 20])
            words = [random.randrange(letters) for _ in range(n)]
            if n and random.random() < 0.5:
                a = random.randrange(n)
                p = 1 + (n - a) // random.randint(2, 10)
                words = words[:a] + [words[a + i % p] for i in range(n - a)]
            documents.append(words)
        found = runs.runs_of([np.array(d, "i8") for d in documents], least)
        for words, got in zip(documents, found, strict=True):
            assert [tuple(r) for r in got.tolist()] == plain_runs(words, least)


def test_rows_of_every_kind(spark):
    long = " ".join(f"w{i % 700}" for i in range(40_000))
    rows = [
        (1, "a b " * 8, 7),
        (1, "a b " * 8, 7),  # repeated
        (2, None, 7),
        (3, "", 7),
        (4, " \t\n", 7),
        (None, "x " * 12, 7),
        (5, "x " * 11, 7),  # one word short
        (6, long, 7),
        (7, "ä ö ü  " * 9, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = runs.periodic_runs(docs).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append((r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]))
    assert by_id[1] == [(16, [(0, 16, 2)], "a b")] * 2
    assert by_id[2] == by_id[3] == by_id[4] == [(0, [], "")]
    assert by_id[None] == [(12, [(0, 12, 1)], "x")]
    assert by_id[5] == [(11, [], " ".join(["x"] * 11))]
    assert by_id[6] == [(40_000, [(0, 40_000, 700)], " ".join(f"w{i}" for i in range(700)))]
    # Only ASCII white space parts words.
    assert by_id[7] == [(18, [(0, 18, 2)], "ä ö ü ")]
    assert runs.periodic_runs(docs.limit(0)).collect() == []


@pytest.mark.skipif(not TABLES.exists(), reason="needs the given tables")
def test_query_equals_plain_python(spark):
    documents = spark.read.parquet(str(TABLES / "documents.parquet")).select("doc_id", "text").collect()
    got = {r["doc_id"]: r.asDict() for r in runs.op11_periodic_runs(spark, str(TABLES)).collect()}
    assert len(got) == len(documents)
    planted = 0
    for doc_id, text in documents:
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        found = plain_runs(words)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        assert got[doc_id] == {
            "doc_id": doc_id,
            "n_words": n,
            "n_runs": len(found),
            "start": best and best[0],
            "length": best and best[1],
            "period": best and best[2],
            "exponent_milli": best and 1000 * best[1] // best[2],
            "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(b" ".join(plain_collapse(words, found))).hexdigest(),
        }
    assert planted
