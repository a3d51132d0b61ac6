"""Limits by character class, and the allow list by pieces."""

import math
import random
import re
import string
from collections import Counter

import pytest

from presswork.llm import secrets

ALPHABETS = {
    "digits": string.digits,
    "hex": "0123456789abcdef",
    "base32": string.ascii_uppercase + "234567",
    "lower": string.ascii_lowercase + string.digits,
    "base62": string.ascii_letters + string.digits,
    "base64": string.ascii_letters + string.digits + "+/",
}


def plain(text):
    """Entropy spans by the query's rule."""
    spans = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text or ""):
        if any(re.search(p, m[0]) for p in secrets.ALLOWED_RUNS):
            continue
        barred, at = set(), m.start()
        for piece in re.split("(?<=[/=])", m[0]):
            if any(re.search(p, piece) for p in secrets.ALLOWED_WORDS):
                barred.update(range(at, at + len(piece)))
            at += len(piece)
        covered = set()
        for begin in range(m.start(), m.end() - 19):
            window = text[begin : begin + 20]
            if re.fullmatch("[0-9]*", window):
                limit = 2.84
            elif re.fullmatch("[0-9A-Fa-f]*", window):
                limit = 3.0
            elif re.fullmatch("[0-9a-z]*|[0-9A-Z]*", window) and re.search("[0-9]", window):
                limit = 3.68
            else:
                limit = 3.9
            bits = -sum(c / 20 * math.log2(c / 20) for c in Counter(window).values())
            if bits >= limit - 1e-6 and not barred & set(range(begin, begin + 20)):
                covered.update(range(begin, begin + 20))
        for at in sorted(covered):
            if at - 1 not in covered:
                end = at
                while end in covered:
                    end += 1
                spans.append((at, end))
    return spans


def scan(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = secrets.scan_secrets(
        docs, secrets.ALLOWED_RUNS, secrets.CLASS_LIMITS, secrets.ALLOWED_WORDS
    )
    return {
        r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == 3]
        for r in found.collect()
    }


def keys(alphabet, n, length, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(length)) for _ in range(n)]


def test_spans_equal_the_rule(spark):
    rnd = random.Random(1)
    texts = [None, "", "x" * 30, "example"]
    for alphabet in ALPHABETS.values():
        for length in (20, 25, 40):
            texts += keys(alphabet, 8, length, length)
    words = ["example", "changeme", "xxxxxx", "abcdefgh", "01234567", "path", "a1", "/", "=", "_"]
    pool = [k for k in texts if k]
    texts += ["".join(rnd.choice([*words, *pool]) for _ in range(rnd.randint(1, 6))) for _ in range(300)]
    got = scan(spark, texts)
    for i, text in enumerate(texts):
        assert got[i] == plain(text), text


@pytest.mark.parametrize("name", [n for n in ALPHABETS if n != "digits"])
def test_few_random_keys_are_missed(spark, name):
    """Of 32 characters. Digits alone are on the allow list."""
    made = keys(ALPHABETS[name], 400, 32, 7)
    got = scan(spark, [f"key {key}." for key in made])
    assert sum(not spans for spans in got.values()) <= 0.05 * len(made)


def test_a_word_of_the_list_hides_its_piece_only(spark):
    key = "wJalrXUtnFEMIK7MDENGbPxRfiCYzQ81kfLw0"
    texts = [
        f"https-/example/v2/{key}",
        f"user=changeme/{key}",
        f"example{key}",
        f"{key}/{key[:10]}01234567{key[:10]}",
    ]
    got = scan(spark, texts)
    assert got[0] and got[0][0][1] == len(texts[0]) and got[1] and not got[2]
    assert got[3] and got[3][-1][1] <= len(key) + 1
