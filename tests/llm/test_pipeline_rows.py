"""The pipeline's stages and rows against plain Python, and its rows of every kind."""

import os
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from test_decontaminate import WORD, words_of
from test_pipeline_near import shingles

import corpus_pipeline as cp
from presswork.llm import language, mixing, token_files

TABLES = Path(os.environ.get("PRESSWORK_TABLES", "/root/testdata/sf0.001"))


def plain_near(rows, words=5, percent=80):
    """Of each group of similar ``(doc_id, text, …)`` the smallest id; ids are different."""
    sets = {}
    for doc_id, text, *_ in rows:
        split = (text or "").encode().lower().split()
        count = len(split) - words + 1
        sets[doc_id] = {tuple(split[i : i + words]) for i in range(max(1, count))} if split else set()
    least = {d: d for d in sets}

    def top(d):
        while least[d] != d:
            d = least[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                least[max(x, y)] = min(x, y)
    return [row for row in rows if top(row[0]) == row[0]]


def plain_clean(rows, items, window=10, coverage=0.8):
    shown = {}
    for _, text in items:
        own = words_of(text)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            shown.setdefault(size, set()).add(tuple(own[i : i + size]))
    out = []
    for doc_id, text, *rest in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        places = [m.span() for m in WORD.finditer(lower)]
        words, hit = words_of(text), set()
        for size, windows in shown.items():
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in windows:
                    hit.update(range(i, i + size))
        if len(hit) > coverage * len(words):
            continue
        if hit:
            kept, at = "", 0
            for i in sorted(hit):
                if i - 1 in hit:
                    continue
                end = i
                while end + 1 in hit:
                    end += 1
                kept, at = kept + text[at : places[i][0]], places[end][1]
            text = kept + text[at:]
        out.append((doc_id, text, *rest))
    return out


@pytest.mark.skipif(not TABLES.exists(), reason="needs the given tables")
def test_rows_equal_plain_stages(spark):
    """Language by the fitted model on the driver, all pairs, a scan for every window, the mix
    from its targets, and the tokenizer."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(str(TABLES / "documents.parquet"))
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").orderBy("doc_id").collect()]
    model = language.fit(docs.filter(~language.held_out("doc_id")))
    rejected = model.predict([text for _, text, _ in rows])[2]
    rows = [row for row, gone in zip(rows, rejected, strict=True) if not gone]
    rows = plain_near(rows)
    items = spark.read.parquet(str(TABLES / "benchmark.parquet")).collect()
    rows = plain_clean(rows, [(r["item_id"], r["text"]) for r in items])
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {r["doc_id"]: r["mix"]["passes"] for r in mixing.mix(frame).collect()}
    tokenizer = Tokenizer.from_file(token_files.tokenizer_path())
    expected, at = [], 0
    for doc_id, text, _ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        for _ in range(taken[doc_id]):
            expected.append((doc_id, at, len(ids), crc))
            at += len(ids)
    assert Counter(map(tuple, cp.run(spark, str(TABLES)).collect())) == Counter(expected)
    assert len(rows) < docs.count() and expected


NAMES = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, turn int, "
    "size int, position string, mix string, _turn int, _words int, hits string, component_id int"
)


def stages(spark, rows, folder):
    docs = spark.createDataFrame(rows, NAMES)
    out = []
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, str(folder))
        out.append((docs.columns, docs.collect()))
        docs = spark.createDataFrame(out[-1][1], docs.schema)
    return out


@pytest.fixture
def folder(spark, tmp_path):
    items = spark.createDataFrame([("i", " ".join(f"item{n}" for n in range(12))), (None, None)], "item_id string, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    return tmp_path


def rest(n):
    """Values of the columns with clashing names."""
    return (f"row{n}", n, n + 1, f"p{n}", "m", n, n, "h", n)


def test_nulls_repeats_and_clashing_names_pass_through_the_stages(spark, folder):
    rng = np.random.default_rng(0)
    speech = {"xx": ["ka", "to", "ri", "mo"], "yy": ["sch", "ung", "eit", "ver"]}
    texts = []
    for n in range(120):
        lang = ("xx", "yy")[n % 2]
        words = ["".join(rng.choice(speech[lang], 3)) for _ in range(40)]
        texts.append((lang, " ".join(words)))
    rows = [(n, t, lang, f"s{n % 3}", len(t), *rest(n)) for n, (lang, t) in enumerate(texts)]
    rows += [
        rows[0],  # repeated
        (200, texts[1][1], None, None, None, *rest(200)),  # a copy, without the rest
        (201, None, "xx", "s0", None, *rest(201)),
        (202, "", "xx", "s0", 0, *rest(202)),
        (203, "123 456 !!", None, "s1", 9, *rest(203)),
        (None, texts[2][1] + " katori", "xx", "s1", 1, *rest(204)),
        (205, texts[3][1] + " " + " ".join(f"item{n}" for n in range(12)), "yy", "s2", 1, *rest(205)),
        (206, " ".join(t for _, t in texts[::2] * 40), "xx", "s2", 1, *rest(206)),  # long
    ]
    out = stages(spark, rows, folder)
    names = [part.split()[0] for part in NAMES.split(", ")]
    assert all(columns == names for columns, _ in out[:-1])
    given = {tuple(r) for r in rows}
    kept = [{r["doc_id"] for r in found} for _, found in out]
    assert all(tuple(r) in given for r in out[0][1] + out[1][1])
    assert not kept[0] & {201, 202, 203} and {0, 200, None, 206} <= kept[0]
    # Of the repeated row and of the copy one stays.
    assert Counter(r["doc_id"] for r in out[1][1])[0] == 1 and 200 not in kept[1]
    # The passage goes, the rest stays; and every other row is as it was.
    cut = {r["doc_id"]: r for r in out[2][1]}
    assert 205 not in cut or "item3" not in cut[205]["text"]
    assert {tuple(r) for r in out[2][1] if r["doc_id"] != 205} <= given
    assert {tuple(r) for r in out[3][1]} <= {tuple(r) for r in out[2][1]}
    assert [r["doc_id"] for r in sorted(out[4][1], key=lambda r: r["start"])] == sorted(
        (r["doc_id"] for r in out[3][1]), key=lambda d: (d is not None, d)
    )


def test_an_empty_table_passes_through_the_stages(spark, folder):
    out = stages(spark, [], folder)
    assert all(found == [] for _, found in out)
    assert out[-1][0] == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_shingle_rule_of_the_plain_version():
    assert plain_near([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x")]) == [(1, "a b c d e f"), (3, "x")]
    assert shingles("a b c d e f", 5) == {tuple("abcde"), tuple("bcdef")}
