"""The queries that SQL can express against their SQL, the others against plain Python."""

import hashlib
import os
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from presswork.llm import registered

TABLES = Path(os.environ.get("PRESSWORK_TABLES", "/root/testdata/sf0.001"))

pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


@pytest.fixture(scope="module")
def documents(database):
    return database.sql("select doc_id, text from documents order by doc_id").fetchall()


def test_all_are_registered():
    assert registered.QUERIES.items() <= entry.queries().items()
    assert registered.ORACLES.items() <= entry.oracle_sql().items()
    numbers = set(range(1, 14))
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in registered.QUERIES if n != "pipeline"} == numbers
    assert registered.QUERIES["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", registered.ORACLES)
def test_query_equals_its_sql(spark, database, name):
    got = registered.QUERIES[name](spark, str(TABLES))
    expected = database.sql(registered.ORACLES[name])
    assert sorted(got.columns) == sorted(expected.columns)
    rows = expected.project(", ".join(f'"{column}"' for column in got.columns)).fetchall()
    assert rows and Counter(map(tuple, got.collect())) == Counter(rows)


def test_repeats_equal_a_set_of_all_strings(spark, documents):
    got = {r["doc_id"]: tuple(r)[1:] for r in _rows(spark, "op2_remove_repeats")}
    seen, expected = set(), {}
    for doc_id, text in documents:
        raw = (text or "").encode()
        strings = [raw[i : i + 50] for i in range(len(raw) - 49)]
        gone = [False] * len(raw)
        for i, string in enumerate(strings):
            if string in seen:
                gone[i : i + 50] = [True] * 50
        seen.update(strings)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        expected[doc_id] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    assert got == expected
    assert sum(e[1] for e in expected.values()) > 0


def test_components_equal_all_pairs(spark, documents):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in _rows(spark, "op10_jaccard_join")}
    sets = {}
    for doc_id, text in documents:
        words = (text or "").encode().lower().split()
        sets[doc_id] = {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()
    assert got == {d: (len(sets[d]), c) for d, c in all_pairs(sets).items()}


def all_pairs(sets):
    least = {d: d for d in sets}

    def top(d):
        while least[d] != d:
            d = least[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                least[max(x, y)] = min(x, y)
    return {d: top(d) for d in sets}


def test_token_files_equal_the_tokenizer(spark, documents):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r["doc_id"]: tuple(r)[1:] for r in _rows(spark, "op9_token_files")}
    start, expected = 0, {}
    for doc_id, text in documents:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        expected[doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == expected


def test_held_out_languages(spark, database):
    lang = dict(database.sql("select doc_id, lang from documents").fetchall())
    rows = _rows(spark, "op8_identify_language")
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_main_text_is_the_article(spark, database):
    import html

    pages = dict(database.sql("select page_id, html from pages").fetchall())
    for row in _rows(spark, "op3_main_text"):
        source = pages[row["page_id"]]
        article = source[source.index("<article>") : source.index("</article>")]
        blocks = [re.sub(r"<[^>]*>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", article)]
        blocks = [" ".join(html.unescape(b).split()) for b in blocks]
        assert row["text"] == " ".join(b for b in blocks if b)
        assert row["n_chars"] == len(row["text"])


def _rows(spark, name):
    return registered.QUERIES[name](spark, str(TABLES)).collect()


def test_pipeline(spark, documents):
    rows = _rows(spark, "pipeline")
    ids = Counter(r["doc_id"] for r in rows)
    assert ids and ids.keys() <= {d for d, _ in documents} and max(ids.values()) <= 3
    at = 0
    for row in sorted(rows, key=lambda r: r["start"]):
        assert row["start"] == at
        at += row["n_tokens"]


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(str(TABLES / "documents.parquet"))
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(TABLES))
        assert docs.columns == columns


def test_a_language_stage_lets_clean_documents_pass(spark):
    docs = spark.read.parquet(str(TABLES / "documents.parquet"))
    kept = corpus_pipeline.identify_language(spark, docs, str(TABLES))
    lettered = docs.filter(docs["text"].rlike(r"\p{L}")).count()
    assert kept.count() == lettered
