"""Language, main text, token files and top-k search on awkward rows."""

import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from presswork.llm import html_text, language, token_files, topk
from presswork.storage import new_folder

# Top-k search


def best(vectors, k=3):
    """``vectors``: pairs of an id, which may repeat, and a vector."""
    out = []
    for query in sorted({i for i, _ in vectors if i % 10 == 0}):
        scores = sorted(
            (-sum(a * b for a, b in zip(q, v, strict=False)), other)
            for i, q in vectors
            if i == query
            for other, v in vectors
            if other != query
        )
        out += [(query, i + 1, other, -s) for i, (s, other) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [1024, 7])
def test_top_k(spark, block):
    rng = np.random.default_rng(0)
    vectors = {i: [int(x) for x in rng.integers(-3, 4, 4)] for i in range(60)}
    vectors |= {i: [1, 1, 1, 1] for i in range(60, 90)} | {100: [0, 0, 0, 0], 110: [5], 121: []}
    # Ids that repeat: a row again, another vector with the highest score of all, two queries.
    pairs = [*vectors.items(), (7, vectors[7]), (8, [9, 9, 9, 9]), (20, [0, -3, 1, 2])]
    rows = [(i, v, 1) for i, v in pairs] + [(None, [1, 2], 1), (200, None, 1)]
    table = spark.createDataFrame(rows, "vec_id long, vector array<long>, rank int")
    got = topk.top_k(table, F.col("vec_id") % 10 == 0, 3, block, block)
    assert sorted(map(tuple, got.collect())) == best(pairs)


def test_top_k_with_one_id_on_a_third_of_all_rows(spark):
    rng = np.random.default_rng(4)
    pairs = [(i if i % 3 else 10, [int(x) for x in rng.integers(-9, 10, 6)]) for i in range(300)]
    table = spark.createDataFrame(pairs, "vec_id long, vector array<long>")
    got = topk.top_k(table, F.col("vec_id") % 10 == 0, 3, 16, 8)
    assert sorted(map(tuple, got.collect())) == best(pairs)


def test_top_k_of_numbers_too_large_for_doubles(spark):
    pairs = [(0, [1 << 30, 1]), (1, [1 << 30, 3]), (2, [1 << 30, 2]), (3, [1, 0])]
    table = spark.createDataFrame(pairs, "vec_id long, vector array<long>")
    got = topk.top_k(table, F.col("vec_id") == 0, 2).collect()
    assert [tuple(r)[2:] for r in sorted(got)] == [(1, (1 << 60) + 3), (2, (1 << 60) + 2)]


def test_top_k_stops_early():
    lists = topk.SortedLists(np.arange(4000), np.array([[4000 - i, 0] for i in range(4000)]))
    reads = []
    lists.rows = type("Rows", (), {"__getitem__": lambda s, at: (reads.append(len(at)), _ROWS[at])[1]})()
    ids, scores = lists.search(-1, np.array([1, 0]), 10)
    assert ids.tolist() == list(range(10)) and sum(reads) < 200


_ROWS = np.array([[4000 - i, 0] for i in range(4000)])


def test_top_k_without_rows_or_queries(spark):
    empty = spark.createDataFrame([], "vec_id long, vector array<long>")
    assert topk.top_k(empty, F.col("vec_id") % 10 == 0).collect() == []
    one = spark.createDataFrame([(3, [1]), (4, [1])], "vec_id long, vector array<long>")
    assert topk.top_k(one, F.col("vec_id") % 10 == 0).collect() == []


# Language


def labelled(spark):
    rng = np.random.default_rng(1)
    parts = {"xx": ["ka", "to", "ri", "mo"], "yy": ["sch", "ung", "eit", "ver"], "zz": ["été", "eau", "oux"]}
    rows = []
    for n in range(150):
        lang = ("xx", "yy", "zz")[n % 3]
        word = lambda lang=lang: "".join(rng.choice(parts[lang], 3))
        rows.append((n, " ".join(word() for _ in range(30)), lang, "x"))
    rows += [(500, None, "xx", "x"), (501, "123 !!", "yy", "x"), (502, rows[0][1], None, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_languages(spark):
    docs = labelled(spark)
    model = language.fit(docs.filter("doc_id % 2 = 0"))
    assert sorted(set(model.langs)) == ["xx", "yy", "zz"]
    assert max(model.langs.count(lang) for lang in model.langs) <= language.CENTROIDS
    rows = language.identify(docs, model).collect()
    assert len(rows) == docs.count()
    for row in rows:
        doc = row["_row"]
        if doc["doc_id"] in (500, 501):
            assert (row["lang_pred"], row["score"], row["rejected"]) == ("und", 0, True)
        else:
            assert row["lang_pred"] == (doc["lang"] or "xx")
            assert 0 < row["score"] <= 1 and not row["rejected"]


def test_far_texts_are_rejected_and_short_ones_get_room(spark):
    docs = labelled(spark)
    model = language.fit(docs)
    noise = "qwx jzk vbn pqw " * 40
    langs, scores, rejected = model.predict([noise, "ka", "été", "", None, "  ", "katori " * 5000])
    assert rejected.tolist() == [True, False, False, True, True, True, False]
    assert langs[1:6] == ["xx", "zz", "und", "und", "und"]


def test_languages_without_rows(spark):
    docs = labelled(spark)
    model = language.fit(docs.limit(0))
    row = language.identify(docs.limit(1), model).first()
    assert (row["lang_pred"], row["score"], row["rejected"]) == ("und", 0, True)
    assert language.identify(docs.limit(0), model).collect() == []


def test_held_out_follows_the_checksum(spark):
    got = spark.range(50).select("id", language.held_out("id")).collect()
    assert [h for _, h in got] == [zlib.crc32(str(i).encode()) % 4 == 2 for i, _ in got]


# Token files


TEXTS = [
    "Plain words, and more words.",
    "two  spaces,   three\n\n new lines \n x\t y ",
    " leading", "trailing ", " ", "", None,
    "it's we'll 's 't  's <|endoftext|> a<|endoftext|>b  <|endoftext|>",
    "é  x　 y \x1c z \x85 w", "日本語 テキスト 😀 😀", "0x1F 12 345", "a" * 3000 + " b" * 3000,
]


def test_token_files(spark):
    from tokenizers import Tokenizer

    path = token_files.tokenizer_path()
    rows = [(i * 3 % 17, t, 1) for i, t in enumerate(TEXTS)] + [(5, "same id", 2), (5, "same id", 2), (None, "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    folder = new_folder(spark, "test")
    token_files.write_tokens(docs.repartition(5), folder, path)
    tokenizer, expected, at = Tokenizer.from_file(path), [], 0
    for doc_id, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    files = token_files.read_tokens(spark, folder)
    got = token_files.token_digests(files).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected


def test_sizes_are_read_without_tokens(spark):
    folder = new_folder(spark, "test")
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    token_files.write_tokens(docs, folder, token_files.tokenizer_path())
    files = token_files.read_tokens(spark, folder)
    plan = token_files.part_offsets(files)._jdf.queryExecution().executedPlan().toString()
    assert "tokens:array" not in plan
    one = files.filter("doc_id = 7").select("tokens")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in one._jdf.queryExecution().executedPlan().toString()
    assert one.first()["tokens"][-1] == 2


def test_token_file_encodings(spark, tmp_path):
    import pyarrow.parquet as pq

    docs = spark.createDataFrame([(i, f"text {i} " * 50) for i in range(500)], "doc_id long, text string")
    token_files.write_tokens(docs.coalesce(1), str(tmp_path / "t"), token_files.tokenizer_path())
    file = pq.ParquetFile(next((tmp_path / "t").glob("*.parquet")))
    columns = {c.path_in_schema: c for c in (file.metadata.row_group(0).column(i) for i in range(5))}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert "RLE_DICTIONARY" in columns["tokens.list.element"].encodings
    assert columns["doc_id"].has_column_index and columns["doc_id"].has_offset_index


def test_no_token_rows(spark):
    folder = new_folder(spark, "test")
    docs = spark.createDataFrame([], "doc_id long, text string")
    token_files.write_tokens(docs, folder, token_files.tokenizer_path())
    assert token_files.token_digests(token_files.read_tokens(spark, folder)).collect() == []


# Main text


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body>
<nav class="menu"><ul><li><a href="/a">Home</a><li><a href="/b">About us</a></ul></nav>
<div class="cookie-notice"><p>We use cookies. They are small, and good.</p></div>
<div class="post-content"><h1>The  title &amp; more</h1><script>var x = "<p>no</p>";</script>
<p>First paragraph, with a <a href="/c">link</a> and <b>bold<br>text. It is long enough, surely.
<p>Second&nbsp;one &lt;here&gt; with some more words in it, and a comma.</p><!-- <p>gone</p> -->
<ul><li>An item of a list in the text.</li></ul><div class="advert">Buy now, cheap.</div></div>
<aside class="sidebar"><h3>Related</h3><ul><li><a href="/d">Other</a></li></ul></aside>
<div class="comments"><ul><li><b>Ann</b><p>I like it, a lot.</p></li></ul></div>
<form class="newsletter"><p>Sign up</p><input type="text"></form>
<footer>&copy; 2020 Nobody, all rights reserved.</footer>"""


@pytest.fixture(scope="module")
def trees():
    words = "some plain words of a text that goes on, and on. until it ends".split()
    rng = np.random.default_rng(0)
    pages = [
        f"<nav><a>{i}</a></nav><article><p>{' '.join(rng.choice(words, 60))}</p></article>"
        for i in range(20)
    ]
    return html_text.fit(pages)


def test_a_page(trees):
    page = html_text.parse(PAGE)
    assert html_text.main_text(page, trees.odds(html_text.features(page))) == (
        "The title & more First paragraph, with a link and bold text. It is long enough, surely. "
        "Second one <here> with some more words in it, and a comma. An item of a list in the text."
    )


def test_nothing_inside_a_dropped_node_is_kept():
    page = html_text.parse("<div><div><p>aaaa</p></div><p>bbbbbbbb</p></div>")
    odds = np.array([0, -1, -5, 1, 3])
    keep = html_text.decode(page, odds)
    assert all(keep[p] for p, k in zip(page.parents, keep, strict=True) if k and p >= 0)


def test_awkward_pages(spark, trees):
    texts = [None, "", "  ", "plain text", "<p", "<", "</p></div>", "<p a='>x", "<div>" * 5000 + "deep", "&amp;" * 9]
    pages = spark.createDataFrame(
        [(i, "u", t, "c") for i, t in enumerate([*texts, PAGE, PAGE])],
        "page_id long, url string, html string, text string",
    )
    rows = html_text.extract(pages, trees).collect()
    got = {r["_row"]["page_id"]: r["text"] for r in rows}
    assert len(rows) == 12 and got[0] == got[1] == got[2] == "" and got[10] == got[11] != ""
    assert html_text.extract(pages.limit(0), trees).collect() == []


def test_links_and_ends():
    page = html_text.parse("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e<tr><td>f</table>g")
    assert [t for _, t in page.texts] == list("abcdefg")
    assert [page.tags[n] for n, _ in page.texts] == ["li", "li", "li", "td", "td", "td", "body"]


def test_pieces_are_remembered_and_forgotten(monkeypatch):
    """Many rounds over few words, with memories so small that they turn over."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "CACHE_PIECES", 50)
    monkeypatch.setattr(token_files, "SEEN_SLOTS", 256)
    monkeypatch.setattr(token_files, "JOINED_CHARS", 40)
    monkeypatch.setattr(token_files, "worker_cache", lambda name: {})
    path = token_files.tokenizer_path()
    encoder, tokenizer = token_files._Encoder(path), Tokenizer.from_file(path)
    rng = np.random.default_rng(9)
    words = [f"wörd{i}" if i % 3 else f"x{i}" for i in range(200)] + ["", " ", "\n", "<|endoftext|>", "'s", "日本"]
    for _ in range(60):
        texts = [" ".join(rng.choice(words, int(rng.integers(0, 40)))) for _ in range(8)] + [t or "" for t in TEXTS]
        expected = [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder(texts)] == expected
    assert encoder._memory["old"] and len(encoder._memory["new"]) <= 300


def test_a_text_of_megabytes(spark):
    from tokenizers import Tokenizer

    path = token_files.tokenizer_path()
    text = " ".join(f"word{i % 5000} und äöü{i % 77}" for i in range(150_000))
    docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    folder = new_folder(spark, "test")
    token_files.write_tokens(docs, folder, path)
    ids = [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, 2]
    got = token_files.token_digests(token_files.read_tokens(spark, folder)).collect()
    crc = zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted(map(tuple, got)) == [(1, 0, len(ids), crc), (2, len(ids), len(ids), crc)]


KINDS = "ab zéß ſÀ ×÷ 09 .,<|> ' 's 're \n\t\r\u00a0 日本 …— _ café's Ünïcödé %%% ° \x1f ½ ğ £".split(" ")


def test_plain_pieces_equal_the_tokenizer(monkeypatch):
    """Texts of all kinds of characters, with few and with many spaces."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "worker_cache", lambda name: {})
    path = token_files.tokenizer_path()
    encoder, tokenizer = token_files._Encoder(path), Tokenizer.from_file(path)
    rng = np.random.default_rng(7)
    signs = [" "] * 12 + list("".join(KINDS)) + KINDS + ["the", "ing", "<|endoftext|>", "x" * 250]
    for _ in range(60):
        texts = ["".join(rng.choice(signs, int(rng.integers(0, 120)))) for _ in range(20)]
        expected = [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder(texts)] == expected


def test_new_plain_pieces_go_without_the_pattern(monkeypatch):
    monkeypatch.setattr(token_files, "worker_cache", lambda name: {})
    encoder = token_files._Encoder(token_files.tokenizer_path())
    through = []
    whole = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda texts: through.extend(texts) or whole(texts))
    encoder(["first second, third.\nFourth fünfte 6th <b> it's " + "x" * 300, "seven"])
    assert sorted(" ".join(through).split()) == sorted(["first", "seven", "<b>", "it's", "x" * 300])


def test_a_model_that_joins_kinds_keeps_its_pattern(tmp_path, monkeypatch):
    """A vocabulary with a token of a letter and a full stop, which the pattern divides."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "worker_cache", lambda name: {})
    spec = json.loads(Tokenizer.from_file(token_files.tokenizer_path()).to_str())
    number = max(spec["model"]["vocab"].values()) + 2
    spec["model"]["vocab"]["a."] = number
    spec["model"]["merges"].insert(0, ["a", "."])
    path = str(tmp_path / "joined.json")
    (tmp_path / "joined.json").write_text(json.dumps(spec))
    encoder, tokenizer = token_files._Encoder(path), Tokenizer.from_file(path)
    texts = ["the sea. a. b.a.", "data.\nsea a.b"]
    expected = [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder(texts)] == expected


def test_a_worker_reads_a_tokenizer_once(tmp_path, monkeypatch):
    from shutil import copyfile

    caches = {}
    monkeypatch.setattr(token_files, "worker_cache", lambda name: caches.setdefault(name, {}))
    path = str(tmp_path / "own.json")
    copyfile(token_files.tokenizer_path(), path)
    first = token_files._encoder(path)
    assert token_files._encoder(path) is first
    first(["a b c", "a b c"])
    (tmp_path / "own.json").write_text((tmp_path / "own.json").read_text() + " ")
    assert token_files._encoder(path) is not first
    assert token_files._encoder(path)._memory["new"] == {}
