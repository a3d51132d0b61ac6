"""Texts in languages the model has not learned, and noise, go at all lengths; own ones stay."""

import base64
import random
from pathlib import Path

import pytest

from presswork.llm import language

TABLES = Path("/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="needs the given tables")

_random = random.Random(5)
_letters = "abcdefghijklmnopqrstuvwxyz"
FAR = {
    "Italian": "Ieri sera siamo andati al cinema a vedere un film nuovo che si è rivelato molto "
    "interessante. Il governo ha deciso di aumentare le tasse sulle imprese, mentre gli operai "
    "chiedono salari migliori e condizioni di lavoro più sicure nelle fabbriche del nord. ",
    "Polish": "Wczoraj wieczorem poszliśmy do kina na nowy film, który okazał się bardzo ciekawy. "
    "Rząd zapowiedział podwyżki podatków, a związki zawodowe domagają się lepszych płac. ",
    "Finnish": "Eilen illalla menimme elokuviin katsomaan uutta elokuvaa, joka osoittautui erittäin "
    "mielenkiintoiseksi. Hallitus aikoo korottaa yritysten veroja, ja liitot vaativat palkkoja. ",
    "Russian": "Вчера вечером мы пошли в кино на новый фильм, который оказался очень интересным. ",
    "C++": "template <typename T> class Stack { public: void push(const T& x) { data.push_back(x); } "
    "private: std::vector<T> data; }; int main(int argc, char** argv) { return 0; } ",
    "base64": base64.b64encode(_random.randbytes(3000)).decode(),
    "letters": "".join(_random.choices(_letters, k=3000)),
    "words": " ".join("".join(_random.choices(_letters, k=5)) for _ in range(600)),
}


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(str(TABLES / "documents.parquet"))


@pytest.fixture(scope="module")
def model(documents):
    return language.fit(documents.filter(~language.held_out("doc_id")))


@pytest.mark.parametrize("name", FAR)
def test_far_texts_go(model, name):
    texts = [(FAR[name] * 80)[:n] for n in (60, 120, 250, 500, 1000, 3000)]
    assert model.predict(texts)[2].all()


def test_clean_held_out_texts_stay(documents, model):
    held = documents.filter(language.held_out("doc_id")).filter(r"text rlike '\\p{L}'").collect()
    # A few words under a license line are that line's language, which was not learned.
    clean = [r["text"] for r in held if "licensed under" not in r["text"]]
    assert not model.predict(clean)[2].any() and len(clean) > 200
    assert model.predict([r["text"] for r in held])[2].sum() <= 1


def test_most_pieces_of_held_out_texts_stay(documents, model):
    held = documents.filter(language.held_out("doc_id")).filter(r"text rlike '\\p{L}'").collect()
    for size in (60, 120, 250, 500):
        texts = [r["text"][:size] for r in held if len(r["text"]) >= size]
        rejected = model.predict([t for t in texts if language.has_letter(t)])[2]
        assert rejected.mean() < 0.05
