from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from presswork.llm import mixing


def rows(spark, sizes, extra="x"):
    data, n = [], 0
    for source, each in sizes.items():
        for size in each:
            data.append((n, " ".join(["w"] * size), source, extra, extra))
            n += 1
    return spark.createDataFrame(data, "doc_id long, text string, source string, mix string, size string")


def shared_out(sizes):
    """Sharing again and again, source by source."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        shares = {s: left * weights[s] / sum(weights[f] for f in free) for s in free}
        above = [s for s in free if shares[s] > 3 * sizes[s]]
        if not above:
            return capped | shares
        capped |= {s: 3 * sizes[s] for s in above}


SIZES = {
    "b": [5] * 40 + [90],
    "a": [3] * 20,
    None: [1, 2, 3],
    "c": list(range(60)),
    "é": [7] * 30,
    "Z": [4, 4],
}


def test_targets_and_taken(spark):
    mixed = mixing.mix(rows(spark, SIZES)).collect()
    assert len(mixed) == sum(map(len, SIZES.values()))
    totals = {s: sum(v) for s, v in SIZES.items()}
    expected, taken, largest = shared_out(totals), defaultdict(int), {s: max(v) for s, v in SIZES.items()}
    for row in mixed:
        m = row["mix"]
        assert m["source_size"] == totals[row["source"]]
        assert m["target"] == pytest.approx(expected[row["source"]])
        assert 0 <= m["passes"] <= 3 and m["taken"] == m["passes"] * m["size"]
        assert len(m["positions"]) == m["passes"]
        assert m["positions"] == sorted(m["positions"]) and all(0 <= p <= 1 for p in m["positions"])
        taken[row["source"]] += m["taken"]
    for source, target in expected.items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1e-9


def test_reruns_agree_on_any_partitioning(spark):
    docs = rows(spark, SIZES)
    one = mixing.mix(docs.repartition(1)).select("doc_id", "mix").collect()
    many = mixing.mix(docs.repartition(7)).select("doc_id", "mix").collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_arrange_repeats_and_sorts(spark):
    mixed = mixing.mix(rows(spark, SIZES))
    got = mixing.arrange(mixed)
    assert got.columns == ["doc_id", "text", "source", "size", "position"]
    positions = [r["position"] for r in got.collect()]
    assert positions == sorted(positions)
    assert len(positions) == mixed.agg(F.sum("mix.passes")).first()[0]


def test_the_ramp_moves_a_source_early_or_late(spark):
    sizes = {"early": [10] * 200, "even": [10] * 200, "late": [10] * 200}
    mixed = mixing.mix(rows(spark, sizes), weights=(1, 1, 1), ramps=(-0.9, 0.0, 0.9))
    means = mixed.select("source", F.explode("mix.positions").alias("p")).groupBy("source").avg("p")
    mean = dict(map(tuple, means.collect()))
    assert mean["early"] < 0.42 < mean["even"] < 0.58 < mean["late"]


def test_awkward_rows(spark):
    data = [(1, None, "a"), (2, "", "a"), (2, "", "a"), (3, " \x0b\t", None), (None, "x y", None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    mixed = {(r["doc_id"], r["source"]): r["mix"] for r in mixing.mix(docs).collect()}
    assert mixed[1, "a"]["taken"] == mixed[2, "a"]["target"] == 0
    assert mixed[None, None]["taken"] == 2
    assert mixing.mix(docs).count() == 5
    assert mixing.mix(docs.limit(0)).collect() == []


def test_words_are_runs_without_ascii_space(spark):
    texts = [("a\x1cb c d e  f\n", 3), ("", 0), (None, 0), ("\x0c\x0b", 0)]
    docs = spark.createDataFrame(texts, "text string, n long")
    assert all(r[0] == r[1] for r in docs.select(mixing.count_words("text"), "n").collect())
