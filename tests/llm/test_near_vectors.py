"""Near vectors against all pairs."""

import math
import random

import numpy as np
import pytest

from presswork.llm import near_vectors as nv


def plain(rows, threshold=0.95):
    """``vec_id, n_links, component_id, kept`` of each row, in their order."""
    usable = [
        v is not None
        and all(x is not None and math.isfinite(x) for x in v)
        and any(x != 0 for x in v)
        for _, v in rows
    ]
    width = max((len(v) for (_, v), ok in zip(rows, usable) if ok), default=0)
    units = []
    for (_, v), ok in zip(rows, usable):
        u = np.zeros(width)
        if ok:
            u[: len(v)] = v
            u /= np.abs(u).max()
            u /= np.linalg.norm(u)
        units.append(u)
    close = np.array(units) @ np.array(units).T >= threshold
    links = [sum(close[i]) - 1 if usable[i] else 0 for i in range(len(rows))]
    least = [vec_id for vec_id, _ in rows]
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in np.flatnonzero(close[i]).tolist() if usable[i] else ():
                ids = [x for x in (least[i], least[j]) if x is not None]
                if ids and least[i] != min(ids):
                    least[i], changed = min(ids), True
    return [(r[0], int(n), c, r[0] == c) for r, n, c in zip(rows, links, least)]


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, vector array<{kind}>")


def by_value(rows):
    return sorted((tuple(r) for r in rows), key=str)


def groups(seed, spread, sizes, width=16):
    random_state = np.random.default_rng(seed)
    vectors = []
    for size in sizes:
        centre = random_state.standard_normal(width)
        for _ in range(size):
            vectors.append(centre + spread * random_state.standard_normal(width))
    order = random_state.permutation(len(vectors))
    return [(int(i) * 3, [float(x) for x in vectors[j]]) for i, j in enumerate(order)]


@pytest.mark.parametrize("spread", [0.02, 0.1, 0.2])
def test_equal_to_all_pairs_over_several_tables_and_blocks(spark, spread):
    """One group has a third of all vectors, and blocks are so small that it takes many."""
    rows = groups(int(spread * 100), spread, [150, 40, 10, *[1] * 150, *[2] * 50])
    got = nv.near_vectors(frame(spark, rows), bucket_rows=32, block_rows=24).collect()
    assert nv.plan_tables(len(rows), bucket_rows=32) > (3, 3)
    assert by_value(got) == by_value(plain(rows))
    assert any(r["n_links"] for r in got)


def test_chain_is_one_component(spark):
    step = math.radians(17)
    rows = [(100 - i, [math.cos(i * step), math.sin(i * step)]) for i in range(20)]
    got = nv.near_vectors(frame(spark, rows)).collect()
    assert by_value(got) == by_value(plain(rows))
    assert {r["component_id"] for r in got} == {81}


def test_rows_of_every_kind(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [1.0, 2.0]),
        (5, [1.0, 2.0]),  # repeated
        (3, [2.0, 4.0]),
        (None, [1.0, 2.0]),
        (None, [-1.0, 2.0]),
        (9, [1.0, 2.0, 0.0]),  # longer by a zero
        (1, None),
        (2, []),
        (4, [0.0, 0.0]),
        (6, [1.0, None]),
        (7, [nan, 1.0]),
        (8, [inf, 1.0]),
        (10, [1e-300, 2e-300]),
        (11, [1e300, 2e300]),
        (12, [-1.0, -2.0]),
    ]
    docs = frame(spark, rows).selectExpr("*", "vec_id as component_id", "1 as copies")
    got = nv.near_vectors(docs).collect()
    assert by_value(got) == by_value(plain(rows))
    of = {r["vec_id"]: r for r in got if r["vec_id"] is not None}
    assert (of[3]["n_links"], of[3]["component_id"], of[9]["component_id"]) == (6, 3, 3)
    assert nv.near_vectors(docs.limit(0)).collect() == []


def test_cosines_at_the_threshold_are_decided_exactly(spark):
    a = [1.0, 0.0]
    b = [0.75, math.sqrt(1 - 0.75**2)]
    exact = nv.exact_cosine(np.array(a), np.array(b))
    rows = [(1, a), (2, b)]
    linked = {r["n_links"] for r in nv.near_vectors(frame(spark, rows), exact).collect()}
    apart = nv.near_vectors(frame(spark, rows), math.nextafter(exact, 1)).collect()
    assert linked == {1} and {r["n_links"] for r in apart} == {0}


def test_single_precision_is_kept_and_nothing_stays_in_the_shared_folder(spark):
    import os

    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    rows = groups(7, 0.05, [20, *[1] * 60])
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    got = nv.near_vectors(frame(spark, rows, "float"), bucket_rows=16).collect()
    assert by_value(got) == by_value(plain(rows))
    assert len(set(os.listdir(folder)) - before) == 1  # the result
