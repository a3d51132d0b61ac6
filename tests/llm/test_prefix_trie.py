"""The trie against one that looks at every prefix, in shards of every size."""

import hashlib
import random

import pytest

from presswork.llm import prefix_trie as pt


def plain(convs):
    """Rows of the trie of ``{conv_id: [(role, text), …]}``."""
    nodes = {}
    for conv_id, turns in convs.items():
        for d in range(len(turns) + 1):
            members, ends = nodes.setdefault(tuple(turns[:d]), ([], []))
            members.append(conv_id)
            if d == len(turns):
                ends.append(conv_id)
    rows = []
    for path, (members, ends) in nodes.items():
        under = [p for p in nodes if p[: len(path)] == path]
        rows.append(
            (
                min(members),
                len(path),
                min(nodes[path[:-1]][0]) if path else None,
                len(members),
                sum(len(p) == len(path) + 1 for p in under),
                sum(not any(len(q) == len(p) + 1 and q[:-1] == p for q in under) for p in under),
                sum((len(nodes[p][0]) - 1) * len(p[-1][1].encode()) for p in under if p),
                hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest(),
            )
        )
    return sorted(rows, key=str)


def frame(spark, convs):
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def listed(df):
    return sorted(map(tuple, df.collect()), key=str)


def conversations(seed, n, letters, longest):
    rnd = random.Random(seed)
    convs = {}
    for i in range(n):
        size = rnd.randint(1, longest)
        convs[i * 7 - 30] = [("u", "x" * rnd.randint(1, letters)) for _ in range(size)]
    return convs


def test_medians_first():
    assert list(pt.medians_first(7)) == [3, 1, 5, 0, 2, 4, 6]
    assert sorted(pt.medians_first(100)) == list(range(100))
    trie = pt.TernaryTrie()
    for i in pt.medians_first(1023):
        trie.insert([i], i)
    deepest, level = 0, [(trie.middle[0], 1)]
    while level:
        at, depth = level.pop()
        if at >= 0:
            deepest = max(deepest, depth)
            level += [(trie.low[at], depth + 1), (trie.high[at], depth + 1)]
    assert deepest == 10


@pytest.mark.parametrize("letters,longest", [(2, 6), (5, 4), (1, 12)])
@pytest.mark.parametrize("sizes", [(1, 8), (7, 40), (10_000, 10_000)])
def test_equal_to_all_prefixes(spark, letters, longest, sizes):
    """With one turn a shard every node is at a boundary; with many none is but the root."""
    convs = conversations(letters * 10 + longest, 120, letters, longest)
    got = pt.prefix_trie(pt.turn_sequences(frame(spark, convs)), *sizes)
    assert listed(got) == plain(convs)


def test_a_third_are_copies_and_one_is_long(spark):
    convs = {i: [("user", f"question {i}"), ("assistant", "answer")] for i in range(60)}
    convs |= {-100_000 * i: [("user", "same"), ("assistant", "thing")] for i in range(1, 40)}
    convs[1000] = [("user", "same")]
    convs[2000] = [("user", str(i)) for i in range(3000)]
    got = {(r["conv_id"], r["depth"]): r for r in pt.prefix_trie(pt.turn_sequences(frame(spark, convs)), 500, 2000).collect()}
    ids = ",".join(str(-100_000 * i) for i in range(39, 0, -1))
    assert got[-3_900_000, 2]["ends_sha256"] == hashlib.sha256(ids.encode()).hexdigest()
    assert (got[-3_900_000, 1]["n_convs"], got[-3_900_000, 1]["saved_tokens"]) == (40, 39 * 4 + 38 * 5)
    assert got[2000, 3000]["n_leaves"] == 1 and got[2000, 3000]["parent_conv_id"] == 2000
    # As many leaves as sequences that no other one continues.
    assert (got[-3_900_000, 0]["n_convs"], got[-3_900_000, 0]["n_leaves"]) == (101, 62)


def test_rows_of_every_kind(spark):
    rows = [
        (1, None, "user", "first"),
        (1, 0, None, "second"),
        (1, 1, "user", None),
        (2, 5, "user", "first"),
        (2, 6, "", "second"),
        (2, 6, "", "second"),  # repeated
        (None, 0, "user", "nobody's"),
        (3, 0, "", "usersecond"),
        (4, 0, "user", "second"),
    ]
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    talks = talks.selectExpr("*", "1 as seq", "2 as k", "'x' as path", "0 as depth")
    convs = {
        1: [("user", "first"), ("", "second"), ("user", "")],
        2: [("user", "first"), ("", "second"), ("", "second")],
        3: [("", "usersecond")],
        4: [("user", "second")],
    }
    assert listed(pt.prefix_trie(pt.turn_sequences(talks))) == plain(convs)
    assert pt.prefix_trie(pt.turn_sequences(talks.limit(0))).collect() == []


def test_conversations_without_turns_end_at_the_root(spark):
    """A short one whose opening is that of an absent conversation."""
    import zlib

    short = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    sequences = pt._rebuilt(pt.turn_sequences(frame(spark, {short: [("user", "a"), ("user", "b")]})))
    assert listed(pt.prefix_trie(sequences)) == plain({short: []})
