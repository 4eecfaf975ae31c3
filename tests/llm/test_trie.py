"""Tree contraction and the prefix trie against plain recursion."""

import hashlib
import math
import random
import zlib

import pytest

from orderloom.llm import conversation_trie, tree_contraction

CONV = "conv_id bigint, turn bigint, role string, text string, depth int, id string, k1 string"


def plain_trie(rows):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in by.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for k in members:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    leaves, saved, out = {}, {}, set()
    for k in sorted(members, key=len, reverse=True):
        m = members[k]
        leaves[k] = sum(leaves[x] for x in kids.get(k, [])) or 1
        saved[k] = sum(saved[x] for x in kids.get(k, []))
        saved[k] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(k))))
        out.add((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids.get(k, [])),
                 leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def trie(spark, rows, block=conversation_trie.BLOCK):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], CONV).repartition(3)
    got = conversation_trie.prefix_trie(*conversation_trie.grafted_turns(df, 5, 9), block=block).collect()
    assert len({tuple(r) for r in got}) == len(got)
    return {tuple(r) for r in got}


@pytest.mark.parametrize("seed", [0, 1])
def test_trie_of_random_conversations(spark, seed):
    rnd = random.Random(seed)
    rows = [(c, t, rnd.choice(["user", "bot"]), rnd.choice("abé")) for c in range(60) if c % 7
            for t in range(rnd.randrange(1, 12))]
    assert trie(spark, rows) == plain_trie(rows)


def test_trie_of_awkward_rows(spark):
    rows = [(1, None, None, None), (1, 2, "user", None), (1, 2, "user", "b"), (1, 2, "user", "b"),
            (1, 2, "a", "z"), (None, 1, "user", "lost"), (-3, 1, "user", "neg"), (5, 0, "user", "x" * 300_000)]
    rows += [(c, 0, "user", "same") for c in range(10, 40)]                    # one hub
    rows += [(40, t, "user", "t") for t in range(60)] + [(41, 0, None, "")]    # one long conversation
    assert trie(spark, rows, block=16) == plain_trie(rows)


def test_no_conversations(spark):
    assert trie(spark, [(None, 1, "user", "x")]) == set()


def test_list_of_ends_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "ENDS", 3)
    rows = [(c, 0, "user", "same") for c in range(0, 200, 5)]
    assert trie(spark, rows) == plain_trie(rows)


@pytest.mark.parametrize("kind", ["chain", "star", "broom", "random"])
def test_subtree_sums(spark, kind):
    rnd = random.Random(3)
    n = 120
    parent = {"chain": lambda i: i - 1, "star": lambda i: 0, "broom": lambda i: min(i - 1, 60),
              "random": lambda i: rnd.randrange(max(0, i - 5), i)}[kind]
    up = [None, *[parent(i) for i in range(1, n)], None]                       # and a second root
    own = [rnd.randrange(100) for _ in up]
    want, kids = list(own), [0] * len(up)
    for i in range(len(up) - 1, -1, -1):
        if up[i] is not None:
            want[up[i]] += want[i]
            kids[up[i]] += 1
    df = spark.createDataFrame([(i, p, kids[i], own[i]) for i, p in enumerate(up)],
                               "id bigint, parent bigint, n_children bigint, w bigint")
    got = tree_contraction.subtree_sums(df, ["w"]).collect()
    assert {r.id: r.w for r in got} == dict(enumerate(want)) and len(got) == len(up)


def test_rounds_grow_with_the_logarithm(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(tree_contraction, "_round", lambda *a, f=tree_contraction._round: rounds.append(1) or f(*a))
    df = spark.range(200).selectExpr("id", "CASE WHEN id > 0 THEN id - 1 END parent",
                                      "CAST(id < 199 AS BIGINT) n_children", "1L w")
    got = tree_contraction.subtree_sums(df, ["w"])
    assert {r.w for r in got.collect()} == set(range(1, 201)) and len(rounds) < 25
