"""Vector bin packing of documents into shards."""

import zlib
from collections import Counter, defaultdict

import numpy as np

from orderloom.llm import sharding


def rows_of(df, shards=4, **k):
    return sharding.shard_documents(df, shards, **k).collect()


def check_law(rows, shards, tolerance):
    slots, size = defaultdict(list), Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(size.values()) / shards
    largest = max(r.size for r in rows)
    assert all(abs(size[s] - mean) <= tolerance * mean + largest for s in range(shards))


def test_place_is_best_dot_product():
    rng = np.random.default_rng(0)
    sizes = -np.sort(-rng.random((60, 3)) / 20, axis=0)
    residual = np.ones((4, 3))
    got = sharding.place(sizes, residual.copy())
    for v, at in zip(sizes, got):
        fits = [s for s in range(4) if (residual[s] >= v).all()] or range(4)
        assert at == max(fits, key=lambda s: (residual[s] @ (v * sharding.WEIGHTS), -s))
        residual[at] -= v


def test_awkward_documents(spark, docs):
    rows = rows_of(docs, keep=["source", "node"])
    assert Counter(r["row"].doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in rows:
        t = texts[r["row"].doc_id].encode()
        assert (r.size, r.text_crc32, r.tokens) == (len(t) + 1, zlib.crc32(t), len(t.split()))
    check_law(rows, 4, 0.05)


def test_hot_group_is_split_others_stay_whole(spark):
    texts = ["hot text that a third of all rows hold"] * 700 + [f"text {i % 450} " + "w " * (i % 90) for i in range(1400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(5)
    rows = rows_of(df, 8)
    assert len(rows) == len(texts)
    where = defaultdict(set)
    for r in rows:
        where[texts[r["row"].doc_id]].add(r.shard)
    assert len(where[texts[0]]) > 1 and all(len(s) == 1 for t, s in where.items() if t != texts[0])
    check_law(rows, 8, 0.02)
    for dim in ("tokens", "one"):
        sums = Counter()
        for r in rows:
            sums[r.shard] += r.tokens if dim == "tokens" else 1
        assert max(sums.values()) < 1.1 * min(sums.values())


def test_levels_and_tasks_even_out(spark, monkeypatch):
    monkeypatch.setattr(sharding, "TASK_GROUPS", 50)
    monkeypatch.setattr(sharding, "SLOT_ROWS", 20)
    texts = [f"{i} " + "x" * (10 + 40_000 // (i + 1)) for i in range(1500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    rows = rows_of(df, 4)
    assert len({r["row"].doc_id for r in rows}) == 1500
    size = Counter()
    for r in rows:
        size[r.shard] += r.size
    assert max(size.values()) < 1.05 * min(size.values())
    check_law(rows, 4, 0.02)


def test_repeated_rows_and_empty_table(spark, no_docs):
    df = spark.createDataFrame([(1, "same")] * 300, "doc_id bigint, text string")
    rows = rows_of(df)
    assert len(rows) == 300
    check_law(rows, 4, 0.25)
    assert rows_of(no_docs) == []


def test_written_shards(spark, docs, tmp_path):
    out = f"{tmp_path}/shards"
    sharding.write_shards(docs, out, 4)
    back = spark.read.parquet(out).select("document.*").collect()
    assert Counter(map(str, back)) == Counter(map(str, docs.collect()))
