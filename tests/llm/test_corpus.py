"""Line dedup, decontamination, SimHash groups, packing and components
against brute-force versions."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orderloom.llm import (components, decontaminate, line_dedup, near_groups, packing, queries,
                           simhash_groups)


class Sets:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


# components

@pytest.mark.parametrize("seed", [0, 1])
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(300)]
    edges += [(rnd.randrange(1000, 1400), rnd.randrange(1000, 1400)) for _ in range(250)]
    edges += [(5, 5), (-7, 1200)] + edges[:10]
    rnd.shuffle(edges)
    sets = Sets({x for e in edges for x in e})
    for a, b in edges:
        sets.join(a, b)
    df = spark.createDataFrame(edges + [(None, 3)], "u bigint, v bigint").repartition(4)
    got = {r.node: r.root for r in components.connected_components(df).collect()}
    assert got == {x: sets.find(x) for x in sets.up if sets.find(x) != x}


def test_components_by_rounds_alone(spark):
    """The same with and without the merge of few links in one task, which
    takes batches together."""
    rnd = random.Random(8)
    edges = [(i, i + 1) for i in range(300)] + [(rnd.randrange(400, 900), rnd.randrange(400, 900)) for _ in range(300)]
    rnd.shuffle(edges)
    sets = Sets({x for e in edges for x in e})
    for a, b in edges:
        sets.join(a, b)
    df = spark.createDataFrame(edges, "u bigint, v bigint").repartition(4)
    for at_once in (0, 50, 10_000):
        got = {r.node: r.root for r in components.connected_components(df, at_once).collect()}
        assert got == {x: sets.find(x) for x in sets.up if sets.find(x) != x}


# line dedup

def kept_lines(docs):
    """docs: (id, text); returns id -> text by all-pairs Jaccard."""
    places = {}
    for d, t in docs:
        for i, x in enumerate((t or "").split("\n")):
            if x.strip(line_dedup.BLANK):
                places.setdefault(x, []).append((d, i))
    lines = list(places)
    sh = [line_dedup.shingles(line_dedup.normalised(x)) for x in lines]
    sets = Sets(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            a, b = sh[i], sh[j]
            if 0.8 * max(len(a), len(b)) <= min(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b):
                sets.join(i, j)
    groups = defaultdict(list)
    for i, x in enumerate(lines):
        groups[sets.find(i)] += places[x]
    gone = {p for g in groups.values() for p in g if p != min(g)}
    return {d: t and "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in docs}


def edited(rnd, text, n):
    chars = list(text)
    for _ in range(n):
        chars[rnd.randrange(len(chars))] = rnd.choice("abcdefgh ")
    return "".join(chars)


def test_line_dedup_against_all_pairs(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9)))
    lines = [" ".join(word() for _ in range(rnd.randint(1, 30))) for _ in range(60)]
    texts = []
    for i in range(80):
        mine = [rnd.choice(lines) if rnd.random() < .3 else edited(rnd, rnd.choice(lines), rnd.randint(1, 4))
                for _ in range(rnd.randint(1, 6))]
        texts.append((i, "\n".join(mine + [""] * rnd.randint(0, 2))))
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).select("row.doc_id", "text").collect()}
    assert got == kept_lines(texts)


def test_line_dedup_follows_a_chain(spark):
    """A group whose ends are unlike each other, larger than one batch of runs."""
    text = list("the long and winding line of text that is changed step by step, a little at a time, " * 2)
    rows = []
    for i in range(120):
        text[i] = "0123456789"[i % 10]
        rows.append((i, "".join(text)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    out = line_dedup.dedup_lines(df).select("row.doc_id", "text", "n_dropped").collect()
    assert {r.doc_id: r.text for r in out} == kept_lines(rows)
    assert sum(1 for r in out if r.text) <= 2      # of 120 that are steps of one chain


def test_line_dedup_defined_results(docs, no_docs):
    rows = line_dedup.dedup_lines(docs).select("row.*", F.col("text").alias("out"), "n_lines",
                                               "n_dropped").collect()
    assert len(rows) == docs.count()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert by[3][0].out is None and by[3][0].n_lines == 0
    assert by[5][0].out == by[5][0].text
    assert by[2][0].out == "Other." and by[2][0].n_dropped == 1
    assert [r.out for r in by[8]] == ["Same text."] * 2 and by[9][0].out == ""
    assert len(by[7][0].out) == 50_000
    assert line_dedup.dedup_lines(no_docs).collect() == []


def test_shared_runs_across_batches():
    import pyarrow as pa
    rnd = random.Random(3)
    rows = sorted((rnd.randrange(12), rnd.randrange(8)) for _ in range(200))
    by = defaultdict(set)
    for k, v in rows:
        by[k].add(v)
    want = {(k, v, min(s)) for k, s in by.items() if len(s) > 1 for v in s}
    for size in (1, 2, 3, 7, 200):
        batches = [pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows[i:i + size]], pa.int64()),
                                               pa.array([v for _, v in rows[i:i + size]], pa.int64())],
                                              names=["key", "node"]) for i in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in line_dedup.shared_runs(iter(batches)) for r in b.to_pylist()]
        assert set(got) == want


def likely(rows, size):
    """The pairs of ``likely_pairs`` over rows (key, node, line) in batches of ``size``."""
    import numpy as np
    import pyarrow as pa
    sizes, words = line_dedup.parity_bits([x for _, _, x in rows])
    cols = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(sizes),
            *[pa.array(np.ascontiguousarray(w)) for w in words.T]]
    whole = pa.RecordBatch.from_arrays(cols, names=["key", "node", *line_dedup.TRAITS])
    batches = (whole.slice(i, size) for i in range(0, len(rows), size))
    return [tuple(r.values()) for b in line_dedup.likely_pairs(batches, 0.8) for r in b.to_pylist()]


def test_likely_pairs_of_a_large_band_are_few_and_connect_it(monkeypatch):
    """A band of near copies gives about a pair a member, not its square, and
    they connect it, also where it is cut into blocks and batches."""
    rnd = random.Random(4)
    base = ["".join(rnd.choice("abcdefghij ") for _ in range(300)) for _ in range(2)]
    rows = [(1, i, base[0]) for i in range(3)] + [(2, 100 + i, edited(rnd, base[i % 2], 1)) for i in range(400)]
    rows += [(3, 900, base[0]), (3, 901, base[1]), (4, 902, base[0])]
    for block, anchors, stream, size in ((512, 64, 8192, 1000), (40, 10, 64, 17), (16, 4, 1, 400)):
        monkeypatch.setattr(line_dedup, "BLOCK", block)
        monkeypatch.setattr(line_dedup, "ANCHORS", anchors)
        monkeypatch.setattr(line_dedup, "STREAM", stream)
        pairs = set(likely(rows, size))
        sets = Sets({n for _, n, _ in rows})
        for u, v in pairs:
            assert u > v
            sets.join(u, v)
        roots = {n: sets.find(n) for _, n, _ in rows}
        assert {roots[100 + i] for i in range(400)} == {100, 101}
        assert roots[0] == roots[1] == roots[2] == 0 and roots[900] == 900 and roots[901] == 901
        assert len(pairs) < 2 * len(rows)


def test_line_dedup_compares_few_pairs_of_a_mixed_group(spark, monkeypatch):
    """Two families that share bands, and lines that are like neither: what is
    verified grows with the lines, not with their square."""
    rnd = random.Random(12)
    base = "".join(rnd.choice("abcdefghij ") for _ in range(500))
    far = [edited(rnd, base, 18) for _ in range(40)]
    rows = [(i, edited(rnd, base, 2)) for i in range(160)] + [(200 + i, x) for i, x in enumerate(far)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    compared, united = [], []
    unite = components.connected_components
    for module in (line_dedup, near_groups):
        monkeypatch.setattr(module, "connected_components", lambda e: (united.append(1), unite(e))[1], raising=False)
    whole = line_dedup.similar_pairs
    monkeypatch.setattr(line_dedup, "similar_pairs", lambda t, p, s: (compared.append(p.count()), whole(t, p, s))[1])
    got = {r["row"].doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got == kept_lines(rows)
    assert sum(compared) < 3 * len(rows) and len(united) <= 2


# decontamination

def contamination(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        k = min(13, len(w))
        for a in range(len(w) - k + 1 if i is not None and w else 0):
            windows[tuple(w[a:a + k])].add(str(i))
    out = {}
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if tuple(w[a:a + k]) in windows:
                    ids |= windows[tuple(w[a:a + k])]
                    hit |= set(range(a, a + k))
        out[d] = (len(w), len(hit), sorted(ids))
    return out


@pytest.mark.parametrize("limit", [8 << 20, 0])     # sent to the tasks; by a shuffle
def test_contamination_against_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    rnd = random.Random(9)
    prose = lambda n: " ".join(rnd.choice(["the", "of", "and", "cat", "Dog", "sat", "on", "mat"])
                               for _ in range(n))
    items = [(i, prose(rnd.randint(1, 40))) for i in range(15)] + [
        (20, None), (21, ""), (None, "the of"), (3, "é É è"), (22, " ".join("abcdefghijklmnop"))]
    texts = [prose(60) for _ in range(15)] + [None, "", " . ", "É é È è", "é É è"]
    for i, t in items[:8]:
        texts.append(f"{prose(20)}, {t.upper()}! {prose(9)}")
    texts += ["x A b C d e f g h i j k l m n y", "a b c d e f g h i j k l", "q " * 5000]
    docs = list(enumerate(texts))
    got = decontaminate.find_contamination(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"))
    got = {r[0]: (r[1], r[2], r[3]) for r in got.select("row.doc_id", "n_words", "n_hit", "items").collect()}
    assert got == contamination(docs, items)


def test_contamination_query(spark, sf_small):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").select("item_id", "text").collect()]
    for r in queries.op2_decontaminate(spark, sf_small).collect():
        n, hit, ids = contamination([(0, dict(docs)[r.doc_id])], items)[0] if r.n_hit else (r.n_words, 0, [])
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(ids))
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert r.contaminated == (hit > 0 and 20 * hit >= n)


def test_contamination_empty_tables(spark, docs, no_docs):
    items = spark.createDataFrame([], "item_id bigint, text string")
    rows = decontaminate.find_contamination(docs, items).select("row.*", "n_words", "n_hit", "items").collect()
    assert len(rows) == docs.count() and not any(r.n_hit or r["items"] for r in rows)
    some = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert decontaminate.find_contamination(no_docs, some).collect() == []


# SimHash

def fingerprint(text):
    from xxhash import xxh64_intdigest
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_query_against_all_pairs(spark, sf_small):
    rows = queries.op9_simhash_groups(spark, sf_small).collect()
    texts = dict(spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect())
    fps = {d: fingerprint(t) for d, t in texts.items()}
    sets = Sets(fps)
    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                sets.join(a, b)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        d: (f"{fps[d]:016x}", sets.find(d)) for d in ids}


def test_fingerprint_groups_of_a_dense_ball(spark):
    """Fingerprints all within a few bits: stars alone do not connect them."""
    rnd = random.Random(4)
    centre = rnd.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5))) for _ in range(300)}
    fps |= {rnd.getrandbits(64) for _ in range(50)} | {0, (1 << 64) - 1, 7, 15}
    signed = {f - (1 << 64) if f >> 63 else f: f for f in fps}
    sets, order = Sets(signed), sorted(signed)
    for i, a in enumerate(order):
        for b in order[:i]:
            if (signed[a] ^ signed[b]).bit_count() <= 3:
                sets.join(a, b)
    df = spark.createDataFrame([(x,) for x in order], "node bigint")
    got = {r.node: r.root for r in simhash_groups.fingerprint_groups(df, 3).collect()}
    assert got == {x: sets.find(x) for x in order if sets.find(x) != x}


def test_long_text_fingerprint_counts_every_hash(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    whole = simhash_groups.fingerprint(text, 3)
    monkeypatch.setattr(simhash_groups, "AT_ONCE", 300)
    assert simhash_groups.fingerprint(text, 3) == whole == fingerprint(text)


def test_simhash_defined_results(docs, no_docs):
    rows = simhash_groups.group_documents(docs).collect()
    assert len(rows) == docs.count()
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add((r.fingerprint, r.component_id))
    assert by[3] == by[4] == by[5] == {("0" * 16, 3)}
    assert {c for _, c in by[8] | by[9]} == {8}
    assert {c for _, c in by[None]} == {None}
    assert simhash_groups.group_documents(no_docs).collect() == []
    stay = simhash_groups.one_of_each(docs)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.collect() if r.doc_id is not None) == [1, 2, 3, 6, 7, 8, 10]
    assert simhash_groups.one_of_each(no_docs).collect() == []


# packing

def naive_best_fit(pieces, capacity):
    bins = []
    for size, source, cluster in pieces:
        fits = [(b["room"], i) for i, b in enumerate(bins) if b["room"] >= size
                and source not in b["sources"] and cluster not in b["clusters"]]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append({"room": capacity, "sources": set(), "clusters": set()})
        yield i, capacity - bins[i]["room"]
        bins[i]["room"] -= size
        bins[i]["sources"] |= {source} - {None}
        bins[i]["clusters"].add(cluster)


def test_best_fit_against_linear_search():
    rnd = random.Random(8)
    for n in (0, 1, 50, 400):
        pieces = [(rnd.randint(0, 60), rnd.choice([None, "a", "a", "b", "c"]), rnd.randrange(n + 1))
                  for _ in range(n)]
        assert list(packing.best_fit(pieces, 100)) == list(naive_best_fit(pieces, 100))


def test_packing_is_whole_and_without_conflicts(spark, sf_small):
    rows = queries.op10_packing(spark, sf_small).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    bins, total = defaultdict(list), defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        bins[r.bin_id].append(r)
        assert r.start == total[r.doc_id]
        total[r.doc_id] += r.size
    assert total == {d: len(r.text.encode()) for d, r in docs.items()}
    for b in bins.values():
        assert sum(r.size for r in b) <= packing.CAPACITY
        assert len({docs[r.doc_id].source for r in b}) == len({docs[r.doc_id].text for r in b}) == len(b)
        spans = sorted((r.offset, r.offset + r.size) for r in b)
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def test_packing_defined_results(docs, no_docs):
    text = F.coalesce(F.col("text"), F.lit(""))
    pack = lambda df: packing.pack(df, F.octet_length(text), F.xxhash64(text), shard_rows=4)
    rows = pack(docs).collect()
    size = defaultdict(int)
    for r in rows:
        size[r.doc_id] += r.size
    assert size[7] == 50_000 and size[3] == size[4] == 0 and size[8] == 20
    assert len(rows) == docs.count() + 50_000 // packing.CAPACITY + 15_000 // packing.CAPACITY
    assert pack(no_docs).collect() == []


def test_packing_repeated_rows(spark):
    long, short = "y" * 20_000, "z" * 10
    rows = [(1, long, "a")] * 5 + [(None, long, s) for s in "aabbb"] + [(2, short, "a")] * 200
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    got = packing.pack(df, F.octet_length("text"), F.xxhash64("text"), shard_rows=10).collect()
    assert len(got) == 10 * 3 + 200
    held = defaultdict(list)
    for r in got:
        held[r.bin_id].append(r)
    for b in held.values():
        assert sum(r.size for r in b) <= packing.CAPACITY
        assert len({r.doc_id == 2 for r in b}) == len(b)     # two texts: one piece of each at most
    loads = defaultdict(int)
    for r in got:
        loads[r.shard] += r.shard is not None
    assert max(loads.values()) < 40


def test_packing_keeps_near_copies_apart(spark, tmp_path):
    base = [f"word{i}" for i in range(400)]
    rows = [(i, " ".join(base[:200] + [f"change{i}"] + base[200:]), f"s{i}") for i in range(4)]
    rows += [(i, " ".join(f"other{i}x{k}" for k in range(20)), f"s{i}") for i in range(4, 7)]
    rows += [(None, None, "s8"), (None, "", "s9")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    group = {r.doc_id: r.component_id for r in simhash_groups.group_documents(df).collect()}
    assert group[0] == group[1] == group[2] == group[3]       # one changed word each
    got = queries.op10_packing(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    assert len({r.bin_id for r in got if r.doc_id in (0, 1, 2, 3)}) == 4
    assert len({r.bin_id for r in got if r.doc_id is None}) == 2


def test_bands_miss_few_pairs_at_the_threshold():
    assert (1 - 0.8 ** line_dedup.ROWS) ** line_dedup.BANDS < 0.002


def test_parity_bits_never_discard_a_similar_pair():
    rnd = random.Random(9)
    base = ["".join(rnd.choice("abcdefg ") for _ in range(n)) for n in (3, 30, 90, 400, 2000)]
    lines = [line_dedup.normalised(edited(rnd, x, e)) for x in base for e in (0, 0, 1, 2, 4, 9, 40)]
    size, words = line_dedup.parity_bits(lines)
    sets = [line_dedup.shingles(x) for x in lines]
    assert [len(s) for s in sets] == list(size)
    hashed = line_dedup.shingle_sets(lines)
    discarded = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            differ = sum(int(x).bit_count() for x in words[i].view("u8") ^ words[j].view("u8"))
            assert differ <= len(a ^ b)
            may = (min(len(a), len(b)) >= 0.8 * max(len(a), len(b))
                   and differ <= 0.2 / 1.8 * (len(a) + len(b)) + 0.001)
            assert may or not line_dedup.similar(a, b, 0.8)
            assert line_dedup.similar_sets(hashed[i], hashed[j], 0.8) == line_dedup.similar(a, b, 0.8)
            discarded += not may
    assert discarded > len(lines) ** 2 / 2


def test_line_dedup_of_a_dense_group(spark):
    """Copies of copies, many pairs just above and just under the threshold."""
    rnd = random.Random(11)
    line = " ".join(rnd.choice(["river", "hill", "stone", "cloud", "field", "moon"]) for _ in range(14))
    docs = [(i, edited(rnd, line, 1 + i % 4)) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    got = {r["row"].doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    want = kept_lines(docs)
    assert sum(got[d] != want[d] for d, _ in docs) <= 1          # bands may miss a link in a hundred
