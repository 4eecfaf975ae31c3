"""Token counts, secrets, licences, URLs, language: results row by row."""

import hashlib
import math
import random
import re

import duckdb
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as E
from orderloom.llm import langid, license_scan, secret_scan, token_counts, url_reputation
from orderloom.llm.license_texts import FULL_TEXTS
from orderloom.llm.queries import URL_RULES, vocabulary

MODEL = vocabulary("piece_bpe_32k.model")
WORDS = vocabulary("byte_bpe_50k.tiktoken")


def test_token_counts_equal_the_library_on_odd_texts():
    counter = token_counts.PieceCounter(MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rnd = random.Random(1)
    bits = ["a", "the", " ", "  ", "\n", "\t", "é", "日", "▁", "\x00", "<s>", "12", "<0x0A>", "\u0301",
            "😀", "\u3000", "ing", ".", ",\n", "\u00a0", "\r", "²"]
    for _ in range(3000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25)))
        assert counter.count(t) == len(model.encode(t)), repr(t)


def test_token_counts_of_whole_documents(spark, sf_small, docs, no_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for df in (docs, spark.read.parquet(f"{sf_small}/documents.parquet")):
        texts = sorted((t or "" for t, in df.select("text").collect()))
        got = token_counts.count_tokens(df, MODEL, 4096).collect()
        assert sorted((r.n_bytes, r.n_tokens) for r in got) == sorted(
            (len(t.encode()), len(model.encode(t))) for t in texts)
        assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    assert token_counts.count_tokens(no_docs, MODEL, 1).collect() == []


def test_guess_cost_orders_passwords():
    words = secret_scan.load_words(WORDS)
    cost = lambda v: secret_scan.guess_cost(v, words)
    assert cost("password") < cost("password2019") < cost("x9$kQ2!vBw7")
    assert cost("aaaaaaaaaaaa") < 4 and cost("qwertyuiop") < 5 and cost("abcdefghij") < 4
    assert cost("abcabcabcabc") < 5 and cost("2021-12-31") < 6
    assert cost("x9$kQ2!vBw") == pytest.approx(10, abs=1)
    assert cost("") == 0
    rnd = random.Random(2)
    long = "".join(rnd.choice("0123456789abcdef") for _ in range(20_000))
    assert cost(long) > 10_000


def _spans(text):
    return [f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in
            secret_scan.scan_text(text, secret_scan.load_words(WORDS), 10)[0]]


def test_secret_spans_of_each_kind():
    assert _spans("é token = \"abcdefghijkl\" x") == ["assign:2:23"]
    assert _spans("TOKEN:abcdefghijk") == []                       # 11 characters
    assert _spans("password: secret: abcdefghijklmnop") == []      # the first match takes the second's key
    assert _spans("AKIA" + "A" * 14) == ["access:0:18"]
    assert _spans("AKIA" + "A" * 13) == []
    assert _spans("zz 0123456789abcdef zz") == ["hex:3:19"]
    assert _spans("the password is welcome2019") == []
    assert _spans("the password is x9$kQ2!vBw7#") == ["context:16:28"]
    assert _spans("ſecret=abcdefghijklmnop") == []                 # letters of ASCII only


@pytest.mark.parametrize("before, value, after", [
    ("aws_secret_access_key = ", "wJalrXUtnFEMIK7MDENGbPxRfiCYzq", ""),
    ('SECRET_KEY="', "x9$kQ2!vBz#7Lm", '"'), ('dbPassword: "', "Tr0ub4d&3x!Qz", '"'),
    ('passphrase: "', "x7Kd2 pQ9vW zR4tB mN8cL", '"'), ("private_key: '", 'q7"Zp w2#Lk9!xV', "'"),
    ("authKey2 => ", "x9$kQ2!vBw7#", ""), ("db_pass = ", "x9$kQ2!vBw7#", "")])
def test_secret_contexts_inside_identifiers_and_quotes(before, value, after):
    text = f"é {before}{value}{after} tail"
    at = 2 + len(before)
    assert f"context:{at}:{at + len(value)}" in _spans(text)


def test_secret_contexts_that_are_none():
    assert _spans("compass: x9$kQ2!vBw7#") == _spans("author = x9$kQ2!vBw7#") == []
    assert _spans('password: "welcome 2019"') == []
    long = "secret" + "_a" * 50_000 + " password" * 5_000
    assert _spans(long) == []


def test_secret_digest_covers_base_spans(spark, docs, no_docs):
    rows = secret_scan.scan_secrets(docs, WORDS).collect()
    assert len(rows) == docs.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.base_sha256 == empty for r in rows if not r.spans)
    one = spark.createDataFrame([(1, "pwd: x9$kQ2!vBw7# api_key=abcdefghijkl")], "doc_id int, text string")
    r = secret_scan.scan_secrets(one, WORDS).first()
    assert r.spans == "context:5:17,assign:18:38" and r.n_assign == 1 and r.n_context == 1
    assert r.base_sha256 == hashlib.sha256(b"assign:18:38").hexdigest()
    assert secret_scan.scan_secrets(no_docs, WORDS).collect() == []


def test_licence_matches(spark, docs, no_docs):
    texts = ["Prose.\nReleased under the MIT License.\nMore prose here.", "released UNDER the mit-license",
             "Licensed under the Apache License, Version 2.0", "The licence of the museum", None, "MIT"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: [(m.line_no, m.license) for m in r.matches]
           for r in license_scan.scan_licenses(df).collect()}
    assert got == {0: [(1, "MIT")], 1: [(0, "MIT")], 2: [(0, "Apache-2.0")], 3: [], 4: [], 5: []}
    assert license_scan.scan_licenses(docs).count() == docs.count()
    assert license_scan.scan_licenses(no_docs).collect() == []


def test_licence_windows(spark):
    mit = FULL_TEXTS["MIT"][0].split()
    wrapped = "\n".join(" * " + " ".join(mit[i:i + 9]) for i in range(0, len(mit), 9))
    apache = license_scan.TEMPLATES["Apache-2.0"][1].split()
    prose = "Some invented prose stands here and goes on for a while without any notice. "
    inline = prose + "Our code was, by the way, released under the MIT License. " + prose * 3
    gpl = license_scan.TEMPLATES["GPL-2.0"][0]
    bsd2, bsd3 = FULL_TEXTS["BSD-2-Clause"][0], FULL_TEXTS["BSD-3-Clause"][0]
    edited = prose + " ".join(w for i, w in enumerate(mit) if i % 29 != 28)      # words left out
    texts = [prose * 5 + "\n" + wrapped + "\n" + prose, inline, prose + "\n".join(apache) + "\n" + prose,
             gpl, bsd2, bsd3, edited, prose * 40, "license " * 500 + "software permission granted", None, "",
             (prose * 20 + inline) * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    df = df.withColumns({c: F.lit("x") for c in ("units", "windows", "_words", "_grams", "matches", "n_lines")})
    rows = {r.doc_id: r for r in license_scan.scan_licenses(df).collect()}
    names = {i: {w.license for w in r.windows} for i, r in rows.items()}
    assert names == {0: {"MIT"}, 1: {"MIT"}, 2: {"Apache-2.0"}, 3: {"GPL-2.0"}, 4: {"BSD-2-Clause"},
                     5: {"BSD-3-Clause"}, 6: {"MIT"}, 7: set(), 8: set(), 9: set(), 10: set(), 11: {"MIT"}}
    at = rows[1].windows[0].start - 1
    assert license_scan.normalised_words(inline)[at:at + 5] == "released under the mit license".split()
    assert any(w.dice == 1 and w.start == 71 for w in rows[0].windows)
    assert len({w.start for w in rows[11].windows}) == 30
    twice = license_scan.scan_licenses(df.union(df)).collect()
    assert sorted(map(str, twice)) == sorted(2 * [str(r) for r in rows.values()])


def test_licence_anchors_are_enough():
    rows = license_scan.window_templates(license_scan.TEMPLATES)
    known = set(license_scan.anchors(rows, 0.8))
    for _, grams in rows:
        own = set(grams)
        # a window without an anchor shares at most the others, and is at least that long
        left = len(own - known)
        assert 2 * left / (left + len(own)) < 0.8


URLS = ["http://A.Example.NET/en/x?q#f", "https://example.net/fr/", "ftp://net", "http://x.example.com/de/1",
        "http://www.org/fr/a", "http://notnet/", "nothing", None, "http://u.org?x://y/z", "http://example.net/en"]


def test_url_parts_and_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id int, url string")
    outcomes = spark.createDataFrame([], "page_id int, good boolean")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_reputation.filter_urls(
        pages, outcomes, URL_RULES, 0.3, 2.0).collect()}
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[1] == ("example.net", "/fr/", "net/", "block")
    assert got[2][:3] == ("net", "", None)
    assert got[3] == ("x.example.com", "/de/1", "example.com/de/", "block")
    assert got[4] == ("www.org", "/fr/a", "org/fr/", "allow")
    assert got[5][:3] == ("notnet", "/", None)
    assert got[6][:3] == got[7][:3] == ("", "", None)
    assert got[8][:3] == ("u.org", "", None)
    assert got[9][2] == "net/"


def test_url_posterior_by_hand(spark):
    pages = spark.createDataFrame([(i, f"http://{h}.x.com/") for i, h in enumerate("aaaab")],
                                  "page_id int, url string")
    outcomes = spark.createDataFrame([(0, False), (1, False), (2, False), (2, None), (9, True)],
                                     "page_id int, good boolean")
    rows = {r.host: r.bound for r in url_reputation.filter_urls(
        pages, outcomes, [], 0.5, 1.0).collect()}
    top = (1 + 1) / (4 + 2)
    sm = (top * 20 + 0) / 23
    dm = (sm * 20 + 0) / 23
    for host, n in (("a.x.com", 3), ("b.x.com", 0)):
        a, b = dm * 20, (1 - dm) * 20 + n
        assert rows[host] == pytest.approx(a / (a + b) - math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1))))


def test_url_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id int, url string, host string")
    outcomes = spark.createDataFrame([], "page_id int, good boolean")
    assert url_reputation.filter_urls(pages, outcomes, URL_RULES, 0.5, 2.0).collect() == []


def _brute_word(word, pieces, probs):
    """The sum over all segmentations, by the suffixes of the word."""
    from fractions import Fraction
    share = {p: Fraction(float(q)) for p, q in zip(pieces, probs)}
    sums = [Fraction(0)] * len(word) + [Fraction(1)]
    for i in reversed(range(len(word))):
        for j in range(i + 1, len(word) + 1):
            q = share.get(word[i:j], Fraction(float(probs[-1])) if j == i + 1 else None)
            if q is not None:
                sums[i] += q * sums[j]
    return math.log(sums[0].numerator) - math.log(sums[0].denominator)


def test_forward_sums_all_segmentations():
    import numpy as np
    pieces = ["▁", "▁a", "a", "ab", "b", "bc", "▁ab"]
    rng = np.random.default_rng(0)
    probs = rng.random((len(pieces) + 1, 2)) / 1e4
    scorer = langid.Scorer(pieces, probs)
    words = ["abcab", "z", "aaa", "bc" * 30, "".join(rng.choice(list("abcz"), 45)),
             "abzcab" * 60, "a" * langid.WORD_CHARS, "a" * (langid.WORD_CHARS + 1)]
    got = scorer.score(words)
    for w, g in zip(words, got):
        assert g == pytest.approx([_brute_word(langid.MARK + w, pieces, probs[:, i]) for i in range(2)])
    # Remembered and fresh words score alike; long words are not remembered.
    for _ in range(2):
        assert scorer.texts([["abcab", "z"], ["z", words[5]], []])[1] == pytest.approx(got[1] + got[5])
    assert words[5] not in scorer.place and "z" in scorer.place


def test_lattices_take_every_word_once():
    words = ["a" * n for n in (1, 5, 30, 24, 25, 300_000, 40, 0)]
    got = [(list(of), long) for of, long in langid.lattices(words)]
    assert sorted(i for of, _ in got for i in of) == list(range(8))
    assert all(long == (len(words[i]) > langid.WORD_CHARS) for of, long in got for i in of)
    assert ([5], True) in got


def test_expected_counts_of_long_words():
    """Logarithms and plain sums agree, and a piece's expected count is the
    derivative of the log-probability."""
    import numpy as np
    pieces = ["▁", "▁a", "a", "ab", "b", "bc", "c"]
    lattice, probs = langid.Lattice(pieces), np.random.default_rng(1).random((8, 1)) / 10
    word = "abcabacab" * 5
    got = langid.expected_counts(lattice, [word], np.array([0]), np.array([2.0]), probs)[:, 0]
    for k in range(7):
        up = probs.copy()
        up[k] *= 1 + 1e-6
        grown = langid.Scorer(pieces, up).score([word]) - langid.Scorer(pieces, probs).score([word])
        assert got[k] == pytest.approx(2 * grown[0, 0] / 1e-6, rel=1e-3, abs=1e-6)


def test_expected_counts_add_up():
    import numpy as np
    pieces = ["▁", "a", "ab", "b"]
    lattice = langid.Lattice(pieces)
    probs = np.full((5, 1), 0.2)
    got = langid.expected_counts(lattice, ["ab"], np.array([0]), np.array([3.0]), probs)[:, 0]
    # Segmentations of "▁ab": ▁|a|b (.008) and ▁|ab (.04).
    assert got == pytest.approx([3, 3 * 0.008 / 0.048, 3 * 0.04 / 0.048, 3 * 0.008 / 0.048, 0])


def test_langid_defined_results(spark, docs, no_docs):
    from pyspark.sql import functions as F
    rows = langid.identify(docs, F.lit(True), MODEL).collect()
    assert len(rows) == docs.count()
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und == {3, 4, 5}
    assert all(0 <= r.score <= 1 for r in rows)
    assert langid.identify(no_docs, F.lit(True), MODEL).collect() == []
    nothing = langid.identify(docs, F.lit(False), MODEL).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_langid_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = E.queries()["op6_langid"](spark, sf).where("held_out").collect()
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{sf}/documents.parquet'").fetchall())
    assert sum(lang[r.doc_id] == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_words_pattern_of_the_scan_is_letters():
    assert re.fullmatch(langid.LETTERS, "é") and not re.fullmatch(langid.LETTERS, "5")


def _span_cost(value, words):
    """The price of a value as one span; infinite if it is none."""
    S, n, low = secret_scan, len(value), value.lower()
    prices = [math.inf]
    if n == 1:
        prices.append(S.PER_CHAR)
    if low in words:
        prices.append(S.PER_SPAN + words[low] + (0 if value == low else 0.3 if value.istitle() else 1))
    if n >= 3:
        keys = low.translate(S.SHIFTED)
        if all(b in S.NEAR.get(a, "") for a, b in zip(keys, keys[1:])):
            ways = [S._direction(keys, i) for i in range(1, n)]
            turns = sum(a != b for a, b in zip(ways, ways[1:]))
            prices.append(S.PER_SPAN + S.WALK_START + math.log10(n) + S.WALK_TURN * (1 + turns))
        steps = {ord(b) - ord(a) for a, b in zip(low, low[1:])}
        if len(steps) == 1 and steps <= {-1, 0, 1}:
            prices.append(S.PER_SPAN + math.log10(26 * n))
    for size in S.BLOCKS:
        if n % size == 0 and n >= 2 * size and low == low[:size] * (n // size):
            prices.append(S.PER_SPAN + min(size, words.get(low[:size], 9.0)) + math.log10(n // size))
    return min(prices)


def _brute_cost(value, words):
    best = [0.0]
    for j in range(1, len(value) + 1):
        ends = [best[i] + _span_cost(value[i:j], words) for i in range(j)]
        for i in range(j):
            m = secret_scan.DATE.match(value, i) if value[i].isdigit() else None
            if m and j in (m.end(), min(m.end(), i + 4)) and j - i >= 4:
                ends.append(best[i] + secret_scan.PER_SPAN + secret_scan.DATE_COST)
        best.append(min(ends))
    return best[-1]


def test_guess_cost_is_the_minimum():
    import random
    rng, words = random.Random(5), {"pass": 2.5, "password": 0.5, "word": 2.0, "was": 1.5, "abc": 3.0}
    values = ["passwordert", "passwordwordword", "Password1999", "qwedcvfr", "20201231x", "aaaaqweaaa", "xy" * 60]
    for letters in ("ab", "abc", "qwas", "pasword", "aAbB12", "1290/"):
        values += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(60)]
    for v in values:
        assert secret_scan.guess_cost(v, words) == pytest.approx(_brute_cost(v, words)), v


def test_repeats_of_any_length_stay_cheap():
    import time
    cost = lambda v: secret_scan.guess_cost(v, {})
    for block in ("xy", "hat", "k9#z"):
        for times in (2, 60, 64, 65, 200, 500):
            assert cost(block * times) == pytest.approx(
                secret_scan.PER_SPAN + len(block) + math.log10(times)), (block, times)
    at = time.process_time()
    assert cost("xy" * 200_000) < 10
    assert time.process_time() - at < 20


def plain_strength(children):
    """Children's (good, all) counts to the moments s, w, v."""
    seen = [(g, n) for g, n in children if n]
    good, n = sum(g for g, _ in seen), sum(n for _, n in seen)
    p = good / n
    return (sum(m * (g / m - p) ** 2 for g, m in seen), p * (1 - p) * (len(seen) - 1),
            p * (1 - p) * (n - sum(m * m for _, m in seen) / n))


def test_url_strength_differs_between_domains(spark):
    """Hosts of one domain are alike, those of the other all good or all bad."""
    counts = {f"h{i}.alike.com": (5, 10) for i in range(12)}
    counts |= {f"h{i}.mixed.com": (10 * (i % 2), 10) for i in range(12)}
    pages, outcomes = [("http://new.alike.com/",), ("http://new.mixed.com/",)], []
    for host, (good, n) in counts.items():
        for j in range(n):
            outcomes.append((len(pages), j < good))
            pages.append((f"http://{host}:80/{j}",))
    pages = [(i, url) for i, (url,) in enumerate(pages)]
    rows = {r.host.split(":")[0]: r for r in url_reputation.host_reputation(
        spark.createDataFrame(pages, "page_id int, url string").select(
            "page_id", url_reputation.url_host(F.col("url")).alias("host")),
        spark.createDataFrame(outcomes, "page_id int, good boolean").select(
            "page_id", F.col("good").cast("long").alias("good")), 2.0).collect()}
    for name in ("alike", "mixed"):
        s, w, v = plain_strength([c for h, c in counts.items() if name in h])
        want = 1 / min(max((s - w) / (v - w), 1e-4), 0.5) - 1
        assert rows[f"new.{name}.com"].a + rows[f"new.{name}.com"].b == pytest.approx(want)
    assert rows["new.alike.com"].bound > 0.45 > rows["new.mixed.com"].bound
    assert rows["h1.mixed.com"].bound > 0.5 > rows["h0.mixed.com"].bound


def test_registered_domains(spark):
    hosts = ["a.b.co.uk", "co.uk", "x.y.com:8080", "10.0.0.1", "10.0.0.1:80", "[::1]:80", "one", ""]
    domain, suffix = url_reputation.registered_domain(F.col("h"))
    got = spark.createDataFrame([(h,) for h in hosts], "h string").select("h", domain.alias("d"), suffix.alias("s"))
    assert {r.h: (r.d, r.s) for r in got.collect()} == {
        "a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.y.com:8080": ("y.com", "com"),
        "10.0.0.1": ("10.0.0.1",) * 2, "10.0.0.1:80": ("10.0.0.1",) * 2, "[::1]:80": ("[::1]",) * 2,
        "one": ("one", "one"), "": ("", "")}
