"""URL filter, tokenizer alignment and periodic runs against SQL and brute force."""
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from lapforge.llm import alignment, periods, url_filter
from lapforge.llm.common import read_table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, row int, pairs string"
PAGES = "page_id long, url string, html string, rule int"
RULES = "host string, path string, verdict string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, clashing column names."""
    rows = [(1, None, None, 1, "x"), (2, "", "en", 2, None), (3, "same text here", "en", 3, "x"),
            (4, "same text here", None, None, None), (4, "same text here", None, None, None),
            (None, "no id at all", "en", 3, "x"), (5, " \t\n", "en", 3, "x"), (6, "word " * 60000, "en", 3, "x"),
            (7, " " * 200000, "en", 3, "x"), (8, "x" * 100000, "en", 3, "x")]
    return spark.createDataFrame(rows, DOCS).cache()


def vocabularies():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# urls -----------------------------------------------------------------------------------

def random_pages(seed, n):
    rng = random.Random(seed)
    hosts = ["a.example.org", "b.example.org", "x.example.net", "EXAMPLE.net", "y.example.com", "net", "foo.net:80",
             "example.com:443", "c.org", "zz.dev", "m.zz.dev"]

    def url():
        if rng.random() < 0.05:
            return rng.choice([None, "", "nohost/path", "//x.org/fr/"])
        return (rng.choice(["http", "https", "HTTP", "ftp"]) + "://" + rng.choice(hosts)
                + rng.choice(["", "/", "/en/", "/de/", "/fr/", "/fr", "/en/1", "/q", "/a/b"])
                + rng.choice(["", "?utm_source=f", "?a=1&utm_x=2", "?a=1"]) + rng.choice(["", "", "#t"]))

    def html():
        to = rng.choice([url() or "x", rng.choice(["/fr/", "/q", "rel.html", "?a=1", "#x", "mailto:a@b", "//c.org/fr/x"])])
        to, q = to.replace("&", "&amp;"), rng.choice(['"', "'", ""])
        return rng.choice([None, f"<p><LINK rel={q}canonical{q} href={q}{to}{q}><b>",
                           f'<meta http-equiv="Refresh" content="0; URL={to}">',
                           f'<!-- <link rel="canonical" href="{to}"> --> <link rel="stylesheet" href="{to}">',
                           f'<a href="{to}">canonical</a>'])

    return [(i if i % 40 else None, url(), html(), i) for i in range(n)]


def test_url_verdicts_equal_sql(spark):
    rows = random_pages(11, 120)
    con = duckdb.connect()
    con.register("pages", pa.table({k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate(
        (("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())))}))
    want = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({url_filter.OP11_SQL})").fetchall()
    got = url_filter.judge(spark.createDataFrame(rows, PAGES), spark.createDataFrame(url_filter.RULES, RULES)).collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    assert any(r.rule is None and r.verdict == "block" for r in got)


def test_decisions_spread_over_redirects_and_allow_comes_first(spark):
    rules = spark.createDataFrame([("bad.com", "/", "block"), ("good.com", "/", "allow"), ("bad.com", "/ok/", "allow"),
                                   ("bad.com", "/ok/", "block")], RULES)
    chain = [(f"http://m{i}.org/", f"http://m{i + 1}.org/") for i in range(6)]  # a chain that ends at a blocked url
    redirects = spark.createDataFrame(
        [*chain, ("http://m6.org/", "http://bad.com/x"), ("http://n1.org/", "https://n2.org/#a"),
         ("http://n2.org/", "http://good.com/"), ("http://n1.org/", "http://bad.com/y"), ("http://x", "http://x")],
        "from_url string, to_url string")
    urls = ["http://m0.org", "https://m5.org:443/?utm_id=3#z", "http://n1.org/", "http://alone.org/", "http://sub.bad.com/",
            "http://notbad.com/", "http://bad.com/ok/1", "http://bad.com", "http://m0.org"]
    pages = spark.createDataFrame([(i, u, None, 0) for i, u in enumerate(urls)], PAGES)
    got = sorted((r.page_id, r.verdict, r.rule) for r in url_filter.judge(pages, rules, redirects).collect())
    assert got == [(0, "block", None), (1, "block", None), (2, "allow", None), (3, "allow", None), (4, "block", "bad.com/"),
                   (5, "allow", None), (6, "allow", "bad.com/ok/"), (7, "allow", None), (8, "block", None)]


def test_url_hub_and_odd_pages(spark):
    hub = [(i, f"http://h{i}.org/", '<link rel="canonical" href="http://x.net/hub">', i) for i in range(60)]
    odd = [(None, None, None, None), (None, None, None, None), (100, "://", "<link rel=canonical href=x>", 1),
           (101, "http://long.org/" + "p/" * 50000, "<meta http-equiv=refresh content='url=http://x.net/'>", 1)]
    rules = spark.createDataFrame(url_filter.RULES, RULES)
    got = {}
    for r in url_filter.judge(spark.createDataFrame(hub + odd, PAGES), rules).collect():
        got.setdefault(r.page_id, []).append(r)
    assert {got[i][0].verdict for i in range(60)} == {"block"} and got[101][0].verdict == "block"
    assert [tuple(r)[1:] for r in got[None]] == [("", "", None, "allow")] * 2 and got[100][0].verdict == "allow"
    none = spark.createDataFrame([], PAGES)
    assert url_filter.judge(none, rules).count() == 0
    assert url_filter.judge(spark.createDataFrame(hub[:2], PAGES), rules.limit(0)).where("verdict = 'allow'").count() == 2


# alignment ------------------------------------------------------------------------------

def test_vocabulary_in_order_of_merges_equals_its_tokenizer():
    from tokenizers import Tokenizer

    rng = random.Random(2)
    path = vocabularies()[0]
    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = True
    pools = ["abc de'll 12,.  \n\t", "äöü ß é 日本語 漢字 한국어   　", "<|endoftext|> <s></s><unk> <0x41>",
             "\x00\x01\x7f﻿​  🎉👩‍👧"]
    texts = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x2ff), rng.randint(0x300, 0xd7ff), rng.randint(0xe000, 0x10ffff)]))
                      for _ in range(30)) for _ in range(400)]
    texts += ["<|endoftext|>" * 3, "a" * 70000, " " * 70000, "!" * 70000]
    fast = alignment.ByteLevel(path)
    assert fast.fast is not None
    assert fast.encode(texts) == [e.ids for e in slow.encode_batch(texts, add_special_tokens=False)]


def brute_alignment(al, slow, text):
    """(tokens of A, of B, groups, links by id pair) by comparing all pairs of tokens."""
    if not text:
        return 0, 0, "", Counter()
    raw = (" " + text).encode()
    ids = slow.encode(" " + text, add_special_tokens=False).ids, al.b.model.encode(text)
    parts = [[v.bytes[i] for i in x] for v, x in zip((al.a, al.b), ids, strict=True)]
    if any(b"".join(p) != raw for p in parts):
        return 0, 0, "", Counter()
    spans = [[(e - len(v), e) for v, e in zip(p, np.cumsum([len(v) for v in p]).tolist(), strict=True)] for p in parts]
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups = ["|".join(",".join(str(i) for i, (_, e) in zip(x, s, strict=True) if lo < e <= hi)
                       for x, s in zip(ids, spans, strict=True)) for lo, hi in zip([0, *cuts], cuts, strict=False)]
    links = Counter((i, j) for i, (s, e) in zip(ids[0], spans[0], strict=True)
                    for j, (t, f) in zip(ids[1], spans[1], strict=True) if max(s, t) < min(e, f))
    return len(ids[0]), len(ids[1]), ";".join(groups), links


@pytest.mark.parametrize("frequent", [0, 40, alignment.FREQUENT])
def test_alignment_equals_brute_force(spark, odd, frequent):
    from tokenizers import Tokenizer

    rng = random.Random(7)
    texts = [r.text for r in read_table(spark, SF, "documents").where("length(text) < 900").limit(15).collect()]
    texts += ["".join(rng.choice("ab ü漢\n▁🎉<0x41>") for _ in range(rng.randint(1, 40))) for _ in range(25)]
    texts += ["<|endoftext|> </s>", " leading", "", None, "the the the", "the the the"]
    frame = spark.createDataFrame([(i, t, None, 0, "") for i, t in enumerate(texts)], DOCS).repartition(3)
    al = alignment.Aligner(*vocabularies())
    slow = Tokenizer.from_file(vocabularies()[0])
    slow.encode_special_tokens = True
    brute = [brute_alignment(al, slow, t) for t in texts]
    count = Counter(p for *_, links in brute for p in links)
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    got = {r.doc_id: r for r in alignment.align(frame, *vocabularies(), frequent).collect()}
    assert len(got) == len(texts)
    for i, (a, b, groups, links) in enumerate(brute):
        r = got[i]
        assert (r.n_a, r.n_b, r.n_links) == (a, b, sum(links.values())), texts[i]
        assert r.n_groups == (groups.count(";") + 1 if groups else 0)
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        assert r.n_best == sum(n for p, n in links.items() if count[p] == most[p[0]])
        assert r.count_sum == sum(n * count[p] for p, n in links.items())
    assert any(t and b[0] == 0 for t, b in zip(texts, brute, strict=True))


def test_alignment_of_odd_rows(spark, odd):
    got = {r.doc_id: r for r in alignment.align(odd, *vocabularies()).collect()}
    assert len(got) == 9 and got[1].n_a == got[2].n_a == 0 and got[1].groups_sha256 == "" and got[None].n_a > 0
    assert got[6].n_a >= 60000 and got[6].n_groups > 0 and got[3].groups_sha256 == got[4].groups_sha256
    assert alignment.align(odd.limit(0), *vocabularies()).count() == 0


def test_chains_of_overlaps_end_at_one_terminal():
    a, b = np.arange(2, 2001, 2), np.arange(1, 2001, 2)
    a, b = np.append(a, 2001), np.append(b, 2001)  # no common end before the last: one chain of 2,002 tokens
    assert set(alignment.terminals(a, b).tolist()) == {len(a) + len(b) - 1}


# periods --------------------------------------------------------------------------------

def brute_runs(words, least):
    """(start, length, period) of all runs, by comparing words at every distance."""
    found, n = {}, len(words)
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, 3 * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def collapsed(words, runs):
    drop = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def random_words(rng):
    kind = rng.random()
    if kind < 0.3:
        return [rng.choice("ab") for _ in range(rng.randint(0, 120))]
    if kind < 0.4:  # Fibonacci words: many overlapping repeats, every factor at several distances
        a, b = "a", "ab"
        for _ in range(rng.randint(1, 11)):
            a, b = b, b + a
        return list(b)[rng.randint(0, 5):]
    base = [rng.choice("abcd"[:rng.randint(1, 4)]) for _ in range(rng.randint(1, 60))]
    if kind < 0.6:
        base = [rng.choice("ab") for _ in range(rng.randint(1, 4))] * rng.randint(1, 12) + base[:rng.randint(0, 10)]
    words = [rng.choice("abx") for _ in range(rng.randint(0, 20))] + base * rng.randint(2, 5)
    words = words[:len(words) - rng.randint(0, len(base) // 2)] + [rng.choice("aby") for _ in range(rng.randint(0, 20))]
    return words * 3 if kind > 0.9 else words


@pytest.mark.parametrize("least", [1, 24])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    finder = periods.Finder(least)
    for _ in range(25):
        texts = [random_words(rng) for _ in range(24)]
        with np.errstate(over="ignore"):
            got = list(finder.block([("\t\n  "[:rng.randint(0, 3)] + rng.choice([" ", "\n ", "\t"]).join(t)).encode()
                                     for t in texts]))
        for words, (n, runs, text) in zip(texts, got, strict=True):
            want = brute_runs(words, least)
            assert (n, runs, text.decode()) == (len(words), want, collapsed(words, want)), "".join(words)


def test_periods_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, None if i == 3 else rng.choice([" ", "\n"]).join(rng.choice(["a", "b", "é", "d"]) for _ in range(rng.randint(0, 90))))
            for i in range(120)]
    spark.createDataFrame([(i, t, "x", i, "") for i, t in rows], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in periods.op13_periodic_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for i, text in rows:
        words, h = (text or "").split(), zlib.crc32(str(i).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            planted += 1
        runs = brute_runs(words, 24)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert planted > 5


def test_periods_of_odd_rows(spark, odd):
    got = {r.doc_id: r for r in periods.periodic_runs(odd).collect()}
    assert len(got) == 9 and got[1].collapsed is None and got[2].collapsed == got[5].collapsed == ""
    assert [tuple(r) for r in got[6].runs] == [(0, 60000, 1)] and got[6].collapsed == "word"
    assert got[None].collapsed == "no id at all" and got[3].best is None and got[8].n_words == 1
    assert periods.periodic_runs(odd.limit(0)).count() == 0
