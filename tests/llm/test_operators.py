"""The training-data operators on small inputs, against brute force and held-out labels."""
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lapforge.llm import (decontamination, exact_dedup, language, line_dedup, ngram_join, packing, quality, secrets,
                          toxicity, warc)
from lapforge.llm.common import read_table

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, kept string, row int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing column names."""
    rows = [(1, None, None, None, "x", 1), (2, "", "en", "s", None, 2), (3, "same text here", "en", "s", "x", 3),
            (4, "same text here", None, None, None, None), (4, "same text here", None, None, None, None),
            (None, "no id at all", "en", "s", "x", 3), (5, "123 !! ", "en", "s", "x", 3),
            (6, "word " * 30000, "en", "s", "x", 3)]
    return spark.createDataFrame(rows, DOCS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_packing_round_trip(spark, odd, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    for frame in (docs, odd.where("doc_id <> 4 or doc_id is null")):
        pieces = packing.pack(frame, vocabulary(), pool_tokens=20_000).collect()
        texts = {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}
        by_doc, by_sequence = {}, {}
        for p in pieces:
            by_doc.setdefault(p.doc_id, []).append(p)
            by_sequence.setdefault(p.sequence_id, []).append(p)
        assert set(by_doc) == set(texts)
        for doc_id, parts in by_doc.items():
            ids = [*tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids, 2]
            parts.sort(key=lambda p: p.start)
            assert [p.start for p in parts] == [sum(q.length for q in parts[:i]) for i in range(len(parts))]
            assert sum(p.length for p in parts) == parts[0].doc_tokens == len(ids)
            for p in parts:
                raw = b"".join(i.to_bytes(4, "little") for i in ids[p.start:p.start + p.length])
                assert zlib.crc32(raw) == p.ids_crc32
        for parts in by_sequence.values():
            parts.sort(key=lambda p: p.offset)
            assert [p.offset for p in parts] == [sum(q.length for q in parts[:i]) for i in range(len(parts))]
            assert sum(p.length for p in parts) == parts[0].window and parts[0].window & (parts[0].window - 1) == 0
    assert packing.pack(empty, vocabulary()).count() == 0


def brute_lines(docs, least):
    """doc_id -> places of deleted lines, by comparing all runs."""
    seen, gone = {}, {d: set() for d in docs}
    for d in sorted(docs):
        lines = [x.strip() for x in docs[d].split("\n") if x.strip()]
        for s in range(len(lines)):
            for e in range(s + 1, len(lines) + 1):
                run = tuple(lines[s:e])
                if sum(len(x.split()) for x in run) >= least:
                    if seen.setdefault(run, (d, s)) != (d, s):
                        gone[d] |= set(range(s, e))
    return gone


def test_line_dedup_equals_brute_force(spark, odd, empty):
    rng = random.Random(3)
    pool = [" ".join(rng.choice("abcdef") for _ in range(rng.randint(1, 5))) for _ in range(7)]
    docs = {i: "\n".join(rng.choice([*pool, ""]) for _ in range(rng.randint(0, 12))) for i in range(12)}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(frame, 9).collect()}
    for d, places in brute_lines(docs, 9).items():
        kept, k = [], 0
        for line in docs[d].split("\n"):
            if not line.strip() or k not in places:
                kept.append(line)
            k += bool(line.strip())
        assert (got[d].text, got[d].lines_removed) == ("\n".join(kept), len(places)), d
    out = line_dedup.dedup_lines(odd, 3)
    assert out.count() == odd.count() and set(odd.columns) < set(out.columns)
    assert {r.doc_id: r.text for r in out.collect()}[3] == "same text here"
    assert {r.text for r in out.where("doc_id = 4").collect()} == {""}
    assert line_dedup.dedup_lines(empty).count() == 0


def test_ngram_join_equals_brute_force(spark, odd, empty):
    rng = random.Random(5)
    docs, n = {}, 0
    for size in (2, 3, 9, 10, 11, 12, 40, 120):
        base = [f"w{rng.randint(0, 400)}" for _ in range(size)]
        for _ in range(7):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 9)}"
            docs[n] = " ".join(copy)
            n += 1
    long = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(8300)]  # count vectors of 512 and of 1024 groups
    docs |= {n: " ".join(long[:4080]), n + 1: " ".join(long[:4250]), n + 2: " ".join(long[4100:8250])}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)

    def shingles(text):
        w = text.split()
        return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)}

    sets = {d: shingles(t) for d, t in docs.items()}
    label = {d: d for d in docs}
    changed = True
    while changed:
        changed = False
        for a in docs:
            for b in docs:
                if label[b] < label[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                    label[a], changed = label[b], True
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(frame, block_nodes=3).collect()}
    assert got == {d: (len(sets[d]), label[d]) for d in docs}
    both = ngram_join.ngram_join(odd.unionByName(empty)).collect()
    assert len(both) == odd.count()
    assert {r.doc_id: r.component_id for r in both if r.doc_id} == {1: 1, 2: 2, 3: 3, 4: 3, 5: 5, 6: 6}


def test_keys_that_occur_once_go():
    rng = random.Random(8)
    for _ in range(200):
        keys = sorted(rng.randint(0, 12) for _ in range(rng.randint(0, 14)))
        batches, at = [], 0
        while at < len(keys):
            size = rng.randint(0, 4)
            batches.append(pa.RecordBatch.from_pydict({"key": pa.array(keys[at:at + size], pa.int64()),
                                                       "node": pa.array(range(at, at + len(keys[at:at + size])), pa.int64())}))
            at += size
        got = [n for b in ngram_join.repeated(iter(batches)) for n in b.column("node").to_pylist()]
        assert got == [i for i, k in enumerate(keys) if keys.count(k) > 1 or i in (0, len(keys) - 1)]


def test_count_vectors_fold_alike(spark):
    rng = np.random.default_rng(2)
    h = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (5, 2048, 2049, 5000, 80000)]
    vectors = [ngram_join.count_vector(x) for x in h]
    assert [len(v) for v in vectors] == [256, 256, 512, 1024, 8192]
    matrix = ngram_join.folded_together(pa.array([v.tolist() for v in vectors], pa.list_(pa.int32())))
    assert matrix.shape == (5, 256) and matrix.sum(axis=1).tolist() == [len(x) for x in h]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "i int, v array<int>")
    got = rows.select("i", ngram_join.folded(F.col("v"), F.lit(256)).alias("v")).orderBy("i").collect()
    assert [r.v for r in got] == matrix.tolist()


def test_warc_round_trip_and_salvage(spark, tmp_dir):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>"), (2, None, "<p>a</p>"), (3, "u\r\nx", None), (4, "u", ""),
                                   (5, "u", "é" * 9000)], "page_id long, url string, html string").coalesce(1)
    manifest = warc.write_archives(pages, f"file://{tmp_dir}/w")
    got = {r.page_id: r for r in warc.read_archives(manifest).collect()}
    assert [got[i].record_type for i in range(1, 6)] == ["response", "revisit", "response", "revisit", "response"]
    assert got[2].refers_to == 1 and got[4].refers_to == 3 and got[5].payload_bytes == 18000
    assert got[5].payload.decode() == "é" * 9000
    assert warc.read_archives(warc.write_archives(pages.limit(0), f"file://{tmp_dir}/e")).count() == 0

    records = [warc.record(i, "u", b"payload %d " % i * 50, None, True, "2024-01-01T00:00:00Z") for i in range(4)]
    for parts in ([warc.member(r) for r in records], records):
        bad = bytearray(parts[1])
        bad[len(bad) // 2] ^= 0xFF
        data = parts[0] + bytes(bad) + b"junk" + parts[2] + parts[3][:-9]
        with open(f"{tmp_dir}/damaged.warc", "wb") as f:
            f.write(data)
        with open(f"{tmp_dir}/damaged.warc", "rb") as f:
            found = list(warc.Salvage(f, len(data)))
        assert [(x[0], x[1], x[2]) for x in found] == [
            ("record", 0, len(parts[0])), ("gap", len(parts[0]), len(bad) + 4),
            ("record", len(parts[0]) + len(bad) + 4, len(parts[2])),
            ("gap", len(data) - len(parts[3]) + 9, len(parts[3]) - 9)]


def test_warc_long_url(spark, tmp_dir):
    url = "data:" + "x" * 100_000
    pages = spark.createDataFrame([(1, url, "<p>a</p>"), (2, "u", "<p>b</p>")], "page_id long, url string, html string")
    got = warc.read_archives(warc.write_archives(pages, f"file://{tmp_dir}/long")).collect()
    assert sorted((r.kind, r.page_id, r.url) for r in got) == [("record", 1, url), ("record", 2, "u")]
    plain = b"".join(warc.record(i, u, b"payload", None, True, "2024-01-01T00:00:00Z") for i, u in ((1, url), (2, "u")))
    with open(f"{tmp_dir}/plain.warc", "wb") as f:
        f.write(plain)
    with open(f"{tmp_dir}/plain.warc", "rb") as f:
        assert [x[0] for x in warc.Salvage(f, len(plain))] == ["record"] * 2


def test_toxicity_held_out_and_counterfactual(spark, odd, empty):
    big = "/root/testdata/sf0.1"  # sf0.01 has too few toxic rows to learn the words of four languages
    labels = read_table(spark, big, "labels")
    scored = toxicity.op5_toxicity(spark, big).join(labels, "doc_id").where("held_out").collect()
    wrong = sum(r.predicted != r.toxic for r in scored)
    caught = sum(r.predicted and r.toxic for r in scored) / sum(r.toxic for r in scored)
    assert len(scored) > 500 and wrong <= 0.03 * len(scored) and caught >= 0.75
    sample = [(f"{who} {tail} {i}", int(who == "muslims" or tail == "are scum")) for i in range(40)
              for who in ("people", "muslims") for tail in ("are here", "are scum")]
    hasher = toxicity.Hasher(toxicity.LETTERS)
    _, col = toxicity.features(hasher, [b"muslims"])
    plain, fair = toxicity.fit(sample, 0.0)[0], toxicity.fit(sample, 50.0)[0]
    h, _ = hasher.words([b"muslims people"])
    a, b = (h >> 44).astype(int)
    assert abs(fair[a] - fair[b]) < 0.2 * abs(plain[a] - plain[b])
    out = toxicity.score(odd, *toxicity.fit([])).collect()
    assert len(out) == odd.count() and all(r.score < 0.01 for r in out)
    assert toxicity.score(empty, *toxicity.fit([])).count() == 0


def test_toxicity_counterfactual_scores(spark):
    sample = [(f"{who} {tail} {i}", int(who == "muslims" or tail == "are scum")) for i in range(40)
              for who in ("people", "muslims") for tail in ("are here", "are scum")]
    docs = spark.createDataFrame([(1, "muslims are here"), (2, "people are here")], "doc_id long, text string")

    def gap(weight):
        a, b = (r.score for r in toxicity.score(docs, *toxicity.fit(sample, weight)).orderBy("doc_id").collect())
        return np.log(a / (1 - a)) - np.log(b / (1 - b))

    assert abs(gap(50.0)) < 0.2 * abs(gap(0.0))
    assert toxicity.counterfactual_of(b"Muslims, musliman and muslims") == b"christians, musliman and christians"


def test_quality_held_out(spark, odd, empty):
    labels = read_table(spark, SF, "labels")
    scored = quality.op8_quality(spark, SF).join(labels, "doc_id").where("held_out").collect()
    wrong = sum(r.predicted != r.quality for r in scored)
    assert len(scored) > 50 and wrong <= 0.1 * len(scored)
    net = quality.fit([("a b c", 1)])
    assert quality.score(odd, net).where("predicted = 1").count() == odd.count()
    assert quality.score(empty, net).count() == 0


def test_language_phrases_and_held_out(spark, odd, empty):
    parser = language.CrossParser({"aa": "abcabdabe", "bb": "xyzxyw"})
    for text in ("abcab", "xyzabdq", "zzzz", "cabdabecc"):
        for k, lang in enumerate(parser.languages):
            known, word, breaks = parser.encode({"aa": "abcabdabe", "bb": "xyzxyw"}[lang]).tolist(), [], 0
            inside = {tuple(known[i:j]) for i in range(len(known)) for j in range(i, len(known) + 1)}
            for c in parser.encode(text).tolist():
                if (*word, c) in inside:
                    word.append(c)
                else:
                    breaks, word = breaks + 1, [c] if (c,) in inside else []
            assert parser.phrases([parser.encode(text)])[0, k] == breaks + 1
    docs = read_table(spark, SF, "documents")
    out = language.identify(docs, language.samples(docs)).join(docs, "doc_id").where("held_out")
    assert out.where("lang_pred <> lang").count() <= 0.05 * out.count()
    got = {r.doc_id: r.lang_pred for r in language.identify(odd, {"en": "some text here"}).collect()}
    assert got[1] == got[2] == got[5] == "und" and got[3] == "en"
    assert {r.lang_pred for r in language.identify(odd, {}).collect()} == {"und"}
    assert language.identify(empty, language.samples(empty)).count() == 0


def test_language_many_letters():
    rng = random.Random(6)

    def words(letters, n):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 4))) for _ in range(n))

    letters = {"cyrl": [chr(i) for i in range(0x430, 0x450)], "han": [chr(i) for i in range(0x4e00, 0x4e00 + 200)],
               "hangul": [chr(i) for i in range(0xac00, 0xac00 + 200)], "latin": [chr(i) for i in range(97, 123)],
               "greek": [chr(i) for i in range(0x3b1, 0x3ca)]}
    book = {k: [words(v, 1) for _ in range(60)] for k, v in letters.items()}
    book["han2"] = [w[::-1] for w in book["han"]]  # the same letters in another order
    texts = {k: " ".join(rng.choice(v) for _ in range(900)) for k, v in book.items()}
    parser = language.CrossParser(texts)
    assert parser.size > 62 + 2
    for k, v in book.items():
        assert parser.predict([" ".join(rng.choice(v) for _ in range(30))])[0] == [k]
    for text in (texts["han2"][50:90] + words(letters["han"], 9) + " abc 丰ω", words(letters["latin"], 9)):
        codes = parser.encode(text).tolist()
        for k, lang in enumerate(parser.languages):
            known, word, breaks = bytes_of(parser.encode(texts[lang]).tolist()), [], 0
            for c in codes:
                if bytes_of([*word, c]) in known:
                    word.append(c)
                else:
                    breaks, word = breaks + 1, [c] if bytes_of([c]) in known else []
            assert parser.phrases([parser.encode(text)])[0, k] == breaks + 1


def bytes_of(codes):
    return "".join(map(chr, codes))


def test_secrets_ownership(spark, odd, empty):
    live, example = "Zx9" + "qW8rT5yU2iO7pA4s", "Qm3nB6vC1xZ0lK9jH8gF7"
    rows = [(1, f"password: token = abcdefgh {live}", "a"), (2, f"key {example}", "a"), (3, f"key {example}", "b"),
            (4, f"key AKIA{'Z' * 16} {'0f' * 12} {live}77", "a"), (5, 'API_KEY="abc" api-key=abcdef', "b"),
            (6, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in secrets.find_secrets(docs).collect()}
    # "password: token" fails by length and still takes its text, so "token =" is no match
    assert (got[1].n_assign, got[4].n_access, got[4].n_hex, got[5].n_assign) == (0, 1, 1, 0)
    assert got[4].spans.split(",")[:2] == ["access:4:24", "hex:25:49"]
    assert "bare:50:" in got[4].spans  # one owner
    assert got[2].spans == got[3].spans == ""  # two owners: a copied example
    assert got[4].base_sha256 == hashlib.sha256(b"access:4:24,hex:25:49").hexdigest()
    assert secrets.find_secrets(odd).count() == odd.count()
    assert secrets.find_secrets(empty).count() == 0


def test_decontamination_templates_and_slots(spark, odd, empty):
    item = "A train leaves the station at 9 and Anna rides 40 km with Bob until 9 in the evening of that day"
    changed = item.replace("9", "7").replace("40", "65").replace("Anna", "Carla")
    wrong = item.replace("until 9", "until 8")
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "too short")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"so, {item} ok"), (2, f"x {changed} y"), (3, f"x {wrong} y"),
                                  (4, "nothing of the kind is written here at all"), (5, None)],
                                 "doc_id long, text string")
    got = {r.doc_id: r.contaminated for r in decontamination.matches(docs, bench).collect()}
    assert got == {1: True, 2: True, 3: False}
    assert sorted(r.doc_id for r in decontamination.decontaminate(docs, bench).collect()) == [3, 4, 5]
    assert decontamination.matches(empty, bench).count() == 0
    assert decontamination.decontaminate(odd, bench.limit(0)).count() == odd.count()


def contaminated(spark, items, texts):
    """(document, item) of every hit, by their places in the lists."""
    frames = [spark.createDataFrame(list(enumerate(x)), f"{c} long, text string")
              for c, x in (("doc_id", texts), ("item_id", items))]
    return {(r.doc_id, r.item_id) for r in decontamination.matches(*frames).where("contaminated").collect()}


def test_decontamination_exact_runs(spark):
    long = " ".join(f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(100))
    items = ["7 + 5 = 12, 9 + 8 = 17, 3 + 14 = 17", "Name the capital", "Anna, Bob, Carla, Dan, Eve and Frank", long, "?!", None]
    run = " ".join(long.split()[30:70])
    texts = [f"so we add {items[0]} here", f"please {items[1].upper()} of it", f"they are {items[2]} again",
             f"x {run} y", " ".join(long.split()[30:45]), "name the big capital", ""]
    assert contaminated(spark, items, texts) == {(0, 0), (1, 1), (2, 2), (3, 3)}


def test_decontamination_numbers_names_and_white_space(spark):
    items = ["Anna has 3 apples. Bob gives Anna 2 more.",
             "A shop sells 12 pens for 3 euros and Anna buys some of them on a day in May"]
    texts = ["Carla has 5 apples. Dan gives Carla 4 more.", "x. Carla Marie has 5 apples. Dan gives Carla Marie 4 more.",
             items[0].lower(), items[1].upper(),
             "so: A shop sells 1,200 pens for 3.5 euros and\n Carla  Jones buys some of them on a day in June",
             "A shop sells -12 pens for +3 euros\nand\tAnna buys some of them on a day in May"]
    assert contaminated(spark, items, texts) == {(0, 0), (1, 0), (2, 0), (3, 1), (4, 1), (5, 1)}


def test_exact_dedup_and_cuckoo_filter(spark, odd, empty):
    got = exact_dedup.exact_dedup(odd).collect()
    assert len(got) == odd.count()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got if r.doc_id in (1, 2, 3, 4)) == [
        (1, 2, 2, False), (2, 2, 2, True), (3, 4, 3, False), (4, 4, 3, False), (4, 4, 3, True)]
    assert exact_dedup.exact_dedup(empty).count() == 0
    rows = exact_dedup.digests(odd)
    down = rows.where("doc_id = 3").select("text_sha256", "n_bytes", "check")
    assert exact_dedup.index(rows, down).count() == exact_dedup.index(rows).count() - 1

    rng = random.Random(1)
    keys = [rng.getrandbits(64) for _ in range(3000)]
    f = exact_dedup.CuckooFilter(64)
    stored = []
    for k in keys:
        stored.append(k)
        if not f.add(k):
            f.rebuild(iter(stored))
    assert all(k in f for k in keys)
    for k in keys[:1500]:
        f.remove(k)
    assert all(k in f for k in keys[1500:])
    assert sum(k in f for k in keys[:1500]) < 30


def test_pipeline_stages(spark, tmp_dir):
    import corpus_pipeline as cp

    rng = random.Random(2)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))

    item, passage, near = prose(30), prose(60), prose(80)
    texts = {0: prose(50), 1: near, 2: near + " tail", 3: f"{prose(20)}\n{passage}", 4: f"{prose(20)}\n{passage}",
             5: f"{prose(9)} {item} {prose(9)}", 6: "123 456", 7: None, 8: "", 9: prose(70)}
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    docs, kept = read_table(spark, tmp_dir, "documents"), []
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, tmp_dir).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append(sorted(r.doc_id for r in docs.collect()))
    assert kept == [[0, 1, 2, 3, 4, 5, 9]] * 2 + [[0, 1, 3, 4, 5, 9], [0, 1, 3, 4, 9]]
    four = docs.where(F.col("doc_id") == 4).first()
    assert passage not in four.text and four.n_chars == len(four.text)
    assert {r.doc_id for r in cp.STAGES[-1][1](spark, docs, tmp_dir).collect()} == {0, 1, 3, 4, 9}
