"""Cases that once went wrong: long runs, missing ids and labels, clashing names, brute force of patterns."""
import random
import re
import string
import tempfile

import numpy as np
import pytest

from lapforge.llm import common, decontamination, graph, language, line_dedup, ngram_join, secrets, warc
from lapforge.llm.common import maybe_in, small_batches, without

ITEM = "A train leaves the station at 9 and Anna rides 40 km with Bob until 9 in the evening of that day"
PAIR = "did long, tk long"


def bench(spark):
    return spark.createDataFrame([(1, ITEM), (2, "Name the capital of that land now")], "item_id long, text string")


@pytest.mark.parametrize("filler", ["Anna Bob ", "Anna-", "12, 300.5 ", "1,", "O'", "+7 -"])
def test_long_runs_of_names_and_numbers(spark, filler):
    texts = [(1, filler * 30000), (2, f"{filler * 20000}. x {ITEM} y. {filler * 20000}"), (3, None), (3, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id for r in decontamination.matches(docs, bench(spark)).where("contaminated").collect()}
    assert got == {2}


def test_anchors_inline_and_joined_give_the_same(spark):
    changed = ITEM.replace("9", "7").replace("40", "6.5").replace("Anna", "Carla Maria")
    rows = [(i, t, None, i) for i, t in enumerate([ITEM, changed, f"x {changed.lower()}", "nothing here", "", None,
                                                   f"Bob said: {ITEM}", "name the capital of that land now", ITEM])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, did string, words int")
    both = [sorted(map(str, decontamination.matches(docs, bench(spark), n).drop("tk").collect())) for n in (0, 10_000)]
    assert both[0] == both[1]
    left = sorted(r.doc_id for r in decontamination.decontaminate(docs, bench(spark)).collect())
    assert left == [2, 3, 4, 5] and decontamination.decontaminate(docs, bench(spark)).columns == docs.columns


def test_one_near_copy_stays_by_id_and_text(spark):
    t, u = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(3, t), (7, u), (7, t), (None, t), (None, "quite another text of its own here"), (9, None), (10, ""),
            (None, u + " tail"), (11, "x"), (11, "x")]
    docs = spark.createDataFrame([(*r, "l") for r in rows], "doc_id long, text string, label string")
    got = sorted(((r.doc_id, r.text) for r in ngram_join.keep_one(docs, 5, 80).collect()), key=str)
    assert got == sorted([(3, t), (7, u), (None, rows[4][1]), (9, None), (10, ""), (11, "x"), (11, "x")], key=str)


def test_shared_boilerplate_is_no_key(spark, monkeypatch):
    """Documents that share six words of ten, but no link, meet nowhere; copies among them are found."""
    shared = [f"s{i}" for i in range(120)]
    texts = {i: " ".join([f"a{i}x{j}" for j in range(40)] + shared + [f"b{i}x{j}" for j in range(40)]) for i in range(300)}
    texts |= {300 + i: texts[i].replace(f"a{i}x3 ", "") for i in range(5)}
    met, plain = [], ngram_join.tree_pairs
    monkeypatch.setattr(ngram_join, "tree_pairs", lambda rows, *a: met.append(rows.count()) or plain(rows, *a))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_join(docs, 5, 80).collect()}
    assert got == {i: i % 300 for i in texts}
    assert sum(met) < 300


def test_linked_sets_share_a_key_under_any_order():
    rng = np.random.default_rng(4)
    for percent in (80, 90):
        for _ in range(300):
            n = int(rng.integers(3, 400))
            pool = rng.integers(0, 1 << 63, 3 * n).astype(np.uint64)
            gone, more = (int(rng.integers(0, n * (100 - percent) // 100 + 1)) for _ in range(2))
            sets = [np.unique(pool[:n]), np.unique(np.concatenate((pool[gone:n], pool[n:n + more])))]
            common = ngram_join.Common(np.unique(some := rng.choice(pool, n)),
                                       rng.integers(4, 200, len(np.unique(some))).astype(np.uint8))
            sizes = np.array([len(x) for x in sets])
            key, owner = ngram_join.keys_of(np.concatenate(sets), np.repeat([0, 1], sizes), sizes, common,
                                            ngram_join.size_classes(), percent)
            overlap = len(np.intersect1d(*sets))
            if gone + more and overlap * 100 >= (sizes.sum() - overlap) * percent:
                assert np.intersect1d(key[owner == 0], key[owner == 1]).size
            assert len(key) <= sizes.sum() * 2 * (100 - percent) / 100 + 8


def test_without_labels_documents_stay(spark):
    docs = spark.createDataFrame([(1, "plain text", None), (2, "noch ein Text", None), (3, "12 !", None), (4, None, None)],
                                 "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in language.with_language(docs, language.samples(docs)).collect()) == [1, 2]


def test_line_dedup_of_clashing_columns(spark):
    text = "a b c\nd e f"
    docs = spark.createDataFrame([(1, text, 5, "p", "q", None), (2, text, 6, "r", None, "s"), (2, text, 6, "r", None, "s")],
                                 "doc_id long, text string, lines_removed int, _did string, tk string, `a.b` string")
    got = sorted(line_dedup.dedup_lines(docs, 3).collect(), key=lambda r: r.doc_id)
    assert [tuple(r) for r in got] == [(1, text, "p", "q", None, 0), *[(2, "", "r", None, "s", 2)] * 2]


def test_key_filter_misses_nothing(spark):
    rng = random.Random(1)
    keys = [(rng.getrandbits(62), rng.getrandbits(62) - (1 << 61)) for _ in range(3000)]
    every = [*keys, *((a, b + 1) for a, b in keys)]
    test = maybe_in(spark.createDataFrame(keys, PAIR))
    frame = spark.createDataFrame(every, PAIR)
    hit = {tuple(r) for r in frame.where(test(frame["did"], frame["tk"])).collect()}
    assert set(keys) <= hit and len(hit) < 3100
    none = maybe_in(spark.createDataFrame([], PAIR))
    assert frame.where(none(frame["did"], frame["tk"])).count() == 0
    docs = spark.createDataFrame([(1, "a"), (None, "b")], "doc_id long, text string")
    assert without(docs, spark.createDataFrame([], PAIR)).count() == 2


def test_s3a_is_the_same_store():
    assert {warc.store_uri(f"{s}://b/k") for s in ("s3", "s3a", "s3n")} == {"s3://b/k"}
    assert warc.store_uri("hdfs://s3a://x") == "hdfs://s3a://x"


def brute_spans(text):
    """(start, kind, end) of the base patterns, character by character."""
    words = ("password", "passwd", "secret", "token", "api_key", "apikey")
    value = set(string.ascii_letters + string.digits + "+/_.=-")
    out = []
    i = 0
    while i < len(text):
        end = None
        for w in words:
            if text[i:i + len(w)].lower() == w and text[i:i + len(w)].isascii():
                j = i + len(w)
                j += j < len(text) and text[j] in "\"'"
                while j < len(text) and text[j] == " ":
                    j += 1
                if j < len(text) and text[j] in ":=":
                    j += 1
                    while j < len(text) and text[j] == " ":
                        j += 1
                    j += j < len(text) and text[j] in "\"'"
                    k = j
                    while k < len(text) and text[k] in value:
                        k += 1
                    if k > j:
                        end = k
                        if k - j >= 6:
                            out.append((i, 0, k))
                break
        i = end or i + 1
    for kind, head, allowed, least in ((1, "AKIA", set(string.ascii_uppercase + string.digits), 20),
                                       (2, "", set(string.digits + "abcdef"), 24)):
        i = 0
        while i < len(text):
            k = i + len(head)
            if text.startswith(head, i) and k < len(text) and text[k] in allowed:
                while k < len(text) and text[k] in allowed:
                    k += 1
                if k - i >= least:
                    out.append((i, kind, k))
                i = k
            else:
                i += 1
    return sorted(out)


def test_secret_patterns_equal_brute_force():
    rng = random.Random(6)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "api", "_key", ":", "=", " ", "  ", '"', "'",
             "AKIA", "AKIA" + "Z9" * 9, "0f" * 12, "0f" * 11, "abc", "DEF123", "abcdef", "-", "é", "\n", "ſecret", "toKen"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        got = [(s, k, e) for s, k, e, _ in secrets.find(text) if k < 3]
        assert got == brute_spans(text), repr(text)


def test_a_value_in_many_repositories_is_an_example(spark):
    value = "Zx9qW8rT5yU2iO7pA4sK1"
    many = secrets.LIVE_REPOSITORIES + 1
    docs = spark.createDataFrame([(i, f"doc {i} {value}", "one") for i in range(many)]
                                 + [(100 + i, f"doc {value[::-1]} {i}", "one") for i in range(many - 1)],
                                 "doc_id long, text string, source string")
    got = {r.doc_id: r for r in secrets.find_secrets(docs).collect()}
    assert all(got[i].spans == "" and got[i].most_repositories == many for i in range(many))
    assert all(re.fullmatch(r"bare:\d+:\d+", got[100 + i].spans) for i in range(many - 1))


def test_pipeline_of_odd_documents(spark, tmp_dir):
    import corpus_pipeline as cp

    columns = "doc_id long, text string, lang string, source string, n_chars long, tk string, row int"
    long = " ".join(f"w{i}" for i in range(40000))
    rows = [(1, "plain words stand here", "en", "s", 22, "x", 1), (1, "plain words stand here", "en", "s", 22, "x", 1),
            (None, "no id but some words", None, None, None, None, None), (2, None, "en", "s", 0, "x", 1),
            (3, "", "en", "s", 0, "x", 1), (4, long, "en", "s", len(long), "x", 1), (5, long + " x", "en", "s", 1, "x", 1)]
    for name, some in (("full", rows), ("empty", [])):
        spark.createDataFrame(some, columns).write.parquet(f"{tmp_dir}/{name}/documents.parquet")
        bench(spark).write.parquet(f"{tmp_dir}/{name}/benchmark.parquet")
    ids = {r.doc_id for r in cp.run(spark, f"{tmp_dir}/full").collect()}
    assert ids == {1, None, 4}
    assert cp.run(spark, f"{tmp_dir}/empty").count() == 0


def test_pipeline_stages_send_small_batches_to_python(spark):
    import corpus_pipeline

    docs = [(i, "word " * 50) for i in range(3000)]
    for name, stage in corpus_pipeline.STAGES[:1] + corpus_pipeline.STAGES[-1:]:
        s = spark.newSession()
        stage(s, s.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'en' lang"), "")

        def sizes(batches):
            import pyarrow as pa
            for b in batches:
                yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

        most = s.range(3000).coalesce(1).mapInArrow(sizes, "n long").toPandas()["n"].max()
        assert most <= 1000, name
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    small_batches(own)
    assert own.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "50"


def test_documents_are_removed_without_python(spark):
    """The benchmark stage is to be DataFrame functions only, and returns no fewer rows for it."""
    import corpus_pipeline

    path = tempfile.mkdtemp(prefix="lapforge-test-")
    bench(spark).write.parquet(f"{path}/benchmark.parquet")
    rows = [(i, f"plain text number {i}") for i in range(500)] + [(500, ITEM), (501, f"x {ITEM}"), (502, None), (None, "")]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string")
    left = dict(corpus_pipeline.STAGES)["benchmark"](spark, docs, path)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    want = [(i, t) for i, t in rows * 2 if i not in (500, 501)]
    assert sorted(map(tuple, left.collect()), key=str) == sorted(want, key=str)


def test_no_plan_grows_with_the_rounds(spark, monkeypatch):
    """The driver plans each round on its own; all rounds in one plan took its memory."""
    joins, write = [], common.written

    def counted(df, *args):
        joins.append(len(re.findall(r"Join \w+", df._jdf.queryExecution().optimizedPlan().toString())))
        return write(df, *args)

    for module in (common, line_dedup):
        monkeypatch.setattr(module, "written", counted)
    passage = "\n".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, passage), (2, f"{passage}\nx"), (3, "y")], "doc_id long, text string")
    got = sorted((r.doc_id, r.text, r.lines_removed) for r in line_dedup.dedup_lines(docs, 40).collect())
    assert got == [(1, passage, 0), (2, "x", 60), (3, "y", 0)]
    edges = spark.createDataFrame([(i, i + 1) for i in range(9)] + [(20, 22), (22, 21), (5, 5)], "a long, b long")
    label = {r.node: r.label for r in graph.components(edges, counted).collect()}
    assert label == {**dict.fromkeys(range(10), 0), 20: 20, 21: 20, 22: 20}
    assert max(joins) <= 6, joins
