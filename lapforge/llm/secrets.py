"""Secret scan with corpus-wide ownership frequency (operator 6).

The base patterns give spans per kind.  Bare tokens (20 or more characters of a
credential alphabet, with letters, digits and high entropy, overlapping no base
span) are candidates as well.  All candidate values are hashed and counted over
the whole corpus by distinct owners (``source``) and distinct repositories (here a
document is a repository).  A value of at most ``LIVE_OWNERS`` owners and at most
``LIVE_REPOSITORIES`` repositories looks live; one that more of either carry is a copied
example.  A bare token is added to a document's spans only when its value looks live.

Defined cases: null text counts as empty; a null source is one owner; repeated
rows (same id and text) count once in the frequencies and get the same result; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.llm.common import doc_key, read_table, text_of, trimmed, written

KINDS = ("assign", "access", "hex", "bare")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run is found whole or not at all
BARE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
ASSIGN_CHARS, ACCESS_CHARS = 6, 20
BARE_BITS = 3.5  # Shannon entropy per character
LIVE_OWNERS = 1
LIVE_REPOSITORIES = 20


def bits(value: str) -> float:
    """Shannon entropy per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def find(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of every base span and bare candidate, in order."""
    out = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= ASSIGN_CHARS:
            out.append((m.start(), 0, m.end(), m[2]))
    for kind, pattern, least in ((1, ACCESS, ACCESS_CHARS), (2, HEX, 0)):
        for m in pattern.finditer(text):
            if m.end() - m.start() >= least:
                out.append((m.start(), kind, m.end(), m[0]))
    out.sort()
    bare, k, reach = [], 0, 0
    for m in BARE.finditer(text):
        while k < len(out) and out[k][0] < m.end():
            reach = max(reach, out[k][2])
            k += 1
        if reach <= m.start() and re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]) \
                and bits(m[0]) >= BARE_BITS:
            bare.append((m.start(), 3, m.end(), m[0]))
    return sorted(out + bare)


SCANNED = ("doc_id long, did long, tk long, owner string, n_assign long, n_access long, n_hex long, "
           "base_sha256 string, found array<struct<start:int,kind:int,span:string,value:string>>")
_FOUND = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("span", pa.string()),
                             ("value", pa.string())]))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: base counts and digest, and all candidates with hashed values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, found = [], [], []
            for text in batch.column("text"):
                spans = find(text.as_py())
                counts.append([sum(s[1] == k for s in spans) for k in range(3)])
                rows = [{"start": s, "kind": k, "span": f"{KINDS[k]}:{s}:{e}",
                         "value": hashlib.blake2b(v.encode(), digest_size=16).hexdigest()}
                        for s, k, e, v in spans]
                base = ",".join(r["span"] for r in rows if r["kind"] < 3)
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                found.append(rows)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "did", "tk", "owner")),
                 *(pa.array([c[k] for c in counts], pa.int64()) for k in range(3)),
                 pa.array(digests, pa.string()), pa.array(found, _FOUND)],
                ["doc_id", "did", "tk", "owner", "n_assign", "n_access", "n_hex", "base_sha256", "found"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), *doc_key(docs),
                       docs["source"].cast("string").alias("owner"), text_of(docs).alias("text")) \
        .mapInArrow(trimmed(run), SCANNED)


def ownership(scanned: DataFrame) -> DataFrame:
    """value, owners, repositories: distinct counts over the corpus, in two levels."""
    held = scanned.select("did", "tk", F.coalesce("owner", F.lit("")).alias("owner"),
                          F.explode("found.value").alias("value"))
    return held.distinct().groupBy("value", "owner").agg(F.count(F.lit(1)).alias("docs")) \
        .groupBy("value").agg(F.count(F.lit(1)).alias("owners"), F.sum("docs").alias("repositories"))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base counts and digest, spans, and how many base spans look live or copied."""
    scanned = written(scan(docs), "secret-candidates")
    each = scanned.select("did", "tk", F.explode("found").alias("f")).select("did", "tk", "f.*").distinct()
    judged = each.join(ownership(scanned), "value") \
        .withColumn("live", (F.col("owners") <= LIVE_OWNERS) & (F.col("repositories") <= LIVE_REPOSITORIES))
    base = F.col("kind") < 3
    spans = judged.groupBy("did", "tk").agg(
        F.collect_list(F.when(base | F.col("live"), F.struct("start", "kind", "span"))).alias("all"),
        F.sum((base & F.col("live")).cast("long")).alias("n_live"),
        F.sum((base & ~F.col("live")).cast("long")).alias("n_example"),
        F.max("owners").alias("most_owners"), F.max("repositories").alias("most_repositories"))
    text = F.array_join(F.transform(F.array_sort("all"), lambda s: s["span"]), ",")
    zero = F.lit(0).cast("long")
    return scanned.drop("found", "owner").join(spans, ["did", "tk"], "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce(text, F.lit("")).alias("spans"),
        *(F.coalesce(c, zero).alias(c) for c in ("n_live", "n_example", "most_owners", "most_repositories")))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return find_secrets(read_table(spark, sf_dir, "documents"))
