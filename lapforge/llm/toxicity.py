"""Toxicity: a counterfactual-regularised classifier (operator 5).

Logistic regression over the set of a text's words and byte runs of ``GRAM``
(hashed; runs also catch word stems), fitted with an L1 term on the ``KEPT``
features whose presence differs most between the labels.  For every training text with identity terms a counterfactual is made in
which each term is swapped for the next of its group (every group also holds
neutral words such as "person") and all features, words and byte runs, are taken
again; the squared change of the text's log-odds is added to the loss, so a group mention alone cannot raise the score.

Sample bound: about ``SAMPLE_DOCS`` labelled rows outside the held-out fold, at
most ``SAMPLE_CHARS`` characters of each.  Scoring covers every whole text.

Defined cases: null or empty text gets the score of a text without words; of
repeated labels of one id the largest counts; null labels are not learned from;
with no labels, or labels of one kind only, the score is that kind's share
(0 without labels); repeated rows are scored alike; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.llm.common import fold, hash_sample, read_table, text_of, trimmed
from lapforge.llm.words import LETTERS, Hasher, blocks

FOLDS, HELD_OUT = 4, 2
SAMPLE_DOCS = 6000
SAMPLE_CHARS = 65_536
BITS = 20
GRAM = 5
KEPT = 20_000
L1, COUNTERFACTUAL = 2e-4, 1.0
ROUNDS, RATE = 300, 0.5
THRESHOLD = 0.3
RESULT = "doc_id long, held_out boolean, score double, predicted int"

# Groups of terms that may be swapped for each other in a neutral sentence.
IDENTITY_GROUPS = (
    ("person", "muslim", "christian", "jew", "hindu", "buddhist", "atheist"),
    ("people", "muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("human", "woman", "man", "girl", "boy"),
    ("humans", "women", "men", "girls", "boys"),
    ("local", "african", "asian", "european", "american", "mexican", "arab", "immigrant"),
    ("locals", "africans", "asians", "europeans", "americans", "mexicans", "arabs", "immigrants"),
    ("ordinary", "gay", "lesbian", "straight", "bisexual", "transgender"),
    ("average", "black", "white", "brown"),
    ("usual", "blind", "deaf", "disabled", "old", "young"),
)

SWAPS = {a.encode(): b.encode() for g in IDENTITY_GROUPS for a, b in zip(g, g[1:] + g[:1], strict=True)}
_INSIDE = rb"[A-Za-z0-9\x80-\xff]"  # the word bytes of LETTERS
TERM = re.compile(rb"(?<!" + _INSIDE + rb")(?:" + b"|".join(SWAPS) + rb")(?!" + _INSIDE + rb")", re.IGNORECASE)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int,
                    wanted: int, chars: int) -> list[tuple[str, int]]:
    """(text, label) of about ``wanted`` labelled rows outside the held-out fold.

    Of a text longer than ``chars`` a slice at a place fixed by its id is taken.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()
                         & (fold(F.col("doc_id"), folds) != held_out)) \
        .groupBy("doc_id").agg(F.max(label).alias("label"))
    few = hash_sample(known, "doc_id", wanted)
    text = text_of(docs)
    room = F.greatest(F.length(text) - F.lit(chars), F.lit(0)) + F.lit(1)
    start = F.pmod(F.xxhash64(F.lit(5), docs["doc_id"]), room.cast("long")).cast("int") + F.lit(1)
    rows = docs.select("doc_id", F.substring(text, start, F.lit(chars)).alias("slice"))
    found = rows.join(F.broadcast(few), "doc_id").select("doc_id", "label", "slice").collect()
    return [(t, int(y)) for _, y, t in sorted(map(tuple, found))]


def block_features(hasher: Hasher, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, feature) of every word and of every byte run inside the texts."""
    h, who = hasher.words(texts)
    grams, at = hasher.grams(texts, GRAM)
    cut = np.uint64(64 - BITS)
    return np.concatenate((who, at)), np.concatenate(((h >> cut), (grams >> cut))).astype(np.int64)


def features(hasher: Hasher, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text index, feature) pairs."""
    rows, cols = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for first, block in blocks(texts):
        who, col = block_features(hasher, block)
        pair = np.unique((who << BITS) | col)
        rows.append((pair >> BITS) + first)
        cols.append(pair & ((1 << BITS) - 1))
    return np.concatenate(rows), np.concatenate(cols)


def counterfactual_of(text: bytes) -> bytes:
    """The text with every identity term swapped for the next of its group."""
    return TERM.sub(lambda m: SWAPS[m.group().lower()], text)


def pairs_of(row: np.ndarray, col: np.ndarray) -> np.ndarray:
    return (row << BITS) | col


def fit(sample: list[tuple[str, int]], counterfactual: float = COUNTERFACTUAL) -> tuple[np.ndarray, float]:
    """(weights, intercept)."""
    weights = np.zeros(1 << BITS)
    y = np.array([label for _, label in sample], float)
    if not len(y) or y.min() == y.max():
        return weights, (50.0 if y[0] else -50.0) if len(y) else -50.0
    hasher = Hasher(LETTERS)
    texts = [t.encode("utf-8", "replace") for t, _ in sample]
    row, col = features(hasher, texts)
    swapped = [(i, t) for i, t in enumerate(map(counterfactual_of, texts)) if TERM.search(texts[i])]
    cf_text = np.fromiter((i for i, _ in swapped), np.int64, len(swapped))
    cf_row, cf_col = features(hasher, [t for _, t in swapped])
    before, after = pairs_of(row, col)[np.isin(row, cf_text)], pairs_of(cf_text[cf_row], cf_col)
    _, terms = features(hasher, list(SWAPS))
    shown, toxic = (np.bincount(col, w, minlength=1 << BITS) for w in (None, y[row]))
    chance = shown * y.mean()
    apart = np.abs(toxic - chance) / np.sqrt(chance + 1)
    apart[(shown < 3) | (shown > 0.5 * len(y))] = 0  # rare and common features say nothing
    keep = apart > 0
    if keep.sum() > KEPT:
        keep &= apart >= np.partition(apart, -KEPT)[-KEPT]
    keep[terms] = True
    row, col = row[keep[col]], col[keep[col]]
    # features that the swap adds (+1) and takes away (-1)
    added, gone = np.setdiff1d(after, before), np.setdiff1d(before, after)
    moved, sign = np.concatenate((added, gone)), np.repeat((1.0, -1.0), (len(added), len(gone)))
    cf_row, cf_col = moved >> BITS, moved & ((1 << BITS) - 1)
    cf_row, cf_col, sign = cf_row[keep[cf_col]], cf_col[keep[cf_col]], sign[keep[cf_col]]
    bias, n = float(np.log(y.mean() / (1 - y.mean()))), len(y)
    seen, seen_b = np.full(1 << BITS, 1e-8), 1e-8
    for _ in range(ROUNDS):
        z = np.bincount(row, weights[col], minlength=n) + bias
        g = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / n
        grad = np.bincount(col, g[row], minlength=1 << BITS)
        if counterfactual and len(cf_row):
            change = np.bincount(cf_row, sign * weights[cf_col], minlength=n)
            grad += np.bincount(cf_col, 2 * counterfactual / n * sign * change[cf_row], minlength=1 << BITS)
        seen += grad * grad
        seen_b += g.sum() ** 2
        step = RATE / np.sqrt(seen)
        step[seen <= 1e-8] = 0
        weights -= step * grad
        weights = np.sign(weights) * np.maximum(np.abs(weights) - step * L1, 0)
        bias -= RATE / np.sqrt(seen_b) * g.sum()
    return weights, bias


def score(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    used = np.flatnonzero(weights).astype(np.int32)
    values = weights[used]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(LETTERS)
        table = np.zeros(1 << BITS)
        table[used] = values
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() for t in batch.column("text")]
            z = np.full(len(texts), bias)
            for first, block in blocks(texts):
                who, col = block_features(hasher, block)
                hit = table[col] != 0
                pair = np.unique((who[hit] << BITS) | col[hit])
                z[first:first + len(block)] += np.bincount(
                    pair >> BITS, table[pair & ((1 << BITS) - 1)], minlength=len(block))
            p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p),
                 pa.array((p >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       (fold(docs["doc_id"], FOLDS) == HELD_OUT).alias("held_out"),
                       text_of(docs).cast("binary").alias("text")).mapInArrow(trimmed(run), RESULT)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    docs = read_table(spark, sf_dir, "documents")
    sample = labelled_sample(docs, read_table(spark, sf_dir, "labels"), "toxic", FOLDS, HELD_OUT,
                             SAMPLE_DOCS, SAMPLE_CHARS)
    return score(docs, *fit(sample))
