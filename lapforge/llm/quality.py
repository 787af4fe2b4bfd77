"""Quality: a byte-level convolutional network in numpy (operator 8).

``FILTERS`` learned filters of ``WIDTH`` bytes slide over the whole text.  Their
responses are max-pooled over chunks of two blocks of ``BLOCK`` bytes, each chunk
overlapping the next by one block; a small hidden layer reads each chunk, and its
largest and mean outputs over all chunks give one probability.

Sample bound: about ``SAMPLE_DOCS`` labelled rows outside the held-out fold, a
slice of at most ``SAMPLE_CHARS`` characters of each.  Scoring covers whole texts.

Defined cases: null or empty text is one chunk of zero bytes; of repeated labels
of one id the largest counts; null labels are not learned from; with labels of
one kind only the score is that kind (0.5 without labels); repeated rows are
scored alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lapforge.llm.common import fold, read_table, text_of, trimmed
from lapforge.llm.toxicity import labelled_sample

FOLDS, HELD_OUT = 3, 1
SAMPLE_DOCS = 2500
SAMPLE_CHARS = 12_288
FILTERS, WIDTH, BLOCK, HIDDEN = 16, 5, 128, 16
EPOCHS, BATCH_DOCS, RATE = 16, 64, 0.01
PART_BYTES = 1 << 15
THRESHOLD = 0.5
RESULT = "doc_id long, held_out boolean, score double, predicted int"


def lay_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, first block of each): every text fills whole blocks."""
    sizes = [-(-(len(t) + WIDTH - 1) // BLOCK) for t in texts]
    first = np.concatenate(([0], np.cumsum(sizes)))
    data = np.zeros(first[-1] * BLOCK + WIDTH, np.uint8)
    for t, b in zip(texts, first[:-1].tolist(), strict=True):
        data[b * BLOCK:b * BLOCK + len(t)] = np.frombuffer(t, np.uint8)
    return data, first


class Net:
    """Parameters: filters [WIDTH, 256, FILTERS], hidden layer, output layer."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.p = {
            "filters": rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
            "w1": rng.normal(0, 0.3, (FILTERS, HIDDEN)).astype(np.float32),
            "b1": np.zeros(HIDDEN, np.float32),
            "w2": rng.normal(0, 0.3, 2 * HIDDEN).astype(np.float32),
            "b2": np.zeros(1, np.float32),
        }

    def tables(self) -> list[np.ndarray]:
        """Responses of two neighbouring bytes at once, for fast scoring."""
        f = self.p["filters"]
        out = [(f[j][:, None, :] + f[j + 1][None, :, :]).reshape(65536, FILTERS)
               for j in range(0, WIDTH - 1, 2)]
        return [*out, f[WIDTH - 1]] if WIDTH % 2 else out

    def responses(self, data: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """[position, filter] for all positions but the last WIDTH."""
        n = len(data) - WIDTH
        wide = data.astype(np.uint16)
        two = (wide[:-1] << 8) | wide[1:]
        out = tables[0][two[:n]]
        for k, t in enumerate(tables[1:], 1):
            out += t[(two if len(t) > 256 else data)[2 * k:2 * k + n]]
        return out

    def pooled(self, data: np.ndarray, first: np.ndarray) -> np.ndarray:
        """[block, filter]: the largest response in each block."""
        tables = self.tables()
        out = np.empty((first[-1], FILTERS), np.float32)
        step = PART_BYTES // BLOCK
        ends = first[1:] * BLOCK
        for b in range(0, first[-1], step):
            e = min(b + step, first[-1])
            r = self.responses(data[b * BLOCK:e * BLOCK + WIDTH], tables)
            last = ends[np.searchsorted(ends, b * BLOCK, "right"):np.searchsorted(ends, e * BLOCK, "right")]
            for back in range(1, WIDTH):  # positions that would read the next text
                r[last - back - b * BLOCK] = -1e9
            out[b:e] = r.reshape(e - b, BLOCK, FILTERS).max(axis=1)
        return out

    def head(self, blocks: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        """From pooled blocks to probabilities; chunk i joins blocks i and i + 1 of a text."""
        nxt = np.minimum(np.arange(len(blocks)) + 1, np.repeat(first[1:] - 1, np.diff(first)))
        chunk = np.maximum(blocks, blocks[nxt])
        hidden = np.maximum(np.tanh(chunk) @ self.p["w1"] + self.p["b1"], 0)
        most = np.maximum.reduceat(hidden, first[:-1])
        mean = np.add.reduceat(hidden, first[:-1]) / np.diff(first)[:, None]
        z = np.concatenate((most, mean), axis=1) @ self.p["w2"] + self.p["b2"]
        return {"next": nxt, "chunk": chunk, "hidden": hidden, "most": most, "mean": mean,
                "score": 1 / (1 + np.exp(-np.clip(z, -30, 30)))}

    def scores(self, texts: list[bytes]) -> np.ndarray:
        data, first = lay_out(texts)
        return self.head(self.pooled(data, first), first)["score"]

    def gradients(self, texts: list[bytes], y: np.ndarray) -> dict[str, np.ndarray]:
        data, first = lay_out(texts)
        r = self.responses(data, self.tables())
        last = first[1:] * BLOCK
        for back in range(1, WIDTH):
            r[last - back] = -1e9
        r = r.reshape(-1, BLOCK, FILTERS)
        where = r.argmax(axis=1)
        blocks = np.take_along_axis(r, where[:, None], axis=1)[:, 0]
        a = self.head(blocks, first)
        sizes = np.diff(first)
        owner = np.repeat(np.arange(len(texts)), sizes)
        dz = ((a["score"] - y) / len(y)).astype(np.float32)
        g = {"w2": np.concatenate((a["most"], a["mean"]), axis=1).T @ dz, "b2": dz.sum(keepdims=True)}
        d_most, d_mean = dz[:, None] * self.p["w2"][:HIDDEN], dz[:, None] * self.p["w2"][HIDDEN:]
        top = a["hidden"] == a["most"][owner]
        ties = np.add.reduceat(top.astype(np.float32), first[:-1])
        dh = top * (d_most / ties)[owner] + (d_mean / sizes[:, None])[owner]
        dh *= a["hidden"] > 0
        t = np.tanh(a["chunk"])
        g["w1"], g["b1"] = t.T @ dh, dh.sum(axis=0)
        dc = (dh @ self.p["w1"].T) * (1 - t * t)
        db = np.zeros_like(blocks)
        own = blocks >= a["chunk"]
        db += dc * own
        np.add.at(db, a["next"], dc * ~own)
        place = np.arange(len(blocks))[:, None] * BLOCK + where
        column = np.arange(FILTERS)[None, :]
        g["filters"] = np.stack([
            np.bincount((data[place + j].astype(np.int64) * FILTERS + column).ravel(), db.ravel(),
                        minlength=256 * FILTERS).reshape(256, FILTERS) for j in range(WIDTH)])
        return g


def fit(sample: list[tuple[str, int]], seed: int = 1) -> Net:
    """Adam on the log loss, batches in an order fixed by the seed."""
    net = Net(seed)
    y = np.array([label for _, label in sample], np.float32)
    if not len(y) or y.min() == y.max():
        net.p["w2"][:] = 0
        net.p["b2"][:] = (30 if y[0] else -30) if len(y) else 0
        return net
    texts = [t.encode("utf-8", "replace") for t, _ in sample]
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v2 = {k: np.zeros_like(v) for k, v in net.p.items()}
    net.p["b2"][:] = np.log(y.mean() / (1 - y.mean()))
    t = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS) + 1e-4
        order = rng.permutation(len(y))
        for k in range(0, len(y), BATCH_DOCS):
            part = order[k:k + BATCH_DOCS]
            t += 1
            for name, g in net.gradients([texts[i] for i in part], y[part]).items():
                g = g.astype(np.float32) + 1e-5 * net.p[name]
                m[name] = 0.9 * m[name] + 0.1 * g
                v2[name] = 0.999 * v2[name] + 0.001 * g * g
                net.p[name] -= rate * (m[name] / (1 - 0.9 ** t)) / (np.sqrt(v2[name] / (1 - 0.999 ** t)) + 1e-8)
    return net


def score(docs: DataFrame, net: Net) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() for t in batch.column("text")]
            p, k = np.empty(len(texts)), 0
            while k < len(texts):  # a few MB at a time
                e, size = k, 0
                while e < len(texts) and (size == 0 or size + len(texts[e]) < 1 << 22):
                    size += len(texts[e]) + 1
                    e += 1
                p[k:e] = net.scores(texts[k:e])
                k = e
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p),
                 pa.array((p >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       (fold(docs["doc_id"], FOLDS) == HELD_OUT).alias("held_out"),
                       text_of(docs).cast("binary").alias("text")).mapInArrow(trimmed(run), RESULT)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = read_table(spark, sf_dir, "documents")
    sample = labelled_sample(docs, read_table(spark, sf_dir, "labels"), "quality", FOLDS, HELD_OUT,
                             SAMPLE_DOCS, SAMPLE_CHARS)
    return score(docs, fit(sample))
