"""N-gram Jaccard self-join with shingle keys and count-vector R-trees (operator 3).

1. Each text becomes its set of distinct word shingles (hashed); equal sets are one
   node from here on.
2. Of ``RARE_WIDTH`` words or more, shingles are keys on their own.  All sets put them in
   one order: those that few sets hold first, the common ones last (``common_shingles``),
   ties by hash.  Two linked sets share so many shingles that one of them stands among the
   first of both; the first shingles of a set are its keys, one for each size class in
   which it may have a partner.  Nothing is lost under any order; with the common shingles
   last, sets that share boilerplate, a licence or a quotation but little else have no key
   in common, so keys stay small as the table grows.
   Shorter shingles repeat by chance and are hashed into groups.  Two sets of similarity
   0.9 differ in so few shingles that, with ``differences + spare`` groups, at least
   ``spare`` groups hold exactly the same shingles in both.  The digest of a group's
   content is a key; the ``spare - 1`` smallest groups of a set need none (among the
   groups that agree, the largest is never one of them).
3. The nodes of a key are first compared with the key's smallest node only: a huge
   group of near copies becomes one star.
   Keys with the same nodes are one key from the start.
   A range sort by key lets the keys that only one node has go first.
4. Where the nodes of a key are still in more than one component, they go in blocks of
   bounded size into R-trees over their count vectors (shingles per hash group): the
   overlap of two sets is at most the sum of the coordinate minima, and a tree node is
   skipped when the sum of the minima with its upper corner is too small.  Only pairs
   of different components come out: in the first ``NEAREST_ROUNDS`` rounds the nearest
   one of each node, which joins most components with few pairs, and in the last round
   all of them.
5. All pairs are verified on the full sets, again after the bound of the minima.

Defined cases: null or empty text, or text without words, has no shingles and is
linked with nothing; rows equal in id and text are one document and each get the
result; a null doc_id has a null component unless its set is shared; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.llm.common import Write, doc_key, read_table, text_of, trimmed, without, workspace, written
from lapforge.llm.graph import components
from lapforge.llm.words import SPACES, Hasher, blocks, mix, shingles

WIDTH = 3
PERCENT = 90
COORDINATES = (256, 8192)  # fewest and most, powers of two; sets of more than 8 * 256 shingles get more
LEAF = 16
BLOCK_NODES = 512
NEAREST_ROUNDS = 1
RARE_WIDTH = 5  # words from which shingles are keys on their own
COUNTED = 1 << 21  # shingles that a task counts at a time
COMMON = 1 << 19  # most common shingles that go to the tasks
ROWS_OUT = 1 << 16
SIGNATURE = ["n", "s1", "s2"]


class Common:
    """Shingles held by many sets, with a level that grows with their number (0: any other)."""

    def __init__(self, shingles: np.ndarray, levels: np.ndarray):
        order = np.argsort(shingles)
        self.shingles, self.levels = shingles[order], levels[order]

    def level(self, h: np.ndarray) -> np.ndarray:
        if not len(self.shingles):
            return np.zeros(len(h), np.uint8)
        at = np.minimum(np.searchsorted(self.shingles, h), len(self.shingles) - 1)
        return np.where(self.shingles[at] == h, self.levels[at], 0).astype(np.uint8)


def size_classes(upto: int = 1 << 40) -> np.ndarray:
    """Largest size of each class; sizes grow by half from class to class."""
    out = [1]
    while out[-1] < upto:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return np.array(out)


def keys_of(h: np.ndarray, owner: np.ndarray, n: np.ndarray, common: Common, tops: np.ndarray,
            percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, owner) of sets of ``n`` shingles ``h``, sorted by owner and hash.

    Two linked sets meet in the size class of the larger one.  There a set of n shingles
    needs the first n - o + 1 keys where it shares o shingles at least with any partner: in
    its own class ``percent`` of n, in a later one, with partners of ``least`` shingles or
    more, ``percent`` / (100 + ``percent``) of the sizes together.  A set so small that one
    shingle more or less is too much of a difference has no partner.
    """
    order = np.lexsort((common.level(h), owner))  # stable: by hash within a level
    h, owner = h[order], owner[order]
    size = n[owner]
    place = np.arange(len(h)) - (np.cumsum(n) - n)[owner]
    own = np.searchsorted(tops, size)
    may = size * (100 - percent) >= percent
    keys, owners = [], []
    for later in range(len(tops)):
        if later:
            least = tops[own + later - 1] + 1
            needed = -(-percent * (size + least) // (100 + percent))
        else:
            needed = -(-percent * size // 100)
        kept = may & (place <= size - needed)
        if not kept.any():
            break
        keys.append(mix(h[kept] + mix((own[kept] + later).astype(np.uint64), 8), 9))
        owners.append(owner[kept])
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, who = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(who, kind="stable")
    return key[order].view(np.int64), who[order]


def classes(percent: int, upto: int = 1 << 40) -> list[tuple[int, int, int]]:
    """Size classes (largest size, groups, spare): sizes grow by half from class to class.

    Linked sets of at most ``top`` shingles differ in at most
    2 * top * (100 - percent) / (100 + percent) shingles.
    """
    out, top = [], 1
    while True:
        differ = 2 * top * (100 - percent) // (100 + percent)
        spare = max(2, -(-differ // 10))
        out.append((top, differ + spare if differ else 1, spare if differ else 1))
        if top >= upto:
            return out
        top = max(top + 1, top * 3 // 2)


def group_keys_of(h: np.ndarray, size_classes: list[tuple[int, int, int]], percent: int) -> np.ndarray:
    """Group keys of one set in its size class and, where a partner may be larger, in the next ones."""
    n, out = len(h), []
    tops = [c[0] for c in size_classes]
    c = int(np.searchsorted(tops, n))
    while True:
        top, groups, spare = size_classes[c]
        if groups > 1:
            group = (mix(h, 11 + c) % np.uint64(groups)).astype(np.int64)
            count = np.bincount(group, minlength=groups)
            content = np.zeros(groups, np.uint64)
            np.add.at(content, group, mix(h, 5))
            kept = np.lexsort((np.arange(groups), count))[spare - 1:]
            key = mix(content[kept] + mix(count[kept].astype(np.uint64), 6)
                      + mix(np.uint64(c << 32) + kept.astype(np.uint64), 8), 9)
            out.append(key.view(np.int64))
        c += 1
        if n * 100 < percent * (top + 1):  # no partner has more than ``top`` shingles
            return np.concatenate(out) if out else np.zeros(0, np.int64)


def sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of each run of ``values`` that ends at ``ends``, modulo 2 ** 64."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))[ends]
    return np.diff(total, prepend=np.uint64(0))


def block_shingles(hasher: Hasher, texts: list[bytes], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(distinct shingles, index of their text in the block, number of each text, its end) of blocks of texts."""
    for _, block in blocks(texts):
        h, who = hasher.words(block)
        k, owner = shingles(h, who, len(block), width)
        n = np.bincount(owner, minlength=len(block))
        yield k, owner, n, np.cumsum(n)


def text_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            part = batch.slice(k, rows)
            yield part, [t.as_buffer().to_pybytes() for t in part.column("text")]


def repeats(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(shingle, number) of the shingles that occur more than once."""
    h = np.concatenate(held)
    h.sort()
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    number = np.diff(first, append=len(h))
    h, number = h[first[number > 1]].view(np.int64), number[number > 1]
    for k in range(0, len(h), ROWS_OUT):
        yield pa.RecordBatch.from_arrays([pa.array(h[k:k + ROWS_OUT]), pa.array(number[k:k + ROWS_OUT])],
                                         ["shingle", "number"])


def common_shingles(docs: DataFrame, width: int, write: Write) -> Common:
    """The shingles that most sets hold, about ``COMMON`` at most: they only set the order of shingles.

    Tasks count all shingles, ``COUNTED`` at a time and each set once, and tell those that
    occur again; what is common in the whole table is so in its parts.  Those told are summed up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SPACES)
        held, size, seen = [], 0, set()
        for _, texts in text_batches(batches, 1000):
            with np.errstate(over="ignore"):
                for h, owner, n, ends in block_shingles(hasher, texts, width):
                    fresh = np.zeros(len(n), bool)
                    for i, s in enumerate(zip(n.tolist(), sums(mix(h, 3), ends).tolist(), strict=True)):
                        if s not in seen:
                            seen.add(s)
                            fresh[i] = True
                    held.append(h[fresh[owner]])
                    size += len(held[-1])
                    if size >= COUNTED or len(seen) >= COUNTED >> 5:
                        yield from repeats(held)
                        held, size, seen = [], 0, set()
        if size:
            yield from repeats(held)

    told = docs.select(text_of(docs).cast("binary").alias("text")).mapInArrow(trimmed(run), "shingle long, number long")
    counts = write(told.groupBy("shingle").agg(F.sum("number").alias("number"))
                   .select("shingle", F.floor(4 * F.log2("number")).cast("int").alias("level")), "common-shingles")
    wanted, room = F.lit(False), COMMON
    for level, n in sorted((tuple(r) for r in counts.groupBy("level").count().collect()), reverse=True):
        wanted |= (F.col("level") == level) & (F.pmod("shingle", F.lit(1 << 30)) < (1 << 30) * min(room, n) // n)
        room -= min(room, n)
    found = counts.where(wanted).toArrow()
    return Common(found["shingle"].to_numpy().view(np.uint64), found["level"].to_numpy().astype(np.uint8))


def batch_shingles(hasher: Hasher, texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """Distinct shingles of every text, in order."""
    for k, _, n, ends in block_shingles(hasher, texts, width):
        for e, size in zip(ends.tolist(), n.tolist(), strict=True):
            yield k[e - size:e]


SETS = "doc_id long, did long, tk long, n long, s1 long, s2 long, keys array<long>"


def sets_of(docs: DataFrame, width: int, percent: int, common: Common | None) -> DataFrame:
    """Size, 128-bit signature and keys of every document's shingle set: its rare shingles, or group
    keys where ``common`` is None."""
    tops, groups = size_classes(), classes(percent)

    def keys(h: np.ndarray, owner: np.ndarray, n: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if common is not None:
            return keys_of(h, owner, n, common, tops, percent)
        each = [group_keys_of(h[e - size:e], groups, percent) for e, size in zip(ends.tolist(), n.tolist(), strict=True)]
        return np.concatenate(each), np.repeat(np.arange(len(each)), [len(x) for x in each])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SPACES)
        for part, texts in text_batches(batches, 1000):
            columns: list[list] = [[] for _ in range(5)]
            with np.errstate(over="ignore"):
                for h, owner, n, ends in block_shingles(hasher, texts, width):
                    key, who = keys(h, owner, n, ends)
                    for c, v in zip(columns, (n, *(sums(mix(h, i), ends).view(np.int64) for i in (3, 4)), key,
                                              np.bincount(who, minlength=len(n))), strict=True):
                        c.append(v)
            n, s1, s2, key, number = (np.concatenate(c) for c in columns)
            offsets = np.concatenate(([0], np.cumsum(number)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("did"), part.column("tk"), pa.array(n), pa.array(s1), pa.array(s2),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(key))],
                ["doc_id", "did", "tk", "n", "s1", "s2", "keys"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), *doc_key(docs),
                       text_of(docs).cast("binary").alias("text")).mapInArrow(trimmed(run), SETS)


def count_vector(h: np.ndarray) -> np.ndarray:
    """Shingles per hash group.  There are at least an eighth as many groups as shingles (up to
    the most), or the counts of any two long sets would be alike."""
    least, most = COORDINATES
    groups = min(most, max(least, 1 << max(0, (len(h) - 1) // 8).bit_length()))
    return np.bincount((mix(h, 2) & np.uint64(groups - 1)).astype(np.int64), minlength=groups)


def folded(vector: Column, groups: Column) -> Column:
    """A count vector brought to fewer groups: group i takes i, i + groups, i + 2 * groups, .."""
    sums = F.transform(F.sequence(F.lit(0), groups - 1), lambda i: F.aggregate(
        F.sequence(i, F.size(vector) - 1, groups), F.lit(0), lambda s, j: s + F.get(vector, j)))
    return F.when(F.size(vector) > groups, sums).otherwise(vector)


def folded_together(counts: pa.ListArray) -> np.ndarray:
    """The count vectors as one matrix, all brought to the fewest groups of any."""
    lengths = np.diff(counts.offsets.to_numpy())
    groups = int(lengths.min())
    out = np.zeros((len(lengths), groups), np.int32)
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        out[at] = counts.take(pa.array(at)).flatten().to_numpy().reshape(len(at), n // groups, groups).sum(axis=1)
    return out


def full_sets(texts: DataFrame, width: int) -> DataFrame:
    """node, n, counts (the count vector), items (the sorted shingles) of (node, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SPACES)
        for part, texts in text_batches(batches, 500):
            found = list(batch_shingles(hasher, texts, width))
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), pa.array([len(h) for h in found], pa.int64()),
                 pa.array([count_vector(h) for h in found], pa.list_(pa.int32())),
                 pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64()))],
                ["node", "n", "counts", "items"])

    return texts.mapInArrow(trimmed(run), "node long, n long, counts array<int>, items array<long>")


def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (key, node) rows sorted by key, without those whose key surely occurs once.

    A key's run may go on in the partition before or after, so the first and the last row
    always stay.  Rows are compared with their neighbours; one row is held at a time.
    """
    held, alone = None, False  # the last row so far; has it no like neighbour before it?
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        same = key[1:] == key[:-1]
        before = np.concatenate(([held is None or held.column("key")[0].as_py() == key[0]], same))
        if held is not None and (before[0] or not alone):
            yield held
        stays = before[:-1] | same
        yield batch.slice(0, len(key) - 1).filter(pa.array(stays))
        held, alone = batch.slice(len(key) - 1), not before[-1]
    if held is not None:
        yield held


def key_members(keyed: DataFrame, write: Write) -> DataFrame:
    """key, node, hub of the keys with more than one node, keys of the same nodes once.

    ``keyed``: node, keys.  A range sort by (key, node) lets most keys, which only one
    node has, go before anything is counted; a key of many nodes spans many partitions.
    """
    each = write(keyed.select(F.explode("keys").alias("key"), "node").repartitionByRange("key", "node")
                 .sortWithinPartitions("key", "node").mapInArrow(trimmed(repeated), "key long, node long"), "keys")
    shared = each.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min("node").alias("hub"),
        *(F.bit_xor(F.xxhash64(F.lit(i), F.col("node"))).alias(f"x{i}") for i in (1, 2))).where("size > 1")
    distinct = shared.groupBy("size", "x1", "x2").agg(F.min("key").alias("key"), F.min("hub").alias("hub"))
    return each.join(distinct.select("key", "hub"), "key")


def verified(pairs: DataFrame, sets: DataFrame, percent: int, write: Write = written) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are linked.

    The count vectors are compared first; full sets travel only for pairs whose bound
    is large enough.
    """

    def with_sides(some: DataFrame, column: str) -> DataFrame:
        side = sets.select(F.col("node").alias("_node"), "n", column)
        for end in ("a", "b"):
            some = some.join(side.select(F.col("_node").alias(end), F.col("n").alias(f"n{end}"),
                                         F.col(column).alias(f"{column}_{end}")), end)
        return some

    def linked(overlap: Column) -> Column:
        return overlap * 100 >= (F.col("na") + F.col("nb") - overlap) * percent

    groups = F.least(F.size("counts_a"), F.size("counts_b"))
    minima = F.aggregate(F.zip_with(*(folded(F.col(f"counts_{end}"), groups) for end in ("a", "b")),
                                    lambda x, y: F.least(x, y)),
                         F.lit(0).cast("long"), lambda s, x: s + x)
    near = write(with_sides(pairs, "counts").where(linked(minima)).select("a", "b"), "near-pairs")
    return with_sides(near, "items") \
        .where(linked(F.size(F.array_intersect("items_a", "items_b")).cast("long"))).select("a", "b")


class CountTree:
    """A bulk-loaded R-tree over count vectors; only upper corners are needed."""

    def __init__(self, sizes: np.ndarray, vectors: np.ndarray, percent: int):
        spread = vectors.var(axis=0).argmax() if len(vectors) else 0
        self.order = np.lexsort((vectors[:, spread], sizes))
        self.sizes, self.vectors, self.percent = sizes[self.order], vectors[self.order], percent
        self.levels = []  # from the leaves up: (upper corners, smallest sizes)
        upper, small = self.vectors, self.sizes
        while len(upper) > 1:
            cuts = np.arange(0, len(upper), LEAF)
            upper, small = np.maximum.reduceat(upper, cuts), np.minimum.reduceat(small, cuts)
            self.levels.append((upper, small))

    def _may_link(self, size: int, vector: np.ndarray, upper: np.ndarray, small: np.ndarray) -> np.ndarray:
        most = np.minimum(upper, vector).sum(axis=1)
        return most * (100 + self.percent) >= (size + small) * self.percent

    def search(self, size: int, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the points whose overlap with the given one may be large enough, and
        the share of the two sizes that it may reach."""
        at = np.zeros(1, np.int64)
        for upper, small in reversed(self.levels):
            at = at[at < len(upper)]
            at = at[self._may_link(size, vector, upper[at], small[at])]
            at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
        at = at[at < len(self.sizes)]
        at = at[self._may_link(size, vector, self.vectors[at], self.sizes[at])]
        return self.order[at], np.minimum(self.vectors[at], vector).sum(axis=1) / (size + self.sizes[at])


def tree_pairs(members: DataFrame, percent: int, block_nodes: int = BLOCK_NODES,
               nearest: bool = False) -> DataFrame:
    """Pairs (a > b) of nodes of one key and different labels that pass the bound; with
    ``nearest`` the nearest one of each node that is not of the commonest label.

    ``members``: key, size (its nodes), node, label, n, counts.  A key with more than ``block_nodes``
    nodes is dealt into blocks and every pair of blocks is one bounded task.
    """
    dealt = members.withColumn("blocks", F.ceil(F.col("size") / block_nodes).cast("int")) \
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))

    def run(table: pa.Table) -> pa.Table:
        node, label = table["node"].to_numpy(), table["label"].to_numpy()
        block, lo, hi = (table[c].to_numpy() for c in ("block", "lo", "hi"))
        sizes = table["n"].to_numpy()
        vectors = folded_together(table["counts"].combine_chunks())
        tree = CountTree(sizes, vectors, percent)
        labels, number = np.unique(label, return_counts=True)
        passive = label == labels[number.argmax()]  # of two labels, one at least is another
        a, b = [], []
        for i in np.flatnonzero(~passive).tolist():
            near, share = tree.search(int(sizes[i]), vectors[i])
            other = label[near] != label[i]
            if lo[0] != hi[0]:
                other &= block[near] != block[i]
            if not nearest:
                other &= passive[near] | (node[near] < node[i])
            near, share = near[other], share[other]
            if nearest and len(near):
                near = near[[np.lexsort((node[near], -share))[0]]]
            a += np.maximum(node[near], node[i]).tolist()
            b += np.minimum(node[near], node[i]).tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.select("key", "lo", "hi", "block", "node", "label", "n", "counts") \
        .groupBy("key", "lo", "hi").applyInArrow(run, "a long, b long").distinct()


def ngram_join(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT,
               block_nodes: int = BLOCK_NODES) -> DataFrame:
    """doc_id, n_shingles, component_id, links, did, tk, label of every row.

    ``links`` counts the verified links found of the document's set (those that were
    needed to join its component), not all partners.  ``did`` and ``tk`` are the key of the
    document, ``label`` is the same for all rows of a component (null without shingles).
    """
    with workspace(docs.sparkSession, "ngram-join") as write:
        with workspace(docs.sparkSession, "ngram-keys") as passing:
            common = common_shingles(docs, width, passing) if width >= RARE_WIDTH else None
            found = passing(sets_of(docs, width, percent, common).withColumn("row", F.monotonically_increasing_id()), "sets")
            rows = write(found.drop("keys"), "rows")
            nodes = write(rows.where("n > 0").groupBy(*SIGNATURE).agg(F.min(F.struct("row", "did", "tk")).alias("first"))
                          .select(*SIGNATURE, "first.*").withColumn("node", F.monotonically_increasing_id()), "nodes")
            keyed = found.select("row", "keys").join(nodes.select("row", "node"), "row")
            members = write(key_members(keyed, passing), "members")
        wanted = members.select("node").distinct().join(nodes.select("node", "did", "tk"), "node")
        texts = docs.select(*doc_key(docs), text_of(docs).cast("binary").alias("text")) \
            .join(wanted, ["did", "tk"]).dropDuplicates(["node"]).select("node", "text")
        links = all_links(members, write(full_sets(texts, width), "full-sets"), percent, block_nodes, write)
        label = components(links, write)
        degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node") \
            .agg(F.count(F.lit(1)).alias("links"))

        placed = nodes.select(*SIGNATURE, "node").join(label, "node", "left").join(degree, "node", "left") \
            .withColumn("label", F.coalesce("label", "node"))
        known = rows.select("doc_id", "did", "tk", *SIGNATURE).join(placed, SIGNATURE, "left")
        smallest = known.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("smallest"))
        return written(known.join(smallest, "label", "left").select(
            "doc_id", F.col("n").alias("n_shingles"), F.coalesce("smallest", "doc_id").alias("component_id"),
            F.coalesce("links", F.lit(0).cast("long")).alias("links"), "did", "tk", "label"), "ngram-components")


def all_links(members: DataFrame, sets: DataFrame, percent: int, block_nodes: int, write: Write) -> DataFrame:
    """Linked pairs (a, b) of nodes that join every component: stars first, then trees."""
    stars = members.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    tested = stars
    links = write(verified(stars, sets, percent, write), "links")
    for last in [False] * NEAREST_ROUNDS + [True]:
        labelled = members.join(components(links, write), "node", "left") \
            .withColumn("label", F.coalesce("label", "node"))
        open_keys = write(labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                                      F.count(F.lit(1)).alias("size"))
                          .where("lo < hi").select("key", "size"), "open-keys")  # a table, so a large key can be split
        open_members = write(labelled.join(open_keys, "key").select("key", "size", "node", "label")
                             .join(sets.select("node", "n", "counts"), "node"), "open-members")
        pairs = write(tree_pairs(open_members, percent, block_nodes, not last)
                      .join(tested, ["a", "b"], "left_anti"), "tree-pairs")
        links = write(links.unionByName(verified(pairs, sets, percent, write)), "links")
        tested = tested.unionByName(pairs)
    return links


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component: the one of the smallest id (a document
    without an id only where no other has one), of texts that share it the one of the
    smallest digest.

    Rows that repeat the kept document, id and text, stay as they are, and so do documents
    without shingles.
    """
    found = ngram_join(docs, width, percent).where("label is not null").select("did", "tk", "label", "doc_id")
    order = F.struct(F.col("doc_id").isNull(), "did", "tk")
    first = found.groupBy("label").agg(F.min(order).alias("first")).select("label", "first.did", "first.tk")
    gone = found.join(first, ["label", "did", "tk"], "left_anti").select("did", "tk").distinct()
    return without(docs, written(gone, "near-copies"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under 3-word shingles at similarity 0.9."""
    return ngram_join(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
pairs AS (
  SELECT a.doc_id AS p, b.doc_id AS q FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
both_ways AS (SELECT p, q FROM pairs UNION ALL SELECT q, p FROM pairs),
reach AS (
  SELECT doc_id AS p, doc_id AS q FROM s
  UNION
  SELECT r.p, b.q FROM reach r JOIN both_ways b ON r.q = b.p)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, min(r.q) AS component_id
FROM s JOIN reach r ON r.p = s.doc_id GROUP BY s.doc_id, len(sh)
"""
