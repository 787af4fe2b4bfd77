"""Benchmark decontamination by exact runs and template canonicalisation (operator 7).

DataFrame functions only.  A document holds an item when one of two searches finds it:

1. Exact: a run of ``RUN_WORDS`` lower-cased words of the item, or the whole item where
   it is shorter, stands in the document.  Every item with a word takes part, whatever
   its length and however many numbers and names it has; a hit counts by itself.
   ``RUN_WORDS`` lies just above the 15 words that a copy with contradictory values may
   share with its item (tests/llm).
2. Template: texts become words in which numbers (with sign, decimals and separators),
   names (runs of capitalised words) and units (after a number) are typed placeholders,
   the rest is lower-cased; any white space separates words.  A run that starts a
   sentence is read twice: its first word as a plain word (reading 0) and the whole run
   as a name (reading 1).  Windows of ``WINDOW`` template words with at least half their
   words outside placeholders are compared.

A first pass drops the documents that cannot match.  Every window of an item, of either
search, has an anchor: of its runs of 4 (else 3, 2, 1) neighbouring words outside
placeholders, the one of the most letters, which few other texts have.  These words stand side by side in every text that
has the window, whatever its names and numbers are, so one hash per word of a document
tells; overlapping windows mostly share their anchor.  Only documents with an anchor are
read in templates.

All their windows, of all readings and widths, are hashed and joined in one pass with the
distinct windows of the benchmark, then with the items that have them.  The first join
broadcasts two numbers per window only below ``BROADCAST_ROWS`` of them and is a shuffled
join beyond.

A document and an item are a template pair when at least ``SHARE`` of the item's windows
of one reading occur in the document (reading 0 first).  Placeholders are then compared
per alignment of the two texts: every value of the item must stand for one value
throughout.  A re-parameterised copy passes with other values, an accidental match of
templates whose slots contradict each other does not.  An exact hit needs neither.

Defined cases: null or empty text has no windows; an item of fewer than ``WINDOW``
template words is one window of its length; one of fewer than ``LEAST_WORDS``, or with no
window of enough plain words, is searched exactly only; ``windows`` and ``hits`` are 0
where none of an item's template windows occurs, and ``consistent`` is true for a pair
found exactly only; rows equal in id and text count as one document; repeated items count
as one; an empty table on either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.llm.common import doc_key, read_table, without, written

WINDOW = 8
LEAST_WORDS = 5
SHARE = 0.5
RUN_WORDS = 16
BROADCAST_ROWS = 500_000
ANCHOR_WORDS = (4, 3, 2, 1)
INLINE_ANCHORS = 50_000

# Words that name a unit when they follow a number.
UNITS = ("mm", "cm", "m", "km", "mg", "g", "kg", "t", "ml", "l", "s", "sec", "seconds", "min", "minutes", "h",
         "hours", "days", "weeks", "months", "years", "miles", "feet", "inches", "pounds", "ounces", "euros",
         "dollars", "cents", "percent", "degrees", "meters", "metres", "kilometers", "kilometres", "grams",
         "kilograms", "liters", "litres", "eur", "usd")
NAME, NUMBER, UNIT = "<name>", "<number>", "<unit>"
EXACT = 2  # the third "reading": raw words

# kinds of words: plain, first of a name within a sentence and at its start, further word of a
# name, number, further part of a number, unit
PLAIN, INNER, OPENER, MORE, DIGITS, PART, MEASURE = range(7)

_WORD = r"[\p{L}\p{N}]+"
_SPACE = r"[\s\p{Z}]+"


def kinds_of() -> Column:
    """Kind of every word, from ``words`` and ``gaps`` (what stands before each).

    Only a word's own first character decides for most words, so the others are looked at
    for few; a loop over words keeps no state, so a run of names of any length is fine.
    """

    def first(w: Column) -> Column:
        return F.substring(w, 1, 1)

    def digit(c: Column) -> Column:
        return c.between("0", "9")

    def capital(w: Column) -> Column:
        return F.lower(first(w)) != first(w)

    def one(w: Column, i: Column) -> Column:
        before, gap = F.get("words", i - 1), F.get("gaps", i)
        last = F.substring(before, -1, 1)
        follows = (i > 0) & gap.rlike(f"^{_SPACE}$") & ((F.upper(last) != last) | digit(last))
        more = (i > 0) & capital(before) & (follows | gap.isin("'", "’", "-"))
        inner = follows | gap.rlike(f'[,;)"]{_SPACE}$')
        part = (i > 0) & gap.isin(".", ",") & before.rlike("^[0-9]+$")
        return F.when(first(w).between("a", "z"), F.when(
            (i > 0) & digit(first(before)) & w.isin(*UNITS), MEASURE).otherwise(PLAIN)) \
            .when(digit(first(w)), F.when(part, PART).otherwise(DIGITS)) \
            .when(~capital(w), PLAIN).when(more, MORE).when(inner, INNER).otherwise(OPENER)

    return F.transform("words", one)


def template_of(reading: int) -> Column:
    """Words with typed placeholders, from ``lower`` and ``kinds``."""

    def one(word: Column, i: Column) -> Column:
        kind = F.get("kinds", i)
        opener = word if reading == 0 else F.lit(NAME)
        more = F.when(F.get("kinds", i - 1) == OPENER, NAME) if reading == 0 else F.lit(None).cast("string")
        return F.when(kind == PLAIN, word).when(kind == DIGITS, NUMBER).when(kind == INNER, NAME) \
            .when(kind == OPENER, opener).when(kind == MEASURE, UNIT).when(kind == MORE, more)

    return F.filter(F.transform("lower", one), lambda w: w.isNotNull())


def values_of(reading: int) -> Column:
    """What stands in the text for every word of the template, from ``words``, ``gaps`` and ``kinds``.

    The words are written one after the other, each after a mark that says whether it opens
    a template word, and cut at those marks.
    """

    def one(word: Column, i: Column) -> Column:
        kind, gap = F.get("kinds", i), F.translate(F.get("gaps", i), "−", "-")
        more = kind == MORE
        if reading == 0:
            more = more & (F.get("kinds", i - 1) != OPENER)
        sign = F.when((kind == DIGITS) & ((i == 0) | (F.length(gap) > 1)) & gap.rlike("[+-]$"), F.substring(gap, -1, 1))
        return F.concat(F.when(more | (kind == PART), "\u0004").otherwise("\u0003"),
                        F.coalesce(sign, F.lit("")), word)

    return F.filter(F.split(F.array_join(F.transform("words", one), ""), "\u0003"), lambda v: v != "")


def in_words(texts: DataFrame, *keys: str) -> DataFrame:
    """``keys``, words, gaps, lower and kinds of (keys, text) rows, each text cut once."""
    return texts.select(*keys, F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)).alias("words"),
                        F.split("text", _WORD).alias("gaps")) \
        .select("*", F.transform("words", F.lower).alias("lower"), kinds_of().alias("kinds"))


def pairs_of(hashes: Column, apart: int) -> Column:
    """Hashes of every two hashes ``apart`` places from each other."""
    n = F.greatest(F.size(hashes) - apart, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, apart + 1, n), lambda x, y: F.xxhash64(F.lit(apart), x, y))


def with_hashes(rows: DataFrame, words: str, reading: Column, widest: int) -> DataFrame:
    """``rows`` with the hashes of all runs of 1, 2, 4, .. words, each from two of half its length.

    Every length is a column of its own; nested, each would be worked out many times.
    """
    rows, block = rows.select("*", F.transform(words, lambda w: F.xxhash64(reading, w)).alias(f"{words}_1")), 1
    while block * 2 <= widest:
        rows = rows.select("*", pairs_of(F.col(f"{words}_{block}"), block).alias(f"{words}_{block * 2}"))
        block *= 2
    return rows


def windows_of(words: str, width: int) -> Column:
    """Hashes of all windows of ``width`` words, by place; other widths than 1, 2, 4, .. come from
    two runs that overlap."""
    block = 1 << (width.bit_length() - 1)
    hashes = F.col(f"{words}_{block}")
    return pairs_of(hashes, width - block) if width > block else hashes


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, reading, place, width, hash, slots (offset and value), windows (of the item
    in the reading).  Runs of raw words have reading ``EXACT`` and no slots."""
    items = in_words(benchmark.where(F.col("text").isNotNull()), "item_id").distinct()
    read = items.select("item_id", F.explode(F.array(*(
        F.struct(F.lit(r).alias("reading"), t.alias("template"), w.alias("words"))
        for r, t, w in ((0, template_of(0), values_of(0)), (1, template_of(1), values_of(1)),
                        (EXACT, F.col("lower"), F.col("lower")))))).alias("r")) \
        .select("item_id", "r.*").distinct()
    exact = F.col("reading") == EXACT
    placed = with_hashes(read, "template", F.col("reading"), RUN_WORDS) \
        .withColumn("width", F.least(F.size("words"), F.when(exact, RUN_WORDS).otherwise(WINDOW))) \
        .where(F.col("width") >= F.when(exact, 1).otherwise(LEAST_WORDS)) \
        .withColumn("windows", F.coalesce(*(F.when(F.col("width") == w, windows_of("template", w))
                                            for w in range(1, RUN_WORDS + 1)))) \
        .select("*", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("width"))).alias("place")) \
        .withColumn("part", F.slice("template", F.col("place") + 1, F.col("width"))) \
        .withColumn("values", F.slice("words", F.col("place") + 1, F.col("width")))
    kinds = (NAME, NUMBER, UNIT)
    slots = F.filter(F.transform("part", lambda w, i: F.when(
        w.isin(*kinds), F.struct(i.alias("offset"), F.get(F.col("values"), i).alias("value")))),
        lambda s: s.isNotNull())
    plain = placed.withColumn("slots", slots).where(exact | (F.size("slots") * 2 <= F.col("width"))) \
        .select("item_id", "reading", "place", "width", F.get("windows", F.col("place")).alias("hash"), "slots", "part")
    plain = with_hashes(plain, "part", F.lit(EXACT), ANCHOR_WORDS[0])

    def longest(n: int) -> Column:
        """Hash of the n words in a row outside placeholders that have the most letters."""
        runs = F.transform(windows_of("part", n), lambda h, i: F.struct(
            F.length(F.array_join(F.slice("part", i + 1, n), "")).alias("letters"), h.alias("hash"),
            F.exists(F.slice("part", i + 1, n), lambda w: w.isin(*kinds)).alias("open")))
        return F.array_max(F.filter(runs, lambda r: ~r["open"]))["hash"]

    plain = plain.withColumn("anchor", F.coalesce(*(F.when(longest(n).isNotNull(), F.struct(
        F.lit(n).alias("words"), longest(n).alias("hash"))) for n in ANCHOR_WORDS))) \
        .select("item_id", "reading", "place", "width", "hash", "slots", "anchor")
    total = plain.select("item_id", "reading", "place").distinct().groupBy("item_id", "reading") \
        .agg(F.count(F.lit(1)).alias("windows"))
    return plain.join(total, ["item_id", "reading"])


def with_anchors(texts: DataFrame, bench: DataFrame, inline: int = INLINE_ANCHORS) -> DataFrame:
    """The rows of ``texts`` (doc_id, did, tk, text) that hold an anchor of some window of the items.

    Up to ``inline`` anchors are tested within the row, so texts stay where they are; more
    of them are joined, and the texts then with the keys of the documents found.
    """
    anchors = bench.select("anchor.words", "anchor.hash").distinct()
    known = anchors.limit(inline + 1).collect()
    lengths = sorted({r["words"] for r in known}) if len(known) <= inline else sorted(ANCHOR_WORDS)
    runs = with_hashes(texts.select("doc_id", "did", "tk", "text", F.transform(
        F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)), F.lower).alias("low")),
        "low", F.lit(EXACT), max(lengths, default=1))

    def known_in(n: int) -> Column:
        return F.exists(windows_of("low", n), lambda h: h.isin(*(r["hash"] for r in known if r["words"] == n)))

    def with_length(n: int) -> Column:
        return F.transform(windows_of("low", n), lambda h: F.struct(F.lit(n).alias("words"), h.alias("hash")))

    if len(known) <= inline:
        held = reduce(Column.__or__, map(known_in, lengths), F.lit(False))
        # explode of an expression: Spark would work out a filter on it below, with its arrays nested
        return runs.select("doc_id", "did", "tk", "text", F.explode(F.when(held, F.array(F.lit(0)))).alias("_")).drop("_")
    spread = runs.select("did", "tk", F.explode(F.flatten(F.array(*map(with_length, lengths)))).alias("a"))
    holders = written(spread.select("did", "tk", "a.words", "a.hash").join(anchors, ["words", "hash"])
                      .select("did", "tk").distinct(), "anchor-holders")
    return texts.join(holders, ["did", "tk"], "left_semi")


def matches(docs: DataFrame, benchmark: DataFrame, inline: int = INLINE_ANCHORS) -> DataFrame:
    """doc_id, item_id, windows, hits, slots, consistent, contaminated of every candidate pair.

    ``doc_id`` keeps its type; ``windows`` counts the item's windows and ``hits`` those
    of them that occur in the document.
    """
    bench = written(benchmark_windows(benchmark), "benchmark-windows")
    count = bench.count()
    kinds = sorted(map(tuple, bench.select("reading", "width").distinct().collect()))  # at most 24 rows
    kinds = kinds or [(0, WINDOW)]
    part = reduce(lambda out, k: out.when((F.col("reading") == kinds[k][0]) & (F.col("width") == kinds[k][1]), k),
                  range(len(kinds)), F.when(F.lit(False), -1))
    bench = bench.withColumn("part", part)
    side = bench.select("hash", "part").distinct()  # two numbers a row
    side = F.broadcast(side) if count <= BROADCAST_ROWS else side
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", *doc_key(docs), docs["text"].cast("string").alias("text"))
    pair = ["doc_id", "did", "tk", "item_id"]
    read = sorted({r for r, _ in kinds})
    runs = in_words(with_anchors(texts, bench, inline), "doc_id", "did", "tk").select(
        "doc_id", "did", "tk", *((F.col("lower") if r == EXACT else template_of(r)).alias(f"p{r}") for r in read))
    for r in read:
        runs = with_hashes(runs, f"p{r}", F.lit(r), max(w for k, w in kinds if k == r))
    hashes = runs.select("doc_id", "did", "tk", F.array(*(windows_of(f"p{r}", w) for r, w in kinds)).alias("hashes"))
    ends = F.transform("hashes", lambda _, k: F.aggregate(
        F.slice("hashes", 1, k), F.lit(0), lambda n, h: n + F.size(h)))  # where each kind starts
    # posexplode of an expression: of a column, Spark would test its size again below, with all of its work
    spread = hashes.select("doc_id", "did", "tk", ends.alias("starts"), "hashes") \
        .select("doc_id", "did", "tk", "starts", F.posexplode(F.flatten("hashes")).alias("spot", "hash"))
    # first which windows any item has, then the items of those
    hits = written(spread.join(side, "hash").select(
        "doc_id", "did", "tk", "hash", "part", (F.col("spot") - F.get("starts", F.col("part"))).alias("at")), "window-hits")
    found = written(hits.join(bench.drop("anchor"), ["hash", "part"]).select(
        *pair, "reading", "at", "place", "width", "slots", "windows"), "window-matches")
    exact = found.where(F.col("reading") == EXACT).select(*pair).distinct()
    shares = found.where(F.col("reading") < EXACT).select(*pair, "reading", "place", "windows").distinct() \
        .groupBy(*pair, "reading").agg(F.max("windows").alias("windows"), F.count(F.lit(1)).alias("hits")) \
        .withColumn("ok", F.col("hits") >= F.col("windows") * SHARE)
    none = (F.lit(0).cast("long").alias(c) for c in ("windows", "hits"))
    evidence = shares.withColumn("exact", F.lit(False)).unionByName(exact.select(
        *pair, F.lit(EXACT).alias("reading"), *none, F.lit(False).alias("ok"), F.lit(True).alias("exact")))
    # the first reading that reaches the share, else the first one with hits
    pairs = evidence.groupBy(*pair).agg(
        F.max("ok").alias("ok"), F.max("exact").alias("exact"),
        F.min(F.struct((~F.col("ok")).alias("late"), "reading", "windows", "hits")).alias("best")) \
        .where("ok or exact").select(*pair, "ok", "exact", "best.reading", "best.windows", "best.hits")
    pairs = written(pairs, "pairs")
    key = ["did", "tk", "item_id", "reading"]
    slotted = written(
        found.where(F.size("slots") > 0).join(pairs.where("ok").select(*key).distinct(), key, "left_semi")
        .select(*key, (F.col("at") - F.col("place")).alias("shift"), F.explode("slots").alias("slot"), "at")
        .select(*key, "shift", F.col("slot.value").alias("value"),
                (F.col("at") + F.col("slot.offset")).alias("at")).distinct(), "slots")
    if slotted.isEmpty():
        judged = pairs.withColumn("slots", F.lit(0).cast("long")).withColumn("consistent", F.lit(True))
    else:
        some = texts.join(slotted.select("did", "tk").distinct(), ["did", "tk"], "left_semi")
        own = in_words(some, "did", "tk").select("did", "tk", F.explode(F.array(*(
            F.struct(F.lit(r).alias("reading"), values_of(r).alias("words")) for r in (0, 1)))).alias("r")) \
            .select("did", "tk", "r.reading", F.posexplode("r.words").alias("at", "here")).distinct()
        stands = slotted.join(own, ["did", "tk", "reading", "at"]) \
            .groupBy(*key, "shift", "value").agg(
                F.min("here").alias("lo"), F.max("here").alias("hi"), F.count(F.lit(1)).alias("uses"))
        shifts = stands.groupBy(*key, "shift").agg(
            F.sum("uses").alias("slots"), F.min((F.col("lo") == F.col("hi")).cast("int")).alias("same"))
        verdict = shifts.groupBy(*key).agg(
            F.max("slots").alias("slots"), (F.max("same") == 1).alias("consistent"))
        judged = pairs.join(verdict, key, "left") \
            .withColumn("slots", F.coalesce("slots", F.lit(0).cast("long"))) \
            .withColumn("consistent", F.coalesce("consistent", F.lit(True)))
    return judged.select("doc_id", "did", "tk", "item_id", "windows", "hits", "slots", "consistent",
                         (F.col("consistent") | F.col("exact")).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    bad = matches(docs, benchmark).where("contaminated").select("did", "tk").distinct()
    return without(docs, written(bad, "contaminated"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, with the evidence."""
    return matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")) \
        .drop("did", "tk")


def _sql_words(table: str, key: str) -> str:
    """SQL for key, words, template of a table."""
    units = ", ".join(f"'{u}'" for u in UNITS)
    number = "regexp_matches({0}, '^[0-9]')"
    return f"""
  SELECT {key}, words, list_transform(words, lambda w, i: CASE WHEN starts_with(w, chr(1)) THEN '{NAME}'
      WHEN {number.format('w')} THEN '{NUMBER}'
      WHEN lower(w) IN ({units}) AND i > 1 AND {number.format('words[i - 1]')} THEN '{UNIT}'
      ELSE lower(w) END) AS template
  FROM (SELECT {key}, list_filter(string_split_regex(regexp_replace(text,
      '([\\p{{Ll}}\\p{{N}},;)"] )(\\p{{Lu}})', '\\1' || chr(1) || '\\2', 'g'), '[^\\p{{L}}\\p{{N}}\\x01]+'),
      lambda w: w <> '' AND w <> chr(1)) AS words FROM {table} WHERE text IS NOT NULL)"""


OP7_SQL = f"""
WITH b AS ({_sql_words('benchmark', 'item_id')}),
d AS ({_sql_words('documents', 'doc_id')}),
bw AS (
  SELECT *, list_filter(range(1, width + 1), lambda k: template[place + k] IN ('{NAME}', '{NUMBER}', '{UNIT}')) AS slots
  FROM (SELECT DISTINCT item_id, words, template, least(len(words), {WINDOW}) AS width,
               unnest(range(0, len(words) - least(len(words), {WINDOW}) + 1)) AS place
        FROM b WHERE len(words) >= {LEAST_WORDS})),
bt AS (
  SELECT item_id, words, place, width, slots, array_to_string(template[place + 1:place + width], ' ') AS content,
         count(*) OVER (PARTITION BY item_id) AS windows
  FROM bw WHERE len(slots) * 2 <= width),
dw AS (
  SELECT doc_id, words, width, place, array_to_string(template[place + 1:place + width], ' ') AS content
  FROM (SELECT doc_id, words, template, width, unnest(range(0, len(words) - width + 1)) AS place
        FROM d CROSS JOIN (SELECT DISTINCT width FROM bt) WHERE len(words) >= width)),
m AS (
  SELECT dw.doc_id, item_id, dw.words AS dwords, bt.words AS bwords, dw.place AS dplace, bt.place, slots, windows
  FROM dw JOIN bt USING (width, content)),
shares AS (
  SELECT doc_id, item_id, max(windows) AS windows, count(DISTINCT place) AS hits FROM m GROUP BY 1, 2
  HAVING count(DISTINCT place) >= {SHARE} * max(windows)),
sl AS (
  SELECT DISTINCT doc_id, item_id, dplace - place AS shift, bwords[place + k] AS value, dplace + k AS spot, dwords[dplace + k] AS here
  FROM (SELECT *, unnest(slots) AS k FROM m)),
st AS (SELECT doc_id, item_id, shift, value, count(*) AS uses, count(DISTINCT here) = 1 AS same FROM sl GROUP BY ALL),
sh AS (SELECT doc_id, item_id, shift, sum(uses) AS slots, bool_and(same) AS same FROM st GROUP BY ALL),
v AS (SELECT doc_id, item_id, max(slots) AS slots, bool_or(same) AS consistent FROM sh GROUP BY ALL)
SELECT doc_id, item_id, windows, hits, CAST(coalesce(slots, 0) AS BIGINT) AS slots,
       coalesce(consistent, true) AS consistent, coalesce(consistent, true) AS contaminated
FROM shares LEFT JOIN v USING (doc_id, item_id)
"""
