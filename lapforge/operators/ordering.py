"""Ranks, positions, top-k.

``sequence_number`` is the one piece of real work here: an exact
``row_number()`` / ``rank()`` within a group that never routes a whole group
through one task.  A plain ``Window.partitionBy(group)`` puts every row of a
group into a single task; with a few seasons (or one hot key holding a third of
the rows) that is one giant sort.  Instead:

1. one global range-partitioned sort on (group, order): a hot group is split
   over as many partitions as its size needs;
2. the sorted rows are pinned with ``checkpoint()`` (in the shared
   ``spark.checkpoint.dir``), so every later read sees the same partitions in
   the same order - also after a lost executor;
3. while sorting, one ``mapInArrow`` pass numbers each row inside its
   contiguous key run of its partition (Arrow compares, columns untouched);
   for ``rank`` also inside its run of equal (key, tie) values;
4. a run that began in earlier partitions gets a carry: the rows of its value
   in those partitions, read from a table with one row per partition (first
   value, last value, rows of the last value), hence a proven-size broadcast.
   Row number = index in the key run + 1; rank = row number - index in the
   tie run.  No aggregate or join is as large as the groups.

Windows stay the tool where a group is bounded by construction (e.g. one row
per season for a constructor, or a top-k of n rows per group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapforge.session import ensure_checkpoint_dir

def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL; keeps one copy of each key."""
    tmp = {k: f"_lf_r_{i}" for i, k in enumerate(keys)}
    r = right.select(*[F.col(c).alias(tmp[c]) if c in tmp else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[tmp[k]])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*tmp.values())


def _run_index(levels: list[list[str]]):
    """mapInArrow body over one sorted partition.

    For each level (a list of columns; e.g. the group keys, then keys + tie
    columns) every row gets its 0-based index inside its contiguous run of equal
    values in this partition (``_lf_i<L>``) and whether it belongs to the
    partition's first run (``_lf_f<L>``); ``_lf_local`` is the row's index in
    the partition.  Runs continue across Arrow batches.  Values are compared as
    Arrow values (NULL equals NULL, NaN equals NaN); no column is converted, so the
    rows pass through as they came.

    The returned function is self-contained (its helpers and imports live
    inside it), so it is shipped to the Python workers by value and needs no
    import of this package there.
    """
    levels = [list(cols) for cols in levels]

    def number(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        def same_as_previous(column, last):
            """Per row: equal to the row before; row 0 against ``last`` (a one-row array)."""
            before = pa.concat_arrays([last if last is not None else column[:1], column[:-1]])
            same = pc.fill_null(pc.equal(column, before), False)
            same = pc.or_(same, pc.and_(pc.is_null(column), pc.is_null(before)))
            if pa.types.is_floating(column.type):
                nan = pc.and_(pc.fill_null(pc.is_nan(column), False), pc.fill_null(pc.is_nan(before), False))
                same = pc.or_(same, nan)
            return same.to_numpy(zero_copy_only=False)

        part = TaskContext.get().partitionId()
        state = [dict(prev=None, run_len=0, first=True) for _ in levels]
        seen = 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            pos = np.arange(n)
            extra = {"_lf_part": np.full(n, part, np.int64), "_lf_local": pos + seen}
            for li, cols in enumerate(levels):
                st = state[li]
                same = np.ones(n, bool)
                for c in cols:
                    same &= same_as_previous(batch.column(c), st["prev"] and st["prev"][c])
                if st["prev"] is None:
                    same[0] = False
                starts = ~same
                run_id = np.cumsum(starts)       # 0: rows continuing the previous batch's run
                idx = pos - np.maximum.accumulate(np.where(starts, pos, 0))
                idx = np.where(run_id == 0, idx + st["run_len"], idx)
                first = (run_id == 1) if st["prev"] is None else ((run_id == 0) & st["first"])
                extra[f"_lf_i{li}"] = idx.astype(np.int64)
                extra[f"_lf_f{li}"] = first
                st["prev"] = {c: batch.column(c)[n - 1:] for c in cols}
                st["run_len"] = int(idx[-1]) + 1
                st["first"] = bool(first[-1])
            seen += n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(v) for v in extra.values())],
                [*batch.schema.names, *extra])
    return number


def _carries(pinned: DataFrame, levels: list[list[str]]) -> DataFrame:
    """Per sorted partition and level: rows of its first run's value that sit in
    earlier partitions.  From one row per partition (per level: first value,
    last value, rows of the last value): those earlier rows are the running
    sum of "rows of the last value" over the consecutive partitions that end in
    that value.  One aggregate for all levels; the result has one row per
    partition."""
    aggs = []
    for li, cols in enumerate(levels):
        val = F.struct(*[F.col(c) for c in cols])
        aggs += [F.max(F.when(F.col(f"_lf_f{li}"), val)).alias(f"_lf_fv{li}"),
                 F.max_by(val, F.col("_lf_local")).alias(f"_lf_lv{li}"),
                 (F.max_by(F.col(f"_lf_i{li}"), F.col("_lf_local")) + 1).alias(f"_lf_ln{li}")]
    parts = pinned.groupBy("_lf_part").agg(*aggs)
    prev = Window.orderBy("_lf_part")  # over the per-partition table only
    out = parts
    for li in range(len(levels)):
        by_last = Window.partitionBy(f"_lf_lv{li}").orderBy("_lf_part") \
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = out.withColumn(f"_lf_cum{li}", F.sum(f"_lf_ln{li}").over(by_last))
    return out.select("_lf_part", *[
        F.when(F.lag(f"_lf_lv{li}").over(prev).eqNullSafe(F.col(f"_lf_fv{li}")),
               F.lag(f"_lf_cum{li}").over(prev)).otherwise(F.lit(0)).alias(f"_lf_c{li}")
        for li in range(len(levels))])


def sequence_number(df: DataFrame, keys: Sequence[str], order: Sequence,
                    name: str = "seq", tie_cols: Sequence[str] | None = None,
                    rank_name: str | None = None) -> DataFrame:
    """Exact ``row_number()`` over (partition by keys order by order) as ``name``.

    ``order`` must be a total order inside a group (add a unique tie-break);
    with ``tie_cols`` also adds ``rank()`` (ties share the lowest number, gaps
    follow) as ``rank_name``, the ties being rows equal on ``tie_cols``.
    """
    from pyspark.sql import types as T
    keys = list(keys)
    ensure_checkpoint_dir(df.sparkSession)
    levels = [keys] + ([keys + [t for t in tie_cols if t not in keys]] if tie_cols else [])
    extra = [T.StructField("_lf_part", T.LongType()), T.StructField("_lf_local", T.LongType())]
    for li in range(len(levels)):
        extra += [T.StructField(f"_lf_i{li}", T.LongType()),
                  T.StructField(f"_lf_f{li}", T.BooleanType())]
    pinned = (df.orderBy(*[F.col(k) for k in keys], *[_col(o) for o in order])
              .mapInArrow(_run_index(levels), T.StructType(df.schema.fields + extra))
              .checkpoint(eager=True))
    # one row per partition: a proven-size broadcast
    out = pinned.join(F.broadcast(_carries(pinned, levels)), "_lf_part")

    def global_index(li):
        return F.col(f"_lf_i{li}") + F.when(F.col(f"_lf_f{li}"), F.col(f"_lf_c{li}")) \
            .otherwise(F.lit(0))

    out = out.withColumn(name, (global_index(0) + 1).cast("bigint"))
    if tie_cols:
        # rank = row number of the first row of the tie run
        out = out.withColumn(rank_name or "rank", (F.col(name) - global_index(1)).cast("bigint"))
    return out.drop(*[f.name for f in extra], *[f"_lf_c{li}" for li in range(len(levels))])


def rank_first(df: DataFrame, by: Sequence[str], order: Sequence,
               name: str = "rank") -> DataFrame:
    """Rank where ties get distinct numbers in a stated order (pandas ``method="first"``)."""
    return sequence_number(df, by, order, name=name)


def rank_min(df: DataFrame, by: Sequence[str], order: Sequence, tie_cols: Sequence[str],
             name: str = "rank") -> DataFrame:
    """SQL ``rank()``: ties share the lowest rank, the next rank leaves a gap."""
    return sequence_number(df, by, order, name="_lf_seq", tie_cols=tie_cols,
                           rank_name=name).drop("_lf_seq")


def top_n(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """K3: first ``n`` rows after a sort (planned as TakeOrderedAndProject)."""
    return df.orderBy(*[_col(o) for o in order]).limit(n)


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence, n: int,
                    name: str = "pos") -> DataFrame:
    """First ``n`` rows of each group with their position 1..n.

    ``row_number() <= n`` lets Spark insert a partial per-group limit before the
    shuffle (WindowGroupLimit), so at most ``n`` rows per group leave each map
    task, whatever the group's size.
    """
    w = Window.partitionBy(*keys).orderBy(*[_col(o) for o in order])
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def n_largest(df: DataFrame, value: str, key: str, n: int) -> DataFrame:
    """K4: ``n`` largest by value; ties go to the smaller key."""
    return top_n(df, [F.col(value).desc(), F.col(key).asc()], n)


def first_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """K7: the first ``n`` distinct keys in key order (order of appearance has no
    meaning on a distributed table)."""
    return df.select(key).distinct().orderBy(key).limit(n)


def tail(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """K6: last ``n`` rows in ``order``, returned in ``order``.

    ``order`` holds ascending columns (names or expressions); for a descending one
    give the negated or otherwise reversed value."""
    last = df.orderBy(*[_col(o).desc_nulls_last() for o in order]).limit(n)
    return last.orderBy(*[_col(o).asc_nulls_first() for o in order])


def argmax_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
               cols: Sequence[str]) -> DataFrame:
    """First row of each group under ``order`` (all ascending struct fields) via
    ``min(struct)``: a partial aggregate, so a hot group never sits in one task."""
    packed = F.struct(*[o.alias(f"_lf_o{i}") for i, o in enumerate(order)],
                      *[F.col(c) for c in cols])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_lf_best"))
    return agg.select(*keys, *[F.col(f"_lf_best.{c}").alias(c) for c in cols])
