"""Values carried along an order: the row before, the last marked row.

``Window.partitionBy(key)`` puts all rows of a key in one task; a hot user or one huge log
file is then one giant sort.  Here, as in ``ordering.sequence_number``,

1. one global range-partitioned sort on (keys, order) spreads a hot key over many partitions;
2. while sorting, one ``mapInArrow`` pass gives every row the values of the nearest source row
   before it in its key and partition, and marks rows whose source may lie in an earlier one;
3. the result is pinned with ``checkpoint()`` in the shared folder;
4. a table with one row per partition (first key, last key, values of the last source row of
   the last key) gives each partition what its first key takes over from those before.  Having
   one row per partition, it is a proven-size broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapforge.session import ensure_checkpoint_dir


def _carry(keys: list[str], values: list[str], own: bool):
    """mapInArrow body over one sorted partition; self-contained, so it is shipped by value.

    ``_lf_v<i>``: value of the nearest source row (``_lf_src``) of the key, the row itself
    counting with ``own``; ``_lf_open``: it must come from earlier partitions, if at all.
    """
    keys, values = list(keys), list(values)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        def same_as_before(column, last):
            before = pa.concat_arrays([last if last is not None else column[:1], column[:-1]])
            same = pc.fill_null(pc.equal(column, before), False)
            return pc.or_(same, pc.and_(pc.is_null(column), pc.is_null(before))).to_numpy(zero_copy_only=False)

        part = TaskContext.get().partitionId()
        held = None     # the last row so far
        source = None   # values of the last source row of its key, if there is one
        first, seen = True, 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            pos = np.arange(n)
            same = np.ones(n, bool)
            for k in keys:
                same &= same_as_before(batch.column(k), held and held[k])
            if held is None:
                same[0] = False
            start = np.maximum.accumulate(np.where(same, -1, pos))  # of the row's key; -1: an earlier batch
            marked = pc.fill_null(batch.column("_lf_src"), False).to_numpy(zero_copy_only=False)
            upto = np.maximum.accumulate(np.where(marked, pos, -1))
            at = upto if own else np.concatenate(([-1], upto[:-1]))
            inside = (at >= 0) & (at >= start)
            kept = ~inside & (start < 0) & (source is not None)
            at = np.where(inside, at, np.where(kept, n, -1))
            take = pa.array(at, pa.int64(), mask=at < 0)
            carried = []
            for v in values:
                column = batch.column(v)
                more = source[v] if source is not None else pa.nulls(1, column.type)
                carried.append(pa.concat_arrays([column, more]).take(take))
            in_first = (np.cumsum(~same) == 1) if held is None else (np.cumsum(~same) == 0) & first
            if upto[-1] >= 0 and upto[-1] >= start[-1]:
                source = {v: batch.column(v)[int(upto[-1]):int(upto[-1]) + 1] for v in values}
            elif start[-1] >= 0:
                source = None
            held = {k: batch.column(k)[n - 1:] for k in keys}
            first = bool(in_first[-1])
            extra = {"_lf_part": pa.array(np.full(n, part, np.int64)), "_lf_local": pa.array(pos + seen),
                     "_lf_open": pa.array(in_first & (at < 0))}
            seen += n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *extra.values(), *carried],
                [*batch.schema.names, *extra, *(f"_lf_v{i}" for i in range(len(values)))])
    return run


def carry(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str],
          source: Column | None = None, own: bool = False) -> DataFrame:
    """``df`` with, per new name, the value of a column in the nearest source row before.

    ``values``: new name -> column.  Every row is a source unless ``source`` says which are;
    with ``own`` a source row takes its own values (a forward fill), else the ones before it
    (a lag).  ``order`` must be total within a key.  Rows without such a source get NULL; NULL
    keys are one key.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys, columns = list(keys), list(dict.fromkeys(values.values()))
    sorted_rows = df.withColumn("_lf_src", F.lit(True) if source is None else source) \
        .orderBy(*(F.col(c) for c in [*keys, *order]))
    extra = [T.StructField("_lf_part", T.LongType()), T.StructField("_lf_local", T.LongType()),
             T.StructField("_lf_open", T.BooleanType())]
    extra += [T.StructField(f"_lf_v{i}", df.schema[c].dataType) for i, c in enumerate(columns)]
    pinned = sorted_rows.mapInArrow(_carry(keys, columns, own), T.StructType(sorted_rows.schema.fields + extra)) \
        .checkpoint(eager=True)

    key = F.struct(*(F.col(k) for k in keys)) if keys else F.struct(F.lit(1).alias("all"))
    state = F.struct(key.alias("key"), F.struct(*(F.col(c).alias(f"_lf_v{i}") for i, c in enumerate(columns))).alias("held"))
    parts = pinned.groupBy("_lf_part").agg(
        F.min_by(key, "_lf_local").alias("first"), F.max_by(key, "_lf_local").alias("last"),
        F.max_by(F.when(F.col("_lf_src"), state), F.when(F.col("_lf_src"), F.col("_lf_local"))).alias("state"))
    own_state = F.when(F.col("state.key").eqNullSafe(F.col("last")), F.col("state.held"))
    before = Window.orderBy("_lf_part")  # over the per-partition table only
    upto = F.last(own_state, ignorenulls=True).over(Window.partitionBy("last").orderBy("_lf_part"))
    taken = parts.withColumn("upto", upto).select(
        F.col("_lf_part"), F.when(F.lag("last").over(before).eqNullSafe(F.col("first")),
                                  F.lag("upto").over(before)).alias("_lf_taken"))
    out = pinned.join(F.broadcast(taken), "_lf_part")
    place = {c: i for i, c in enumerate(columns)}
    return out.select(*df.columns, *(
        F.when(F.col("_lf_open"), F.col(f"_lf_taken._lf_v{place[c]}")).otherwise(F.col(f"_lf_v{place[c]}")).alias(name)
        for name, c in values.items()))
