"""Mix sources to target weights with balanced sampling by the cube method.

A source whose target is m times its size takes every document floor(m) times, and a sample of
them once more, each with probability m - floor(m). The sample is balanced: three documents at a
time move their probabilities along the null space of two constraints, number of documents
and number of words, until one of them is 0 or 1 (flight phase). What two documents are left with
is settled at the end (landing phase).

At scale: sources are cut by a hash into blocks of bounded size, each a task of its own, so a
source with a third of all documents uses many tasks. A block keeps both totals and leaves ten
documents open; these are blocks of the next level, until a source has one block. Only ids,
sizes and probabilities move, never texts. The table of sources has one slim row per source.

Defined results: a null text or one without words has size 0 and takes 0. A null source is a source,
last in order. Repeated rows are documents of their own. Sources without words have target 0. Order
of rows and partitions does not matter: draws depend on hashes of the rows alone, so reruns agree.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.llm.arrow import map_groups
from visitlake.scratch import via_table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
#: Documents of a block; bounds a task's memory.
BLOCK_ROWS = 2_000
#: Documents of many sizes that a block leaves to the next level, so that the last one can land finely.
HELD_BACK = 8
LEFT_OPEN = HELD_BACK + 2
EPSILON = 1e-9


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(
    units: DataFrame, weights: Sequence[float] = WEIGHTS, most_times: int = MOST_TIMES
) -> DataFrame:
    """Rows (source, documents, source_size, target) from units (source, size).

    Targets share the total by weight, but none is above ``most_times`` its source's size. With
    sources in the order of the level at which they reach that bound, the first one that
    stays below it fixes the common level for all that follow.
    """
    sources = units.groupBy("source").agg(
        F.count("*").alias("documents"), F.sum("size").alias("source_size")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(weight)) for weight in weights])
    by_level = Window.orderBy("level", "place")
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    return (
        sources.withColumn("place", place)
        .withColumn("weight", F.get(cycle, F.col("place") % len(weights)))
        .withColumn("most", (F.col("source_size") * most_times).cast("double"))
        .withColumn("level", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn(
            "shared",
            (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
            / F.sum("weight").over(after),
        )
        .withColumn(
            "common",
            F.min_by(
                F.when(F.col("level") >= F.col("shared"), F.col("shared")),
                # Sources of one level have different values of "shared"; only the first one's is whole.
                F.when(F.col("level") >= F.col("shared"), F.struct("level", "place")),
            ).over(everything),
        )
        .select(
            "source",
            "documents",
            "source_size",
            F.least("most", F.col("weight") * F.col("common")).alias("target"),
        )
    )


def mix(units: DataFrame, seed: int = 17, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, times) from units (doc_id, source, size)."""
    targets = via_table(source_targets(units), "mix-targets")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    times = F.least(times, F.lit(float(MOST_TIMES)))
    open_units = (
        units.join(targets, units["source"].eqNullSafe(targets["source"]))
        .drop(targets["source"])
        .withColumn("whole", F.floor(times).cast("int"))
        .withColumn("part", times - F.col("whole"))
        .withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "source", "size"))
    )
    most = targets.agg(F.max("documents")).first()[0] or 0
    done = None
    level = 0
    while True:
        # A block leaves at most LEFT_OPEN documents open.
        blocks = F.greatest(F.ceil(F.col("documents") / block_rows), F.lit(1))
        dealt = open_units.withColumn("last", blocks == 1).withColumn(
            "block", F.pmod(F.xxhash64(F.lit(level), "key"), blocks)
        )
        flown = map_groups(dealt, ["source", "block"], _fly, _schema(open_units))
        if most <= block_rows:
            return _taken(flown if done is None else done.unionByName(flown))
        flown = via_table(flown, f"mix-level-{level}")
        settled = flown.where("part in (0, 1)")
        done = settled if done is None else done.unionByName(settled)
        open_units = flown.where("part not in (0, 1)").withColumn(
            "documents", LEFT_OPEN * F.ceil(F.col("documents") / block_rows)
        )
        most = LEFT_OPEN * -(-most // block_rows)
        level += 1


def _taken(flown: DataFrame) -> DataFrame:
    return flown.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("whole") + F.col("part").cast("int")).alias("times"),
    )


def _schema(units: DataFrame) -> str:
    kinds = dict(units.dtypes)
    return ", ".join(f"`{name}` {kinds[name]}" for name in units.columns)


def _fly(table: pa.Table) -> pa.Table:
    """One block: flight phase, and the landing phase if the block is its source's last.

    Another block holds back documents at equal steps of the order of sizes.
    """
    names = [name for name in table.column_names if name not in ("last", "block")]
    size = table["size"].to_numpy().astype(float)
    part = table["part"].to_numpy().copy()
    key = table["key"].to_numpy()
    order = np.lexsort((key, -size))  # small documents last, so that little is left open
    seed = zlib.crc32(key[order].tobytes() + size[order].tobytes())
    last = table["last"][0].as_py()
    if not last:
        order = np.delete(order, np.arange(HELD_BACK) * len(order) // HELD_BACK)
    p, x = part[order].tolist(), size[order].tolist()
    open_ones = fly(p, x, random.Random(seed).random)
    if last:
        land(p, x, open_ones, float(part @ size))
    part[order] = p
    return table.set_column(table.column_names.index("part"), "part", pa.array(part)).select(names)


def fly(p: list[float], x: list[float], draw) -> list[int]:
    """Move ``p`` in place, keeping sum(p) and sum(p * x); at most two stay between 0 and 1."""
    live: list[int] = []
    for i, value in enumerate(p):
        if EPSILON < value < 1 - EPSILON:
            live.append(i)
            while len(live) == 3:
                a, b, c = live
                u = (x[c] - x[b], x[a] - x[c], x[b] - x[a])
                if not any(u):
                    u = (1.0, -1.0, 0.0)
                live = _move(p, live, u, draw)
        else:
            p[i] = float(round(value))
    return live


def _move(p: list[float], live: list[int], u: Sequence[float], draw) -> list[int]:
    """One step along ``u`` or against it, so far that one of ``live`` becomes 0 or 1."""
    ahead = min((1 - p[i] if v > 0 else p[i]) / abs(v) for i, v in zip(live, u) if v)
    back = min((p[i] if v > 0 else 1 - p[i]) / abs(v) for i, v in zip(live, u) if v)
    step = ahead if draw() * (ahead + back) < back else -back
    left = []
    for i, v in zip(live, u):
        p[i] += step * v
        if EPSILON < p[i] < 1 - EPSILON:
            left.append(i)
        else:
            p[i] = float(round(p[i]))
    return left


def land(p: list[float], x: list[float], open_ones: list[int], wanted: float) -> None:
    """Settle what is open at the least cost in words, then mend the total by single documents
    as long as one brings it nearer to ``wanted``."""
    for i in open_ones:
        p[i] = 0.0
    sizes, taken = np.array(x), np.array(p)
    if not len(sizes) or not (open_ones or abs(taken @ sizes - wanted) > 0.5):
        return
    while True:  # every flip brings the total nearer, so this ends
        missing = wanted - taken @ sizes
        change = np.where(taken == 0, sizes, -sizes)
        best = int(np.argmin(np.abs(missing - change)))
        if abs(missing - change[best]) >= abs(missing) - EPSILON:
            break
        taken[best] = 1 - taken[best]
    p[:] = taken.tolist()
