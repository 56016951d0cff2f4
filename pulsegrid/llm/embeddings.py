"""Embedding near-duplicates by collision-counting projections."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.graph import components, landed

#: Cells of more vectors than this are dealt to several tasks, by pairs of parts.
PART = 20_000
STRIP = 256
SEED = 11
#: Widths in standard deviations of a threshold pair's difference on one projection: of a cell, and of half a window.
CELL, HALF_WINDOW = 6.0, 1.5
#: Projections whose windows are counted: enough to tell unrelated pairs, with a quarter of collisions, from near ones.
COUNTED = 32


class Plan(NamedTuple):
    """Projections in ``groups`` of ``per_group``; a pair is counted where it shares all cells of a group, and verified if
    of the first ``counted`` projections at least ``least`` lie in the window of ``half`` to either side of the query's."""

    groups: int
    per_group: int
    counted: int
    least: int
    cell: float
    half: float

    @property
    def projections(self) -> int:
        return self.groups * self.per_group


def _phi(x: float) -> float:
    return math.erf(x / math.sqrt(2))


def _same_cell(width: float) -> float:
    """P(two points whose difference is N(0, 1) share a cell of this width and random offset)."""
    return _phi(width) - math.sqrt(2 / math.pi) / width * (1 - math.exp(-width * width / 2))


def calibrate(n: int, dim: int, threshold: float, miss: float = 1e-3) -> Plan:
    """Parameters under which a pair at the threshold is missed with probability ``miss`` at most, nearer ones less.

    More vectors get more projections a group, so that a cell keeps some 256 unrelated vectors at any size; as many groups
    follow as the recall needs. The count asked for is the largest that a pair at the threshold reaches with
    probability 1 - ``miss`` / 2.
    """
    deviation = math.sqrt(max(1e-12, 2 - 2 * threshold) / dim)
    near, far = _same_cell(CELL), _same_cell(CELL * math.sqrt((2 - 2 * threshold) / 2))
    per_group = max(2, math.ceil(math.log(max(2.0, n / 256)) / -math.log(far)))
    groups = math.ceil(math.log(miss / 2) / math.log(1 - near**per_group))
    m, p = min(COUNTED, groups * per_group), _phi(HALF_WINDOW)
    below, least = 0.0, 0
    for k in range(m + 1):
        below += math.comb(m, k) * p**k * (1 - p) ** (m - k)
        if below > miss / 2:
            break
        least = k + 1
    return Plan(groups, per_group, m, least, CELL * deviation, HALF_WINDOW * deviation)


def _directions(dim: int, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dim])
    a = rng.standard_normal((dim, plan.projections))
    return a / np.linalg.norm(a, axis=0), rng.uniform(0, plan.cell, plan.projections)


def _units(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors in double precision) for each length of the vectors of a list column."""
    sizes = np.diff(column.offsets.to_numpy())
    flat, starts = column.values.to_numpy(zero_copy_only=False).astype(np.float64), column.offsets.to_numpy()[:-1]
    out = []
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        v = flat[starts[rows][:, None] + np.arange(size)]
        if size:  # by a power of two, which is exact, so that squares neither overflow nor vanish
            v = np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])
        out.append((rows, v / np.linalg.norm(v, axis=1, keepdims=True)))
    return out


def _links(x: np.ndarray, plan: Plan, threshold: float, split: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of rows of unit vectors that pass count and cosine, each once, strip by strip.

    Of each strip of queries the windows are counted on all ``counted`` projections at once. With ``split`` (False or True a
    row) only pairs across it are looked at.
    """
    a, _ = _directions(x.shape[1], plan)
    columns = np.ascontiguousarray((x @ a[:, :plan.counted]).T.astype(np.float32))
    for lo in range(0, len(x), STRIP):
        hi = min(lo + STRIP, len(x))
        count = np.zeros((hi - lo, len(x) - lo), np.uint8)
        for c in columns:
            count += np.abs(c[lo:hi, None] - c[None, lo:]) <= plan.half
        i, j = np.nonzero(count >= plan.least)
        i, j = i + lo, j + lo
        keep = i < j if split is None else (i < j) & (split[i] != split[j])
        i, j = i[keep], j[keep]
        for at in range(0, len(i), 1 << 16):
            s, t = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
            near = np.einsum("nd,nd->n", x[s], x[t]) >= threshold
            yield s[near], t[near]


def _cell_links(ids, times, units, cells, group, split, plan, threshold):
    """What one cell adds: (id, links) counts of the pairs that this group owns, and star edges (id, root)."""
    n = np.zeros(len(ids), np.int64)
    root = np.arange(len(ids))
    for i, j in _links(units, plan, threshold, split):
        own = np.ones(len(i), bool) if group == 0 else ~(cells[i, :group] == cells[j, :group]).any(axis=1)
        np.add.at(n, i[own], times[j[own]])
        np.add.at(n, j[own], times[i[own]])
        while True:  # union of the strip's pairs: hook the larger root to the smaller, then shorten the paths
            a, b = root[i], root[j]
            if (a == b).all():
                break
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    least = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(least, root, ids)
    return n, least[root]


def _keyed(vectors: DataFrame, plans: dict[int, Plan]) -> DataFrame:
    """A row for each vector and group of the plan for its length, with the group's cell and all cells of the vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _units(batch.column("embedding")):
                plan = plans[x.shape[1]]
                weights = np.random.default_rng(SEED + 1).integers(1, 1 << 62, (plan.groups, plan.per_group), np.int64) | 1
                a, offset = _directions(x.shape[1], plan)
                at = np.floor((x @ a + offset) / plan.cell).astype(np.int64).reshape(len(x), plan.groups, plan.per_group)
                with np.errstate(over="ignore"):
                    cells = (at * weights).sum(axis=2) * 1_000_003 + x.shape[1]
                own = batch if len(rows) == batch.num_rows else batch.take(pa.array(rows))
                all_cells = pa.FixedSizeListArray.from_arrays(pa.array(cells.ravel()), plan.groups).cast(pa.list_(pa.int64()))
                for g in range(plan.groups):
                    yield pa.RecordBatch.from_arrays(
                        [*own.columns, all_cells, pa.array(np.full(len(rows), g)), pa.array(cells[:, g])],
                        ["id", "times", "embedding", "cells", "grp", "cell"])

    kind = vectors.schema["embedding"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id long, times long, embedding {kind}, cells array<long>, grp long, cell long")


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """``(id, n_links, component_id)`` of every row of ``rows``.

    Two rows link if the cosine of their vectors in double precision is at least ``threshold``; n_links counts the other rows
    linked directly, component_id is the smallest id reachable, itself included. Null, empty and zero vectors and those with
    null or non-finite components link with nothing, as do vectors of different lengths. Equal vectors, however many, are
    searched for once and link with each other; repeated rows count as rows. An empty table gives no rows.

    Pairs are found by counting collisions (see ``calibrate``, by the number of vectors of each length): the pairs of a cell are counted, verified and added up
    inside its task, by the first group of projections that they share a cell of, and leave it as counts and one edge a row.
    """
    table = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("embedding"))
    odd = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = F.col("embedding").isNotNull() & ~odd & F.exists("embedding", lambda v: v != 0)
    distinct = landed(
        table.where(usable).groupBy("embedding").agg(F.min("id").alias("first"), F.count("*").alias("times"))
        .select(F.monotonically_increasing_id().alias("id"), "first", "times", "embedding"), "vectors")
    sizes = distinct.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).collect()
    plans = {r["dim"]: calibrate(r["n"], r["dim"], threshold) for r in sizes}
    keyed = _keyed(distinct.select("id", "times", "embedding"), plans)
    hot = (_keyed(distinct.select("id", "times", "embedding"), plans).groupBy("grp", "cell").agg(F.count("*").alias("__n"))
           .where(F.col("__n") > PART).select("grp", "cell", F.ceil(F.col("__n") / PART).alias("parts")))
    hot = landed(hot, "hot-cells")
    none = F.array(F.struct(F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high")))
    if hot.take(1):
        mine = F.pmod(F.xxhash64("id"), F.col("parts"))
        dealt = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1),
                            lambda x: F.struct(F.least(mine, x).alias("low"), F.greatest(mine, x).alias("high")))
        keyed = keyed.join(hot, ["grp", "cell"], "left").withColumn("deal", F.explode(F.when(F.col("parts").isNotNull(), dealt).otherwise(none)))
        part = F.when(F.col("parts").isNotNull(), mine).otherwise(F.lit(0).cast("long"))
    else:
        keyed = keyed.withColumn("deal", F.explode(none))
        part = F.lit(0).cast("long")
    dealt = keyed.select("grp", "cell", F.col("deal.low").alias("low"), F.col("deal.high").alias("high"), part.alias("part"),
                         "id", "times", "cells", "embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def cells_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
            table = table.combine_chunks()
            keys = np.column_stack([table.column(k).to_numpy() for k in ("grp", "cell", "low", "high")])
            bound = np.concatenate(([0], np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1, [len(keys)]))
            counts: list[np.ndarray] = []
            for lo, hi in zip(bound[:-1].tolist(), bound[1:].tolist()):
                if hi - lo < 2:
                    continue
                cell = table.slice(lo, hi - lo)
                ids, times, part = (cell.column(c).to_numpy() for c in ("id", "times", "part"))
                split = None if keys[lo, 2] == keys[lo, 3] else part == keys[lo, 2]
                all_cells = np.stack(cell.column("cells").to_numpy())
                ((_, units),) = _units(cell.column("embedding").combine_chunks())
                n, root = _cell_links(ids, times, units, all_cells, int(keys[lo, 0]), split, plans[units.shape[1]], threshold)
                some = np.flatnonzero((n > 0) | (root != ids))
                counts.append(np.column_stack([ids[some], n[some], root[some]]))
            if counts and sum(map(len, counts)):
                found = np.concatenate(counts)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, i]) for i in range(3)], ["id", "n", "root"])

        for batch in batches:
            key = [batch.column(c).to_numpy() for c in range(4)]
            change = np.flatnonzero(np.any([np.diff(k) != 0 for k in key], axis=0)) + 1
            cut = int(change[-1]) if len(change) else 0
            if kept and all(k[0] == kept[-1].column(c)[-1].as_py() for c, k in enumerate(key)) and not cut:
                kept.append(batch)
                continue
            if kept or cut:
                yield from cells_of(pa.Table.from_batches([*kept, *([batch.slice(0, cut)] if cut else [])]))
            kept = [batch.slice(cut)]
        if kept:
            yield from cells_of(pa.Table.from_batches(kept))

    keys = ["grp", "cell", "low", "high"]
    found = landed(dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "id long, n long, root long"), "links")
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    roots = components(found.where(F.col("root") != F.col("id")).select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = (distinct.join(links, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
             .withColumn("root", F.coalesce("root", "id")))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of = named.join(least, "root").select(
        "embedding", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component_id")
    linked = table.where(usable).join(of, "embedding").select("id", "n_links", "component_id")
    return linked.union(table.where(F.coalesce(~usable, F.lit(True))).select("id", F.lit(0).cast("long"), "id"))
