"""Near-copies among embeddings: exact pairs over a cosine threshold, by dual traversal of cover trees.

On unit vectors cosine >= c is a distance of at most sqrt(2 - 2c).  Equal vectors of a label are one vector with a weight.
The rest is dealt to the nearest of a bounded number of pivots of its label; cells too far apart for their covering radii
are never compared, large cells are cut into blocks, and every other pair of blocks is one task of bounded size.  In a
task each block becomes a cover tree: nested levels of centres whose radius halves, each node knowing how far its members
reach.  Two nodes are dropped if their centres are farther apart than both reaches and the threshold, linked as a whole
if even their farthest members are near enough, and split otherwise; what is left is compared in double precision.
Tasks return sums of links for each vector and a spanning forest, never all pairs, so large groups of near-copies stay
linear in output.

Vectors without direction or pivots too many to matter: in data without clusters no metric bound prunes the upper levels,
and the comparisons grow with the square of a label's distinct vectors.

Defined results: null, empty and zero vectors, vectors with null or non-finite components and rows without label link
with nothing and are kept; vectors of unequal length never link; vectors of any finite size are compared, as each is
divided by its largest component first; the rows of an id are one node of the graph, and each gives the id's result; a
null id ties nothing; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import settled, table
from tallyforge.llm.graph import components

THRESHOLD = 0.98
#: Pivots in all (shipped to the executors), vectors of a cell that has one, vectors of a block.
PIVOTS, CELL, BLOCK = 2048, 2048, 2048
#: Node pairs of so few member pairs are compared directly; slack of the bounds against rounding.
DIRECT, SLACK = 4096, 1e-6


class CoverTree:
    """Nodes as arrays: centre (a row), reach (farthest member), members, children."""

    def __init__(self, unit: np.ndarray):
        self.unit, self.centre, self.reach, self.members, self.children = unit, [], [], [], []
        todo = []
        if len(unit):
            rows = np.arange(len(unit))
            todo.append((self.node(0, rows, self.far(0, rows)), 1.0))
        while todo:
            node, radius = todo.pop()
            rows = self.members[node]
            if len(rows) * len(rows) <= DIRECT or self.reach[node] <= SLACK:
                continue
            kids, left, centre = [], rows, self.centre[node]
            while len(left):  # the node's own centre is the first child's: levels are nested
                d = self.far(centre, left)
                near = d <= radius
                near[left == centre] = True
                kids.append(self.node(centre, left[near], d[near]))
                left = left[~near]
                if len(left):
                    centre = int(left[0])
            if len(kids) == 1:
                radius_next = max(radius / 2, self.reach[kids[0]] / 2)
                self.centre.pop(), self.reach.pop(), self.members.pop(), self.children.pop()
                todo.append((node, radius_next))
                continue
            self.children[node] = kids
            todo += [(k, radius / 2) for k in kids]

    def far(self, centre: int, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 - 2 * (self.unit[rows] @ self.unit[centre])))

    def node(self, centre: int, rows: np.ndarray, d: np.ndarray) -> int:
        self.centre.append(centre)
        self.reach.append(float(d.max()))
        self.members.append(rows)
        self.children.append([])
        return len(self.centre) - 1


def near_pairs(a: CoverTree, b: CoverTree, raw_a: np.ndarray, raw_b: np.ndarray, threshold: float):
    """Yields (rows of a, rows of b): lists of linked pairs, or with the third value True all pairs between the two lists.

    A tree with itself gives each pair of two rows once.
    """
    same, eps = a is b, float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    norm_a, norm_b = np.linalg.norm(raw_a, axis=1), np.linalg.norm(raw_b, axis=1)
    todo = [(0, 0)] if len(raw_a) and len(raw_b) else []
    while todo:
        x, y = todo.pop()
        rows, cols = a.members[x], b.members[y]
        kids_x, kids_y = a.children[x] or [x], b.children[y] or [y]
        if (kids_x == [x] and kids_y == [y]) or len(rows) * len(cols) <= DIRECT:
            cos = (raw_a[rows] @ raw_b[cols].T) / (norm_a[rows][:, None] * norm_b[cols])
            i, j = np.nonzero(cos >= threshold)
            i, j = rows[i], cols[j]
            if same and x == y:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j, False
            continue
        d = np.sqrt(np.maximum(0, 2 - 2 * (a.unit[[a.centre[k] for k in kids_x]] @ b.unit[[b.centre[k] for k in kids_y]].T)))
        reach = np.array([a.reach[k] for k in kids_x])[:, None] + np.array([b.reach[k] for k in kids_y])
        keep = d <= reach + eps + SLACK
        whole = d + reach <= eps - SLACK
        if same and x == y:
            keep &= np.arange(len(kids_x))[:, None] <= np.arange(len(kids_y))
            whole &= np.arange(len(kids_x))[:, None] < np.arange(len(kids_y))
        for i, j in zip(*np.nonzero(keep), strict=True):
            if whole[i, j]:
                yield a.members[kids_x[i]], b.members[kids_y[j]], True
            else:
                todo.append((kids_x[i], kids_y[j]))


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def task_links(left: np.ndarray, right: np.ndarray | None, weight: np.ndarray, threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of each row (left's rows, then right's), by weight, and a forest that spans them."""
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    a = CoverTree(unit(left))
    b = a if right is None else CoverTree(unit(right))
    other = left if right is None else right
    shift = 0 if right is None else len(left)
    links, forest, edges = np.zeros(len(weight), np.int64), _Forest(len(weight)), []
    for i, j, whole in near_pairs(a, b, left, other, threshold):
        j = j + shift
        if whole:
            links[i] += weight[j].sum()
            links[j] += weight[i].sum()
            pairs = [(int(i[0]), int(y)) for y in j] + [(int(x), int(j[0])) for x in i[1:]]
        else:
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            pairs = zip(i.tolist(), j.tolist(), strict=True)
        edges += [p for p in pairs if forest.join(*p)]
    return links, edges


def linked(vectors: DataFrame, vec: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """Per vector: vec, n_links, component_id, kept."""
    spark = vectors.sparkSession
    e = F.col(embedding).cast("array<double>")
    sound = F.coalesce(F.col(label).isNotNull() & (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0), F.lit(False))
    base = vectors.select(F.col(vec).alias("v"), F.col(label).alias("l"), e.alias("e"), sound.alias("ok"))
    largest = F.array_max(F.transform("e", F.abs))
    keyed = base.where("ok").withColumn("e", F.transform("e", lambda x: x / largest)).withColumn("key", F.sha2(F.concat_ws(",", F.transform("e", lambda x: (x + 0.0).cast("string"))).cast("binary"), 256))
    reps = keyed.groupBy("l", "key").agg(F.min("v").alias("rep"), F.count("*").alias("w"), F.first("e").alias("e"))
    reps = settled(reps.withColumn("dim", F.size("e")))

    n = reps.count()
    order = F.xxhash64("key", F.lit(3)).bitwiseAND(F.lit(0xFFFFFF)) / 0x1000000
    chosen = reps.where(order < min(1 / CELL, 0.75 * PIVOTS / max(1, n))).select("l", "dim", "e").orderBy("l", "dim", "e").limit(PIVOTS).collect()
    pivots: dict[tuple, tuple[int, np.ndarray]] = {}
    for k, r in enumerate(chosen):
        first, m = pivots.get((r.l, r.dim), (k, np.empty((0, r.dim))))
        v = np.array(r.e)
        pivots[r.l, r.dim] = first, np.vstack([m, v / np.linalg.norm(v)])
    ship = spark.sparkContext.broadcast(pivots)

    def assign(batches):
        for b in batches:
            cell, d = np.full(b.num_rows, -1, np.int64), np.full(b.num_rows, 2.0)
            col = lambda c: b.column(b.schema.get_field_index(c))  # noqa: B023, E731
            where: dict[tuple, list[int]] = {}
            for k, key in enumerate(zip(col("l").to_pylist(), col("dim").to_pylist(), strict=True)):
                where.setdefault(key, []).append(k)
            for key, rows in where.items():
                if key in ship.value:
                    first, m = ship.value[key]
                    x = np.array(col("e").take(pa.array(rows)).flatten()).reshape(len(rows), -1)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    gap = np.sqrt(np.maximum(0, 2 - 2 * (x @ m.T)))
                    cell[rows], d[rows] = first + gap.argmin(axis=1), gap.min(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(d)], [*b.schema.names, "cell", "d"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in reps.schema)
    dealt = settled(reps.mapInArrow(assign, f"{fields}, cell long, d double"))
    cells = dealt.groupBy("l", "dim", "cell").agg(F.count("*").alias("n"), F.max("d").alias("r")).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    stats = {r.cell: r for r in cells.where("cell >= 0").collect()}  # a row for each pivot
    eps = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    close = []
    for first, m in pivots.values():
        own = [k for k in range(len(m)) if first + k in stats]
        gap = np.sqrt(np.maximum(0, 2 - 2 * (m @ m.T)))
        close += [(first + i, first + j, stats[first + i].blocks, stats[first + j].blocks) for i in own for j in own if i <= j and gap[i, j] <= stats[first + i].r + stats[first + j].r + eps + SLACK]
    pairs = spark.createDataFrame(close, "c1 long, c2 long, b1 int, b2 int")
    # Every block names the tasks it takes part in: (cell, block) x (cell, block), the lesser first.
    block = F.pmod(F.xxhash64("key", F.lit(5)), F.col("blocks")).cast("int")
    rows = dealt.join(cells.select("l", "dim", "cell", "blocks"), ["l", "dim", "cell"]).withColumn("block", block)
    inner = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")).select(
        "rep", "w", "e", F.struct("l", "dim", "cell", F.least("block", "o").alias("x"), F.col("cell").alias("cell2"), F.greatest("block", "o").alias("y")).alias("task"), (F.col("block") > F.col("o")).alias("second"),
    )
    apart = pairs.where("c1 <> c2")
    outer1 = rows.join(F.broadcast(apart), rows["cell"] == apart["c1"]).select("*", F.explode(F.sequence(F.lit(0), F.col("b2") - 1)).alias("o")).select("rep", "w", "e", F.struct("l", "dim", "cell", F.col("block").alias("x"), F.col("c2").alias("cell2"), F.col("o").alias("y")).alias("task"), F.lit(False).alias("second"))
    outer2 = rows.join(F.broadcast(apart), rows["cell"] == apart["c2"]).select("*", F.explode(F.sequence(F.lit(0), F.col("b1") - 1)).alias("o")).select("rep", "w", "e", F.struct("l", "dim", F.col("c1").alias("cell"), F.col("o").alias("x"), F.col("c2").alias("cell2"), F.col("block").alias("y")).alias("task"), F.lit(True).alias("second"))
    work = inner.unionAll(outer1).unionAll(outer2).withColumn("key", F.xxhash64("task")).withColumn("self", (F.col("task.cell") == F.col("task.cell2")) & (F.col("task.x") == F.col("task.y"))).drop("task")

    rep_kind = next(f.dataType.simpleString() for f in reps.schema if f.name == "rep")

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        col = lambda c: group.column(c)
        x = np.array(col("e").combine_chunks().flatten()).reshape(group.num_rows, -1)
        second = np.array(col("second").to_pylist())
        order = np.argsort(second, kind="stable")
        rep, w, n = col("rep").take(pa.array(order)), col("w").to_numpy()[order], int((~second).sum())
        x = x[order]
        if col("self")[0].as_py():
            links, edges = task_links(x, None, w, threshold)
        elif 0 < n < len(x):
            links, edges = task_links(x[:n], x[n:], w, threshold)
        else:
            links, edges = np.zeros(len(x), np.int64), []
        at = np.flatnonzero(links)
        a = rep.take(pa.array([*at.tolist(), *(i for i, _ in edges)], pa.int64()))
        b = pa.concat_arrays([pa.nulls(len(at), rep.type), *rep.take(pa.array([j for _, j in edges], pa.int64())).chunks]) if edges else pa.nulls(len(at), rep.type)
        return pa.table({"a": a, "b": b, "n": pa.array([*links[at].tolist(), *([0] * len(edges))], pa.int64())})

    found = settled(work.groupBy("key").applyInArrow(compare, f"a {rep_kind}, b {rep_kind}, n long"))
    links = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    ids = settled(keyed.select("v", "l", "key").join(reps.select("l", "key", "rep", "w"), ["l", "key"]))
    # ids with rows of different vectors tie these vectors
    tied = ids.where("v IS NOT NULL AND rep IS NOT NULL AND v <> rep").join(ids.groupBy("v").agg(F.min("rep").alias("m"), F.max("rep").alias("x")).where("m <> x").select("v"), "v", "left_semi").select(F.col("v").alias("a"), F.col("rep").alias("b"))
    joined = components(found.where("a is not null and b is not null").select("a", "b").union(tied))
    ids = ids.join(links.withColumnRenamed("a", "rep"), "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    own = ids.groupBy("v").agg(F.max(F.col("w") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.min(F.coalesce("component", "rep")).alias("component_id"))
    out = vectors.select(F.col(vec).alias("v")).join(own, "v", "left")
    return out.select(F.col("v").alias(vec), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "v").alias("component_id")).withColumn("kept", F.col(vec).eqNullSafe(F.col("component_id")))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "embeddings"))
