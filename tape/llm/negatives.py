"""Hard negatives by exact search in a multiway hyperplane tree.

*Space.* The score of two rows is the inner product of their whole-number
vectors.  With one more component, sqrt(M - |x|^2) for a row (M the greatest
|x|^2) and 0 for an anchor, all rows lie on a sphere, and the squared distance
of anchor q and row x is |q|^2 + M - 2 q.x: a window of scores is an annulus
around the anchor.

*Tree.* Two levels of split points, drawn from a bounded sample of the rows
(about ``SAMPLE_ROWS``).  A row goes to the nearest split point of the root (a
*branch*) and there to the nearest split point of the branch (a *leaf*): the
borders are hyperplanes.  Every split point p stores, for each sibling subtree,
the range of the distances from p to the rows in it, taken over all rows.  By the
triangle inequality a subtree with the range [lo, hi] holds a row at a distance
r1 to r2 from q only if [lo, hi] meets [max(d - r2, r1 - d), d + r2], d being the
distance of q and p; a subtree is searched only if that holds at all split points.

*Search.* A branch's rows are dealt to cells of about ``CELL_ROWS`` rows.  An
anchor goes to the cells of the branches that its annulus may reach; there the
leaves that it may reach are read whole (exact).  A window is searched in the
anchor's own branch first; its k-th best score narrows the annulus for the rest.
Where anchors are many, a cell's are dealt to groups of about ``CELL_ANCHORS``,
so that no task holds more than one cell and one group.

1. positives: the best rows of the anchor's label;
2. negatives: for each positive, the best rows of other labels whose scores are
   ``low`` to ``high`` per cent of the positive's.

Scores are exact whole numbers: products of doubles where |q| |x| proves that no
sum passes 2**53, of 64-bit integers up to 2**62; beyond that it is an error.
Distances are compared with a margin for rounding, which only opens subtrees.

Defined cases: rows without id, label or vector, or with a component that is null
or not finite, take no part; shorter vectors are filled up with zeros; a row is
never its anchor's positive or negative, nor is another one of that id; equal rows
count as often as they come, but equal anchors are searched once; equal
scores rank by id; anchors without positives and positives without negatives
give no rows; an empty table gives none; further columns are ignored, whatever
their names.  Copies, be they a third of all rows, are one leaf in many cells.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .common import staged

#: Rows of the sample that split points come from, and split points of a node.
SAMPLE_ROWS = 4096
FANOUT = 16
#: Rows and anchors that one task joins.
CELL_ROWS = 1 << 15
CELL_ANCHORS = 1 << 15
#: Anchors that are compared with a leaf at once.
STEP = 256
#: Share by which a squared distance may be off (rounding).
SLACK = 1e-9


def prepared(rows: DataFrame, key: str, label: str, vector: str, grain: int) -> DataFrame:
    """(id, label, x): rows that take part, components as whole numbers."""
    plain = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("x"))
    plain = plain.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull())
    plain = plain.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))))
    return plain.withColumn("x", F.transform("x", lambda v: F.floor(v * F.lit(float(grain)))))


def matrix(column, dim: int) -> np.ndarray:
    """Rows of an Arrow list column as whole numbers, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.zeros((len(column), dim), np.int64)
    if len(column):
        values = column.flatten().to_numpy(zero_copy_only=False)
        sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        out[owner, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0))


def spread_points(points: np.ndarray, k: int) -> np.ndarray:
    """Up to ``k`` different points, each the farthest from those before."""
    chosen = [0]
    far = distances(points, points[:1])[:, 0]
    while len(chosen) < k and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


class Tree:
    """Split points of the root (node -1) and of each branch (nodes 0, 1, ...),
    and the distance ranges [point, subtree] of each node."""

    def __init__(self, sample: np.ndarray, dim: int, top: float):
        self.dim, self.top = dim, top
        points = self.lifted(sample)
        root = spread_points(points, FANOUT)
        nearest = distances(points, root).argmin(1)
        self.points = {-1: root, **{b: spread_points(points[nearest == b], FANOUT) if (nearest == b).any() else root[b:b + 1] for b in range(len(root))}}
        self.ranges = {n: np.stack([np.full((len(p), len(p)), np.inf), np.full((len(p), len(p)), -np.inf)], 2) for n, p in self.points.items()}

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Rows on the sphere."""
        x = x.astype(np.float64)
        return np.hstack([x, np.sqrt(np.maximum(self.top - (x * x).sum(1), 0))[:, None]])

    def place(self, x: np.ndarray):
        """(branch, leaf) of rows, and (node, distances, subtree) of each node."""
        y = self.lifted(x)
        d = distances(y, self.points[-1])
        branch, leaf = d.argmin(1), np.zeros(len(y), np.int64)
        seen = [(-1, d, branch)]
        for b in np.unique(branch).tolist():
            of = branch == b
            e = distances(y[of], self.points[b])
            leaf[of] = e.argmin(1)
            seen.append((b, e, leaf[of]))
        return branch, leaf, seen

    def reach(self, node: int, anchors: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """(anchor, subtree): which subtrees of ``node`` may hold rows whose
        scores with the anchors are ``least`` to ``most``."""
        q = np.hstack([anchors.astype(np.float64), np.zeros((len(anchors), 1))])
        size = (q * q).sum(1) + self.top
        slack = SLACK * size + 1e-6
        far = np.sqrt(np.maximum(size - 2.0 * least + slack, 0))[:, None]
        near = np.sqrt(np.maximum(size - 2.0 * most - slack, 0))[:, None]
        d, margin = distances(q, self.points[node]), np.sqrt(slack)[:, None]
        low, high = np.maximum(d - far, near - d) - margin, d + far + margin
        ranges = self.ranges[node]
        meets = (ranges[None, :, :, 0] <= high[:, :, None]) & (ranges[None, :, :, 1] >= low[:, :, None])
        return meets.all(1) & (least <= most)[:, None]


def grown_tree(rows: DataFrame) -> tuple[Tree, float, str]:
    """A tree over ``rows`` without its ranges, the bound of all scores and the
    smallest type of a component."""
    norm = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("dim"), F.max(norm).alias("top"),
                     F.max(F.array_max(F.transform("x", F.abs))).alias("most")).first()
    if not facts["n"]:
        return None, 0.0, "bigint"
    top, most = float(facts["top"]), facts["most"] or 0
    if top >= 2.0 ** 62:
        raise ValueError("scores may need more than 64 bits")
    found = rows.sample(min(1.0, SAMPLE_ROWS / facts["n"]), seed=23).select("x").toArrow()
    if not found.num_rows:
        found = rows.select("x").limit(1).toArrow()
    kind = "smallint" if most < 1 << 15 else "int" if most < 1 << 31 else "bigint"
    return Tree(matrix(found.column("x"), facts["dim"]), facts["dim"], top), top, kind


def placed(rows: DataFrame, tree: Tree, kind: str) -> DataFrame:
    """(id, label, x, branch, leaf) of all rows."""
    def place(batches):
        for batch in batches:
            branch, leaf, _ = tree.place(matrix(batch.column("x"), tree.dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(branch, pa.int32()), pa.array(leaf, pa.int32())], names=["id", "label", "x", "branch", "leaf"])

    small = rows.withColumn("x", F.col("x").cast(f"array<{kind}>"))
    return small.mapInArrow(place, f"id long, label long, x array<{kind}>, branch int, leaf int")


def learn_ranges(tree: Tree, rows: DataFrame) -> None:
    """The distance ranges over all rows: FANOUT**3 + FANOUT**2 at most."""
    def ranges(batches):
        low, high = ({n: np.full((len(p), len(p)), v) for n, p in tree.points.items()} for v in (np.inf, -np.inf))
        for batch in batches:
            for node, d, subtree in tree.place(matrix(batch.column("x"), tree.dim))[2]:
                for s in np.unique(subtree).tolist():
                    of = d[subtree == s]
                    low[node][:, s] = np.minimum(low[node][:, s], of.min(0))
                    high[node][:, s] = np.maximum(high[node][:, s], of.max(0))
        for node in low:
            p, s = np.nonzero(low[node] <= high[node])
            if len(p):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), node), pa.int32()), pa.array(p, pa.int32()), pa.array(s, pa.int32()), pa.array(low[node][p, s]), pa.array(high[node][p, s])], names=["node", "point", "subtree", "low", "high"])

    found = rows.select("x").mapInArrow(ranges, "node int, point int, subtree int, low double, high double")
    for r in found.groupBy("node", "point", "subtree").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        tree.ranges[r["node"]][r["point"], r["subtree"]] = r["low"], r["high"]


def visits(anchors: DataFrame, tree: Tree, home: bool) -> DataFrame:
    """``anchors`` once for each branch they must visit: their own one
    (``home``), or the others that their windows reach."""
    def rows(batches):
        for batch in batches:
            x = matrix(batch.column("x"), tree.dim)
            own = tree.place(x)[0]
            if home:
                go = np.zeros((len(x), len(tree.points[-1])), bool)
                go[np.arange(len(x)), own] = True
            else:
                least, most = spans(batch)
                go = tree.reach(-1, x, least, most)
                go[np.arange(len(x)), own] = False
            who, branch = np.nonzero(go)
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(who)) for c in batch.columns), pa.array(branch, pa.int32())], names=[*batch.schema.names, "branch"])

    return anchors.mapInArrow(rows, StructType([*anchors.schema.fields, StructField("branch", IntegerType())]))


def spans(table) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score over each anchor's windows."""
    least, most = (np.array([f(v) for v in table.column(c).to_pylist()], np.int64) for c, f in (("least", min), ("most", max)))
    return least, most


def best_of(scores: np.ndarray, fits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the ``k`` best fitting scores of each row, the first place
    of equal ones first."""
    width = scores.shape[1]
    if width > k:
        # one number for score and place, so that ties need no second look
        whole = np.where(fits, scores, np.iinfo(np.int64).min // (2 * width)) * width + np.arange(width - 1, -1, -1)
        at = np.argpartition(whole, width - k, axis=1)[:, width - k:]
    else:
        at = np.broadcast_to(np.arange(width), scores.shape)
    row, place = np.repeat(np.arange(len(at)), at.shape[1]), at.ravel()
    good = fits[row, place]
    return row[good], place[good]


def search_cell(tree: Tree, k: int, same: bool, bound: float):
    """A function (key, rows, anchors) -> (anchor, window, score, id): the ``k``
    best of the rows in each window of each anchor."""
    kind = np.float64 if bound < 2.0 ** 53 else np.int64
    names = ["anchor", "window", "score", "other"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def leaf_best(x, ids, labels, q, group, least, most, valid):
        scores = (q @ x.T).astype(np.int64)
        allowed = ((labels[None, :] == group["label"][:, None]) == same) & (ids[None, :] != group["id"][:, None])
        for w in range(least.shape[1]):
            fits = allowed & (scores >= least[:, w, None]) & (scores <= most[:, w, None]) & valid[:, w, None]
            row, place = best_of(scores, fits, k) if fits.any() else (np.zeros(0, np.int64),) * 2
            yield row, np.full(len(row), w), scores[row, place], ids[place]

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in types], names=names)
        leaf, ids, labels = (rows.column(c).to_numpy() for c in ("leaf", "id", "label"))
        order = np.lexsort((ids, leaf))
        leaf, ids, labels = leaf[order], ids[order], labels[order]
        x = matrix(rows.column("x"), tree.dim)[order].astype(kind)
        ends = np.append(np.flatnonzero(np.diff(leaf, prepend=leaf[0] - 1)), len(leaf))
        found = []
        for i in range(0, anchors.num_rows, STEP):
            part = anchors.slice(i, STEP)
            q = matrix(part.column("x"), tree.dim)
            lists = [part.column(c).to_pylist() for c in ("least", "most")]
            wide = max(map(len, lists[0]))
            least, most = (np.array([v + [0] * (wide - len(v)) for v in ls], np.int64) for ls in lists)
            valid = np.arange(wide)[None, :] < np.array([len(v) for v in lists[0]])[:, None]
            group = {c: part.column(c).to_numpy() for c in ("id", "label", "anchor")}
            go = tree.reach(key[0].as_py(), q, *spans(part))
            best = []
            for a, b in zip(ends[:-1], ends[1:]):
                who = np.flatnonzero(go[:, leaf[a]])
                if len(who):
                    some = {c: v[who] for c, v in group.items()}
                    for row, w, score, other in leaf_best(x[a:b], ids[a:b], labels[a:b], q[who].astype(kind), some, least[who], most[who], valid[who]):
                        best.append((who[row], w, score, other))
            if best:
                row, w, score, other = (np.concatenate(v) for v in zip(*best))
                order = np.lexsort((other, -score, w, row))
                row, w, score, other = row[order], w[order], score[order], other[order]
                new = np.flatnonzero(np.diff(row * wide + w, prepend=-1))
                rank = np.arange(len(row)) - np.repeat(new, np.diff(np.append(new, len(row))))
                keep = rank < k
                found.append((group["anchor"][row[keep]], w[keep], score[keep], other[keep]))
        columns = [np.concatenate(v) for v in zip(*found)] if found else [[]] * 4
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(columns, types)], names=names)

    return run


class Index:
    """All rows, dealt to the cells of a tree."""

    def __init__(self, rows: DataFrame):
        self.tree, self.bound, kind = grown_tree(rows)
        if self.tree:
            self.rows = staged(placed(rows, self.tree, kind), "negatives-rows")
            learn_ranges(self.tree, self.rows)
            sizes = {r["branch"]: r["count"] for r in self.rows.groupBy("branch").count().collect()}
            self.cells = [-(-sizes.get(b, 0) // CELL_ROWS) or 1 for b in range(len(self.tree.points[-1]))]

    def look(self, anchors: DataFrame, n_anchors: int, k: int, same: bool, home: bool) -> DataFrame:
        groups = -(-n_anchors // CELL_ANCHORS) or 1
        of = F.element_at(F.array(*map(F.lit, self.cells)), F.col("branch") + 1)
        rows = self.rows.withColumn("cell", F.pmod(F.xxhash64(F.monotonically_increasing_id()), of))
        rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        gone = visits(anchors, self.tree, home).withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), of.cast("long") - 1)))
        gone = gone.withColumn("part", F.pmod(F.xxhash64("anchor", F.lit(1)), F.lit(groups)).cast("int"))
        keys = ["branch", "cell", "part"]
        return rows.groupBy(*keys).cogroup(gone.groupBy(*keys)).applyInArrow(
            search_cell(self.tree, k, same, self.bound), "anchor long, window int, score long, other long")

    def best(self, anchors: DataFrame, k: int, same: bool, name: str) -> DataFrame:
        """(anchor, window, rank, score, other) of the ``k`` best rows in every
        window of ``anchors`` (anchor, id, label, x, least, most)."""
        n = anchors.count()
        top = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "other")
        near = staged(self.look(anchors, n, k, same, True).withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k), f"{name}-home")
        raised = near.where(F.col("rank") == k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("kth"))
        floor = F.transform("least", lambda v, w: F.greatest(v, F.coalesce(F.try_element_at("kth", w), v)))
        rest = anchors.join(raised, "anchor", "left").withColumn("least", F.when(F.col("kth").isNull(), F.col("least")).otherwise(floor)).drop("kth")
        found = near.drop("rank").unionByName(self.look(rest.select(anchors.columns), n, k, same, False))
        return found.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   key: str = "vec_id", label: str = "label", vector: str = "embedding", grain: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each anchor (ids divisible by ``every``) and each of its
    best ``positives``, the best ``negatives`` rows of other labels in the window."""
    plain = prepared(rows, key, label, vector, grain)
    index = Index(plain)
    if index.tree is None:
        return plain.select(F.col("id").alias("anchor_id"), F.col("id").alias("positive_id"), F.lit(1).alias("rank"), F.col("id").alias("negative_id"),
                            F.col("id").alias("positive_score"), F.col("id").alias("negative_score"))
    bound = int(index.bound) + 1
    chosen = index.rows.where(F.col("id") % every == 0).select(F.xxhash64("id", "label", "x").alias("anchor"), "id", "label", "x").distinct()
    anchors = staged(chosen.withColumn("least", F.array(F.lit(-bound).cast("long"))).withColumn("most", F.array(F.lit(bound).cast("long"))), "negatives-anchors")
    good = staged(index.best(anchors, positives, True, "positives").select("anchor", F.col("rank").alias("place"), F.col("other").alias("positive"), F.col("score").alias("positive_score")), "positives")
    # 100 * score between low and high times the positive's, in whole numbers that do not overflow
    good = good.withColumn("odd", F.pmod("positive_score", F.lit(100))).withColumn("hundreds", F.expr("(positive_score - odd) div 100"))
    least, most = F.expr(f"{low} * hundreds + ({low} * odd + 99) div 100"), F.expr(f"{high} * hundreds + ({high} * odd) div 100")
    windows = good.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", least.alias("least"), most.alias("most")))).alias("w"))
    asked = staged(anchors.drop("least", "most").join(windows, "anchor").select("anchor", "id", "label", "x", F.col("w.least").alias("least"), F.col("w.most").alias("most")), "negatives-asked")
    found = index.best(asked, negatives, False, "negatives").withColumn("place", F.col("window") + 1)
    named = found.join(good.drop("odd", "hundreds"), ["anchor", "place"]).join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor")
    return named.select("anchor_id", F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
