"""Operator 9 — embedding near-duplicates by a cover-tree dual traversal.

Vectors of one label (and one dimension) with cosine >= ``COSINE`` are linked. On
unit vectors that is a distance of at most sqrt(2 - 2 * cosine).

1. Equal vectors of a label form a class; its size counts, its copies do not.
2. Upper levels, as Spark tables: nodes with more than ``LEAF`` vectors are split.
   Centres are a net of the level's radius (halved from level to level) among a hash
   sample of the node, about two for each ``LEAF`` of its members; every vector goes to
   its nearest centre, and the covering radius of each child is then measured over all
   its members, so bounds are exact whatever the sample was.
3. Dual traversal, as joins: starting with each root against itself, node pairs are
   expanded to pairs of children level by level; a pair is pruned if the distance
   of its centres less both radii exceeds the limit, and taken whole, without
   comparing members, if the distance plus both radii stays within it.
4. Lower levels: a leaf's members are dealt to blocks of bounded size, and each block
   becomes nested levels of radius 1, 1/2, 1/4 ... once: a node's members are within the
   level's radius of its centre, itself a member, and centres below one parent are
   farther apart than that radius.
5. Block pairs of the leaf pairs that are left go on with the dual traversal in the tasks,
   with the same two bounds level by level; only members of node pairs that neither bound
   settles are compared, exactly, in double precision. A unit returns per vector its number
   of links and one neighbour that keeps the components connected, not its pairs.

A vector is sent to the blocks its leaf is not pruned from: fewer than 10 rows for each of
50,000 vectors of 10 labels without any structure. Where vectors have none, centres of all
levels down to near copies are about equally far apart and every pair of centres is looked at,
as with any bound by radius.

Cases: a vector that is NULL, empty, zero, or holds NULL or non-finite parts links
with nothing, nor does one with a NULL label or a NULL id; repeated rows are
vectors of their own; other dimensions never link; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import save
from churnlens.llm.components import components

COSINE = 0.98
LEAF = 2048
SAMPLE = 48
LEVELS = 6
NESTED = 8          # lower levels at most
_SLACK = 1e-7       # keeps rounding from deciding a bound; it only costs comparisons


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def classes_of(vectors: DataFrame) -> DataFrame:
    """(node, vec, rep, m): distinct usable vectors per label, smallest id, copies."""
    vec = F.col("embedding").cast("array<double>")
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                            F.col("label").cast("string").alias("label"), vec.alias("vec")) \
        .where("vec_id is not null and label is not null and vec is not null") \
        .where(F.size("vec") > 0) \
        .where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x)
                        & (F.abs(x) < F.lit(float("inf"))))) \
        .where(F.exists("vec", lambda x: x != 0))
    return usable.groupBy("label", "vec").agg(F.min("vec_id").alias("rep"),
                                              F.count("*").alias("m")) \
        .select(F.concat_ws("/", "label", F.size("vec").cast("string")).alias("node"),
                "label", "vec", "rep", "m")


def _net(radius: float):
    """Centres of a node's sample: greedy, in the order given, at least ``radius`` apart."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("order")
        x = _unit(np.stack(pdf["vec"].to_numpy()).astype(np.float64))
        chosen = [x[0]]
        for row in x[1:]:
            if np.linalg.norm(np.stack(chosen) - row, axis=1).min() > radius:
                chosen.append(row)
        return pd.DataFrame({"node": [pdf["node"].iloc[0]], "centres": [np.concatenate(chosen)]})
    return run


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, dist = [], []
        for node, vec, flat in zip(batch.column("node").to_pylist(), batch.column("vec"),
                                   batch.column("centres"), strict=True):
            x = _unit(vec.values.to_numpy(zero_copy_only=False).astype(np.float64))
            if not flat.is_valid:
                nodes.append(node)
                dist.append(None)
                continue
            c = flat.values.to_numpy(zero_copy_only=False).reshape(-1, len(x))
            d = np.linalg.norm(c - x, axis=1)
            k = int(d.argmin())
            nodes.append(f"{node}.{k}")
            dist.append(float(d[k]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(nodes, pa.string()), pa.array(dist, pa.float64()),
             *[batch.column(n) for n in ("label", "vec", "rep", "m")]],
            names=["parent", "node", "dist", "label", "vec", "rep", "m"])


def _distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)),
                              F.lit(0.0), lambda s, x: s + x))


def _split_level(members: DataFrame, radius: float) -> tuple[DataFrame, DataFrame] | None:
    """Members with their new nodes, and (parent, node, centre, radius); None: no node
    is too large."""
    sizes = save(members.groupBy("node").agg(F.count("*").alias("n"))
                 .where(F.col("n") > LEAF).select(
                     "node", F.least(F.lit(SAMPLE), F.ceil(2 * F.col("n") / F.lit(LEAF)))
                     .alias("wanted")), "large")
    if sizes.isEmpty():
        return None
    order = F.xxhash64("vec", "rep")
    sample = members.join(sizes, "node").select("node", "wanted", "vec", order.alias("order")) \
        .groupBy("node", F.pmod("order", "wanted").alias("slot")) \
        .agg(F.min_by("vec", "order").alias("vec"), F.min("order").alias("order"))
    centres = save(sample.groupBy("node").applyInPandas(
        _net(radius), "node string, centres array<double>"), "centres")
    moved = save(members.join(centres, "node", "left").mapInArrow(
        _nearest, "parent string, node string, dist double, label string, vec array<double>, "
                  "rep long, m long"), "members")
    reach = moved.where("dist is not null").groupBy("parent", "node").agg(
        F.max("dist").alias("radius"))
    dims = F.element_at(F.split(F.element_at(F.split("parent", "/"), -1), r"\."), 1).cast("int")
    number = F.element_at(F.split("node", r"\."), -1).cast("int")
    named = reach.join(centres.select(F.col("node").alias("parent"), "centres"), "parent").select(
        "parent", "node", F.slice("centres", number * dims + 1, dims).alias("centre"),
        (F.col("radius") + _SLACK).alias("radius"))
    return moved.select("node", "label", "vec", "rep", "m"), save(named, "nodes")


def _expand(pairs: DataFrame, nodes: DataFrame, limit: float) -> DataFrame:
    """Node pairs one level down, without those whose bounds exclude a link."""
    pairs = pairs.withColumn("_self", F.col("a") == F.col("b"))
    for side in ("a", "b"):
        below = nodes.select(F.col("parent").alias(side), F.col("node").alias("_n"),
                             F.col("centre").alias("_c"), F.col("radius").alias("_r"))
        others = [c for c in pairs.columns if c not in (side, f"{side}c", f"{side}r")]
        pairs = pairs.join(below, side, "left").select(
            *others, F.coalesce("_n", side).alias(side),
            F.when(F.col("_n").isNull(), F.col(f"{side}c")).otherwise(F.col("_c"))
            .alias(f"{side}c"),
            F.when(F.col("_n").isNull(), F.col(f"{side}r")).otherwise(F.col("_r"))
            .alias(f"{side}r"))
    apart = _distance(F.col("ac"), F.col("bc")) - F.col("ar") - F.col("br")
    return pairs.where((~F.col("_self")) | (F.col("a") <= F.col("b"))).drop("_self").where(
        (F.col("a") == F.col("b")) | F.coalesce(apart <= limit + _SLACK, F.lit(True)))


def radii_for(limit: float) -> list[float]:
    """1, 1/2, 1/4 ... down to a quarter of the limit."""
    return [2.0 ** -k for k in range(NESTED) if k == 0 or 2.0 ** -k > limit / 4]


def nest(x: np.ndarray, radii: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Nested levels over unit vectors: (path, dist), both rows x levels. ``path`` names a
    row's centre by its position, ``dist`` is its distance from there, at most the level's
    radius; centres below one parent are farther apart than that."""
    path = np.zeros((len(x), len(radii)), dtype=np.int32)
    dist = np.zeros((len(x), len(radii)))
    parents = [np.arange(len(x))]
    for level, radius in enumerate(radii):
        below = []
        for left in parents:
            while len(left):
                centre = left[0]
                d = np.linalg.norm(x[left] - x[centre], axis=1)
                near = d <= radius
                near[0] = True
                node = left[near]
                path[node, level], dist[node, level] = centre, d[near]
                below.append(node)
                left = left[~near]
        parents = below
    return path, dist


def _nested(radii: list[float]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        path, dist = nest(_unit(np.stack(pdf["vec"].to_numpy()).astype(np.float64)), radii)
        return pdf.assign(at=np.arange(len(pdf), dtype=np.int32), path=list(path),
                          dist=list(dist))
    return run


class Tree:
    """Nested levels of one block: per level the nodes' centres, radii and members' nodes."""

    def __init__(self, vec: np.ndarray, at: np.ndarray, path: np.ndarray, dist: np.ndarray):
        self.vec, self.norm = vec, np.sqrt((vec * vec).sum(axis=1))
        unit = vec / self.norm[:, None]
        row = np.empty(at.max() + 1, dtype=np.int64)
        row[at] = np.arange(len(at))
        self.node, self.centre, self.radius, self.size, self.parent = [], [], [], [], []
        for level in range(path.shape[1]):
            named, node = np.unique(path[:, level], return_inverse=True)
            radius = np.zeros(len(named))
            np.maximum.at(radius, node, dist[:, level])
            self.node.append(node)
            self.centre.append(unit[row[named]])
            self.radius.append(radius)
            self.size.append(np.bincount(node))
            above = np.zeros(len(named), dtype=np.int64)
            if level:
                above[node] = self.node[-2]
            self.parent.append(above)


def meet(a: Tree, b: Tree, cosine: float) -> tuple[np.ndarray, int]:
    """(hit, compared): which members of ``a`` link with which of ``b``, and how many member
    pairs were compared for it. ``a is b`` leaves out each member with itself."""
    limit = float(np.sqrt(2 - 2 * cosine))
    hit = np.zeros((len(a.vec), len(b.vec)), dtype=bool)
    alive = np.ones((1, 1), dtype=bool)
    for level, (na, nb) in enumerate(zip(a.node, b.node, strict=True)):
        alive = alive[np.ix_(a.parent[level], b.parent[level])]
        rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        cos = a.centre[level][rows] @ b.centre[level][cols].T
        apart = np.sqrt(np.maximum(2 - 2 * cos, 0))
        reach = a.radius[level][rows][:, None] + b.radius[level][cols][None, :]
        block = alive[np.ix_(rows, cols)]
        whole = block & (apart + reach <= limit - _SLACK)
        alive = np.zeros_like(alive)
        alive[np.ix_(rows, cols)] = block & ~whole & (apart - reach <= limit + _SLACK)
        if a is b:                      # a single member against itself
            np.fill_diagonal(alive, alive.diagonal() & (a.size[level] > 1))
        for i, j in zip(*np.nonzero(whole), strict=True):
            hit[np.ix_(na == rows[i], nb == cols[j])] = True
        if not alive.any():
            break
    rows = np.flatnonzero(alive.any(axis=1)[na])
    cols = np.flatnonzero(alive.any(axis=0)[nb])
    open_ = alive[np.ix_(na[rows], nb[cols])]
    cos = (a.vec[rows] @ b.vec[cols].T) / np.outer(a.norm[rows], b.norm[cols])
    hit[np.ix_(rows, cols)] |= open_ & (cos >= cosine)
    if a is b:
        np.fill_diagonal(hit, False)
    return hit, int(open_.sum())


def _tree(pdf: pd.DataFrame) -> Tree:
    return Tree(np.stack(pdf["vec"].to_numpy()).astype(np.float64), pdf["at"].to_numpy(),
                np.stack(pdf["path"].to_numpy()), np.stack(pdf["dist"].to_numpy()))


def _compare(cosine: float):
    def close(rows: pd.DataFrame) -> pd.DataFrame:
        two = not rows["own"].iloc[0]
        a = rows[rows["side"] == 0]
        b = rows[rows["side"] == 1] if two else a
        if not len(a) or not len(b):
            return pd.DataFrame({"rep": [], "n": [], "other": []}, dtype="int64")
        first = _tree(a)
        hit, _ = meet(first, _tree(b) if two else first, cosine)
        ma, mb = a["m"].to_numpy(), b["m"].to_numpy()
        n, rep = hit @ mb, a["rep"].to_numpy()
        near = {i: np.flatnonzero(hit[i]) + (len(a) if two else 0)
                for i in np.flatnonzero(hit.any(axis=1)).tolist()}
        if two:
            n, rep = np.concatenate([n, hit.T @ ma]), np.concatenate([rep, b["rep"].to_numpy()])
            near |= {len(a) + j: np.flatnonzero(hit[:, j])
                     for j in np.flatnonzero(hit.any(axis=0)).tolist()}
        # a spanning forest of the hits: each row points at where it came from
        came = np.full(len(rep), -1)
        for i in near:
            if came[i] < 0:
                came[i], todo = i, [i]
                while todo:
                    at = todo.pop()
                    fresh = near[at][came[near[at]] < 0]
                    came[fresh] = at
                    todo += fresh.tolist()
        some = np.flatnonzero(n)
        return pd.DataFrame({"rep": rep[some], "n": n[some], "other": rep[came[some]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unit, held = None, []
        for pdf in batches:
            for name, part in pdf.groupby("unit", sort=False):
                if name != unit and held:
                    yield close(pd.concat(held, ignore_index=True))
                    held = []
                unit = name
                held.append(part)
        if held:
            yield close(pd.concat(held, ignore_index=True))
    return run


def _units(nested: DataFrame, far: DataFrame) -> DataFrame:
    """One unit per pair of blocks of an unsettled leaf pair: the rows of both sides."""
    blocks = lambda n: F.ceil(F.col(n) / F.lit(LEAF)).cast("int")
    row = ("rep", "m", "vec", "at", "path", "dist")
    as_a = nested.join(far.withColumnRenamed("a", "node"), "node").select(
        F.col("node").alias("a"), "b", "i", *row,
        F.explode(F.sequence(F.lit(0), blocks("bn") - 1)).alias("j"))
    same = as_a.where("a = b").select(
        F.concat_ws("|", "a", "b", F.least("i", "j"), F.greatest("i", "j")).alias("unit"),
        F.when(F.col("i") <= F.col("j"), 0).otherwise(1).alias("side"),
        (F.col("i") == F.col("j")).alias("own"), *row)
    first = as_a.where("a != b").select(
        F.concat_ws("|", "a", "b", "i", "j").alias("unit"), F.lit(0).alias("side"),
        F.lit(False).alias("own"), *row)
    second = nested.withColumnRenamed("i", "j").join(
        far.where("a != b").withColumnRenamed("b", "node"), "node").select(
        "a", F.col("node").alias("b"), "j", *row,
        F.explode(F.sequence(F.lit(0), blocks("an") - 1)).alias("i")).select(
        F.concat_ws("|", "a", "b", "i", "j").alias("unit"), F.lit(1).alias("side"),
        F.lit(False).alias("own"), *row)
    return same.unionByName(first).unionByName(second)


def _leaf_links(members: DataFrame, pairs: DataFrame, cosine: float) -> DataFrame:
    """(rep, n, other) of all leaf pairs."""
    limit = float(np.sqrt(2 - 2 * cosine))
    leaves = save(members.groupBy("node").agg(
        F.count("*").alias("n"), F.sum("m").alias("copies"), F.min("rep").alias("first")), "leaves")
    one = leaves.select(F.col("node").alias("a"), F.col("n").alias("an"),
                        F.col("copies").alias("ak"), F.col("first").alias("af"))
    two = leaves.select(F.col("node").alias("b"), F.col("n").alias("bn"),
                        F.col("copies").alias("bk"), F.col("first").alias("bf"))
    together = F.when(F.col("a") == F.col("b"), 2 * F.col("ar")).otherwise(
        _distance(F.col("ac"), F.col("bc")) + F.col("ar") + F.col("br")) <= limit - _SLACK
    sized = save(pairs.join(one, "a").join(two, "b").select(
        "a", "b", "an", "bn", "ak", "bk", "af", "bf",
        F.coalesce(together, F.lit(False)).alias("whole")), "pairs")
    near = sized.where("whole")
    sides = near.select(F.col("a").alias("node"), F.col("bk").alias("k"), F.col("bf").alias("other"),
                        (F.col("a") == F.col("b")).alias("self")).unionByName(
        near.where("a != b").select(F.col("b").alias("node"), F.col("ak").alias("k"),
                                    F.col("af").alias("other"), F.lit(False).alias("self")))
    included = members.join(sides, "node").select(
        "rep", (F.col("k") - F.when(F.col("self"), F.col("m")).otherwise(0)).alias("n"), "other")
    # the rest: members in blocks of at most about LEAF, each with its nested levels
    dealt = members.join(leaves.select("node", "n"), "node").select(
        "node", F.pmod(F.xxhash64("rep"), F.ceil(F.col("n") / F.lit(LEAF))).cast("int").alias("i"),
        "rep", "m", "vec")
    nested = save(dealt.groupBy("node", "i").applyInPandas(
        _nested(radii_for(limit)), "node string, i int, rep long, m long, vec array<double>, "
                                   "at int, path array<int>, dist array<double>"), "nested")
    units = _units(nested, sized.where("not whole"))
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    compared = units.repartitionByRange(n, "unit").sortWithinPartitions("unit").mapInPandas(
        _compare(cosine), "rep long, n long, other long")
    return included.unionByName(compared)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept — one row per input row."""
    limit = float(np.sqrt(2 - 2 * cosine))
    classes = save(classes_of(vectors), "classes")
    members = classes.select("node", "label", "vec", "rep", "m")
    nothing = F.lit(None).cast("array<double>")
    pairs = members.select(F.col("node").alias("a")).distinct().select(
        "a", nothing.alias("ac"), F.lit(2.0).alias("ar"),
        F.col("a").alias("b"), nothing.alias("bc"), F.lit(2.0).alias("br"))
    for level in range(LEVELS):
        split = _split_level(members, 2.0 ** -(level + 1))
        if split is None:
            break
        members, nodes = split
        pairs = save(_expand(pairs, nodes, limit), "pairs")
    links = save(_leaf_links(members, pairs, cosine), "links")
    counts = links.groupBy("rep").agg(F.sum("n").alias("n"))
    ends = components(links, "rep", "other")
    known = save(classes.join(counts, "rep", "left").join(
        ends, F.col("rep") == F.col("v"), "left").select(
        F.col("label").alias("_l"), F.col("vec").alias("_v"),
        (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("_n"),
        F.coalesce("component", "rep").alias("_c")), "known")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("label").cast("string").alias("_label"),
                          F.col("embedding").cast("array<double>").alias("_vec"))
    out = rows.join(known, (F.col("_label") == F.col("_l")) & (F.col("_vec") == F.col("_v"))
                    & F.col("vec_id").isNotNull(), "left")
    return out.select(
        "vec_id", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("_c", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("_c", "vec_id"), F.lit(True)).alias("kept"))
