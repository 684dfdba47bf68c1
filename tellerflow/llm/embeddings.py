"""Near-duplicate vectors by a forest of random-projection trees with spill overlap."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tellerflow.llm.common import components, mix, stored

LEVELS = 42
#: Levels that one pass over the vectors descends.
STEP = 6
_CUTS = 2**STEP - 1


def _units(lists: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors in double precision, one length of vector after the other.

    Vectors that are null, empty, zero, or hold null or non-finite components are left out.
    """
    values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    starts = lists.offsets.to_numpy()
    sizes = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(starts), 0)
    for dim in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == dim)
        x = values[starts[rows][:, None] + np.arange(dim)]
        scale = np.abs(x).max(axis=1)
        good = np.isfinite(scale) & (scale > 0)
        x = x[good] / scale[good, None]
        yield rows[good], x / np.sqrt((x * x).sum(axis=1))[:, None]


def _keyed(vectors: DataFrame, kind: str) -> DataFrame:
    """The vectors that can link, with their length and two hashes of the unit vector."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _units(batch.column(1)):
                hashes = [xxhash.xxh3_128_intdigest(row.tobytes()) for row in x]
                k1, k2 = (np.array([h >> by & 2**64 - 1 for h in hashes], np.uint64).view(np.int64)
                          for by in (0, 64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(k1), pa.array(k2),
                     pa.array(np.full(len(rows), x.shape[1], np.int32)),
                     batch.column(1).take(pa.array(rows))],
                    ["vec_id", "k1", "k2", "dim", "v"],
                )

    return vectors.mapInArrow(key, f"vec_id long, k1 long, k2 long, dim int, v {kind}")


@lru_cache(maxsize=64)
def _directions(tree: int, level: int, dim: int) -> np.ndarray:
    """Random directions of STEP levels of one tree, a column each; they follow from the numbers."""
    return np.random.default_rng([tree, level, dim]).standard_normal((dim, STEP))


_erfc = np.frompyfunc(math.erfc, 1, 1)


def _split_rate(off: np.ndarray, spill: float, gap: float) -> float:
    """Share of pairs that a cut parts, from the distances of a sample's projections to the cut.

    The partner's projection differs by a normal deviate of standard deviation ``gap``; the pair
    is parted if one lies beyond the overlap on one side and the other beyond it on the other.
    """
    off = np.abs(off)
    far = (off[off > spill] + spill) / (gap * math.sqrt(2))
    return float(_erfc(far[far < 6]).astype(float).sum() / 2 / len(off))


def _fitted(group: pa.Table, level: int, leaf: int, spill: float, gap: float) -> pa.Table:
    """Cuts of the next STEP levels below one node, in heap order, from a sample of its vectors,
    and for each the share of pairs ``gap`` apart that it parts.

    Each cut is the median of the projections. NaN marks a node that is a leaf: it holds at most
    ``leaf`` vectors, or over half of them lie within the overlap, as in a group of copies, where
    splitting would only repeat them. Infinity marks one with too small a sample to tell.
    """
    (_, x), = _units(group.column("v").combine_chunks())
    shade = x @ _directions(group.column("tree")[0].as_py(), level, x.shape[1])
    weight = group.column("n")[0].as_py() / len(x)
    cuts, rates = np.full(_CUTS, np.nan), np.zeros(_CUTS)
    stack = [(0, 0, np.arange(len(x)))]
    while stack:
        at, depth, rows = stack.pop()
        if len(rows) * weight <= leaf:
            continue
        if len(rows) < 32:
            cuts[at] = np.inf
            continue
        p = shade[rows, depth]
        low, cut, high = np.quantile(p, [0.25, 0.5, 0.75])
        if high - low < 2 * spill:
            continue
        cuts[at], rates[at] = cut, _split_rate(p - cut, spill, gap)
        if depth + 1 < STEP:
            stack.append((2 * at + 1, depth + 1, rows[p <= cut + spill]))
            stack.append((2 * at + 2, depth + 1, rows[p > cut - spill]))
    return pa.table(
        {"node": group.column("node")[:1], "cuts": pa.array([cuts]), "rates": pa.array([rates])}
    )


def _placed(batch: pa.RecordBatch, level: int, spill: float) -> Iterator[pa.RecordBatch]:
    """Where the vectors of some nodes come out STEP levels further down; near a cut, both sides.
    ``risk`` sums -log(1 - rate) over the cuts on the way."""
    names = ["vec_id", "tree", "dim", "node", "risk"]
    vec_id, tree, dim, node, risk = (batch.column(name).to_numpy() for name in names)
    for rows, x in _units(batch.column("v")):
        for t in np.unique(tree[rows]):
            mine = tree[rows] == t
            at = rows[mine]
            shade = x[mine] @ _directions(int(t), level, x.shape[1])
            cuts, rates = (
                batch.column(name).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
                .reshape(-1, _CUTS) for name in ("cuts", "rates")
            )
            who, pos, sofar, out = np.arange(len(at)), np.zeros(len(at), np.int64), risk[at], []
            for depth in range(STEP):
                cut = cuts[who, pos]
                going = np.isfinite(cut)
                out.append((who[~going], pos[~going], sofar[~going], np.isnan(cut[~going])))
                who, pos, cut = who[going], pos[going], cut[going]
                sofar = sofar[going] - np.log1p(-rates[who, pos])
                p = shade[who, depth]
                left, right = p <= cut + spill, p > cut - spill
                who = np.concatenate([who[left], who[right]])
                sofar = np.concatenate([sofar[left], sofar[right]])
                pos = np.concatenate([2 * pos[left] + 1, 2 * pos[right] + 2])
            out.append((who, pos, sofar, np.zeros(len(who), bool)))
            who, pos, sofar, done = (np.concatenate(part) for part in zip(*out, strict=True))
            source = at[who]
            child = mix(node[source].view(np.uint64) + mix(pos.astype(np.uint64) + np.uint64(1)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(vec_id[source]), pa.array(tree[source]), pa.array(dim[source]),
                 pa.array(child.view(np.int64)), pa.array(sofar), pa.array(done)],
                [*names, "done"],
            )


def _leaves(
    roots: DataFrame, heads: DataFrame, leaf: int, spill: float, gap: float, sample: int
) -> DataFrame:
    """(vec_id, dim, tree, leaf, risk): the vectors placed in the leaves of the trees that
    ``roots`` (vec_id, dim, tree) names for them.

    A pass counts the open nodes, fits the cuts of STEP levels from about ``sample`` vectors of
    each node, a task per node, and lets every vector descend by them. Only ids and node numbers
    are written; the table of cuts is a few hundred bytes for a node of over ``leaf`` vectors.
    """

    def fit(group: pa.Table) -> pa.Table:
        return _fitted(group, level, leaf, spill, gap)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _placed(batch, level, spill)

    names = ["vec_id", "tree", "dim", "node", "risk"]
    state = roots.select(
        "vec_id", "tree", "dim", F.xxhash64("tree", "dim").alias("node"), F.lit(0.0).alias("risk")
    )
    vectors = heads.select("vec_id", "dim", "v")
    done: DataFrame | None = None
    for level in range(0, LEVELS, STEP):
        sizes = stored(state.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "sizes")
        sized = state.join(sizes, "node")
        final = sized.filter(F.col("n") <= leaf)
        wide = sized.filter(F.col("n") > leaf)
        chosen = F.pmod(F.xxhash64("vec_id", "node"), F.col("n")) < sample
        cuts = stored(
            wide.filter(chosen).join(vectors, ["vec_id", "dim"])
            .select("node", "tree", "n", "v").groupBy("node")
            .applyInArrow(fit, "node long, cuts array<double>, rates array<double>"),
            "cuts",
        )
        placed = stored(
            wide.select(*names).join(vectors, ["vec_id", "dim"]).join(cuts, "node")
            .select(*names, "v", "cuts", "rates")
            .mapInArrow(
                place, "vec_id long, tree int, dim int, node long, risk double, done boolean"),
            "nodes",
        )
        for part in (final, placed.filter("done")):
            part = part.select("vec_id", "dim", "tree", F.col("node").alias("leaf"), "risk")
            done = part if done is None else done.unionByName(part)
        state = placed.filter("NOT done").select(*names).distinct()
        if state.isEmpty():
            return done
    return done.unionByName(
        state.select("vec_id", "dim", "tree", F.col("node").alias("leaf"), "risk"))


def _forest(
    heads: DataFrame, trees: int, loss: float, leaf: int, spill: float, gap: float, sample: int
) -> DataFrame:
    """(vec_id, dim, leaf): all vectors in the leaves of as many trees as each of them needs.

    A pair survives a tree with probability exp(-risk) at least, the risk of the worst of a
    vector's leaves; it must be lost in all trees of both. Vectors whose estimate over ``trees``
    trees is above ``loss`` go into further trees, made of such vectors alone, until it is not.
    """
    names = ["vec_id", "dim", "tree"]
    roots = heads.select("vec_id", "dim").distinct().select(
        "vec_id", "dim", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    leaves: DataFrame | None = None
    while True:
        grown = stored(_leaves(roots, heads, leaf, spill, gap, sample).distinct(), "leaves")
        leaves = grown if leaves is None else leaves.unionByName(grown)
        lost = F.log(F.greatest(-F.expm1(-F.max("risk")), F.lit(1e-300)))
        each = leaves.groupBy(*names).agg(lost.alias("lost")).groupBy("vec_id", "dim").agg(
            F.sum("lost").alias("lost"), F.count(F.lit(1)).cast("int").alias("has"))
        more = F.ceil(F.col("has") * (math.log(loss) / F.col("lost") - 1)).cast("int")
        roots = stored(
            each.filter(F.col("lost") > math.log(loss)).select(
                "vec_id", "dim",
                F.explode(F.sequence("has", F.col("has") + F.greatest(more, F.lit(1)) - 1))
                .alias("tree")),
            "roots",
        )
        if roots.isEmpty():
            return leaves.select("vec_id", "dim", "leaf")


def _compare(group: Iterator[pd.DataFrame], limit: float) -> pd.DataFrame:
    """Links of one pair of blocks of one leaf: per vector their number, and a spanning forest.

    A pair that meets in several leaves is counted in the smallest of them only.
    """
    pdf = pd.concat(list(group), ignore_index=True)
    left, right = pdf[pdf["left"]], pdf[pdf["right"]]
    leaf, same = pdf["leaf"].iloc[0], bool(pdf["same"].iloc[0])
    if not len(left) or not len(right):
        return pd.DataFrame({"a": [], "b": [], "n": []})
    (_, a), = _units(pa.array(left["v"]))
    b = a if same else next(_units(pa.array(right["v"])))[1]
    hit = a @ b.T >= limit
    if same:
        np.fill_diagonal(hit, False)
    rows, cols = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
    if not len(rows):
        return pd.DataFrame({"a": [], "b": [], "n": []})
    hit = hit[np.ix_(rows, cols)]
    ids_a, ids_b = left["vec_id"].to_numpy()[rows], right["vec_id"].to_numpy()[cols]
    homes = []
    for side, at in ((left, rows), (right, cols)):
        own = [x[x < leaf] for x in side["leaves"].to_numpy()[at]]
        where = np.repeat(np.arange(len(own)), [len(x) for x in own])
        known = np.concatenate(own)
        order = np.argsort(known, kind="stable")
        homes.append((known[order], where[order]))
    (known_a, where_a), (known_b, where_b) = homes
    shared = np.intersect1d(known_a, known_b)
    from_a, to_a = (np.searchsorted(known_a, shared, side) for side in ("left", "right"))
    from_b, to_b = (np.searchsorted(known_b, shared, side) for side in ("left", "right"))
    for k in range(len(shared)):
        hit[np.ix_(where_a[from_a[k] : to_a[k]], where_b[from_b[k] : to_b[k]])] = False
    weight_a, weight_b = left["copies"].to_numpy()[rows], right["copies"].to_numpy()[cols]
    count_a = hit @ weight_b
    parts = [pd.DataFrame({"a": ids_a, "b": ids_a, "n": count_a})]
    if not same:
        parts.append(pd.DataFrame({"a": ids_b, "b": ids_b, "n": weight_a @ hit}))
    ids = np.unique(np.concatenate([ids_a, ids_b]))
    label = np.arange(len(ids))
    at_a, at_b = np.searchsorted(ids, ids_a), np.searchsorted(ids, ids_b)
    while True:
        low = np.minimum(
            label[at_a], np.where(hit, label[at_b][None, :], len(ids)).min(axis=1)
        )
        new = label.copy()
        np.minimum.at(new, at_a, low)
        low = np.minimum(label[at_b], np.where(hit, new[at_a][:, None], len(ids)).min(axis=0))
        np.minimum.at(new, at_b, low)
        if (new == label).all():
            break
        label = new
    tied = np.flatnonzero(label != np.arange(len(ids)))
    parts.append(pd.DataFrame({"a": ids[tied], "b": ids[label[tied]], "n": 0}))
    return pd.concat(parts, ignore_index=True)


def near_duplicate_vectors(
    vectors: DataFrame,
    cosine: float = 0.95,
    trees: int = 8,
    leaf: int = 1536,
    spill: float = 0.16,
    block: int = 2048,
    sample: int = 4096,
    loss: float = 1e-4,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors are linked when their cosine, in double precision, reaches ``cosine``. Candidates share
    a leaf in one of at least ``trees`` trees; ``spill`` is the half-width of the overlap in units of a
    projection's standard deviation for unit vectors along it (directions are not normalised).
    Cuts are medians of about ``sample`` vectors of a node; every vector is placed. All links
    inside leaves are verified; below ``cosine`` there are none. The share of pairs at ``cosine``
    that a cut parts is estimated from its sample, and vectors get as many trees as keep their
    estimated loss of such pairs at or below ``loss``, whatever the table's size and density.

    Equal vectors are compared once and counted as often as they occur. A leaf that cannot be
    split is compared in pairs of blocks of ``block`` vectors, a task each; what leaves a task is
    a count per vector and a spanning forest, never all pairs.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing:
    no links, own component, kept. Vectors of different lengths never link. Rows without an id
    link with nothing and are kept; their component is null. Rows that repeat an id and a vector are
    vectors of their own: each counts the others among its links. Rows of one id with different
    vectors all get the links of these together, where one neighbour may count more than once.
    """
    column = vectors.schema[vector_col].dataType
    single = isinstance(column, ArrayType) and isinstance(column.elementType, FloatType)
    kind = "array<float>" if single else "array<double>"
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast(kind).alias("v"))
    points = stored(_keyed(base.filter("vec_id IS NOT NULL"), kind), "points")
    named = points.select("vec_id", "k1", "k2")
    same = named.groupBy("k1", "k2").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    named = stored(named.join(same, ["k1", "k2"]), "copies")
    reps = named.filter("vec_id = rep").select("vec_id", "k1", "k2", "copies").distinct()
    heads = stored(
        points.join(reps, ["vec_id", "k1", "k2"]).dropDuplicates(["vec_id", "k1", "k2"])
        .select("vec_id", "dim", "v", "copies"),
        "heads",
    )
    gap = math.sqrt(2 * max(1 - cosine, 1e-9))
    leaves = _forest(heads, trees, loss, leaf, spill, gap, sample)
    sizes = leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    homes = leaves.groupBy("vec_id").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))
    blocks = F.ceil(F.col("size") / block).cast("int")
    placed = (
        leaves.join(sizes, "leaf")
        .withColumn("blocks", blocks)
        .withColumn("mine", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
        .select(
            "leaf", "vec_id", "dim", "mine",
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
        )
        .select(
            "vec_id", "dim", "leaf",
            F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
            (F.col("mine") <= F.col("other")).alias("left"),
            (F.col("mine") >= F.col("other")).alias("right"),
        )
    )
    placed = placed.withColumn("same", F.col("low") == F.col("high"))
    full = heads.join(homes, "vec_id").select("vec_id", "dim", "v", "copies", "leaves")
    compared = placed.join(full, ["vec_id", "dim"]).groupBy("leaf", "low", "high").applyInPandas(
        lambda pdf: _compare(iter([pdf]), cosine), "a long, b long, n long"
    )
    compared = stored(compared, "links")
    counts = compared.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    edges = compared.filter("a <> b").select("a", "b").unionByName(
        named.filter("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    )
    groups = components(edges).withColumnRenamed("id", "vec_id")
    linked = (
        named.distinct()  # rows alike in id and vector are counted in ``copies``
        .join(counts, "rep", "left")
        .groupBy("vec_id")
        .agg(F.sum(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    out = (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"))
        .join(linked, "vec_id", "left")
        .join(groups, "vec_id", "left")
    )
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
