"""Distances between small sets of points within a group: radius joins, neighbours, clashes, feature matches."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.operators.gates import GateError
from siftline.operators.ranking import numbered
from siftline.operators.storage import cut


def distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    total = None
    for x, y in zip(a, b, strict=True):
        term = (x - y) * (x - y)
        total = term if total is None else total + term
    return F.sqrt(total)


def _cells(df: DataFrame, xyz: Sequence[str], size: float, spread: bool) -> DataFrame:
    """Grid cells of points; with spread, also the 26 around each. A range join becomes an equi-join on cells."""
    steps = [-1, 0, 1] if spread else [0]
    cells = F.array(*[F.struct(*[(F.floor(F.col(c) / size) + s).cast("long").alias(f"g{i}") for i, (c, s) in enumerate(zip(xyz, shift, strict=True))]) for shift in [(p, q, r) for p in steps for q in steps for r in steps]])
    return df.withColumn("_cell", F.explode(cells))


def radius_pairs(left: DataFrame, right: DataFrame, group: str, left_id: str, right_id: str, xyz: Sequence[str], radius: float, strict: bool = False) -> DataFrame:
    """group, left_id, right_id, distance of points of a group within radius (strict: less than it)."""
    names = [f"_{c}" for c in xyz]
    a = _cells(left.select(group, left_id, *xyz), xyz, radius, False)
    b = _cells(right.select(group, F.col(right_id).alias("_right"), *[F.col(c).alias(n) for c, n in zip(xyz, names, strict=True)]), names, radius, True)
    d = distance([F.col(c) for c in xyz], [F.col(n) for n in names])
    pairs = a.join(b, [group, "_cell"]).withColumn("distance", d)
    near = F.col("distance") < radius if strict else F.col("distance") <= radius
    return pairs.where(near).select(group, left_id, F.col("_right").alias(right_id), "distance")


def whole_groups_within(points: DataFrame, centres: DataFrame, group: str, unit: Sequence[str], xyz: Sequence[str], radius: float) -> DataFrame:
    """All points of a unit (a residue) of which any point lies within radius of a centre of the group."""
    marked = points.withColumn("_point", F.xxhash64(group, *unit, *xyz))
    near = radius_pairs(marked, centres.withColumn("_centre", F.xxhash64(group, *xyz)), group, "_point", "_centre", xyz, radius)
    units = marked.join(near.select(group, "_point").distinct(), [group, "_point"], "left_semi").select(group, *unit).distinct()
    return points.join(units, [group, *unit], "left_semi")


def pocket_graph(atoms: DataFrame, ligand: DataFrame, group: str, unit: Sequence[str], order: str, xyz: Sequence[str], radius: float) -> DataFrame:
    """Atoms of all residues (`unit`) of which any atom lies within radius of a ligand atom of the group, with residue_id,
    0 for the residue that comes first in order, and so on. A group without such a residue has no rows."""
    near = whole_groups_within(atoms, ligand, group, unit, xyz, radius)
    firsts = near.groupBy(group, *unit).agg(F.min(order).alias("_first"))
    ids = firsts.withColumn("residue_id", F.row_number().over(Window.partitionBy(group).orderBy("_first")) - 1)
    return near.join(ids.drop("_first"), [group, *unit])


def neighbours(left: DataFrame, right: DataFrame, group: str, left_id: str, right_id: str, xyz: Sequence[str], cutoff: float, k: int, max_pairs: int) -> DataFrame:
    """Per left point the k nearest right points of its group closer than cutoff, or the single nearest one flagged
    invalid; then at most max_pairs per group: valid ones first, by distance, ties by the ids. Equal distances of a point
    go to the smaller right id. Groups on one side only, and points with a null coordinate, have no pairs. Adds distance
    and valid.

    Points meet by the cells of a grid, so the points of one group are spread over tasks. Those without a near one go
    down a tree of cells (`nearest_beyond`), and only groups with more than max_pairs are numbered, range by range.
    """
    whole = lambda d: d.where(reduce(and_, [F.col(c).isNotNull() & ~F.isnan(c) for c in xyz]))
    left, right = whole(left.select(group, left_id, *xyz)), whole(right.select(group, right_id, *xyz))
    w = Window.partitionBy(group, left_id).orderBy("distance", right_id)
    near = radius_pairs(left, right, group, left_id, right_id, xyz, cutoff, strict=True).withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= k)
    near = cut(near.select(group, left_id, right_id, "distance", F.lit(True).alias("valid")))
    alone = left.join(near.select(group, left_id), [group, left_id], "left_anti")
    far = nearest_beyond(alone, right, group, left_id, right_id, xyz, cutoff)
    pairs = cut(near.unionByName(far.withColumn("valid", F.lit(False))))
    large = pairs.groupBy(group).agg(F.count("*").alias("_n")).where(F.col("_n") > max_pairs).select(group)
    if large.isEmpty():
        return pairs
    order = [(~F.col("valid")).cast("int"), F.col("distance"), F.col(left_id), F.col(right_id)]
    first = numbered(pairs.join(large, group, "left_semi"), [group], order, "_place").where(F.col("_place") <= max_pairs)
    return pairs.join(large, group, "left_anti").unionByName(first.drop("_place"))


def nearest_beyond(points: DataFrame, others: DataFrame, group: str, point_id: str, other_id: str, xyz: Sequence[str], size: float) -> DataFrame:
    """group, point_id, other_id, distance: the nearest other point of the group, ties to the smaller id.

    The others lie in a tree of cells, from cells of `size` up to ones as large as all of them. Each cell knows the box
    of its points and one of them. From the top, a point looks at the cells inside those it kept, and keeps the ones
    whose box is no further than the nearest point it knows of: cells are skipped only where they cannot hold the
    nearest. What is left meets its points.
    """
    box = others.agg(*[f(c).alias(f"{c}{i}") for i, f in enumerate((F.min, F.max)) for c in xyz]).first()
    if box[f"{xyz[0]}0"] is None:
        return points.join(others.select(group, other_id).limit(0), group).select(group, point_id, other_id, F.lit(0.0).alias("distance"))
    extent = max(box[f"{c}1"] - box[f"{c}0"] for c in xyz)
    depth = min(40, max(0, math.ceil(math.log2(max(extent, size) / size))))
    cell = lambda c, level: F.floor((F.col(c) - F.lit(box[f"{c}0"])) / F.lit(size * 2.0**level)).cast("long")
    names = [f"_{c}" for c in xyz]
    far = others.select(group, F.col(other_id).alias("_other"), *[F.col(c).alias(n) for c, n in zip(xyz, names, strict=True)], F.struct(*[cell(c, 0).alias(c) for c in xyz]).alias("_cell"))
    up = lambda column: F.struct(*[F.floor(column[c] / 2).cast("long").alias(c) for c in xyz])
    one = F.min(F.struct("_other", *names))
    levels = [cut(far.groupBy(group, "_cell").agg(*[F.min(n).alias(f"{n}0") for n in names], *[F.max(n).alias(f"{n}1") for n in names], one.alias("_one")))]
    for _ in range(depth):
        ends = [F.min(f"{n}0").alias(f"{n}0") for n in names] + [F.max(f"{n}1").alias(f"{n}1") for n in names]
        levels.append(levels[-1].groupBy(group, up(F.col("_cell")).alias("_cell")).agg(*ends, F.min("_one").alias("_one")))
    axes = [F.col(c) for c in xyz]
    to_box = distance([F.greatest(F.lit(0.0), F.col(f"{n}0") - a, a - F.col(f"{n}1")) for a, n in zip(axes, names, strict=True)], [F.lit(0.0)] * len(xyz))
    to_one = distance(axes, [F.col(f"_one.{n}") for n in names])
    kept = None
    known = Window.partitionBy(group, point_id)
    for level in reversed(range(depth + 1)):
        cells = levels[level]
        if kept is None:  # a few cells of a group
            met = points.select(group, point_id, *xyz).join(cells, group)
        else:
            met = kept.join(cells.withColumn("_parent", up(F.col("_cell"))), [group, "_parent"])
        met = met.withColumns({"_least": to_box, "_most": F.min(to_one).over(known)})
        kept = met.where(F.col("_least") <= F.col("_most") * (1 + 1e-12)).select(group, point_id, *xyz, F.col("_cell").alias("_parent"))
    found = kept.withColumnRenamed("_parent", "_cell").join(far, [group, "_cell"]).withColumn("distance", distance(axes, [F.col(n) for n in names]))
    best = found.groupBy(group, point_id).agg(F.min(F.struct("distance", "_other")).alias("_best"))
    return best.select(group, point_id, F.col("_best._other").alias(other_id), F.col("_best.distance").alias("distance"))


def radius_graph(points: DataFrame, group: str, point_id: str, xyz: Sequence[str], cutoff: float, most: int = 32) -> DataFrame:
    """Edges between points of a group within cutoff, no loops, the `most` nearest of each point, ties to the smaller id.
    Points with a null coordinate, id or group have none.

    Not all pairs within cutoff are made, which would grow as the square of the points. Places (points at one place are
    one, of which the most + 1 smallest ids can matter) lie in a tree of cells, from cells of `cutoff` down. The smallest
    cell around a place that holds more than `most` points bounds how far it has to look, and it meets only cells that
    this ball touches, of the ball's size. At most a fixed number of places a cell look into it from each level.
    Groups in which an id is repeated make all pairs.
    """
    known = points.where(reduce(and_, [F.col(c).isNotNull() & ~F.isnan(c) for c in xyz])).where(F.col(point_id).isNotNull() & F.col(group).isNotNull())
    known = known.select(group, point_id, *[(F.col(c) + F.lit(0.0)).alias(c) for c in xyz])  # -0.0 is 0.0
    mixed = cut(known.groupBy(group, point_id).count().where("count > 1").select(group).distinct())
    if mixed.isEmpty():
        return _nearest_places(known, group, point_id, xyz, cutoff, most)
    few = known.join(mixed, group, "left_semi")
    pairs = radius_pairs(few, few.withColumnRenamed(point_id, "neighbour"), group, point_id, "neighbour", xyz, cutoff)
    w = Window.partitionBy(group, point_id).orderBy("distance", "neighbour")
    pairs = pairs.where(F.col(point_id) != F.col("neighbour")).withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= most).drop("_k")
    return pairs.unionByName(_nearest_places(known.join(mixed, group, "left_anti"), group, point_id, xyz, cutoff, most))


def _nearest_places(whole: DataFrame, group: str, point_id: str, xyz: Sequence[str], cutoff: float, most: int) -> DataFrame:
    names, need = [f"_{c}" for c in xyz], most + 1
    place = Window.partitionBy(group, *xyz).orderBy(point_id)
    few = cut(whole.withColumn("_k", F.row_number().over(place)).where(F.col("_k") <= need))
    size = lambda level: F.lit(cutoff * (1 + 1e-9)) / F.pow(F.lit(2.0), level)
    cells = lambda df, level: df.withColumn("_cell", F.struct(*[F.floor(F.col(c) / size(level)).cast("long").alias(c) for c in xyz]))
    d = distance([F.col(c) for c in xyz], [F.col(n) for n in names])
    others = few.select(group, F.col(point_id).alias("neighbour"), *[F.col(c).alias(n) for c, n in zip(xyz, names, strict=True)], *xyz)

    # the smallest cell with more than `most` points; in it, the distance within which there are as many
    crowded, live, depth = [], few, 0
    while depth < 40:
        inside = cells(live, F.lit(depth))
        dense = inside.groupBy(group, "_cell").agg(F.count("*").alias("_n"), F.count_if(F.col("_k") == 1).alias("_places")).where(F.col("_n") > most)
        held = cut(inside.join(dense, [group, "_cell"]).withColumn("_level", F.lit(depth)))
        if held.isEmpty():
            break
        crowded.append(held.where("_k = 1").select(group, *xyz, "_level", "_cell"))
        live, depth = held.where("_places > 1").select(*few.columns), depth + 1
    spots = few.where("_k = 1").select(group, *xyz)
    if crowded:
        deepest = reduce(DataFrame.unionByName, crowded).groupBy(group, *xyz).agg(F.max_by(F.struct("_level", "_cell"), "_level").alias("_at")).select(group, *xyz, "_at.*")
        levels = F.array(*[F.lit(i) for i in range(depth)])
        tree = cut(cells(others.withColumn("_level", F.explode(levels)).drop(*xyz).withColumnsRenamed(dict(zip(names, xyz, strict=True))), F.col("_level")).withColumnsRenamed(dict(zip(xyz, names, strict=True))))
        near = deepest.join(tree, [group, "_level", "_cell"]).withColumn("_d", d)
        nth = Window.partitionBy(group, *xyz).orderBy("_d", "neighbour")
        bound = near.withColumn("_k", F.row_number().over(nth)).where(F.col("_k") <= need).groupBy(group, *xyz, "_level").agg(F.max("_d").alias("_r"))
        spots = spots.join(bound, [group, *xyz], "left")
    else:
        tree = cells(others.withColumn("_level", F.lit(0)), F.lit(0)).drop(*xyz)
        spots = spots.withColumns({"_level": F.lit(0), "_r": F.lit(None).cast("double")})
    spots = spots.withColumn("_r", F.least(F.coalesce("_r", F.lit(cutoff)), F.lit(cutoff))).withColumn("_level", F.coalesce("_level", F.lit(0)))
    spots = spots.withColumn("_level", F.when((F.col("_level") > 0) & (F.col("_r") > size(F.col("_level"))), F.col("_level") - 1).otherwise(F.col("_level")))
    for c, n in zip(xyz, names, strict=True):
        reach = F.col("_r") * (1 + 1e-9) + F.abs(c) * 1e-12
        spots = spots.withColumn(f"_at{n}", F.explode(F.sequence(*[F.floor(end / size(F.col("_level"))).cast("long") for end in (F.col(c) - reach, F.col(c) + reach)])))
    looked = spots.withColumn("_cell", F.struct(*[F.col(f"_at{n}").alias(c) for c, n in zip(xyz, names, strict=True)])).select(group, *xyz, "_level", "_r", "_cell")
    found = looked.join(tree, [group, "_level", "_cell"]).withColumn("distance", d).where(F.col("distance") <= F.col("_r"))
    nearest = Window.partitionBy(group, *xyz).orderBy("distance", "neighbour")
    found = found.withColumn("_k", F.row_number().over(nearest)).where(F.col("_k") <= need).select(group, *xyz, "neighbour", "distance")
    w = Window.partitionBy(group, point_id).orderBy("distance", "neighbour")
    edges = whole.join(found, [group, *xyz]).where(F.col(point_id) != F.col("neighbour")).withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= most)
    return edges.select(group, point_id, "neighbour", "distance")


def clash_fraction(points: DataFrame, obstacles: DataFrame, group: str, point_id: str, xyz: Sequence[str], limit: float) -> DataFrame:
    """group, clash: the share of points with an obstacle closer than limit."""
    near = radius_pairs(points, obstacles.withColumn("_o", F.xxhash64(*xyz)), group, point_id, "_o", xyz, limit, strict=True)
    hit = near.select(group, point_id).distinct().withColumn("_hit", F.lit(1))
    return points.join(hit, [group, point_id], "left").groupBy(group).agg(F.avg(F.coalesce("_hit", F.lit(0))).alias("clash"))


def clash_penalty(score, clash) -> Column:
    return F.col(score) * F.greatest(F.lit(0.0), F.lit(1.0) - F.lit(0.80) * F.col(clash))


def combined_similarity(feature, shape) -> Column:
    return F.lit(0.60) * F.col(feature) + F.lit(0.40) * F.col(shape)


def match_features(reference: Sequence[dict], candidates: Sequence[dict]) -> float:
    """Greedy one-to-one matching within each family by Gaussian similarity; ties go to the larger indexes. The matched
    weight over the weight of all reference features."""
    total = sum(float(r["weight"]) for r in reference)
    by_family: dict[str, list[tuple[float, int, int]]] = {}
    for i, r in enumerate(reference):
        for j, c in enumerate(candidates):
            if r["family"] == c["family"]:
                d = float(np.linalg.norm(np.subtract(r["position"], c["position"])))
                by_family.setdefault(r["family"], []).append((float(np.exp(-0.5 * (d / float(r["tolerance"])) ** 2)), i, j))
    score = 0.0
    for pairs in by_family.values():
        free_r, free_c = {p[1] for p in pairs}, {p[2] for p in pairs}
        for similarity, i, j in sorted(pairs, reverse=True):
            if i in free_r and j in free_c:
                free_r.discard(i), free_c.discard(j)
                score += similarity * float(reference[i]["weight"])
    return score / total if total else 0.0


def feature_scores(candidates: DataFrame, reference: Sequence[dict], group: str) -> DataFrame:
    """group, feature_score of candidate features (family, x, y, z, and ord for their order, unique in a group), by the
    rule of `match_features`.

    A reference feature can lose its best candidates only to the other references, so as many pairs of it as there are
    references are enough: these few rows of a group are gathered and walked in order. All others are dropped where they
    are made. Candidates with a null place or family match nothing; a group of these has 0.
    """
    total = sum(float(r["weight"]) for r in reference)
    scores = candidates.select(group).distinct().withColumn("feature_score", F.lit(0.0))
    if not total:
        return scores
    place = [F.col(c) for c in ("x", "y", "z")]

    def pair(i: int, r: dict) -> Column:
        d = distance(place, [F.lit(float(v)) for v in r["position"]]) / F.lit(float(r["tolerance"]))
        mine = F.struct(F.exp(F.lit(-0.5) * d * d).alias("similarity"), F.lit(i).alias("i"), F.col("ord").cast("long").alias("j"), F.lit(float(r["weight"])).alias("weight"))
        return F.when((F.col("family") == r["family"]) & d.isNotNull(), mine)

    pairs = candidates.select(group, F.inline(F.array_compact(F.array(*[pair(i, r) for i, r in enumerate(reference)]))))
    best = Window.partitionBy(group, "i").orderBy(F.desc("similarity"), F.desc("j"))
    few = pairs.withColumn("_k", F.row_number().over(best)).where(F.col("_k") <= len(reference))
    walk = F.sort_array(F.collect_list(F.struct("similarity", "i", "j", "weight")), asc=False)  # references squared, at most
    nothing = F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("i"), F.array().cast("array<bigint>").alias("j"))

    def step(done: Column, p: Column) -> Column:
        free = ~F.array_contains(done["i"], p["i"]) & ~F.array_contains(done["j"], p["j"])
        return F.when(free, F.struct((done["score"] + p["similarity"] * p["weight"]).alias("score"), F.array_append(done["i"], p["i"]).alias("i"), F.array_append(done["j"], p["j"]).alias("j"))).otherwise(done)

    matched = few.groupBy(group).agg(walk.alias("_walk")).select(group, F.aggregate("_walk", nothing, step, lambda done: done["score"] / F.lit(total)).alias("_score"))
    return scores.join(matched, group, "left").select(group, F.coalesce("_score", "feature_score").alias("feature_score"))


def contact_features(features: DataFrame, pocket: DataFrame, xyz: Sequence[str], cutoffs: dict[str, float], tolerances: dict[str, float], weights: dict[str, float]) -> DataFrame:
    """Features whose nearest pocket point is within their family's cutoff, with tolerance and weight."""
    one = lambda d: d.withColumn("_g", F.lit(0))
    lookup = lambda table: F.element_at(F.create_map(*[F.lit(x) for p in table.items() for x in p]), F.col("family"))
    marked = one(features).withColumn("_f", F.xxhash64("family", *xyz))
    near = radius_pairs(marked, one(pocket).withColumn("_p", F.xxhash64(*xyz)), "_g", "_f", "_p", xyz, max(cutoffs.values()))
    nearest = near.groupBy("_f").agg(F.min("distance").alias("nearest"))
    kept = marked.join(nearest, "_f").where(F.col("nearest") <= lookup(cutoffs))
    return kept.select(*features.columns, "nearest", lookup(tolerances).alias("tolerance"), lookup(weights).alias("weight"))


def centred(points: DataFrame, group: str, xyz: Sequence[str], on: Column | None = None) -> DataFrame:
    """Coordinates less the centroid of their group (of the points for which `on` holds)."""
    w = Window.partitionBy(group)
    mean = lambda c: F.avg(F.when(on, F.col(c)) if on is not None else F.col(c)).over(w)
    return points.withColumns({c: F.col(c) - mean(c) for c in xyz})


def coordinates(value) -> np.ndarray | None:
    """An (n, 3) array of numbers given flat or in rows; None if they cannot be one."""
    try:
        a = np.asarray(value, np.float32)
    except (TypeError, ValueError):
        return None
    if a.ndim == 1 and a.size % 3 == 0:
        return a.reshape(-1, 3)
    return a if a.ndim == 2 and a.shape[1] == 3 else None


def pooled(df: DataFrame, graph: str, value: str, gate: str, top: int = 8, mask: str | None = None) -> DataFrame:
    """Per graph, of `value`: mean, max, sum, sum over the root of the number, mean weighted by the softmax of gate, mean of
    the `top` values of largest gate and of those of largest size, the logarithm of one plus the number; mean and max of
    the rows for which `mask` holds (0 without any). Sums are partial, and of each graph only `top` rows are sorted."""
    held = F.col(mask) if mask else F.lit(True)
    peaks = df.groupBy(graph).agg(F.max(gate).alias("_peak"))
    weight = F.exp(F.col(gate) - F.col("_peak"))
    sums = df.join(peaks, graph).groupBy(graph).agg(
        F.avg(value).alias("mean"), F.max(value).alias("max"), F.sum(value).alias("sum"), (F.sum(value) / F.sqrt(F.count("*"))).alias("scaled_sum"),
        (F.sum(weight * F.col(value)) / F.sum(weight)).alias("softmax_mean"), F.log1p(F.count("*")).alias("log_count"),
        F.coalesce(F.avg(F.when(held, F.col(value))), F.lit(0.0)).alias("masked_mean"), F.coalesce(F.max(F.when(held, F.col(value))), F.lit(0.0)).alias("masked_max"),
    )
    for name, order in (("top_mean", [F.desc(gate), F.desc(value)]), ("top_size_mean", [F.desc(F.abs(value)), F.desc(value)])):
        place = F.row_number().over(Window.partitionBy(graph).orderBy(*order))
        sums = sums.join(df.withColumn("_k", place).where(F.col("_k") <= top).groupBy(graph).agg(F.avg(value).alias(name)), graph)
    return sums


def pocket_summary(atoms: DataFrame, ligand: DataFrame, group: str, unit: Sequence[str], point_id: str, xyz: Sequence[str], radius: float) -> DataFrame:
    """group, atoms, residues, nearest of each group of ligand points: the atoms and units of its pocket within radius, 0
    if there are none, and the distance of the nearest atom at all (null without atoms)."""
    near = whole_groups_within(atoms, ligand, group, unit, xyz, radius).groupBy(group).agg(F.count("*").alias("atoms"), F.count_distinct(F.struct(*unit)).alias("residues"))
    marked = ligand.withColumn("_i", F.monotonically_increasing_id())
    nearest = nearest_beyond(marked, atoms, group, "_i", point_id, xyz, radius).groupBy(group).agg(F.min("distance").alias("nearest"))
    out = ligand.select(group).distinct().join(near, group, "left").join(nearest, group, "left")
    return out.select(group, F.coalesce("atoms", F.lit(0)).alias("atoms"), F.coalesce("residues", F.lit(0)).alias("residues"), "nearest")


def require_pockets(summary: DataFrame, group: str, radius: float) -> DataFrame:
    """An error names a group without a residue within radius, and how far the nearest atom is."""
    if row := summary.where("residues = 0").orderBy(group).first():
        raise GateError(f"no residue within {radius} of {row[group]}; the nearest atom is {row['nearest']} away")
    return summary
