"""Embedding near-duplicates by int8 tile products with error bounds.

A unit vector u is held as s*q + e with integers q in -127..127; |e| is measured, not assumed. For two vectors
u.v = s*t*(q.p) + error, |error| <= |s q||f| + |e||t p| + |e||f|. A tile product of the integers is exact in floating
point; only pairs whose upper bound reaches the threshold are computed anew, in double precision on the given numbers.

Equal vectors are one class with a count. Classes are dealt to tiles around pivots (PIVOTS at most, vectors that only
decide which cell a vector lies in). Cells whose pivots lie further apart than the cells reach and the threshold's angle
are skipped, then pairs of tiles whose caps do, which the triangle inequality on the sphere makes safe. The pairs of
cells have a bound and are told to every task; the tiles and their pairs grow with the input and are joined. A tile pair
emits a count per vector and a spanning forest of its links, never the links themselves, so a large group of near copies
stays linear.

Defined results: null vectors, zero vectors and ones with null or non-finite components link with nothing, nor do
vectors of different lengths; repeated rows are linked copies; rows with a null id are linked like others, so two
vectors meet through one, but name no component (one of nameless rows alone is null); rows of one id are one node of the components; only the named columns are read;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import components, discard, fresh_ids, map_batches, materialize

TILE_ROWS = 8192
PIVOTS = 1024
SLACK = 1e-6


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at unit length, safe against overflow and underflow of squares."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def quantise(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """q int8, scale s, |s q| and |u - s q| of unit rows; the norms rounded up."""
    s = np.abs(u).max(1) / 127
    q = np.rint(u / s[:, None]).astype(np.int8)
    back = q * s[:, None]
    return q, s, np.linalg.norm(back, axis=1) * (1 + 1e-12), np.linalg.norm(u - back, axis=1) * (1 + 1e-12) + 1e-15


def close_pairs(ua: np.ndarray, ub: np.ndarray, threshold: float, same: bool, chunk: int = 1024):
    """Index arrays (i, j) of rows with cosine >= threshold; with `same`, each pair of different rows once."""
    (qa, sa, na, ea), (qb, sb, nb, eb) = quantise(ua), (quantise(ub) if not same else (None,) * 4)
    if same:
        qb, sb, nb, eb = qa, sa, na, ea
    kind = np.float32 if ua.shape[1] * 127 * 127 < 1 << 24 else np.float64  # in which the integer sums are exact
    right = np.ascontiguousarray(qb.T.astype(kind))
    for at in range(0, len(ua), chunk):
        rows = slice(at, at + chunk)
        upper = (qa[rows].astype(kind) @ right).astype(np.float32, copy=False)
        upper *= sb.astype(np.float32)
        upper *= sa[rows, None].astype(np.float32)
        upper += (na[rows, None] * eb.max() + ea[rows, None] * (nb + eb).max()).astype(np.float32)
        i, j = np.nonzero(upper >= threshold - SLACK)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        exact_bound = na[i] * eb[j] + ea[i] * (nb[j] + eb[j])
        maybe = (upper[i - at, j] - (na[i] * eb.max() + ea[i] * (nb + eb).max())) + exact_bound >= threshold - 2 * SLACK
        i, j = i[maybe], j[maybe]
        for k in range(0, len(i), 1 << 16):
            a, b = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            near = np.einsum("ij,ij->i", ua[a], ub[b]) >= threshold
            yield a[near], b[near]


def local_forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node reachable from each of n nodes over links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while True:
            deeper = new[new]
            if (deeper == new).all():
                break
            new = deeper
        label = new[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def link(df: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", tile_rows: int = TILE_ROWS) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    spark = df.sparkSession
    double = "double" in dict(df.dtypes)[vector_col]
    kind = np.float64 if double else np.float32
    rows = df.select(df[id_col].cast("long").alias("vec_id"), df[vector_col].alias("v"))

    def keys():
        def each(b):
            out, raw = [], []
            for v in b.column(1):
                x = np.array(v.values if v.is_valid else [], kind) if v.is_valid and v.values.null_count == 0 else np.zeros(0, kind)
                fine = len(x) and np.isfinite(x).all() and x.any()
                data = (x + kind(0)).tobytes() if fine else None
                raw.append(data)
                out.append(hashlib.blake2b(data, digest_size=16).digest() if fine else None)
            return pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary()), pa.array(raw, pa.binary())], ["vec_id", "key", "raw"])

        return each

    keyed = materialize(map_batches(rows, keys, "vec_id long, key binary, raw binary").withColumn("content", F.xxhash64("key")), "vectors")
    classes = materialize(keyed.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.any_value("raw").alias("raw")), "classes")
    nameless = classes.where("rep is null").select("key")
    if nameless.isEmpty():
        classes = classes.withColumn("lent", F.lit(False))
    else:  # an id for the time being
        ids = fresh_ids(nameless, classes.where("rep is not null").select(F.col("rep").alias("id")))
        classes = classes.join(ids, "key", "left").select("key", F.coalesce("rep", "id").alias("rep"), "n", "raw", F.col("id").isNotNull().alias("lent"))
        classes = materialize(classes, "named-classes")
    # A class is known to the tiles by its digest; ids may be null or repeated.
    found = _tile_links(classes.select("key", "n", "raw"), threshold, kind, tile_rows)
    weights = found.groupBy("key").agg(F.sum("weight").alias("weight"))
    nodes = classes.select("key", "rep")
    edges = found.where("parent <> key").select("key", "parent").join(nodes.select("key", F.col("rep").alias("a")), "key").join(nodes.select(F.col("key").alias("parent"), F.col("rep").alias("b")), "parent")
    # the vectors of one id are one node: ids with different ones are linked to their classes
    several = keyed.where("vec_id is not null").groupBy("vec_id").agg((F.min("content") != F.max("content")).alias("differ")).where("differ").select("vec_id")
    several = materialize(several, "shared-ids")
    of_one = keyed.join(several, "vec_id", "left_semi").join(nodes, "key").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    comp = components(edges.select("a", "b").unionByName(of_one), "vector-components")
    info = classes.drop("raw").join(weights, "key", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    info = info.select("key", "rep", "lent", (F.col("n") - 1 + F.coalesce("weight", F.lit(0))).alias("n_links"), F.coalesce("component_id", "rep").alias("_component"))
    if not nameless.isEmpty():
        names = info.groupBy("_component").agg(F.min(F.when(~F.col("lent"), F.col("rep"))).alias("_name"))
        info = info.join(names, "_component").withColumn("_component", F.col("_name"))
    out = keyed.select("vec_id", "key").join(info.select("key", "n_links", "_component"), "key", "left")
    if not several.isEmpty():  # and so are its rows that link with nothing
        own = out.join(several, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("_component").alias("_own"))
        out = out.join(own, "vec_id", "left").withColumn("_component", F.coalesce("_component", "_own"))
    component = F.when(F.col("key").isNull(), F.coalesce("_component", "vec_id")).otherwise(F.col("_component"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _near_cells(spark, pivots: dict, reach: list, angle: float) -> DataFrame:
    """d, cell, other: cells that may hold similar vectors, cell <= other. PIVOTS**2 / 2 rows for a length, at most."""
    parts = []
    for d, p in pivots.items():
        mine = sorted((r["cell"], r["reach"]) for r in reach if r["d"] == d)
        cells, far = np.array([c for c, _ in mine], np.int32), np.array([x for _, x in mine])
        apart = np.arccos(np.clip(p[cells].astype(float) @ p[cells].T.astype(float), -1, 1))
        i, j = np.nonzero(apart <= far[:, None] + far + angle)
        i, j = i[i <= j], j[i <= j]
        parts.append(pa.table({"d": np.full(len(i), d, np.int32), "cell": cells[i], "other": cells[j]}))
    none = pa.table({c: pa.array([], pa.int32()) for c in ("d", "cell", "other")})
    return spark.createDataFrame(pa.concat_tables([none, *parts]))


def _tile_links(classes: DataFrame, threshold: float, kind, tile_rows: int) -> DataFrame:
    """key, weight (rows of other classes linked), parent (the key it hangs from): a row per class and tile pair with links."""
    spark = classes.sparkSession
    size = np.dtype(kind).itemsize
    lengths = [(r["len"] // size, r["n"]) for r in classes.groupBy(F.octet_length("raw").alias("len")).agg(F.count("*").alias("n")).collect()]
    per = {d: max(256, min(tile_rows, (1 << 21) // d)) for d, _ in lengths}
    pivots = {}
    for d, n in lengths:
        want = min(PIVOTS, math.ceil(n / per[d]))
        picked = classes.where(F.octet_length("raw") == d * size).orderBy("key").select("raw").limit(want).collect()
        pivots[d] = unit(np.stack([np.frombuffer(r["raw"], kind) for r in picked])).astype(np.float32)
    sent = spark.sparkContext.broadcast(pivots)

    def cells():
        p = sent.value

        def each(b):
            raw = [np.frombuffer(r, kind) for r in b.column(2).to_pylist()]
            cell = [int(np.argmax(p[len(x)] @ (unit(x[None])[0].astype(np.float32)))) for x in raw]
            return pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([len(x) for x in raw], pa.int32()), pa.array(cell, pa.int32())], ["key", "n", "raw", "d", "cell"])

        return each

    dealt = materialize(map_batches(classes.select("key", "n", "raw"), cells, "key binary, n long, raw binary, d int, cell int"), "cells")
    counts = dealt.groupBy("d", "cell").agg(F.count("*").alias("m"))
    width = F.create_map(*[F.lit(x) for d, k in per.items() for x in (d, k)]) if per else F.lit(None)
    parts = F.ceil(F.col("m") / width[F.col("d")]) if per else F.lit(1)
    tiled = dealt.join(counts, ["d", "cell"]).withColumn("sub", F.pmod(F.xxhash64("key"), parts).cast("int"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        u = unit(np.stack([np.frombuffer(r, kind) for r in pdf["raw"]]))
        pivot = sent.value[u.shape[1]][int(pdf["cell"].iloc[0])].astype(float)
        reach = float(np.arccos(np.clip((u @ pivot / np.linalg.norm(pivot)).min(), -1, 1)))
        centre = u.mean(0)
        norm = np.linalg.norm(centre)
        centre = centre / norm if norm > 1e-9 else u[0]
        radius = float(np.arccos(np.clip((u @ centre).min(), -1, 1)))
        d, cell, sub = (int(pdf[c].iloc[0]) for c in ("d", "cell", "sub"))
        return pd.DataFrame({"tile": [f"{d}:{cell}:{sub}"], "d": [d], "cell": [cell], "reach": [reach], "keys": [b"".join(pdf["key"])], "ns": [pdf["n"].to_numpy(np.int64).tobytes()], "raw": [b"".join(pdf["raw"])], "centre": [centre.astype(np.float32).tobytes()], "radius": [radius]})

    tiles = materialize(tiled.groupBy("d", "cell", "sub").applyInPandas(pack, "tile string, d int, cell int, reach double, keys binary, ns binary, raw binary, centre binary, radius double"), "tiles")
    discard(dealt)
    angle = math.acos(min(threshold, 1.0)) + 1e-3
    reach = tiles.groupBy("d", "cell").agg(F.max("reach").alias("reach")).collect()  # PIVOTS rows for a length, at most
    near = F.broadcast(_near_cells(spark, pivots, reach, angle))
    one = tiles.select("d", "cell", F.col("tile").alias("ta"), F.col("centre").alias("ca"), F.col("radius").alias("ra"))
    two = tiles.select("d", F.col("cell").alias("other"), F.col("tile").alias("tb"), F.col("centre").alias("cb"), F.col("radius").alias("rb"))
    met = one.join(near, ["d", "cell"]).join(two.hint("merge"), ["d", "other"]).where("cell < other or ta <= tb")

    def neighbours():
        def each(b):
            ta, ca, ra, tb, cb, rb = (b.column(c).to_pylist() for c in range(6))
            close = [math.acos(max(-1.0, min(1.0, float(np.frombuffer(x, np.float32) @ np.frombuffer(y, np.float32))))) <= r + s + angle for x, y, r, s in zip(ca, cb, ra, rb, strict=True)]
            mask = pa.array(close, pa.bool_())
            return pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(3).filter(mask)], ["ta", "tb"])

        return each

    pairs = map_batches(met.select("ta", "ca", "ra", "tb", "cb", "rb"), neighbours, "ta string, tb string")
    side = lambda s: tiles.select(F.col("tile").alias(f"t{s}"), F.col("keys").alias(f"keys_{s}"), F.col("ns").alias(f"ns_{s}"), F.col("raw").alias(f"raw_{s}"), *([F.col("d")] if s == "a" else []))
    both = pairs.join(side("a"), "ta").join(side("b"), "tb").select("ta", "tb", "d", "keys_a", "ns_a", "raw_a", "keys_b", "ns_b", "raw_b")

    def products(batches):
        for b in batches:
            for i in range(b.num_rows):
                ta, tb, d, ka, wa, ra, kb, wb, rb = (b.column(c)[i].as_py() for c in range(9))
                same = ta == tb
                ua = unit(np.frombuffer(ra, kind).reshape(-1, d))
                ub = ua if same else unit(np.frombuffer(rb, kind).reshape(-1, d))
                na, nb = np.frombuffer(wa, np.int64), np.frombuffer(wb, np.int64)
                shift = 0 if same else len(ua)
                n = len(ua) if same else len(ua) + len(ub)
                weight, label = np.zeros(n, np.int64), np.arange(n)
                for x, y in close_pairs(ua, ub, threshold, same):
                    weight[: len(ua)] += np.bincount(x, nb[y], len(ua)).astype(np.int64)
                    weight[shift : shift + len(ub)] += np.bincount(y, na[x], len(ub)).astype(np.int64)
                    label = local_forest(n, np.concatenate((np.arange(n), x)), np.concatenate((label, y + shift)))
                keys = np.frombuffer(ka if same else ka + kb, "V16")
                at = np.flatnonzero(weight)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in keys[at]], pa.binary()), pa.array(weight[at]), pa.array([k.tobytes() for k in keys[label[at]]], pa.binary())], ["key", "weight", "parent"])

    out = materialize(both.mapInArrow(products, "key binary, weight long, parent binary"), "links")
    discard(tiles)
    return out
