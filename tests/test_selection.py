import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftline.operators import dedupe, filters, quantiles, ranking, selection
from siftline.operators.gates import GateError


def pool(spark):
    rows = [(i, f"{i:040x}", i / 100, (99 - i) / 100, 0.5, i / 100, 0, f"s{i // 2}") for i in range(100)]
    return spark.createDataFrame(rows, "row_ord int, structure_key string, pnu_consensus double, pharm2d_similarity double, quality_score double, library_evidence_score double, soft_alert_count int, murcko_scaffold string")


def test_prescreen_fills_all_quotas_without_repeats(spark):
    quotas = {"pnu_2d": 16, "pharm2d": 12, "scaffold_diversity": 36, "exploration": 16}
    got = selection.fill_channels(pool(spark), quotas, 1).collect()
    assert len(got) == len({r["structure_key"] for r in got}) == 80
    counts = {c: sum(r["prescreen_channel"] == c for r in got) for c in quotas}
    assert counts == quotas
    assert sorted(r["prescreen_source_rank"] for r in got) == list(range(1, 81))


def test_pool_gates(spark):
    df = pool(spark).withColumns({"hard_filter_pass": F.lit(1), "source_pool": F.when(F.col("row_ord") < 10, "activity_recorded").otherwise("unlabeled")})
    fractions = {"pnu_2d": 0.2, "pharm2d": 0.15, "scaffold_diversity": 0.45, "exploration": 0.2}
    got = selection.prescreen_pool(df, fractions, 40, 20, 1)
    assert got.count() == 40 and got.where("source_pool = 'activity_recorded'").count() == 10
    with pytest.raises(GateError, match="no room"):
        selection.prescreen_pool(df, fractions, 20, 20, 1)
    with pytest.raises(GateError, match="too few"):
        selection.prescreen_pool(df, fractions, 200, 20, 1)


def final_rows(spark):
    rows = [(i, f"{i:040x}", (i * 37 % 100) / 100, (i * 53 % 100) / 100, 0.4 + (i % 50) / 100, (i * 11 % 100) / 100, i % 3, f"s{i % 40}", "activity_recorded" if i % 20 == 0 else "unlabeled", "embed_failed" if i % 9 == 4 else "ok", (i * 7 % 100) / 100, 0.4 + (i % 60) / 100, [i % 64, i % 50, i % 33]) for i in range(240)]
    names = "row_ord int, structure_key string, pnu_consensus double, pharm2d_similarity double, quality_score double, library_evidence_score double, soft_alert_count int, murcko_scaffold string, source_pool string, structure3d_status string, structure3d_score double, qed double, bits array<int>"
    return spark.createDataFrame(rows, names)


def test_final_selection_keeps_caps_and_totals(spark):
    targets = {"pnu_structure3d_enrichment": 10, "pnu_2d_enrichment": 10, "pnu_pharm2d_enrichment": 10, "h9e937_pocket_discovery": 8, "diversity": 12, "exploration": 6}
    df = final_rows(spark)
    got = selection.final_selection(df, targets, 1, "bits").join(df, "structure_key").collect()
    by = {}
    for r in got:
        by.setdefault(r["selection_channel"], []).append(r)
    active = df.where("source_pool = 'activity_recorded' and structure3d_status = 'ok'").count()
    assert {c: len(v) for c, v in by.items()} == targets | {"activity_recorded_all": active}
    assert len({r["structure_key"] for r in got}) == len(got)
    groups = {}
    for r in got:
        if r["source_pool"] == "unlabeled":
            groups[r["murcko_scaffold"]] = groups.get(r["murcko_scaffold"], 0) + 1
    assert max(groups.values()) <= 6
    # the first ranked channel is the greedy walk by score under its cap
    left = sorted((r for r in df.collect() if r["source_pool"] == "unlabeled" and r["structure3d_status"] == "ok"), key=lambda r: (-r["structure3d_score"], -r["quality_score"], r["row_ord"]))
    seen, walk = {}, []
    for r in left:
        if seen.get(r["murcko_scaffold"], 0) < 6 and len(walk) < 10:
            seen[r["murcko_scaffold"]] = seen.get(r["murcko_scaffold"], 0) + 1
            walk.append(r["structure_key"])
    assert [r["structure_key"] for r in sorted(by["pnu_structure3d_enrichment"], key=lambda r: r["selection_rank"])] == walk


def test_final_selection_says_when_short(spark):
    with pytest.raises(GateError, match="short"):
        selection.final_selection(final_rows(spark).limit(30), {"pnu_2d_enrichment": 500}, 1, "bits")


def test_active_rows_without_a_structure(spark):
    df = final_rows(spark).withColumn("compound_id", F.concat(F.lit("c"), "row_ord"))
    gone = selection.activity_failures(df).collect()
    assert [r["compound_id"] for r in gone] == ["c40", "c220"] and gone[0]["structure3d_status"] == "embed_failed"
    with pytest.raises(GateError, match="2 active rows"):
        selection.final_selection(df, {"pnu_2d_enrichment": 5}, 1, "bits", require_all_active=True)
    assert selection.activity_failures(df.withColumn("structure3d_status", F.lit(None).cast("string"))).count() == 12


@pytest.mark.parametrize("beside", [1, 7, 1024])
def test_maxmin_picks_as_the_plain_walk(spark, beside):
    rng = np.random.default_rng(3)
    sets = [sorted({int(x) for x in rng.integers(0, 25, int(rng.integers(0, 6)))}) for _ in range(60)] + [[], [1, 2], [1, 2], None]
    rows = [(f"k{i:02d}", i * 37 % 64, s) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "id string, o int, v array<int>").repartition(3)
    walk = [(k, set(s or [])) for k, _, s in sorted(rows, key=lambda r: r[1])]
    want, far = [], [math.inf] * len(walk)
    while len(want) < 20:
        now = max(range(len(walk)), key=lambda i: (far[i], -i))
        want.append(walk[now][0])
        far = [-1 if f < 0 or i == now else min(f, 1 - (len(s & walk[now][1]) / len(s | walk[now][1]) if s | walk[now][1] else 1.0)) for i, (f, (_, s)) in enumerate(zip(far, walk, strict=True))]
    got = selection.maxmin_pick(df, "id", "v", [F.col("o")], 20, beside).orderBy("pick_rank").collect()
    assert [r["id"] for r in got] == want
    if beside == 7:
        assert selection.maxmin_pick(df, "id", "v", [F.col("o")], 500, beside).count() == 64
        assert selection.maxmin_pick(df.limit(0), "id", "v", [F.col("o")], 5).count() == 0


def plain_channels(rows, quotas, seed):
    h = lambda r, s: hashlib.sha256(f"{s}|{r['structure_key']}".encode()).hexdigest()[:16]
    consensus = sorted(r["pnu_consensus"] for r in rows)
    median = (consensus[(len(rows) - 1) // 2] + consensus[len(rows) // 2]) / 2
    taken, out = set(), {c: [] for c in quotas}

    def fill(channel, order):
        for r in order:
            if len(out[channel]) < quotas[channel] and r["row_ord"] not in taken:
                taken.add(r["row_ord"])
                out[channel].append(r["structure_key"])

    by = lambda name: sorted(rows, key=lambda r: (-r[name], -r["quality_score"], r["row_ord"]))
    for no, channel in enumerate(quotas):
        if channel in ("pnu_2d", "pharm2d"):
            fill(channel, by("library_evidence_score" if channel == "pnu_2d" else "pharm2d_similarity"))
            continue
        a, b = (1, 2) if channel == "scaffold_diversity" else (11, 12)
        groups = {}
        for r in rows:
            if r["row_ord"] not in taken and (a == 1 or (r["pnu_consensus"] <= median and r["soft_alert_count"] == 0 and r["quality_score"] >= 0.35)):
                groups.setdefault(r["murcko_scaffold"], []).append(r)
        firsts = [min(g, key=lambda r: (r["soft_alert_count"] != 0, -r["quality_score"], h(r, seed + a), r["row_ord"])) for g in groups.values()]
        fill(channel, sorted(firsts, key=lambda r: (h(r, seed + b), r["row_ord"])))
    for no, channel in enumerate(quotas):
        fill(channel, sorted(rows, key=lambda r: (-r["quality_score"], h(r, seed + 100 + no), r["row_ord"])))
    return [(k, channel) for channel, keys in out.items() for k in keys]


@pytest.mark.parametrize(("n", "groups", "quotas"), [(900, 300, (20, 15, 45, 20)), (900, 7, (30, 30, 40, 30)), (4000, 4000, (5, 5, 5, 5)), (90, 10, (20, 20, 30, 20))])
def test_channels_equal_the_plain_walk(spark, n, groups, quotas):
    rng = np.random.default_rng(n + groups)
    third = lambda x: x if rng.random() > 0.33 else 0.5  # noqa: E731  ties, a third of all rows
    rows = [dict(row_ord=i, structure_key=f"{i * 7919:012x}", pnu_consensus=third(float(rng.random())), pharm2d_similarity=third(float(rng.random())), quality_score=float(rng.integers(0, 20)) / 20, library_evidence_score=third(float(rng.random())), soft_alert_count=int(rng.integers(0, 3)), murcko_scaffold=f"s{0 if rng.random() < 0.3 else rng.integers(groups)}") for i in range(n)]
    schema = "row_ord int, structure_key string, pnu_consensus double, pharm2d_similarity double, quality_score double, library_evidence_score double, soft_alert_count int, murcko_scaffold string"
    named = dict(zip(("pnu_2d", "pharm2d", "scaffold_diversity", "exploration"), quotas, strict=True))
    got = selection.fill_channels(spark.createDataFrame([tuple(r.values()) for r in rows], schema).repartition(4), named, 1).orderBy("prescreen_source_rank").collect()
    want = plain_channels(rows, named, 1)
    assert [(r["structure_key"], r["prescreen_channel"]) for r in got] == want


def test_median_is_exact(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(8)
    many = [float(x) for x in rng.normal(size=501)]
    cases = [[], [1.0], [1.0, 2.0], [3.0, None, 1.0, 2.0], [5.0] * 40 + [1.0] * 39 + [9.0], many, many + [0.25] * 300, [-1.7e308, 1.7e308, 1.0, 2.0], [5e-324, 1e-323, 0.0], [-inf, inf, 0.0], [nan, nan, 1.0], [-inf, -inf, 3.0, inf], [2.0**-i for i in range(60)]]
    for values in cases:
        df = spark.createDataFrame([(v,) for v in values], "v double")
        want = df.agg(F.median("v")).first()[0]
        for buckets in (4, 4096):
            monkeypatch.setattr(quantiles, "BUCKETS", buckets)
            got = quantiles.exact_median(df, "v")
            assert got == want or (got != got and want != want), (values[:5], buckets)
    seen = []
    monkeypatch.setattr(quantiles, "BUCKETS", 16)
    plain = quantiles._histogram
    monkeypatch.setattr(quantiles, "_histogram", lambda *a: seen.append(plain(*a)) or seen[-1])
    df = spark.createDataFrame([(v,) for v in many], "v double")
    assert quantiles.order_statistics(df, "v", lambda n: [0, 17, n - 1]) == [min(many), sorted(many)[17], max(many)]
    assert seen and max(map(len, seen)) <= 16


def test_caps_reach_the_scan(spark):
    df = final_rows(spark)
    taken = df.groupBy("murcko_scaffold").agg(F.lit(1).alias("n")).limit(5)
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan(ranking.capped_take(df, "murcko_scaffold", [F.col("row_ord")], 20, 3, taken))
    assert "WindowGroupLimit" in plan(ranking.stratified_bottom_k(df, "murcko_scaffold", "structure_key", 1, 50, "row_ord"))


def test_maxmin_takes_the_farthest(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [1, 2]), (3, [3]), (4, [1, 2, 4])], "id int, v array<int>")
    got = selection.maxmin_pick(df, "id", "v", [F.col("id")], 3).orderBy("pick_rank").collect()
    assert [r["id"] for r in got] == [1, 3, 4]


def test_global_dedupe_over_sources(spark):
    files = [["CCO"], ["CCO", "CCN"], ["CCN", "CCC"], ["c1ccccc1", "CCO"], ["CCCl", "CCC"]]
    rows = [(i, j, "activity_recorded" if i == 0 else "unlabeled", s) for i, names in enumerate(files) for j, s in enumerate(names)]
    df = spark.createDataFrame(rows, "source_index int, row_ord int, source_pool string, key string")
    out = dedupe.first_wins(df, "key", ["source_index", "row_ord"], F.lit(True), "source_pool", "activity_recorded").collect()
    assert len(out) == 9 and sum(r["dedup_status"] == "unique_parent" for r in out) == 5
    copies = {(r["source_index"], r["row_ord"]): r["resolved_pool"] for r in out if r["dedup_status"] == "exact_duplicate"}
    assert copies == {(1, 0): "activity_recorded", (3, 1): "activity_recorded", (2, 0): "unlabeled", (4, 1): "unlabeled"}


def test_running_overlap_is_so_far(spark):
    df = spark.createDataFrame([(0, "k", "activity_recorded"), (1, "k", "activity_recorded"), (2, "k", "unlabeled"), (3, None, "unlabeled")], "o int, key string, pool string")
    out = dedupe.running_overlap(df, "key", ["o"], F.col("pool") == "activity_recorded", "flag").orderBy("o").collect()
    assert [r["flag"] for r in out] == [0, 1, 1, 0]


def test_hard_filter_bounds_are_inclusive(spark):
    names = "id int, heavy_atoms int, mw double, clogp double, tpsa double, hbd int, hba int, rotatable_bonds int, ring_count int, formal_charge int, atomic_numbers array<int>"
    df = spark.createDataFrame([(1, 9, 179.0, 0.0, 30.0, 1, 2, 1, 1, 0, [6, 8]), (2, 10, 180.0, -1.5, 15.0, 7, 14, 15, 10, -2, [6]), (3, 10, 180.0, 7.0, 15.0, 7, 14, 15, 10, 3, [26])], names)
    got = {r["id"]: r["hard_filter_reasons"] for r in filters.hard_filter(df).collect()}
    assert got == {1: "heavy_atoms_low|mw_low", 2: "", 3: "disallowed_element|clogp_high|formal_charge_extreme"}
