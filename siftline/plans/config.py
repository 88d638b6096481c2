"""Configuration files with inheritance, and their rules."""

from __future__ import annotations

import json
from collections.abc import Callable
from operator import itemgetter
from pathlib import Path

from siftline.plans.final_score import WEIGHTS


def merged(parent: dict, child: dict) -> dict:
    """The child's values over the parent's; dicts merge, lists and scalars are replaced."""
    return parent | {k: merged(parent[k], v) if isinstance(v, dict) and isinstance(parent.get(k), dict) else v for k, v in child.items()}


def load(path: str) -> dict:
    """A JSON file; "extends" names a file beside it that it inherits from."""
    with open(path, encoding="utf-8") as f:
        own = json.load(f)
    base = own.pop("extends", None)
    return merged(load(str(Path(path).parent / base)), own) if base else own


def _sums_to(values, total: float) -> bool:
    return abs(sum(map(float, values)) - total) <= 1e-9


def rules() -> list[tuple[str, Callable[[dict], bool]]]:
    """Each rule by what it demands. Fixed cluster layouts are no rule here: Spark schedules executors."""
    pool, final, states, dock, score = map(itemgetter, ("prescreen_3d_pool", "final_selection", "ligand_states", "docking", "integrated_scoring"))
    ids = lambda c: [p["protocol_id"] for p in dock(c)["protocols"]]
    unit = lambda x: 0.0 < float(x) <= 1.0
    return [
        ("channel_fractions sum to 1", lambda c: _sums_to(pool(c)["channel_fractions"].values(), 1)),
        ("all active rows enter the pool", lambda c: bool(pool(c).get("include_all_activity_recorded"))),
        ("activity_recorded_policy is all_3d_feasible", lambda c: final(c).get("activity_recorded_policy") == "all_3d_feasible"),
        ("require_all_activity_recorded_3d is a boolean", lambda c: isinstance(final(c).get("require_all_activity_recorded_3d"), bool)),
        ("unlabeled_count is positive", lambda c: int(final(c)["unlabeled_count"]) > 0),
        ("unlabeled_channel_counts sum to unlabeled_count", lambda c: _sums_to(final(c)["unlabeled_channel_counts"].values(), int(final(c)["unlabeled_count"]))),
        ("the pool is larger than unlabeled_count", lambda c: int(pool(c)["size"]) > int(final(c)["unlabeled_count"])),
        ("one state per parent", lambda c: int(states(c).get("states_per_parent", 0)) == 1),
        ("one conformer per state", lambda c: int(states(c).get("conformers_per_state", 0)) == 1),
        ("tautomer_method is rdkit_canonical", lambda c: states(c).get("tautomer_method") == "rdkit_canonical"),
        ("embedding_failure_policy is exclude_with_report", lambda c: states(c).get("embedding_failure_policy") == "exclude_with_report"),
        ("wt is the only profile", lambda c: set(score(c)["profiles"]) == {"wt"}),
        ("predocking weights sum to 1", lambda c: _sums_to(score(c)["predocking"]["weights"].values(), 1)),
        ("profile weights sum to 1", lambda c: all(_sums_to(p["weights"].values(), 1) for p in score(c)["profiles"].values())),
        ("profiles have exactly the known components", lambda c: all(set(p["weights"]) == set(WEIGHTS) for p in score(c)["profiles"].values())),
        ("affinity coverages are in (0, 1]", lambda c: unit(score(c)["affinity"]["minimum_pose_coverage"]) and unit(score(c)["affinity"]["minimum_parent_coverage"])),
        ("similarity coverage is in (0, 1]", lambda c: unit(score(c)["minimum_postdock_3d_pose_coverage"])),
        ("similarity coverages agree", lambda c: _sums_to([score(c)["minimum_postdock_3d_pose_coverage"]], float(c["postdock_3d"]["minimum_pose_coverage"]))),
        ("protocol ids are unique", lambda c: len(ids(c)) == len(set(ids(c)))),
        ("exactly one protocol is enabled", lambda c: sum(bool(p.get("enabled")) for p in dock(c)["protocols"]) == 1),
        ("protocols are of the reference variant", lambda c: all(p.get("mutant_id", "WT") == "WT" for p in dock(c)["protocols"])),
        ("boxes have three coordinates and positive sizes", lambda c: all(len(p["box"]["center"]) == 3 == len(p["box"]["size"]) and all(float(x) > 0 for x in p["box"]["size"]) for p in dock(c)["protocols"])),
        ("protocols have a scope", lambda c: all(p.get("scope", {}).get("selection_channels") for p in dock(c)["protocols"])),
        ("production-required protocols are known", lambda c: set(dock(c).get("production_required_protocols", [])) <= set(ids(c))),
        ("excluded protocols are known", lambda c: set(score(c).get("excluded_protocols", [])) <= set(ids(c))),
        ("required protocols are known", lambda c: set(score(c).get("required_protocols", [])) <= set(ids(c))),
        ("no protocol is both required and excluded", lambda c: not set(score(c).get("required_protocols", [])) & set(score(c).get("excluded_protocols", []))),
    ]


def problems(config: dict) -> list[str]:
    """Every rule that a configuration breaks."""
    return [what for what, holds in rules() if not holds(config)]


def validate(config: dict) -> dict:
    if broken := problems(config):
        raise ValueError("; ".join(broken))
    return config
