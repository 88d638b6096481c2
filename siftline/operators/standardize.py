"""Standardization of raw structures: status, parent, identity keys. The chemistry is a pluggable kernel."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import Any, NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions import chemistry as chem
from siftline.functions.scalars import group_label, jaccard

# Counter-ions and solvents that may be removed beside one organic parent.
COUNTERIONS = [
    "[Cl-]", "[Br-]", "[I-]", "[F-]", "Cl", "Br", "I", "O", "N", "[Na+]", "[K+]", "[Li+]", "[Ca+2]", "[Mg+2]", "[Zn+2]",
    "O=S(=O)(O)O", "O=P(O)(O)O", "O=C(O)C", "CS(=O)(=O)O", "O=C(O)C(=O)O", "O=C(O)/C=C/C(=O)O", "O=C(O)/C=C\\C(=O)O",
    "O=C(O)CCC(=O)O", "O=C(O)C(O)C(O)C(=O)O", "O=C(O)C(O)(CC(=O)O)CC(=O)O", "O=C(O)c1ccccc1", "Cc1ccc(S(=O)(=O)O)cc1",
    "CCO", "CO", "CC(C)O", "CC(=O)C", "CCOC(C)=O", "CS(C)=O", "CN(C)C=O", "C1CCOC1", "C1COCCO1",
]
ALLOWED = (5, 6, 7, 8, 9, 14, 15, 16, 17, 35, 53)
SCHEMA = (
    "status string, component_class string, original_fragment_count int, removed_component_smiles string, charged_parent_smiles string, standardized_smiles string, "
    "connectivity_smiles string, structure_key string, connectivity_key string, std_mol_weight double, heavy_atom_count int, formal_charge int, has_permanent_charge int, model_eligible int"
)


class Counts(NamedTuple):
    """How many parts a structure has, and how many of them are so; numbers or columns."""

    n: Any
    metals: Any  # unlisted with a metal
    organic: Any  # unlisted with carbon
    listed: Any
    listed_organic: Any
    carbons: Any


# Status and class, the first that holds. A lone part is the parent even if it is listed.
RULES: list[tuple[str, str, Callable[[Counts], Any]]] = [
    ("quarantine_special_element", "metal_or_special", lambda c: c.metals > 0),
    ("quarantine_ambiguous_components", "ambiguous_multi_component", lambda c: (c.n > 1) & ((c.organic != 1) | (c.listed != c.n - 1))),
    ("quarantine_no_organic_parent", "no_organic_parent", lambda c: c.carbons == 0),
    ("valid_parent", "single_component", lambda c: c.n == 1),
    ("valid_parent", "organic_counterion_salt", lambda c: c.listed_organic > 0),
    ("valid_parent", "simple_salt_or_solvate", lambda c: c.n > 1),
]


def fragment_status(parts: Column) -> Column:
    """struct(status, component_class, parent) from an array of struct(smiles, has_carbon, has_metal, known_counterion),
    by RULES. `parent` is its position, from 1; null where there is none."""
    count = lambda test: F.size(F.filter(parts, test))
    plausible = lambda p: p["has_carbon"] & ~p["known_counterion"]
    counts = Counts(F.size(parts), count(lambda p: p["has_metal"] & ~p["known_counterion"]), count(plausible), count(lambda p: p["known_counterion"]), count(lambda p: p["known_counterion"] & p["has_carbon"]), count(lambda p: p["has_carbon"]))
    parent = F.when(counts.n == 1, 1).otherwise(F.array_position(F.transform(parts, plausible), F.lit(True)).cast("int"))
    out = F.lit(None)
    for status, kind, holds in reversed(RULES):
        found = F.struct(F.lit(status).alias("status"), F.lit(kind).alias("component_class"), (parent if status == "valid_parent" else F.lit(None).cast("int")).alias("parent"))
        out = F.when(holds(counts), found).otherwise(out)
    return out


def _listed() -> frozenset[str]:
    return frozenset(chem.write(chem.parse(s)) for s in COUNTERIONS)


class Part(NamedTuple):
    mol: Any
    text: str
    carbon: bool
    metal: bool
    listed: bool


def parts_of(smiles: str, listed: frozenset[str]) -> list[Part]:
    """A structure's unconnected parts; none of a blank text."""
    out = []
    for mol in chem.fragments(chem.parse(smiles)) if smiles else []:
        numbers, text = {chem.NUMBERS[a.element] for a in mol.atoms}, chem.write(mol)
        out.append(Part(mol, text, 6 in numbers, bool(numbers & chem.METALS), text in listed))
    return out


def counted(parts: Sequence[Part]) -> Counts:
    return Counts(len(parts), sum(p.metal and not p.listed for p in parts), sum(p.carbon and not p.listed for p in parts), sum(p.listed for p in parts), sum(p.listed and p.carbon for p in parts), sum(p.carbon for p in parts))


def identity(parent: Part, allowed: Sequence[int]) -> dict:
    """What a parent is known by: its neutral form, keys and counts."""
    neutral = chem.uncharged(parent.mol)
    found, names = chem.properties(neutral), {"standardized_smiles": chem.write(neutral), "connectivity_smiles": chem.write(neutral, stereo=False)}
    eligible = not set(found["atomic_numbers"]) - {1, *allowed}
    keys = {key: hashlib.sha1(names[name].encode()).hexdigest() for key, name in (("structure_key", "standardized_smiles"), ("connectivity_key", "connectivity_smiles"))}
    weight = None if found["mw"] is None else round(found["mw"], 6)
    return names | keys | {"charged_parent_smiles": parent.text, "std_mol_weight": weight, "heavy_atom_count": found["heavy_atoms"], "formal_charge": found["formal_charge"], "has_permanent_charge": int(found["formal_charge"] != 0), "model_eligible": int(eligible)}


def standardize_one(smiles: str | None, listed: frozenset[str], allowed: Sequence[int] = ALLOWED) -> dict:
    """SCHEMA's values of one structure, with the reduced kernel."""
    blank = {"component_class": "", "removed_component_smiles": "", "original_fragment_count": 0, "has_permanent_charge": 0, "model_eligible": 0}
    out = dict.fromkeys(c.split()[0] for c in SCHEMA.split(", ")) | blank
    try:
        parts = parts_of((smiles or "").strip(), listed)
    except chem.SmilesError:
        return out | {"status": "invalid_smiles"}
    if not parts:
        return out | {"status": "empty_smiles"}
    counts = counted(parts)
    status, kind = next((status, kind) for status, kind, holds in RULES if holds(counts))
    out |= {"status": status, "component_class": kind, "original_fragment_count": len(parts)}
    if status == "valid_parent":
        parent = next(p for p in parts if counts.n == 1 or (p.carbon and not p.listed))
        out |= identity(parent, allowed) | {"removed_component_smiles": ".".join(sorted(p.text for p in parts if p is not parent))}
        if not out["model_eligible"]:
            out["status"] = "quarantine_special_element"
    return out


def standardize(df: DataFrame, smiles: str = "original_smiles", kernel: Callable[[str | None, frozenset[str]], dict] = standardize_one) -> DataFrame:
    """All columns of df and those of SCHEMA. An error of the kernel becomes status standardization_error:<type>."""

    @F.pandas_udf(SCHEMA)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        listed = _listed()  # once per task
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for values in batches:
            rows = []
            for v in values:
                try:
                    rows.append(kernel(v, listed))
                except Exception as e:  # noqa: BLE001
                    rows.append(dict.fromkeys(names) | {"status": f"standardization_error:{type(e).__name__}", "has_permanent_charge": 0, "model_eligible": 0})
            yield pd.DataFrame(rows, columns=names).astype({n: "Int32" for n in ("original_fragment_count", "heavy_atom_count", "formal_charge", "has_permanent_charge", "model_eligible")})

    return df.withColumn("_s", run(smiles)).select("*", "_s.*").drop("_s")


def score_structures(df: DataFrame, smiles: str, key: str, reference: Sequence[int], n_bits: int = 2048) -> DataFrame:
    """Adds counts, scaffold, circular bits and their Tanimoto similarity to reference bits; unreadable structures go."""
    fields = "mw double, heavy_atoms int, formal_charge int, ring_count int, rotatable_bonds int, hbd int, hba int, fraction_csp3 double, atomic_numbers array<int>, scaffold string, bits array<int>"
    names = [f.strip().split()[0] for f in fields.split(",")]

    @F.pandas_udf(fields)
    def run(values: pd.Series) -> pd.DataFrame:
        rows = []
        for v in values:
            try:
                mol = chem.parse(v)
                rows.append(chem.properties(mol) | {"scaffold": chem.scaffold(mol), "bits": chem.circular_bits(mol, 2, n_bits)})
            except (chem.SmilesError, TypeError):
                rows.append(dict.fromkeys(names))
        return pd.DataFrame(rows, columns=names).astype({n: "Int32" for n in ("heavy_atoms", "formal_charge", "ring_count", "rotatable_bonds", "hbd", "hba")})

    scored = df.withColumn("_s", run(smiles)).where("_s.heavy_atoms is not null").select("*", "_s.*").drop("_s")
    wanted = F.array(*[F.lit(int(b)) for b in reference]) if reference else F.array().cast("array<int>")
    return scored.withColumns({"murcko_scaffold": group_label("scaffold", key), "similarity": jaccard(F.col("bits"), wanted)}).drop("scaffold")
