"""What must hold of the reference structures before anything is scored against them."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from siftline.functions import chemistry as chem
from siftline.operators.gates import GateError
from siftline.sources import fetch, molecular


def bound_ligand(spark: SparkSession, path: str, heavy_atoms: int, smiles: str | None = None) -> int:
    """Heavy atoms of the single record of a bound ligand, which must be so many; `smiles` must have as many too."""
    rows = molecular.read_sdf(spark, path).select(F.size(F.filter("atoms", lambda a: ~a["element"].isin("H", "D"))).alias("n")).take(2)
    if len(rows) != 1 or rows[0]["n"] != heavy_atoms:
        raise GateError(f"{path}: one structure of {heavy_atoms} heavy atoms is needed")
    if smiles and chem.properties(chem.parse(smiles))["heavy_atoms"] != heavy_atoms:
        raise GateError(f"the reference SMILES does not have {heavy_atoms} heavy atoms")
    return heavy_atoms


def target(spark: SparkSession, path: str, chain: str, accession: str, residues: dict[int, str]) -> dict[int, str]:
    """A target's chain must name this database entry and have these residues."""
    entries = molecular.database_references(spark, path)
    if entries.where((F.col("chain") == chain) & F.col("text").contains(accession)).isEmpty():
        raise GateError(f"{path}: chain {chain} does not name {accession}")
    found = {n: molecular.residue_name(spark, path, chain, int(n)) for n in residues}
    if wrong := [n for n, name in residues.items() if found[n] != name]:
        raise GateError(f"{path}: residue {wrong[0]} of chain {chain} is {found[wrong[0]]}, not {residues[wrong[0]]}")
    return found


def validate(spark: SparkSession, folder: str, checksums: dict[str, str], ligand: dict, complex_file: str, targets: list[dict]) -> dict:
    """Checks files, ligand, its instance in the complex and the targets; returns what was found, for the quality report.

    ligand: file, heavy_atoms, resname, chain, resseq and perhaps smiles. targets: file, chain, accession, residues.
    """
    at = lambda name: os.path.join(folder, name)
    if bad := [name for name, ok in fetch.verify(checksums, folder).items() if not ok]:
        raise GateError(f"changed or missing files: {bad}")
    n = bound_ligand(spark, at(ligand["file"]), ligand["heavy_atoms"], ligand.get("smiles"))
    instances = {(r["chain"], int(r["resseq"])): r["n"] for r in molecular.residue_instances(molecular.read_pdb_atoms(spark, at(complex_file)), ligand["resname"]).collect()}
    bound = instances.get((ligand["chain"], int(ligand["resseq"])))
    if bound != n:
        raise GateError(f"the bound instance has {bound} heavy atoms, not {n}")
    known = {t["file"]: target(spark, at(t["file"]), t["chain"], t["accession"], t.get("residues", {})) for t in targets}
    return {"bound_heavy_atoms": bound, "expected_heavy_atoms": n, "targets": sorted(known), "known_targets": sorted(known), "residues": known}
