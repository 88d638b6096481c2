"""Text formats of structures: SDF records, PDB atoms, affinity indexes."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftline.functions.scalars import ATOM_CODES, RESIDUES, coded, parsed_affinity
from siftline.sources.listing import files, qualified

SDF_SCHEMA = "title string, props map<string,string>, atoms array<struct<element:string,x:double,y:double,z:double,charge:int>>, bonds array<struct<a:int,b:int,order:int>>, molblock string"
# Charge codes of the atom block.
CHARGE_CODES = {0: 0, 1: 3, 2: 2, 3: 1, 5: -1, 6: -2, 7: -3}


def parse_sdf_record(record: str) -> dict:
    """Title, properties, atoms, bonds and mol block of one V2000 record; ValueError if malformed."""
    lines = record.split("\n")
    if len(lines) < 4:
        raise ValueError("an SDF record needs a header and a counts line")
    try:
        n_atoms, n_bonds = int(lines[3][:3]), int(lines[3][3:6])
        atoms = [{"element": a[31:34].strip(), "x": float(a[:10]), "y": float(a[10:20]), "z": float(a[20:30]), "charge": CHARGE_CODES.get(int(a[36:39] or 0), 0)} for a in lines[4 : 4 + n_atoms]]
        bonds = [{"a": int(b[:3]) - 1, "b": int(b[3:6]) - 1, "order": int(b[6:9])} for b in lines[4 + n_atoms : 4 + n_atoms + n_bonds]]
    except (ValueError, IndexError) as e:
        raise ValueError(f"malformed SDF record {lines[0]!r}: {e}") from e
    if len(atoms) != n_atoms or len(bonds) != n_bonds:
        raise ValueError(f"SDF record {lines[0]!r} is cut short")
    end = 4 + n_atoms + n_bonds
    charged = False
    while end < len(lines) and not lines[end].startswith("M  END"):
        if lines[end].startswith("M  CHG"):
            if not charged:
                charged = True
                for a in atoms:
                    a["charge"] = 0
            part = lines[end].split()[3:]
            for i in range(0, len(part) - 1, 2):
                atoms[int(part[i]) - 1]["charge"] = int(part[i + 1])
        end += 1
    props, name, value = {}, None, []
    for line in lines[end + 1 :]:
        if line.startswith(">") and "<" in line:
            name, value = line[line.index("<") + 1 : line.rindex(">")], []
        elif name is not None and line == "":
            props[name], name = "\n".join(value), None
        elif name is not None:
            value.append(line)
    if name is not None:
        props[name] = "\n".join(value)
    return {"title": lines[0].strip(), "props": props, "atoms": atoms, "bonds": bonds, "molblock": "\n".join(lines[: end + 1])}


def _between_separators(batches):
    """(file, block, place, text) of the records of a task, empty ones left out; place counts within a block."""
    part, place, begins = None, 0, False
    for pdf in batches:
        for file, block, value in zip(pdf["file"], pdf["block"], pdf["value"], strict=True):
            if (file, block) != part:
                part, place, begins = (file, block), 0, block == 0
            # behind a separator comes the end of its line; only a file's first record has none before it
            text = (value if begins else value.partition("\n")[2]).replace("\r\n", "\n").removesuffix("\r")
            begins = False
            if text.strip():
                place += 1
                yield file, block, place, text


def read_sdf(spark: SparkSession, path: str) -> DataFrame:
    """file, record_index (1-based within its file, in order) and the parsed record. A malformed record is an error; blank
    ones are left out and not counted. Records end with a line that starts with $$$$; lines end either way.

    A large file is read in the blocks that Spark cuts it into. One pass counts the records of each block, and a record's
    index is its place in its block behind those of the blocks before: no task sees a whole file.
    """
    text = spark.read.text(path, lineSep="\n$$$$")
    records = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    columns = ["title", "props", "atoms", "bonds", "molblock"]

    def count(batches):
        last: dict[tuple, int] = {}
        for file, block, place, _ in _between_separators(batches):
            last[file, block] = place
        yield pd.DataFrame([(*k, n) for k, n in last.items()], columns=["file", "block", "n"])

    def parse(batches):
        rows = []
        for file, block, place, record in _between_separators(batches):
            found = parse_sdf_record(record)
            rows.append((file, block, place, *(found[c] for c in columns)))
            if len(rows) == 1000:
                yield pd.DataFrame(rows, columns=["file", "block", "place", *columns])
                rows = []
        yield pd.DataFrame(rows, columns=["file", "block", "place", *columns])

    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    counts = records.mapInPandas(count, "file string, block long, n long")
    starts = counts.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = records.mapInPandas(parse, f"file string, block long, place long, {SDF_SCHEMA}").join(starts, ["file", "block"])
    return placed.select("file", (F.col("start") + F.col("place")).alias("record_index"), *columns)


def sdf_record(molblock: str, props: Sequence[str]) -> Column:
    """One record as text without its separator: mol block, then a property block per column."""
    blocks = [F.concat(F.lit(f">  <{p}>\n"), F.coalesce(F.col(p).cast("string"), F.lit("")), F.lit("\n\n")) for p in props]
    return F.concat(F.rtrim(F.col(molblock), F.lit("\n")), F.lit("\n"), *blocks)


def repair_bonds(record: dict) -> tuple[dict, list[str]]:
    """Double bonds that a docking tool writes wrongly become single: S(+1, three neighbours)=O(-1, one neighbour), and
    the bond of two neutral boron atoms with three neighbours each. Returns the record and the repairs."""
    atoms, bonds = record["atoms"], [dict(b) for b in record["bonds"]]
    degree = [0] * len(atoms)
    for b in bonds:
        degree[b["a"]] += 1
        degree[b["b"]] += 1
    is_like = lambda i, element, charge, neighbours: (atoms[i]["element"], atoms[i]["charge"], degree[i]) == (element, charge, neighbours)
    repairs = []
    for b in bonds:
        if b["order"] != 2:
            continue
        ends = ((b["a"], b["b"]), (b["b"], b["a"]))
        if any(is_like(s, "S", 1, 3) and is_like(o, "O", -1, 1) for s, o in ends):
            b["order"] = 1
            repairs.append("charged_sulfoxide_double_to_single")
        elif is_like(b["a"], "B", 0, 3) and is_like(b["b"], "B", 0, 3):
            b["order"] = 1
            repairs.append("neutral_diboron_double_to_single")
    return record | {"bonds": bonds}, repairs


def ligand_graph(record: dict) -> dict:
    """Heavy atoms' categories and positions, and bonds between them in both directions with bond categories."""
    heavy = [i for i, a in enumerate(record["atoms"]) if a["element"] not in ("H", "D")]
    if not heavy:
        raise ValueError("no heavy atoms")
    place = {old: new for new, old in enumerate(heavy)}
    edges, kinds = [], []
    for b in record["bonds"]:
        if b["a"] in place and b["b"] in place:
            i, j = place[b["a"]], place[b["b"]]
            edges += [(i, j), (j, i)]
            kinds += [BOND_CODES.get(b["order"], BOND_CODES[1])] * 2
    atoms = [record["atoms"][i] for i in heavy]
    return {"x": [ATOM_CODES.get(a["element"], ATOM_CODES["OTHER"]) for a in atoms], "pos": [(a["x"], a["y"], a["z"]) for a in atoms], "edge_index": [[e[0] for e in edges], [e[1] for e in edges]], "edge_attr": kinds}


# Categories of bonds by their order in the bond block (4 is aromatic).
BOND_CODES = {1: 0, 2: 1, 3: 2, 4: 3}


def _field(first: int, last: int) -> Column:
    """Columns first..last of a line, counted from 1."""
    return F.substring("value", first, last - first + 1)


def read_pdb_atoms(spark: SparkSession, path: str) -> DataFrame:
    """Heavy atoms of ATOM and HETATM lines: the first alternative location, element from its columns or the atom's name,
    residue category (HETATM: unknown)."""
    lines = spark.read.text(path).where(F.col("value").startswith("ATOM  ") | F.col("value").startswith("HETATM"))
    het = F.col("value").startswith("HETATM")
    letters = F.regexp_replace(F.regexp_replace(F.trim(_field(13, 16)), r"^[0-9]+", ""), r"[^A-Za-z]", "")
    first, two = F.upper(F.substring(letters, 1, 1)), F.concat(F.upper(F.substring(letters, 1, 1)), F.lower(F.substring(letters, 2, 1)))
    guessed = F.when(het & (F.length(letters) >= 2) & two.isin(*ATOM_CODES), two).otherwise(first)
    stated = F.trim(_field(77, 78))
    element = F.when(stated != "", F.initcap(stated)).otherwise(F.nullif(guessed, F.lit("")))
    residue = F.upper(F.trim(_field(18, 20)))
    kind = F.when(het, RESIDUES.index("UNK")).otherwise(coded(residue, {r: i for i, r in enumerate(RESIDUES)}, RESIDUES.index("UNK")))
    atoms = lines.select(
        F.monotonically_increasing_id().alias("ord"), element.alias("element"), _field(31, 38).try_cast("double").alias("x"), _field(39, 46).try_cast("double").alias("y"), _field(47, 54).try_cast("double").alias("z"),
        F.trim(_field(22, 22)).alias("chain"), F.trim(_field(23, 26)).alias("resseq"), F.trim(_field(27, 27)).alias("icode"), residue.alias("resname"), kind.alias("residue_type"), het.alias("hetatm"), _field(17, 17).alias("altloc"),
    )
    kept = atoms.where(F.col("altloc").isin("", " ", "A") & F.col("element").isNotNull() & ~F.col("element").isin("H", "D") & F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull())
    return kept.drop("altloc")


def pocket_atoms(atoms: DataFrame, excluded: str) -> DataFrame:
    return atoms.where(~F.col("resname").isin(excluded, "HOH", "DOD"))


def residue_instances(atoms: DataFrame, resname: str) -> DataFrame:
    """chain, resseq, n of non-hydrogen HETATM atoms of a residue name."""
    return atoms.where(F.col("hetatm") & (F.col("resname") == resname)).groupBy("chain", "resseq").agg(F.count("*").alias("n"))


def database_references(spark: SparkSession, path: str) -> DataFrame:
    """chain, text of the lines that name a chain's entry in a sequence database."""
    lines = spark.read.text(path).where(F.col("value").startswith("DBREF ") | F.col("value").startswith("DBREF1"))
    return lines.select(F.trim(_field(13, 13)).alias("chain"), F.col("value").alias("text"))


def residue_name(spark: SparkSession, path: str, chain: str, number: int) -> str | None:
    """The name of the first residue of this chain and number among ATOM lines."""
    lines = spark.read.text(path).withColumn("_at", F.monotonically_increasing_id()).where(F.col("value").startswith("ATOM  "))
    hit = lines.where((F.trim(_field(22, 22)) == chain) & (_field(23, 26).try_cast("int") == number))
    row = hit.orderBy("_at").select(F.trim(_field(18, 20)).alias("name")).first()
    return row["name"] if row else None


def rigid_atoms(text: str) -> int:
    """Atoms of a receptor in the docking program's format; ValueError if it has torsions, like a ligand, or no atoms."""
    lines = text.splitlines()
    if flexible := next((line for line in lines if line.startswith(("ROOT", "BRANCH", "TORSDOF"))), None):
        raise ValueError(f"a receptor with {flexible.split()[0]} is no rigid one")
    n = sum(line.startswith(("ATOM", "HETATM")) for line in lines)
    if not n:
        raise ValueError("a receptor without atoms")
    return n


def located(codes: DataFrame, folder: str, code: str = "complex_id") -> DataFrame:
    """Adds ligand_path and pocket_path: the first file of each kind in a complex's folder, named by the code in lower
    case, then in upper case, SDF before MOL2; null if there is none. Files are those that Spark lists below `folder`."""
    spark = codes.sparkSession
    parts = F.split(F.substring(F.col("path"), F.lit(len(qualified(spark, folder)) + 2), F.length("path")), "/")
    inside = files(spark, folder).select("path", parts.alias("_p")).where(F.size("_p") == 2).select("path", F.col("_p")[0].alias("_code"), F.col("_p")[1].alias("_name"))
    ends = {"ligand_path": ("_ligand.sdf", "_ligand.mol2"), "pocket_path": ("_pocket.pdb",)}
    names = [(kind, case, end) for kind, given in ends.items() for end in given for case in (F.lower, F.upper)]
    wanted = F.array(*[F.struct(F.lit(kind).alias("_kind"), F.lit(i).alias("_place"), F.concat(case("_code"), F.lit(end)).alias("_name")) for i, (kind, case, end) in enumerate(names)])
    asked = codes.select(F.col(code).alias("_code")).distinct().select("_code", F.inline(wanted))
    first = [F.min_by(F.when(F.col("_kind") == kind, F.col("path")), F.when(F.col("_kind") == kind, F.col("_place"))).alias(kind) for kind in ends]
    found = asked.join(inside, ["_code", "_name"]).groupBy("_code").agg(*first)
    return codes.join(found, F.col(code) == F.col("_code"), "left").drop("_code")


def receptor_subset(spark: SparkSession, path: str, chains: Sequence[str], removed: Sequence[str]) -> DataFrame:
    """ord, value, chain, resname, reason of atom lines in order: included, other_chain or removed_residue."""
    lines = spark.read.text(path).withColumn("ord", F.monotonically_increasing_id())
    atoms = lines.where(F.col("value").startswith("ATOM  ") | F.col("value").startswith("HETATM"))
    atoms = atoms.select("ord", "value", F.trim(_field(22, 22)).alias("chain"), F.trim(_field(18, 20)).alias("resname"))
    reason = F.when(~F.col("chain").isin(*chains), "other_chain").when(F.col("resname").isin(*removed), "removed_residue").otherwise("included")
    return atoms.withColumn("reason", reason)


def receptor_counts(subset: DataFrame) -> DataFrame:
    """reason, name, n: atoms kept and left out by their chain, removed ones by their residue. Blank chains are NONE, blank
    residues UNKNOWN."""
    chain, residue = (F.when(F.col(c) == "", F.lit(blank)).otherwise(F.col(c)) for c, blank in (("chain", "NONE"), ("resname", "UNKNOWN")))
    return subset.groupBy("reason", F.when(F.col("reason") == "removed_residue", residue).otherwise(chain).alias("name")).agg(F.count("*").alias("n"))


def read_affinity_index(spark: SparkSession, path: str, kinds: Sequence[str] = ()) -> DataFrame:
    """complex_id, pk, kind of index lines with four fields or more and a strict measurement behind the third."""
    lines = spark.read.text(path).select(F.trim("value").alias("line")).where(~F.col("line").startswith("#") & (F.col("line") != ""))
    parts = lines.select(F.split("line", r"\s+").alias("p")).where(F.size("p") >= 4)
    found = parts.select(F.lower(F.element_at("p", 1)).alias("complex_id"), parsed_affinity(F.array_join(F.slice("p", 4, 1_000_000), " ")).alias("m")).where("m is not null")
    out = found.select("complex_id", F.col("m.pk").alias("pk"), F.col("m.kind").alias("kind"))
    return out.where(F.col("kind").isin(*[k.upper() for k in kinds])) if kinds else out
