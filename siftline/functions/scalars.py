"""Scalar expressions. Everything here is a Column built from Spark's own functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def structure_hash(value) -> Column:
    """SHA-1 of the UTF-8 text, in hex."""
    return F.sha1(col(value).cast("binary"))


def stable_hash(value, seed: int) -> Column:
    """The first 8 bytes of SHA-256 of "seed|value", as 16 hex digits: hex order is the order of the unsigned number."""
    return F.substring(F.sha2(F.concat(F.lit(f"{seed}|"), col(value).cast("string")).cast("binary"), 256), 1, 16)


def stable_hash_number(value, seed: int) -> Column:
    """The same as decimal(20,0); Spark has no unsigned long."""
    return F.conv(stable_hash(value, seed), 16, 10).cast("decimal(20,0)")


def job_seed(protocol, chunk, seed: int) -> Column:
    """A seed per protocol and chunk, below 2**31 - 1."""
    return ((F.lit(seed) + F.crc32(col(protocol).cast("binary")) + col(chunk)) % F.lit(2147483647)).cast("long")


def embed_seed(key, rank=0, attempt: int = 0) -> Column:
    """A 31-bit seed from a hex key; later attempts step by a prime."""
    first = F.conv(F.substring(col(key), 1, 8), 16, 10).cast("long").bitwiseAND(0x7FFFFFFF)
    return first + (col(rank) if isinstance(rank, (str, Column)) else F.lit(rank)) + F.lit(104729 * attempt)


def scaled_affinity(value, midpoint: float = 6.0, scale: float = 1.0) -> Column:
    """Logistic curve, 0.5 at the midpoint."""
    if scale <= 0:
        raise ValueError("scale must be positive")
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-((col(value) - F.lit(midpoint)) / F.lit(scale))))


def or_aggregate(value) -> Column:
    """Aggregate: 0.70 * max + 0.30 * mean; 0 without values."""
    return F.coalesce(F.lit(0.70) * F.max(col(value)) + F.lit(0.30) * F.avg(col(value)), F.lit(0.0))


def weighted_sum(weights: Mapping[str, float]) -> Column:
    """The weighted sum of columns, in the given order. Weights must sum to 1."""
    if abs(sum(weights.values()) - 1.0) > 1e-9:
        raise ValueError("weights must sum to 1")
    total = None
    for name, weight in weights.items():
        term = F.lit(float(weight)) * F.col(name)
        total = term if total is None else total + term
    return total


def percent_score(weights: Mapping[str, float]) -> Column:
    """100 * the weighted sum, clipped to 0..1."""
    return F.lit(100.0) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), weighted_sum(weights)))


def alert_count(*descriptions) -> Column:
    """How many of the alert families have any description at all."""
    return sum((F.coalesce((col(d) != "").cast("int"), F.lit(0)) for d in descriptions), F.lit(0))


def quality_score(qed, alerts, penalty: float = 0.08) -> Column:
    return F.greatest(F.lit(0.0), col(qed) - F.lit(penalty) * col(alerts))


def group_label(scaffold, key) -> Column:
    """A scaffold, or a label of its own for a record without one."""
    return F.coalesce(F.nullif(col(scaffold), F.lit("")), F.concat(F.lit("ACYCLIC:"), col(key)))


def concentration_nm(p) -> Column:
    """Nanomolar concentration of a negative log10 molar value; an error if it is not finite."""
    finite = ~(F.isnan(col(p)) | col(p).isin(float("inf"), float("-inf")) | col(p).isNull())
    return F.when(finite, F.lit(1e9) * F.pow(F.lit(10.0), -col(p))).otherwise(F.raise_error("prediction is not finite").cast("double"))


# Measurement units in molar.
UNIT_SCALES = {"fm": 1e-15, "pm": 1e-12, "nm": 1e-9, "um": 1e-6, "mm": 1e-3}
AFFINITY_PATTERN = r"(?i)\b(Ki|Kd|IC50)\s*=\s*([0-9.]+|\.[0-9]+)\s*(F?M|fM|pM|nM|uM|mM|MM)\b"


def parsed_affinity(text) -> Column:
    """struct(kind, pk) of text such as "Kd=19uM // note"; null without a usable measurement."""
    body = F.trim(F.substring_index(col(text), "//", 1))
    kind, number, unit = (F.regexp_extract(body, AFFINITY_PATTERN, i) for i in (1, 2, 3))
    scale = F.lit(1.0)
    for name, factor in UNIT_SCALES.items():
        scale = F.when(F.lower(unit) == name, F.lit(factor)).otherwise(scale)
    molar = number.try_cast("double") * scale
    return F.when((kind != "") & (molar > 0), F.struct(F.upper(kind).alias("kind"), (-F.log10(molar)).alias("pk")))


def jaccard(a, b) -> Column:
    """Tanimoto similarity of two arrays as sets; of two empty sets it is 0."""
    both, either = F.size(F.array_intersect(col(a), col(b))), F.size(F.array_union(col(a), col(b)))
    return F.when(either > 0, both / either).otherwise(F.lit(0.0))


def bit_tanimoto(a, b) -> Column:
    """Tanimoto similarity of two bit vectors held as arrays of 64-bit words."""
    count = lambda zipped: F.aggregate(zipped, F.lit(0), lambda s, x: s + x)
    both = count(F.zip_with(col(a), col(b), lambda x, y: F.bit_count(x.bitwiseAND(y))))
    either = count(F.zip_with(col(a), col(b), lambda x, y: F.bit_count(x.bitwiseOR(y))))
    return F.when(either > 0, both / either).otherwise(F.lit(0.0))


def state_id(key) -> Column:
    return F.concat(F.substring(col(key), 1, 16), F.lit("_s01"))


def state_origin(ph: float | None, canonical_tautomer, has_stereo) -> Column:
    """How a state came about, parts joined by semicolons."""
    first = F.lit("standardized_parent" if ph is None else f"openbabel_pH_{ph}")
    second = F.when(col(canonical_tautomer), F.lit("rdkit_canonical_tautomer")).otherwise(F.lit("tautomer_canonicalization_failed"))
    return F.concat_ws(";", first, second, F.when(col(has_stereo), F.lit("source_stereochemistry_preserved")))


def pose_id(protocol, state, rank) -> Column:
    return F.concat_ws("|", col(protocol), col(state), col(rank).cast("string"))


def first_property(props, names: Sequence[str]) -> Column:
    """The first of several keys of a map that is there, as a double."""
    return F.coalesce(*[F.element_at(col(props), n) for n in names]).try_cast("double")


def radial_basis(distance, count: int, low: float, high: float, width: float = 1.0) -> Column:
    """exp(-((d - mu_k) / sigma)**2 / 2) for `count` evenly spaced centres; sigma = width * spacing."""
    step = (high - low) / (count - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda k: F.exp(F.lit(-0.5) * F.pow((col(distance) - (F.lit(low) + k * F.lit(step))) / F.lit(width * step), F.lit(2.0))))


def coded(value, table: Mapping[str, int], other: int) -> Column:
    """A category's number; `other` for unknown ones."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*entries), col(value)), F.lit(other))


# Categories of atoms, bonds and residues by number.
ATOM_CODES = {
    "H": 0, "C": 1, "N": 2, "O": 3, "F": 4, "P": 5, "S": 6, "Cl": 7, "Br": 8, "I": 9, "B": 10, "Si": 11, "Se": 12, "As": 13,
    "Li": 14, "Na": 15, "K": 16, "Mg": 17, "Ca": 18, "Zn": 19, "Fe": 20, "Cu": 21, "Mn": 22, "Co": 23, "Ni": 24,
    "OTHER": 25, "virtual_intra_node": 26, "virtual_inter_node": 27, "MASK": 28,
}
RESIDUES = ["ALA", "ARG", "ASN", "ASP", "CYS", "GLN", "GLU", "GLY", "HIS", "ILE", "LEU", "LYS", "MET", "PHE", "PRO", "SER", "THR", "TRP", "TYR", "VAL", "UNK"]


def blank_to_zero(value) -> Column:
    """Lenient numbers: blank and missing are 0."""
    return F.coalesce(F.nullif(F.trim(col(value).cast("string")), F.lit("")).try_cast("double"), F.lit(0.0))


def strict_number(value, name: str) -> Column:
    """Strict numbers: blank, missing or malformed is an error."""
    number = F.nullif(F.trim(col(value).cast("string")), F.lit("")).try_cast("double")
    return F.when(number.isNotNull(), number).otherwise(F.raise_error(f"{name} is blank or no number").cast("double"))


def in_unit_interval(value, name: str) -> Column:
    """The value, or an error outside 0..1."""
    return F.when(col(value).between(0.0, 1.0), col(value)).otherwise(F.raise_error(f"{name} is outside 0..1").cast("double"))


def lenient_flag(value) -> Column:
    return F.lower(F.trim(col(value).cast("string"))).isin("1", "true", "yes").cast("int")
