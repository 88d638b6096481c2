"""The package that goes to an affinity model: structures, a table to fill in, and how to fill it."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.operators.gates import GateError, require_contiguous, require_none
from siftline.operators.joining import wide_package
from siftline.operators.ranking import average_rank_percentile
from siftline.sources import molecular, sinks

README = """# Input for an affinity model

* `receptor/` holds the receptor, `ligands/docked_poses.sdf` all poses, one record each.
* `affinity_predictions/` is the table to fill in: a row per pose. `ligand_record_index` counts records of the SDF file
  from 1; `receptor_pdb` and `ligand_pose_sdf` say where the structures are.
* Write a number into `predicted_paffinity` and leave everything else, the order of rows included, as it is.
"""


def package(spark: SparkSession, folder: str, poses: DataFrame, parents: DataFrame, states: DataFrame, similarity: DataFrame, receptor: str, ligands: str) -> dict:
    """Writes the package into a folder that driver and executors mount, and returns its summary.

    Every pose must have a similarity row, a known parent and state and a record of its index; each state has one parent.
    """
    rows = wide_package(poses.withColumnRenamed("parent_structure_key", "structure_key"), parents, states, similarity, "structure_key", "state_id", "pose_id")
    require_contiguous(rows, "ligand_record_index", "ligand_record_index")
    several = poses.groupBy("state_id").agg(F.count_distinct("parent_structure_key").alias("n"))
    require_none(several, F.col("n") != 1, "states of several parents")
    require_none(rows, F.col("postdock_3d_status").isNull(), "poses without a similarity row")
    receptor_copy = sinks.copy_whole(receptor, os.path.join(folder, "receptor", os.path.basename(receptor)))
    ligand_copy = sinks.copy_whole(ligands, os.path.join(folder, "ligands", "docked_poses.sdf"))
    records, n = molecular.read_sdf(spark, ligand_copy).count(), rows.count()
    if records != n:
        raise GateError(f"{records} ligand records for {n} poses")
    ranked = average_rank_percentile(rows, ["protocol_id"], "smina_score", "docking_percentile")
    table = ranked.withColumns({"receptor_pdb": F.lit(receptor_copy), "ligand_pose_sdf": F.lit(ligand_copy), "predicted_paffinity": F.lit("")}).withColumnRenamed("structure_key", "parent_structure_key")
    sinks.write_csv(table, os.path.join(folder, "affinity_predictions"), ["ligand_record_index"])
    sinks.write_text(os.path.join(folder, "README.md"), README)
    summary = {"poses": n, "parents": table.select("parent_structure_key").distinct().count(), "receptor": receptor_copy, "ligands": ligand_copy}
    sinks.write_json(os.path.join(folder, "summary.json"), summary)
    return summary
