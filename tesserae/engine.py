"""Engine(root): the matrices of a project folder as DataFrames.

Layout: root/project/sample/{run_mode}/{counts,obs,var} as written by write_matrix, with root/project/sample/puck for
coordinates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tesserae.operators.catalog import Catalog, Config
from tesserae.operators.counts import cell_metrics, gene_metrics, molecule_counts
from tesserae.operators.mesh import mesh_counts, meshed
from tesserae.operators.tiles import with_coordinates
from tesserae.sources.tables import write_matrix


class Engine:
    def __init__(self, spark: SparkSession, root: str, catalog: Catalog | None = None, config: Config | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.catalog, self.config = catalog or Catalog(), config or Config()

    def path(self, project: str, sample: str, name: str) -> str:
        return f"{self.root}/{project}/{sample}/{name}"

    def process(self, alignments: DataFrame, project: str, sample: str, run_mode: str = "default", cell: str = "CB", gene: str = "gene", umi: str = "MI") -> None:
        """Count molecules of alignments and store the matrix with its cell and gene metrics."""
        self.config.assert_there("run_modes", run_mode)
        at = self.path(project, sample, run_mode)
        write_matrix(at, molecule_counts(alignments, cell, gene, umi).drop("channel"))
        stored = self.load(project, sample, run_mode)
        write_matrix(at, obs=cell_metrics(stored), var=gene_metrics(stored))

    def load(self, project: str, sample: str, run_mode: str = "default", part: str = "counts") -> DataFrame:
        """counts, obs or var of a run mode."""
        return self.spark.read.parquet(f"{self.path(project, sample, run_mode)}/{part}")

    def load_spatial(self, project: str, sample: str, run_mode: str = "default") -> DataFrame:
        """Cells with their metrics and coordinates."""
        puck = self.spark.read.parquet(self.path(project, sample, "puck")).withColumnRenamed("cell_bc", "cell")
        return with_coordinates(self.load(project, sample, run_mode, "obs"), puck, "cell")

    def load_mesh(self, project: str, sample: str, run_mode: str = "default", **mesh) -> DataFrame:
        """The count matrix by mesh unit."""
        return mesh_counts(meshed(self.load_spatial(project, sample, run_mode), **mesh), self.load(project, sample, run_mode))
