"""Sample catalogs and configuration: driver-side records with their rules, and predicates over catalog tables."""

from __future__ import annotations

import json
from collections.abc import Iterable
from copy import deepcopy
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "project_id string, sample_id string, species string, puck string, puck_ids array<string>, puck_files array<string>, r1 array<string>, r2 array<string>, longreads string, "
    "basecalls string, dge string, run_modes array<string>, barcode_flavor string, adapter_flavor string, map_strategy string, is_merged boolean, merged_from array<struct<project_id:string,sample_id:string>>, demux_index string, sequencing_date string"
)
NO_PUCK = "no_spatial_data"


class CatalogError(ValueError):
    pass


class Duplicate(CatalogError):
    pass


class Missing(CatalogError):
    pass


class Inconsistent(CatalogError):
    pass


def as_list(value: object) -> list[str]:
    """A list cell: JSON or a bracketed list of quoted or bare names; never evaluated. Empty, None and nan are no entries."""
    if value is None or value != value:
        return []
    if isinstance(value, (list, tuple)):
        return [str(v) for v in value]
    text = str(value).strip()
    if text.lower() in ("", "none", "nan", "[]", "[nan]", "[none]"):
        return []
    try:
        found = json.loads(text)
        return [str(v) for v in found] if isinstance(found, list) else [str(found)]
    except ValueError:
        return [p.strip().strip("'\"") for p in text.strip("[]()").split(",") if p.strip()]


def as_bool(value: object) -> bool:
    if isinstance(value, bool):
        return value
    text = str(value).strip().lower()
    if text in ("true", "t", "yes", "y", "1"):
        return True
    if text in ("false", "f", "no", "n", "0", "none", ""):
        return False
    raise CatalogError(f"{value!r} is neither true nor false")


@dataclass
class Catalog:
    """Samples by (project, sample)."""

    samples: dict[tuple[str, str], dict] = field(default_factory=dict)

    def add(self, project_id: str, sample_id: str, **values) -> None:
        if (project_id, sample_id) in self.samples:
            raise Duplicate(f"sample {project_id}, {sample_id} is there already")
        self.samples[project_id, sample_id] = self._checked({"species": None, "puck": "default", "run_modes": ["default"], "barcode_flavor": "default", "adapter_flavor": "default", "map_strategy": "STAR:genome:final", "is_merged": False} | values)

    @staticmethod
    def _checked(s: dict) -> dict:
        s = dict(s)
        for k in ("r1", "r2", "run_modes", "puck_ids", "puck_files"):
            s[k] = as_list(s.get(k))
        # what a sample is made from, in this order
        if not s["is_merged"] and not (s["r2"] or s.get("longreads") or s.get("basecalls") or s.get("dge")):
            raise Missing("a sample needs R2, longreads, basecalls or a matrix")
        if s["r1"] and s["r2"] and len(s["r1"]) != len(s["r2"]):
            raise Inconsistent(f"{len(s['r1'])} files of R1, {len(s['r2'])} of R2")
        if len(set(s["puck_files"])) != len(s["puck_files"]):
            raise Duplicate("a barcode file is listed twice")
        return s

    def _at(self, project_id: str, sample_id: str) -> dict:
        if (project_id, sample_id) not in self.samples:
            raise Missing(f"no sample {project_id}, {sample_id}")
        return self.samples[project_id, sample_id]

    def update(self, project_id: str, sample_id: str, **values) -> None:
        self.samples[project_id, sample_id] = self._checked(self._at(project_id, sample_id) | values)

    def delete(self, project_id: str, sample_id: str) -> dict:
        self._at(project_id, sample_id)
        return self.samples.pop((project_id, sample_id))

    def upsert(self, rows: Iterable[dict]) -> None:
        for r in rows:
            own = dict(r)
            key = own.pop("project_id"), own.pop("sample_id")
            (self.update if key in self.samples else self.add)(*key, **own)

    def merge(self, project_id: str, sample_id: str, parts: list[tuple[str, str]], **values) -> None:
        """A sample out of others that agree on all that matters; run modes are those that all have."""
        if not parts:
            raise Missing("nothing to merge")
        rows = [self._at(*p) for p in parts]
        for k in ("puck", "species", "barcode_flavor", "adapter_flavor", "map_strategy"):
            if len({str(r.get(k)) for r in rows}) > 1:
                raise Inconsistent(f"samples to merge differ in {k}")
        modes = [m for m in rows[0]["run_modes"] if all(m in r["run_modes"] for r in rows)]
        if not modes:
            raise Inconsistent("samples to merge share no run mode")
        pucks = sorted({x for r in rows for x in zip(r["puck_ids"], r["puck_files"], strict=False)})
        own = {k: rows[0].get(k) for k in ("puck", "species", "barcode_flavor", "adapter_flavor", "map_strategy")}
        self.add(project_id, sample_id, **(own | {"run_modes": modes, "is_merged": True, "merged_from": list(parts), "puck_ids": [p for p, _ in pucks], "puck_files": [f for _, f in pucks]} | values))

    def leaves(self, project_id: str, sample_id: str) -> list[tuple[str, str]]:
        """The unmerged samples below one, each once."""
        row = self._at(project_id, sample_id)
        if not row["is_merged"]:
            return [(project_id, sample_id)]
        return list(dict.fromkeys(x for p in row["merged_from"] for x in self.leaves(*p)))

    def get(self, field_name: str, **where) -> object:
        """A field of the first sample that matches, '' if none does."""
        for (p, s), row in self.samples.items():
            own = row | {"project_id": p, "sample_id": s}
            if all(own.get(k) == v for k, v in where.items()):
                return own.get(field_name, "")
        return ""

    def to_df(self, spark: SparkSession) -> DataFrame:
        names = [c.strip().split(" ")[0] for c in SCHEMA.replace("array<struct<project_id:string,sample_id:string>>", "x").split(",")]
        rows = [tuple((r | {"project_id": p, "sample_id": s}).get(n) for n in names) for (p, s), r in self.samples.items()]
        return spark.createDataFrame(rows, SCHEMA)


def is_external(df: DataFrame | None = None) -> Column:
    """A matrix and no reads."""
    return F.col("dge").isNotNull() & (F.size(F.coalesce("r2", F.array().cast("array<string>"))) == 0) & F.col("longreads").isNull() & F.col("basecalls").isNull()


def has_dge() -> Column:
    """A matrix is given or can be made: long reads alone make none."""
    reads = (F.size(F.coalesce("r2", F.array().cast("array<string>"))) > 0) | F.col("basecalls").isNotNull() | F.coalesce("is_merged", F.lit(False))
    return F.col("dge").isNotNull() | reads


def is_spatial(pucks_with_coordinates: list[str]) -> Column:
    """The puck has coordinates of its own, or the sample has barcode files."""
    return F.col("puck").isin(*pucks_with_coordinates) | (F.size(F.coalesce("puck_files", F.array().cast("array<string>"))) > 0)


def tiles_of(df: DataFrame) -> DataFrame:
    """(project_id, sample_id, puck_id, puck_file) of every sample's tiles."""
    z = F.arrays_zip(F.col("puck_ids").alias("puck_id"), F.col("puck_files").alias("puck_file"))
    return df.select("project_id", "sample_id", F.inline(z))


def passing_tiles(df: DataFrame, matches: DataFrame, default: str = NO_PUCK) -> DataFrame:
    """Tiles above their matching threshold per sample, and the default one."""
    some = tiles_of(df).join(matches.filter("pass_threshold").select(F.col("tile").alias("puck_id")), "puck_id", "left_semi").select("project_id", "sample_id", "puck_id")
    return some.unionByName(df.select("project_id", "sample_id", F.lit(default).alias("puck_id")))


def shared_run_modes(df: DataFrame, by: list[str]) -> DataFrame:
    """Run modes that all samples of a group have."""
    n = df.groupBy(*by).agg(F.count("*").alias("n"))
    m = df.select(*by, F.explode(F.array_distinct("run_modes")).alias("mode")).groupBy(*by, "mode").agg(F.count("*").alias("k"))
    return m.join(n, by).filter("k = n").groupBy(*by).agg(F.array_sort(F.collect_list("mode")).alias("run_modes"))


# ---- configuration ---------------------------------------------------------------------------------------------------

#: Built-in slices of cell barcode and molecule id by barcode flavour (fixed values).
BARCODE_FLAVORS = {
    "default": ("r1[0:12]", "r1[12:20]"), "dropseq": ("r1[0:12]", "r1[12:20]"), "slide_seq_14bc": ("r1[0:14]", "r1[14:23]"), "slide_seq_15bc": ("r1[0:14]", "r1[15:23]"),
    "visium": ("r1[0:16]", "r1[16:28]"), "sc_10x_v2": ("r1[0:16]", "r1[16:26]"), "seq_scope": ("r1[0:20]", "r2[0:9]"), "openst": ("r1[2:27]", "r2[0:9]"),
}
RUN_MODE_TYPES = {
    "n_beads": int, "umi_cutoff": list, "clean_dge": as_bool, "detect_tissue": as_bool, "polyA_adapter_trimming": as_bool, "count_intronic_reads": as_bool, "count_mm_reads": as_bool,
    "mesh_data": as_bool, "mesh_type": str, "mesh_spot_diameter_um": int, "mesh_spot_distance_um": int, "spatial_barcode_min_matches": float,
}


@dataclass
class Config:
    """Named variables by kind: pucks, barcode_flavors, adapters, adapter_flavors, run_modes, species, quant."""

    kinds: dict[str, dict[str, dict]] = field(default_factory=lambda: {"pucks": {"default": {"width_um": 10_000, "spot_diameter_um": 10}}, "barcode_flavors": {n: {"cell": c, "UMI": u} for n, (c, u) in BARCODE_FLAVORS.items()}, "adapters": {}, "adapter_flavors": {"default": {}}, "run_modes": {"default": {"n_beads": 100_000, "umi_cutoff": [100, 300, 500]}}, "species": {}, "quant": {}})

    def _kind(self, kind: str) -> dict:
        if kind not in self.kinds:
            raise Missing(f"no kind of variable {kind!r}")
        return self.kinds[kind]

    def assert_there(self, kind: str, name: str) -> None:
        if name not in self._kind(kind):
            raise Missing(f"no {name!r} among {kind}: {sorted(self._kind(kind))}")

    def add(self, kind: str, name: str, **values) -> None:
        if name in self._kind(kind):
            raise Duplicate(f"{name!r} is among {kind} already")
        self.kinds[kind][name] = self._typed(kind, values)

    def update(self, kind: str, name: str, **values) -> None:
        self.assert_there(kind, name)
        self.kinds[kind][name] |= self._typed(kind, values)

    def delete(self, kind: str, name: str) -> dict:
        self.assert_there(kind, name)
        if name == "default":
            raise Inconsistent("the default can't be deleted")
        return self.kinds[kind].pop(name)

    @staticmethod
    def _typed(kind: str, values: dict) -> dict:
        if kind != "run_modes":
            return dict(values)
        return {k: RUN_MODE_TYPES.get(k, lambda x: x)(v) for k, v in values.items()}

    def run_mode(self, name: str) -> dict:
        """Defaults, then its chain of parents from the top, then its own."""
        chain, seen = [], set()
        at: str | None = name
        while at:
            self.assert_there("run_modes", at)
            if at in seen:
                raise Inconsistent(f"run mode {name!r} is its own parent")
            seen.add(at)
            chain.append(self.kinds["run_modes"][at])
            at = chain[-1].get("parent_run_mode")
        out = deepcopy(self.kinds["run_modes"]["default"])
        for c in reversed(chain):
            out |= deepcopy(c)
        return out

    def puck(self, name: str, or_empty: bool = False) -> dict:
        if or_empty and name not in self.kinds["pucks"]:
            return {}
        self.assert_there("pucks", name)
        return self.kinds["pucks"][name]

    def adapters_of(self, flavor: str) -> list[dict]:
        """A flavour's cuts with their adapters' sequences: the names join the table of adapters."""
        self.assert_there("adapter_flavors", flavor)
        out = []
        for where in ("cut_left", "cut_right"):
            for name, args in (self.kinds["adapter_flavors"][flavor].get(where) or {}).items():
                self.assert_there("adapters", name)
                out.append({"name": name, "where": where[4:], "seq": self.kinds["adapters"][name]} | (args or {}))
        return out

    def expanded(self, **values: str) -> Config:
        """A copy whose strings have {name} filled in."""

        def fill(x):
            if isinstance(x, dict):
                return {k: fill(v) for k, v in x.items()}
            if isinstance(x, list):
                return [fill(v) for v in x]
            if isinstance(x, str):
                for k, v in values.items():
                    x = x.replace("{" + k + "}", v)
            return x

        return Config(fill(self.kinds))


def bam_tag_names(template: str = "CR:{cell},CB:{cell},MI:{UMI},RG:{assigned}") -> dict[str, str]:
    """'TAG:{variable},...' as variable -> last tag that holds it."""
    return {v.strip("{}"): t for t, v in (p.split(":") for p in template.split(","))}


def filled(template: str, values: dict, defaults: dict | None = None) -> str:
    """A path template with its {names} filled from values, else defaults."""
    import string

    names = {n for _, n, _, _ in string.Formatter().parse(template) if n}
    known = (defaults or {}) | values
    return template.format(**{n: known.get(n, f"NO_{n}") for n in names})


def run_mode_matrix(spark: SparkSession, config: Config, names: list[str]) -> DataFrame:
    """(variable, one column per run mode) as text, null where a mode leaves a variable unset."""
    modes = {n: config.run_mode(n) for n in names}
    every = sorted({v for m in modes.values() for v in m})
    return spark.createDataFrame([(v, *[None if m.get(v) is None else str(m[v]) for m in modes.values()]) for v in every], ", ".join(["variable string", *[f"`{n}` string" for n in names]]))


def signature_catalog(text: str) -> tuple[dict[str, str], dict[str, dict]]:
    """(blocks, signatures) of a YAML file of long-read signatures: oligos with their reverse complements as X_RC, and every
    signature with the fields of the default one where it has none."""
    import yaml

    own = yaml.safe_load(text)
    turn = str.maketrans("ACGTUNRYSWKMBDHVacgtunryswkmbdhv", "TGCAANYRSWMKVHDBtgcaanyrswmkvhdb")
    blocks = {n: s for name, seq in own["blocks"].items() for n, s in ((name, seq), (f"{name}_RC", seq[::-1].translate(turn)))}
    default = own["signatures"][own["default"]]
    return blocks, {n: default | d for n, d in own["signatures"].items()}


def sample_info(df: DataFrame, project_id: str, sample_id: str) -> DataFrame:
    """What a report says about one sample."""
    own = df.filter((F.col("project_id") == project_id) & (F.col("sample_id") == sample_id))
    return own.select("project_id", "sample_id", "species", "puck", "barcode_flavor", "adapter_flavor", "map_strategy", "sequencing_date", F.array_join("run_modes", ", ").alias("run_modes"), F.size(F.coalesce("puck_ids", F.array().cast("array<string>"))).alias("n_pucks"))


def find_file(root: str, stem: str) -> str | None:
    """The first file under a folder whose name starts with stem, in sorted order of folders and names."""
    import os

    for folder, dirs, names in os.walk(root):
        dirs.sort()
        for n in sorted(names):
            if n.split(".")[0] == stem:
                return os.path.join(folder, n)
    return None
