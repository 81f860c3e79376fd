"""A project folder's records: its configuration and samples in one YAML file."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

import yaml

from tesserae.operators.catalog import Catalog, CatalogError, Config

NAME = "project.yaml"


@dataclass
class Project:
    root: str
    config: Config = field(default_factory=Config)
    catalog: Catalog = field(default_factory=Catalog)

    @property
    def path(self) -> str:
        return os.path.join(self.root, NAME)

    @classmethod
    def init(cls, root: str) -> Project:
        """A new project; an existing one is an error."""
        own = cls(root)
        if os.path.exists(own.path):
            raise CatalogError(f"{own.path} is there already")
        os.makedirs(root, exist_ok=True)
        own.save()
        return own

    @classmethod
    def open(cls, root: str) -> Project:
        own = cls(root)
        if not os.path.exists(own.path):
            raise CatalogError(f"no project in {root}: init it first")
        with open(own.path, encoding="utf-8") as f:
            stored = yaml.safe_load(f)
        own.config.kinds = stored["config"]
        for s in stored["samples"]:
            key = s.pop("project_id"), s.pop("sample_id")
            if s.get("merged_from"):
                s["merged_from"] = [tuple(p) for p in s["merged_from"]]
            own.catalog.samples[key] = s
        return own

    def save(self) -> None:
        """Written beside the file first, so that a broken write leaves the old one."""
        rows = [{"project_id": p, "sample_id": s} | {k: [list(x) for x in v] if k == "merged_from" and v else v for k, v in r.items()} for (p, s), r in self.catalog.samples.items()]
        with open(f"{self.path}.new", "w", encoding="utf-8") as f:
            yaml.safe_dump({"config": self.config.kinds, "samples": rows}, f, sort_keys=False, allow_unicode=True)
        os.replace(f"{self.path}.new", self.path)


def values_of(pairs: list[str]) -> dict[str, object]:
    """name=value arguments; values are read as YAML (numbers, lists, true)."""
    out = {}
    for p in pairs:
        name, eq, value = p.partition("=")
        if not eq:
            raise CatalogError(f"{p!r}: name=value is wanted")
        out[name] = yaml.safe_load(value) if value else None
    return out
