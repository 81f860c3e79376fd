"""Mapping strategies: 'bowtie2:rRNA->STAR@flavor:genome:final', parsed, normalised and run as a fall-through cascade."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

MAPPERS = ("bowtie2", "STAR")


class StrategyError(ValueError):
    pass


class UnknownReference(StrategyError):
    pass


class UnknownFlavor(StrategyError):
    pass


@dataclass(frozen=True)
class Rule:
    mapper: str
    reference: str
    flavor: str | None = None
    link: str | None = None
    source: str = "uBAM"
    keep_unmapped: bool = False

    @property
    def output(self) -> str:
        return f"{self.reference}.{self.mapper}"

    def __str__(self) -> str:
        return self.mapper + (f"@{self.flavor}" if self.flavor else "") + f":{self.reference}" + (f":{self.link}" if self.link else "")


def _rule(text: str) -> Rule:
    parts = text.split(":")
    if len(parts) not in (2, 3):
        raise StrategyError(f"{text!r}: two or three fields are expected, not {len(parts)}")
    mapper, reference = parts[:2]
    if reference.split("@")[0] in MAPPERS:  # the older order, reference first
        mapper, reference = reference, mapper
    mapper, _, flavor = mapper.partition("@")
    return Rule(mapper, reference, flavor or None, parts[2] if len(parts) == 3 else None)


def parse_strategy(text: str, references: set[str] | None = None, flavors: set[str] | None = None, source: str = "uBAM", final: str = "final") -> tuple[list[Rule], dict[str, str]]:
    """(rules, links name -> output). Without a `final` link the last rule gets it.

    '->' feeds a stage what the last rule of the stage before left unmapped; ',' maps the same input several times.
    """
    stages = [[_rule(r) for r in stage.split(",")] for stage in text.split("->")]
    rules: list[Rule] = []
    links: dict[str, str] = {}
    for i, stage in enumerate(stages):
        for r in stage:
            if references is not None and r.reference not in references:
                raise UnknownReference(f"{r.reference!r} isn't among {sorted(references)}: {text}")
            if flavors is not None and r.flavor and r.flavor not in flavors:
                raise UnknownFlavor(f"{r.flavor!r} isn't among {sorted(flavors)}: {text}")
            rules.append(Rule(r.mapper, r.reference, r.flavor, r.link, source, i == len(stages) - 1))
            if r.link:
                links[final if r.link == "final" else r.link] = r.output
        source = f"not_{stage[-1].output}"
    links.setdefault(final, rules[-1].output)
    return rules, links


def normalised_strategy(text: str, references: set[str] | None = None, flavors: set[str] | None = None) -> str:
    parse_strategy(text, references, flavors)
    return "->".join(",".join(str(_rule(r)) for r in stage.split(",")) for stage in text.split("->"))


def cascade(reads: DataFrame, text: str, mappers: dict[str, Callable[[DataFrame, Rule], DataFrame]], key: str = "qname") -> dict[str, DataFrame]:
    """Outputs by name: each rule's mapped rows, and not_<output>: what its input left, by left anti join.

    mappers: per mapper name a function (input, rule) -> mapped rows with the key.
    """
    rules, links = parse_strategy(text)
    made = {"uBAM": reads}
    for r in rules:
        made[r.output] = mappers[r.mapper](made[r.source], r)
        made[f"not_{r.output}"] = made[r.source].join(made[r.output].select(key).distinct(), key, "left_anti")
    return made | {name: made[out] for name, out in links.items()}
