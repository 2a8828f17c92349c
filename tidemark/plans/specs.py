"""Declared jobs: an ingest of one source table, or a model built by SQL."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from tidemark.operators.quality import Rules
from tidemark.sinks.tables import MODES

try:
    import yaml
except ImportError:  # specs can still be given as mappings
    yaml = None


@dataclass(frozen=True)
class Ingest:
    name: str
    source: Mapping
    table: str
    primary_key: str
    write_mode: str = "merge"
    cursor: str | None = None
    lag_seconds: int = 0
    soft_delete_column: str | None = None
    transforms: tuple[str, ...] = ()
    quality: Rules | None = None
    money_columns: tuple[str, ...] = ()
    buckets: int | None = None
    bucket_width: int | None = None

    def __post_init__(self):
        if self.write_mode not in MODES:
            raise ValueError(f"{self.name}: unknown write_mode {self.write_mode!r}")


@dataclass(frozen=True)
class Model:
    name: str
    inputs: tuple[str, ...]
    sql: str
    table: str
    money_columns: tuple[str, ...] = ()


Spec = Ingest | Model


def parse_ingest(doc: Mapping) -> Ingest:
    target, reading = doc["target"], doc.get("extract") or {}
    rules = doc.get("quality")
    return Ingest(
        name=doc["name"],
        source=doc["source"],
        table=target["table"],
        primary_key=target["primary_key"],
        write_mode=target.get("write_mode", "merge"),
        cursor=reading.get("incremental_cursor"),
        lag_seconds=int(reading.get("lag_seconds", 0)),
        soft_delete_column=target.get("soft_delete_column"),
        transforms=tuple(doc.get("transforms") or ()),
        quality=Rules.of(rules) if rules else None,
        money_columns=tuple(doc.get("money_columns") or ()),
        buckets=target.get("buckets"),
        bucket_width=target.get("bucket_width"),
    )


def parse_model(doc: Mapping) -> Model:
    target = doc["target"]
    money = tuple(target.get("money_columns") or ())
    return Model(doc["name"], tuple(doc["inputs"]), doc["sql"], target["table"], money)


def parse_spec(doc: Mapping) -> Spec:
    kinds = {"ingest": parse_ingest, "model": parse_model}
    kind = doc.get("kind")
    if kind not in kinds:
        raise ValueError(f"{doc.get('name')}: unknown kind {kind!r} (use {' or '.join(kinds)})")
    try:
        return kinds[kind](doc)
    except KeyError as missing:
        raise KeyError(f"{kind} {doc.get('name')!r} lacks the key {missing}") from None


@dataclass
class Specs:
    """Jobs by name, in the order they were added."""

    jobs: dict[str, Spec] = field(default_factory=dict)

    def add(self, doc: Mapping | Spec) -> Spec:
        spec = doc if isinstance(doc, (Ingest, Model)) else parse_spec(doc)
        if spec.name in self.jobs:
            raise ValueError(f"two jobs are named {spec.name!r}")
        self.jobs[spec.name] = spec
        return spec

    def __getitem__(self, name: str) -> Spec:
        return self.jobs[name]

    def ingests(self) -> list[Ingest]:
        return [s for s in self.jobs.values() if isinstance(s, Ingest)]

    def models(self) -> list[Model]:
        return [s for s in self.jobs.values() if isinstance(s, Model)]


def load_specs(folder: str | Path) -> Specs:
    """All ``*.yaml`` files of a folder, by file name."""
    if yaml is None:
        raise RuntimeError("PyYAML is not installed; pass the specs as mappings to Specs.add")
    specs = Specs()
    for path in sorted(Path(folder).glob("*.yaml")):
        specs.add(yaml.safe_load(path.read_text()))
    return specs
