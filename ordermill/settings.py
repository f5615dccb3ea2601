"""Run parameters. Every value a job may want to change is a field here."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class Thresholds:
    """Limits used by the gates and the quality checks."""

    min_row_count: int = 1
    max_row_growth: float = 1.1
    max_duplicate_rate: float = 0.01
    min_segment_coverage: float = 0.05
    min_mean_amount: float = 1.0
    max_mean_amount: float = 1000.0
    max_age_hours: int = 24
    max_quarantine_rate: float = 0.01
    min_quality_score: float = 0.98

    @classmethod
    def from_mapping(cls, values: dict | None) -> "Thresholds":
        """Defaults overridden by the known names in ``values``; other names are ignored."""
        known = {f.name for f in fields(cls)}
        return replace(cls(), **{k: v for k, v in (values or {}).items() if k in known})


@dataclass(frozen=True)
class Prices:
    """List prices in USD. Storage is charged per 2**40 bytes and month, as the report states it."""

    scan_per_tib: float = 6.25
    storage_per_tib_month: float = 0.02


@dataclass(frozen=True)
class Retention:
    """Days each zone keeps its partitions."""

    raw: int = 90
    quarantine: int = 14
    staging: int = 7


@dataclass(frozen=True)
class Locations:
    """Roots of the zones; any URI Spark can read."""

    raw: str
    validated: str
    quarantine: str
    processed: str
    staging: str
    production: str
    ledger: str
    metrics: str
    watermarks: str

    @classmethod
    def under(cls, root: str) -> "Locations":
        root = root.rstrip("/")
        return cls(**{f.name: f"{root}/{f.name}" for f in fields(cls)})


@dataclass(frozen=True)
class Settings:
    app_name: str = "ordermill"
    shuffle_partitions: int | None = None
    broadcast_limit: str = "64m"
    thresholds: Thresholds = field(default_factory=Thresholds)
    prices: Prices = field(default_factory=Prices)
    retention: Retention = field(default_factory=Retention)
    locations: Locations | None = None
    watermark_default: str = "2026-03-21 00:00:00"
    #: Dates of the published table before this one do not count as its newest.
    date_floor: str = "2000-01-01"
    #: Shared folder for tables between steps where the session names none in spark.checkpoint.dir.
    work_dir: str | None = None

    @classmethod
    def from_mapping(cls, tree: dict) -> "Settings":
        spark = tree.get("spark") or {}
        base = cls()
        return cls(
            app_name=spark.get("app_name", base.app_name),
            shuffle_partitions=spark.get("partitions"),
            broadcast_limit=spark.get("broadcast_limit", base.broadcast_limit),
            thresholds=Thresholds.from_mapping(tree.get("quality_gate")),
            prices=Prices(**(tree.get("prices") or {})),
            retention=Retention(**(tree.get("retention") or {})),
            locations=Locations.under(tree["root"]) if tree.get("root") else None,
            date_floor=tree.get("date_floor", base.date_floor),
            work_dir=spark.get("work_dir"),
            watermark_default=tree.get("watermark", base.watermark_default),
        )

    @classmethod
    def from_yaml(cls, path: str) -> "Settings":
        import yaml

        return cls.from_mapping(yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {})
