"""Every number and path that changes a result, in one place."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from typing import Any

# Where each parameter sits in a nested configuration mapping.
_CONFIG_KEYS = {
    "raw_path": ("storage", "raw_layer_path"),
    "bronze_path": ("storage", "bronze_layer_path"),
    "silver_path": ("storage", "silver_layer_path"),
    "serving_path": ("storage", "serving_layer_path"),
    "max_late_event_hours": ("pipeline_settings", "max_late_event_hours"),
    "late_event_share": ("data_quality", "late_event_share"),
    "max_rejected_share": ("data_quality", "max_rejected_share"),
    "duplicate_tolerance": ("data_quality", "duplicate_tolerance"),
    "null_threshold_pct": ("data_quality", "null_threshold_pct"),
    "row_count_variance_pct": ("data_quality", "row_count_variance_pct"),
}


@dataclass(frozen=True)
class Params:
    # Layer folders. They must lie on storage that every executor reaches.
    raw_path: str = "raw"
    bronze_path: str = "bronze"
    silver_path: str = "silver"
    serving_path: str = "serving"
    # In front of the catalog's namespaces when publishing there.
    catalog_prefix: str = ""

    # Fixed values of the domain.
    max_late_event_hours: float = 24
    # The share of late inspections that the gate lets pass, as the late filter drops them; None: not one.
    late_event_share: float | None = None
    # The share of raw rows that may not parse: they are set aside. None: one stops the ingest.
    max_rejected_share: float | None = None
    duplicate_tolerance: int = 0
    null_threshold_pct: float = 0.05
    row_count_variance_pct: float = 0.20
    shift_minutes: float = 480.0
    high_defect_pct: float = 5.0
    defect_window_rows: int = 7
    downtime_window_rows: int = 30
    supplier_window_rows: int = 4

    # A window group above this many rows is cut into chunks (operators.frames).
    window_group_rows: int = 5_000_000
    # A join key above this many rows is spread over several tasks (operators.joins).
    hot_key_rows: int = 2_000_000

    @classmethod
    def from_mapping(cls, config: Mapping[str, Any], **overrides: Any) -> Params:
        """Build from a nested mapping such as a parsed YAML file; unknown keys are ignored."""
        found = {}
        for name, (section, key) in _CONFIG_KEYS.items():
            value = (config.get(section) or {}).get(key)
            if value is not None:
                found[name] = value
        # An empty serving path publishes to the catalog instead of a folder.
        if "serving_path" not in found and "silver_path" in found:
            found["serving_path"] = found["silver_path"].rstrip("/") + "_serving"
        return cls(**{**found, **overrides})

    @classmethod
    def from_yaml(cls, path: str, **overrides: Any) -> Params:
        try:
            import yaml
        except ImportError as missing:
            raise RuntimeError("reading a YAML configuration needs the yaml module") from missing
        with open(path, encoding="utf-8") as handle:
            return cls.from_mapping(yaml.safe_load(handle) or {}, **overrides)

    def __post_init__(self) -> None:
        for f in fields(self):
            if f.name.endswith("_rows") and getattr(self, f.name) < 1:
                raise ValueError(f"{f.name} must be at least 1")
