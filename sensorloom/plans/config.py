"""Job configurations from YAML or JSON files."""

from __future__ import annotations

import json
from pathlib import Path


def load_config(path: str) -> dict:
    """Read a job configuration (risk sections, fetch sources, metrics)."""
    file = Path(path)
    if not file.exists():
        raise FileNotFoundError(f"no configuration at {path}")
    text = file.read_text(encoding="utf-8")
    if file.suffix.lower() == ".json":
        return json.loads(text)
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading YAML needs PyYAML; JSON works without") from error
    return yaml.safe_load(text)


def metric_catalog(config: dict) -> dict[str, dict]:
    """Metrics of a configuration (``metrics`` list with ids) by id."""
    catalog = {m["id"]: {k: v for k, v in m.items() if k != "id"} for m in config["metrics"]}
    for name, metric in catalog.items():
        missing = [k for k in ("data_field", "calculation_logic", "default_freq") if k not in metric]
        if missing:
            raise ValueError(f"metric {name!r} misses {missing}")
    return catalog
