import json

import pytest

from sensorloom.plans.config import load_config, metric_catalog


def test_load_config(tmp_path):
    metric = {"id": "m", "name": "x", "data_field": "v", "calculation_logic": ["均值"], "default_freq": "h"}
    (tmp_path / "a.json").write_text(json.dumps({"metrics": [metric]}), encoding="utf-8")
    catalog = metric_catalog(load_config(str(tmp_path / "a.json")))
    assert catalog["m"]["calculation_logic"] == ["均值"]
    pytest.importorskip("yaml")
    (tmp_path / "a.yaml").write_text("rainfall_intensity:\n  enabled: true\n  window: 1h\n", encoding="utf-8")
    assert load_config(str(tmp_path / "a.yaml"))["rainfall_intensity"]["window"] == "1h"
    with pytest.raises(FileNotFoundError):
        load_config(str(tmp_path / "none.yaml"))
    with pytest.raises(ValueError, match="misses"):
        metric_catalog({"metrics": [{"id": "m"}]})
