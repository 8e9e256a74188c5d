"""Job settings from a YAML file or a mapping; keyword overrides win."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

Config = Mapping | str


def read_config(config: Config, **overrides) -> dict:
    """Settings as a dict. A string is the path of a YAML file."""
    if isinstance(config, Mapping):
        settings = dict(config)
    else:
        import yaml

        settings = yaml.safe_load(Path(config).read_text(encoding="utf-8"))
    return {**settings, **overrides}
