"""Settings of the flows as frozen dataclasses, from a dict or a JSON or YAML file's section."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from pathlib import Path

#: Score thresholds with the best F1 by model: fixed values.
BEST_THRESHOLDS = {68: 0.5, 72: 0.4, 75: 0.2, 92: 0.25, 102: 0.35}
CONSERVATIVE = 0.05


def score_threshold(kind: str, model: int | None = None) -> float:
    """'conservative' or 'optimal'; anything else raises."""
    if kind == "conservative":
        return CONSERVATIVE
    if kind == "optimal":
        if model not in BEST_THRESHOLDS:
            raise ValueError(f"no threshold is known for model {model}")
        return BEST_THRESHOLDS[model]
    raise ValueError(f"unknown score type {kind!r}")


@dataclass(frozen=True)
class Merge:
    distance: int = 10
    score: float = CONSERVATIVE
    keep_datasets_apart: bool = False


@dataclass(frozen=True)
class Fuse:
    n_models: int = 5
    iou: float = 0.5
    presence: float = 0.2
    score: float = 0.1
    small: int = 100_000
    most: int = 275_000
    area_max: int = 300_000


@dataclass(frozen=True)
class Years:
    iou: float = 0.5
    grow: int = 5


@dataclass(frozen=True)
class Artifacts:
    area_min: int = 132_500
    area_max: int = 200_000
    iou: float = 0.75
    years_max: int = 2


@dataclass(frozen=True)
class Enrich:
    elevation: dict = field(default_factory=lambda: {"ticino": 900.0, "vaud": 4500.0})
    area: float = 100.0
    area_ratio: float = 0.25
    compactness: float = 0.2
    exclude: tuple = ()
    overlap: tuple = ()


@dataclass(frozen=True)
class Assess:
    iou: float = 0.25
    area_min: float | None = None
    method: str = "micro-average"
    ignore_year: bool = False


def load(kind: type, source: str | dict, section: str | None = None):
    """A dataclass from a dict or from a file's section; names that it doesn't know raise."""
    if not isinstance(source, dict):
        text = Path(source).read_text()
        if source.endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as e:
                raise RuntimeError("YAML settings need the yaml package; JSON works without") from e
            source = yaml.safe_load(text)
        else:
            source = json.loads(text)
    values = source[section] if section else source
    if unknown := set(values) - {f.name for f in fields(kind)}:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})
