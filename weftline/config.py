"""Settings with their defaults; a YAML file may override them where PyYAML is installed."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field
from typing import Any

from weftline.functions import fixed_values as V


@dataclass(frozen=True)
class Normalization:
    titles: tuple[str, ...] = tuple(V.TITLES)
    suffixes: tuple[str, ...] = tuple(V.SUFFIXES)
    case: str = "title"
    affiliation_threshold: float = 0.5
    #: Remove suffixes without a word boundary behind them, as the original rules do.
    loose_suffixes: bool = False

    def __post_init__(self) -> None:
        if self.case not in ("title", "upper", "lower"):
            raise ValueError(f"case: {self.case!r}")
        if not 0 <= self.affiliation_threshold <= 1:
            raise ValueError("affiliation_threshold must lie in [0, 1]")


@dataclass(frozen=True)
class Strategy:
    """A blocking strategy: field expressions, and whether their words make the key."""

    name: str
    keys: tuple[str, ...]
    tokens: bool = False


@dataclass(frozen=True)
class Blocking:
    strategies: tuple[Strategy, ...] = (
        Strategy("location_name", ("state_norm", "zip_norm[:3]", "last_name_metaphone", "first_name_soundex")),
        Strategy("affiliation_tokens", ("state_norm", "affiliation_tokens"), tokens=True),
        Strategy("address_hash", ("city_norm", "address_line_1_norm[:3]")),
    )
    #: Records of a block that is paired, at most; None pairs them all.
    most_per_block: int | None = 1000
    #: Token keys leave array columns out, as the original does.
    skip_arrays: bool = False


@dataclass(frozen=True)
class Weights:
    name_exact: float = 0.30
    name_fuzzy: float = 0.20
    name_fuzzy_fuzz: float = 0.15
    affiliation: float = 0.15
    location: float = 0.25
    contact: float = 0.10
    ml_model: float = 0.25


@dataclass(frozen=True)
class Thresholds:
    auto_merge: float = 0.85
    audit_low: float = 0.65
    audit_high: float = 0.85
    most_edits: int = 2
    least_fuzz: int = 90


@dataclass(frozen=True)
class Merge:
    strategy: str = "most_complete"
    hash_fields: tuple[str, ...] = ("norm_name", "city_norm", "state_norm")
    #: With most_recent: the column to order by; without, the first value counts.
    recency: str | None = None

    def __post_init__(self) -> None:
        if self.strategy not in ("most_complete", "longest", "most_recent"):
            raise ValueError(f"strategy: {self.strategy!r}")


@dataclass(frozen=True)
class Audit:
    retrain_threshold: int = 100
    sample_rate: float = 0.07


@dataclass(frozen=True)
class Config:
    normalization: Normalization = field(default_factory=Normalization)
    blocking: Blocking = field(default_factory=Blocking)
    weights: Weights = field(default_factory=Weights)
    thresholds: Thresholds = field(default_factory=Thresholds)
    merge: Merge = field(default_factory=Merge)
    audit: Audit = field(default_factory=Audit)


def merged(base: dict[str, Any], over: dict[str, Any]) -> dict[str, Any]:
    """``base`` with the values of ``over``, nested mappings merged."""
    return base | {k: merged(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in over.items()}


def from_dict(values: dict[str, Any]) -> Config:
    """A Config from nested mappings; unknown names are errors."""

    def build(kind, given):
        kwargs = {}
        known = {f.name: f for f in dataclasses.fields(kind)}
        for name, v in given.items():
            if name not in known:
                raise ValueError(f"{kind.__name__} has no setting {name!r}")
            if name == "strategies":
                v = tuple(Strategy(s["name"], tuple(s["keys"]), bool(s.get("tokens", s.get("similarity_threshold")))) for s in v)
            elif isinstance(v, list):
                v = tuple(v)
            kwargs[name] = v
        return kind(**kwargs)

    sections = {"normalization": Normalization, "blocking": Blocking, "weights": Weights, "thresholds": Thresholds, "merge": Merge, "audit": Audit}
    if unknown := values.keys() - sections.keys():
        raise ValueError(f"unknown sections: {sorted(unknown)}")
    return Config(**{name: build(sections[name], v or {}) for name, v in values.items()})


def to_dict(config: Config) -> dict[str, Any]:
    """Nested mappings and lists that ``from_dict`` takes."""

    def plain(v):
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        return [plain(x) for x in v] if isinstance(v, (list, tuple)) else v

    return plain(dataclasses.asdict(config))


def load(path: str | None = None) -> Config:
    """The defaults, with what the YAML file at ``path`` overrides."""
    if path is None:
        return Config()
    import yaml

    with open(path, encoding="utf-8") as f:
        return from_dict(yaml.safe_load(f) or {})


def save(config: Config, path: str) -> None:
    import yaml

    with open(path, "w", encoding="utf-8") as f:
        yaml.safe_dump(to_dict(config), f, sort_keys=False)
