"""Run configuration of one basin: plain dataclasses parsed once on the driver."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

DEFAULT_OPERATOR_THRESHOLD = 50


@dataclass(frozen=True)
class StatisticalFilter:
    columns: tuple[str, ...] | None = None
    threshold: float = 3.0
    kind: str = "mad"


@dataclass(frozen=True)
class FilterConfig:
    keep: tuple[str, ...] | None = None
    percentile: bool = False
    thresholds: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    statistical: StatisticalFilter | None = None
    ratios: Mapping[tuple[str, str], float] = field(default_factory=dict)


@dataclass(frozen=True)
class SplitConfig:
    test: bool = True
    test_ratio: float = 0.1
    valid_ratio: float = 0.2


@dataclass(frozen=True)
class RunConfig:
    reservoirs: tuple[str, ...]
    filtering: FilterConfig
    features: tuple[str, ...]
    target: str
    categories: tuple[str, ...] = ()
    operator_threshold: int = DEFAULT_OPERATOR_THRESHOLD
    transforms: Mapping[str, Any] = field(default_factory=dict)
    split: SplitConfig = SplitConfig()
    scale_x: bool = True
    scaler: str = "robust"  # or "standard"
    scale_y: bool = False
    models: Mapping[str, Mapping[str, Any]] = field(default_factory=lambda: {"HuberRegressor": {"max_iter": 1000}})
    tuning: Mapping[str, Mapping[str, Sequence[Any]]] = field(default_factory=dict)

    @property
    def feature_transforms(self) -> dict[str, Any]:
        return {c: t for c, t in self.transforms.items() if c != self.target}

    @property
    def target_transform(self) -> Any | None:
        return self.transforms.get(self.target)


def split_ratio_key(key: str) -> tuple[str, str]:
    """``"a / b"`` or ``"a/b"``; the spaced form wins because a column name may hold a slash."""
    parts = key.split(" / ") if " / " in key else key.split("/")
    if len(parts) != 2:
        raise ValueError(f"cannot split ratio key {key!r} into two columns")
    return parts[0].strip(), parts[1].strip()


def parse_filtering(raw: Mapping[str, Any]) -> FilterConfig:
    statistical = None
    if "statistical_filtering" in raw:
        block = raw["statistical_filtering"]
        columns = block.get("cols_to_filter")
        statistical = StatisticalFilter(
            tuple(columns) if columns else None, block.get("threshold", 3.0), block.get("type", "mad")
        )
    technical = raw.get("technical_filtering", {})
    keep = raw.get("cols_to_keep")
    thresholds = {c: tuple(b) for c, b in technical.get("thresholds", {}).items()}
    percentile = bool(technical.get("percentile", False))
    settings = FilterConfig(
        keep=tuple(keep) if keep else None,
        percentile=percentile,
        thresholds=thresholds,
        statistical=statistical,
        ratios={split_ratio_key(k): v for k, v in raw.get("ratio_filtering", {}).items()},
    )
    warn_of_fractional_bounds(settings)
    return settings


def warn_of_fractional_bounds(settings: FilterConfig) -> None:
    bounds = [b for pair in settings.thresholds.values() for b in pair if b is not None]
    if bounds and not settings.percentile and all(0 <= b <= 1 for b in bounds):
        warnings.warn("absolute thresholds all lie in [0, 1]: were percentiles meant?", stacklevel=3)


def parse_config(raw: Mapping[str, Any]) -> RunConfig:
    """Build a :class:`RunConfig` from the JSON object of one basin."""
    categories = raw.get("categorical_feature") or ()
    if isinstance(categories, str):
        categories = (categories,)
    split = raw.get("split_data") or {}
    scale = raw.get("scale_data") or {}
    targets = raw["target_features"]
    tuning = raw.get("hyperparam_tuning_config") or {}
    threshold = raw.get("operator_threshold")
    return RunConfig(
        reservoirs=tuple(raw["reservoirs_of_interest"]),
        filtering=parse_filtering(raw.get("filtering_config") or {}),
        features=tuple(raw["input_features"]),
        target=targets if isinstance(targets, str) else targets[0],
        categories=tuple(categories) if raw.get("encode") else (),
        operator_threshold=DEFAULT_OPERATOR_THRESHOLD if threshold is None else int(threshold),
        transforms=dict(raw.get("transformations") or {}),
        split=SplitConfig(
            bool(split.get("test_data", False)),
            split.get("test_data_ratio") or 0.1,
            split.get("validation_data_ratio") or 0.2,
        ),
        scale_x=bool(scale.get("scale_x", False)),
        scaler=str(scale.get("scaler", "robust")),
        scale_y=bool(scale.get("scale_y", False)),
        models={name: dict(params or {}) for name, params in raw["training_config"].items()},
        tuning={name: dict(block["param_grid"]) for name, block in tuning.items()},
    )


def check_reservoirs(config: RunConfig, reservoirs: Sequence[str]) -> None:
    unknown = sorted(set(reservoirs) - set(config.reservoirs))
    if unknown:
        raise ValueError(f"reservoirs {unknown} are not configured; known: {list(config.reservoirs)}")


def basin_config(basin: str) -> RunConfig:
    if basin.upper() not in BASINS:
        raise KeyError(f"no configuration for basin {basin!r}; known: {sorted(BASINS)}")
    config = BASINS[basin.upper()]
    warn_of_fractional_bounds(config.filtering)
    return config


# Basins, their reservoirs and the percentile bounds of the shipped configuration.
_FEATURES = ("Proppant_LBSPerFT", "Fluid_BBLPerFT", "LateralLength_FT", "LatitudeMP", "LongitudeMP")
_TARGET = "cost/ft_Lateral"
_RESERVOIR = "ReservoirGoldConsolidated"
_OPERATOR = "OperatorGold"
_KEEP = (
    "TotalWellCost_USDMM",
    "Proppant_LBSPerFT",
    "Fluid_BBLPerFT",
    "LateralLength_FT",
    "LatitudeMP",
    "TVD_FT",
    "LongitudeMP",
    _TARGET,
    _RESERVOIR,
)


def _basin(
    *reservoirs: str,
    operators: bool = False,
    top_cost_quantile: float = 0.999,
    percentile: bool = True,
    transforms: Mapping[str, Any] | None = None,
) -> RunConfig:
    bounds = {
        "Proppant_LBSPerFT": (0.025, 0.975),
        "Fluid_BBLPerFT": (0.025, 0.975),
        "TVD_FT": (0.025, 0.999),
        "LateralLength_FT": (0.025, 0.975),
        _TARGET: (0.025, top_cost_quantile),
    }
    return RunConfig(
        reservoirs=reservoirs,
        filtering=FilterConfig(
            keep=_KEEP + ((_OPERATOR,) if operators else ()), percentile=percentile, thresholds=bounds
        ),
        features=_FEATURES,
        target=_TARGET,
        categories=(_RESERVOIR, _OPERATOR) if operators else (_RESERVOIR,),
        transforms=transforms or {},
    )


BASINS: dict[str, RunConfig] = {
    "GULF COAST EAST": _basin("HAYNESVILLE", "BOSSIER", "COTTON VALLEY", "AUSTIN CHALK", operators=True),
    "MIDLAND": _basin(
        "SPRABERRY MIDDLE", "JO MILL", "SPRABERRY LOWER", "DEAN",
        "WOLFCAMP A", "WOLFCAMP B", "WOLFCAMP C", "WOLFCAMP D",
        operators=True, top_cost_quantile=0.975,
    ),
    "ANADARKO EAST": _basin(
        "WOODFORD", "MISSISSIPPIAN",
        operators=True,
        transforms={"LateralLength_FT": "log", "Proppant_LBSPerFT": "log", "Fluid_BBLPerFT": "log", _TARGET: "log"},
    ),
    "DELAWARE": _basin(
        "AVALON", "1ST BONE SPRING", "2ND BONE SPRING", "3RD BONE SPRING",
        "WOLFCAMP XY", "WOLFCAMP A", "WOLFCAMP B", "WOLFCAMP C", "WOLFCAMP D",
    ),
    "GULF COAST WEST": _basin("EAGLE FORD LOWER", "AUSTIN CHALK", "EAGLE FORD UPPER", "EAGLE FORD"),
    "APPALACHIAN": _basin("MARCELLUS", "POINT PLEASANT"),
    "DJ": _basin("NIOBRARA A", "NIOBRARA B", "NIOBRARA C", "CODELL"),
    "POWDER RIVER": _basin("NIOBRARA B", "TURNER", "NIOBRARA", "PARKMAN", percentile=False),
    "WILLISTON": _basin("BAKKEN", "THREE FORKS"),
}
