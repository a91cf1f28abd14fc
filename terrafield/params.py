"""What a run is: bounding box, periods, models and bias-correction choices, with a stable identity."""

from __future__ import annotations

import hashlib
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


def str_to_hash(text: str) -> str:
    """A 16-digit hex digest (blake2b of 8 bytes) of a text."""
    return hashlib.blake2b(text.encode(), digest_size=8).hexdigest()


def _pair(values, what: str) -> tuple:
    values = tuple(values)
    if len(values) != 2:
        raise ValueError(f"{what} needs two values, not {len(values)}")
    return values


@dataclass(frozen=True)
class BBox:
    """A closed box of latitudes and longitudes."""

    latmin: float
    latmax: float
    lonmin: float
    lonmax: float

    def predicate(self, lat: str = "lat", lon: str = "lon") -> Column:
        return F.col(lat).between(self.latmin, self.latmax) & F.col(lon).between(self.lonmin, self.lonmax)

    def __str__(self) -> str:
        return f"{self.latmin}_{self.latmax}_{self.lonmin}_{self.lonmax}"


@dataclass(frozen=True)
class TimePeriod:
    """Whole years from ``start`` to ``stop``, both included."""

    start: str
    stop: str

    def predicate(self, time: str = "time") -> Column:
        """Bounds of days, which scans are given (years of days are not); times of the last day lie within."""
        return (F.col(time) >= F.lit(f"{int(self.start):04d}-01-01").cast("date")) & (F.col(time) < F.lit(f"{int(self.stop) + 1:04d}-01-01").cast("date"))

    def __str__(self) -> str:
        return f"{self.start}_{self.stop}"


@dataclass(frozen=True)
class RunParameters:
    """One run. ``features`` defaults to the variable alone; a detrend flag may be a text."""

    method: str
    variable: str
    obs: str = "obs"
    model: str = "gcm"
    scenario: str = "historical"
    member: str = ""
    grid_label: str = ""
    table_id: str = "day"
    features: tuple[str, ...] = ()
    latmin: float = -90.0
    latmax: float = 90.0
    lonmin: float = -180.0
    lonmax: float = 180.0
    train_dates: tuple[str, ...] = ("1981", "2010")
    predict_dates: tuple[str, ...] = ("2015", "2099")
    bias_correction_method: str = "quantile_map"
    bias_correction_kwargs: tuple[tuple[str, object], ...] = ()
    model_type: str = ""
    model_params: tuple[tuple[str, object], ...] = field(default=())

    def __post_init__(self):
        object.__setattr__(self, "features", tuple(self.features) or (self.variable,))
        object.__setattr__(self, "train_dates", _pair(self.train_dates, "train_dates"))
        object.__setattr__(self, "predict_dates", _pair(self.predict_dates, "predict_dates"))

    @property
    def bbox(self) -> BBox:
        return BBox(self.latmin, self.latmax, self.lonmin, self.lonmax)

    @property
    def train_period(self) -> TimePeriod:
        return TimePeriod(*map(str, self.train_dates))

    @property
    def predict_period(self) -> TimePeriod:
        return TimePeriod(*map(str, self.predict_dates))

    @property
    def run_id(self) -> str:
        parts = [self.method, self.obs, self.model, self.scenario, self.member, self.grid_label, "+".join(self.features), self.variable, str(self.bbox), str(self.train_period), str(self.predict_period)]
        return "_".join(p for p in parts if p)

    @property
    def run_id_hash(self) -> str:
        return str_to_hash(self.run_id + repr(sorted(asdict(self).items())))


def parse_flag(value) -> bool:
    """True or false of a flag given as such or as a text."""
    if isinstance(value, str):
        if value.strip().lower() not in ("true", "false"):
            raise ValueError(f"not a flag: {value!r}")
        return value.strip().lower() == "true"
    return bool(value)


def percentile_of(metric: str) -> float:
    """0.95 of ``percentile95``."""
    if not metric.startswith("percentile"):
        raise ValueError(f"not a percentile: {metric!r}")
    return float(metric.removeprefix("percentile")) / 100


def make_run_parameters(**values) -> RunParameters:
    """Run parameters of a parameter file; ``train_period`` and ``predict_period`` are read as the newer names."""
    for old, new in (("train_period", "train_dates"), ("predict_period", "predict_dates")):
        if old in values:
            values[new] = values.pop(old)
    for key in ("bias_correction_kwargs", "model_params"):
        if isinstance(values.get(key), dict):
            values[key] = tuple(sorted((k, v if not isinstance(v, dict) else tuple(sorted(v.items()))) for k, v in values[key].items()))
    known = RunParameters.__dataclass_fields__
    return RunParameters(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items() if k in known})
