"""Monthly water balance and drought severity: recurrences over the months of a cell."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hydrology import humidity, monthly_pet
from ..functions.scalar import melt_fraction

CELL = ("lat_i", "lon_i")
MM_PER_INCH = 25.4
SMALL_PPT = 1e-10


#: Share of rain and melt that runs off before it reaches the soil.
DIRECT_RUNOFF = 0.05
#: Cells are dealt into so many groups a shuffle partition; a group's months are stepped through for all its cells at once.
GROUPS_A_PARTITION = 2
#: Months of cells that a group has at most, about; more cells make more groups.
GROUP_ROWS = 400_000


@dataclass
class Bucket:
    """Soil water and snow of some cells (mm), stepped month by month."""

    capacity: np.ndarray
    soil: np.ndarray
    snow: np.ndarray

    @classmethod
    def full(cls, capacity: np.ndarray) -> Bucket:
        """Full soils without snow."""
        return cls(capacity, capacity.astype(float).copy(), np.zeros(len(capacity)))

    def step(self, rain_and_snow: np.ndarray, demand: np.ndarray, melt: np.ndarray) -> dict[str, np.ndarray]:
        """One month for all cells: aet, deficit, runoff, soil and snow.

        Snow that falls joins the pack before the pack melts. What reaches the soil serves the
        demand first; what is left of that is met by sublimation, as far as the pack goes, and then
        by the soil, which gives the less the emptier it is. A surplus fills the soil, the rest runs off.
        """
        pack = self.snow + (1 - melt) * rain_and_snow
        reaching = melt * (rain_and_snow + pack)
        runoff = DIRECT_RUNOFF * reaching
        reaching = reaching - runoff
        pack = (1 - melt) * pack
        unmet = np.maximum(demand - reaching, 0)
        sublimated = np.minimum(pack, unmet)
        with np.errstate(divide="ignore", invalid="ignore"):
            yielded = -np.expm1(-np.where(self.capacity > 0, self.soil / self.capacity, 0.0))
        drawn = np.minimum(unmet - sublimated, self.soil) * yielded
        surplus = np.maximum(reaching - demand, 0)
        stored = np.minimum(surplus, self.capacity - self.soil)
        self.soil, self.snow = self.soil + stored - drawn, pack - sublimated
        met = np.minimum(reaching, demand) + sublimated + drawn
        return {"aet": met, "def": demand - met, "q": runoff + surplus - stored, "soil": self.soil, "swe": self.snow}


def soil_terms(ppt: np.ndarray, pet: np.ndarray, awc: np.ndarray) -> dict[str, np.ndarray]:
    """Palmer's two soil layers stepped through months (rows) of many cells (columns), in inches; the upper layer holds one inch.

    et, r, ro and l are evapotranspiration, recharge, runoff and loss; pr, pro and pl what recharge, runoff and loss could be at most.
    """
    n, cells = ppt.shape
    upper_size, lower_size = np.ones(cells), np.maximum(awc - 1.0, 0.0)
    both = upper_size + lower_size
    upper, lower = upper_size.copy(), lower_size.copy()
    out = {k: np.zeros((n, cells)) for k in ("et", "r", "ro", "l", "pr", "pro", "pl")}
    for i in range(n):
        out["pr"][i], out["pro"][i] = both - upper - lower, upper + lower
        wanted = np.minimum(pet[i], upper)
        out["pl"][i] = wanted + np.minimum((pet[i] - wanted) * lower / both, lower)
        excess = ppt[i] - pet[i]
        more, less = np.maximum(excess, 0), np.maximum(-excess, 0)
        into_upper = np.minimum(more, upper_size - upper)
        into_lower = np.minimum(more - into_upper, lower_size - lower)
        from_upper = np.minimum(upper, less)
        from_lower = np.minimum((less - from_upper) * lower / both, lower)
        out["r"][i], out["ro"][i], out["l"][i] = into_upper + into_lower, more - into_upper - into_lower, from_upper + from_lower
        out["et"][i] = np.where(excess >= 0, pet[i], ppt[i] + out["l"][i])
        upper, lower = upper + into_upper - from_upper, lower + into_lower - from_lower
    return out


def palmer(ppt: np.ndarray, pet: np.ndarray, awc: np.ndarray, calibration: np.ndarray) -> np.ndarray:
    """Palmer's drought severity of monthly series in inches, months by cells, that begin in January; ``calibration`` marks months of whole years."""
    n = len(ppt)
    t, month = soil_terms(ppt, pet, awc), np.arange(n) % 12
    of_month = (month == np.arange(12)[:, None]).astype(float)  # 12 by months
    total = lambda x: of_month @ np.where(calibration, x, 0.0)
    ratio = lambda a, b, empty: np.divide(a, b, out=np.full(a.shape, empty), where=b != 0)
    alpha, beta = ratio(total(t["et"]), total(pet), 1.0), ratio(total(t["r"]), total(t["pr"]), 1.0)
    gamma, delta = ratio(total(t["ro"]), total(t["pro"]), 1.0), ratio(total(t["l"]), total(t["pl"]), 0.0)
    departure = ppt - (alpha[month] * pet + beta[month] * t["pr"] + gamma[month] * t["pro"] - delta[month] * t["pl"])
    mean_d = total(np.abs(departure)) / np.maximum(1, total(np.ones_like(ppt)))
    demand = ratio(total(pet) + total(t["r"]) + total(t["ro"]), total(ppt) + total(t["l"]), 1.0)
    k = 1.5 * np.log10(np.maximum((demand + 2.8) / np.maximum(mean_d, 1e-9), 1e-9)) + 0.5
    weight = 17.67 * k / np.maximum((mean_d * k).sum(axis=0), 1e-9)
    return severities(weight[month] * departure)


#: Palmer's constants: how much of an index lasts into the next month, and the share that a month's departure adds.
LASTING, ADDED = 0.897, 1 / 3
#: An index of this size starts a spell, one of this size ends it, and a month counts towards its end beyond this.
ESTABLISHED, ENDED = 1.0, 0.5
NEAR_NORMAL = 0.15


def severity(z: np.ndarray) -> np.ndarray:
    """The index of Palmer's moisture anomalies, with his probability that a spell has ended and the look back.

    A wet and a dry spell to come are followed side by side. An established spell lasts until the
    moisture received since its end began is all that it takes to end it (a probability of 100 %).
    Months between are settled looking back: they belong to the spell if its end does not
    come after all, and to the spell to come, or to the one of greater size, if it does.
    """
    out = np.zeros(len(z))
    coming = {1: 0.0, -1: 0.0}  # the spell to come, by sign
    index, sign, received = 0.0, 0, 0.0  # the established spell, and what has been received towards its end
    open_months: list[tuple[int, float, float]] = []  # months not settled: place, wet and dry spell to come

    def settle(towards: int) -> None:
        """Months not settled go to the spell to come of that sign, as far back as it reaches, before that to the other."""
        for place, wet, dry in reversed(open_months):
            own, other = (wet, dry) if towards > 0 else (dry, wet)
            if not own:
                towards, own = -towards, other
            out[place] = own
        open_months.clear()

    for i, value in enumerate(z.tolist()):
        for s in (1, -1):
            coming[s] = s * max(0.0, s * (LASTING * coming[s] + ADDED * value))
        if sign:
            # What the month adds towards the spell's end, and what it takes to end it, as moisture anomalies.
            against = received - sign * (value - sign * NEAR_NORMAL)
            needed = (LASTING * abs(index) - ENDED) / ADDED + received
            index, received = LASTING * index + ADDED * value, max(0.0, against)
            if against > 0 and (needed <= 0 or against >= needed):  # the end is certain
                sign, index, received = 0, 0.0, 0.0
            elif received:
                out[i] = index
                open_months.append((i, coming[1], coming[-1]))
                continue
            else:  # the spell goes on: open months keep its index, and no other spell is to come
                open_months.clear()
                coming = {1: 0.0, -1: 0.0}
                out[i] = index
                continue
        open_months.append((i, coming[1], coming[-1]))
        started = next((s for s in (1, -1) if s * coming[s] >= ESTABLISHED), 0)
        if started:
            settle(started)
            sign, index, received = started, out[i], 0.0
            coming = {1: 0.0, -1: 0.0}
        elif not coming[1] or not coming[-1]:  # one spell alone can be meant
            settle(1 if coming[1] else -1)
    for place, wet, dry in open_months:
        if not sign:
            out[place] = wet if wet >= -dry else dry
    return out


def severities(z: np.ndarray) -> np.ndarray:
    """``severity`` of many cells at once (months by cells): the same steps on arrays, cells that look back picked out a month at a time."""
    n, cells = z.shape
    out, coming = np.zeros((n, cells)), {1: np.zeros(cells), -1: np.zeros(cells)}
    index, sign, received = np.zeros(cells), np.zeros(cells, int), np.zeros(cells)
    begins = np.zeros(cells, int)  # the first month that is not settled; those up to now are open
    wet, dry = np.zeros((n, cells)), np.zeros((n, cells))

    def settle(which: np.ndarray, towards: np.ndarray, last: int) -> None:
        """Open months of some cells go to the spell to come of a sign, as far back as it reaches, before that to the other."""
        which, towards = np.flatnonzero(which), towards.copy()
        for place in range(last, -1, -1):
            which = which[begins[which] <= place]
            if not len(which):
                break
            own = np.where(towards[which] > 0, wet[place, which], dry[place, which])
            other = np.where(towards[which] > 0, dry[place, which], wet[place, which])
            towards[which] = np.where(own != 0, towards[which], -towards[which])
            out[place, which] = np.where(own != 0, own, other)

    for i in range(n):
        for s in (1, -1):
            coming[s] = s * np.maximum(0.0, s * (LASTING * coming[s] + ADDED * z[i]))
        going = sign != 0
        against = received - sign * (z[i] - sign * NEAR_NORMAL)
        needed = (LASTING * np.abs(index) - ENDED) / ADDED + received
        over = going & (against > 0) & ((needed <= 0) | (against >= needed))
        index = np.where(going & ~over, LASTING * index + ADDED * z[i], 0.0)
        received = np.where(going & ~over, np.maximum(0.0, against), 0.0)
        sign = np.where(over, 0, sign)
        certain = (sign != 0) & (received == 0)
        wet[i], dry[i] = coming[1], coming[-1]
        out[i] = np.where(sign != 0, index, out[i])
        # A spell that goes on keeps its open months as they are.
        begins[certain] = i + 1
        for s in (1, -1):
            coming[s] = np.where(certain, 0.0, coming[s])
        free = sign == 0
        starts_wet = free & (coming[1] >= ESTABLISHED)
        started = starts_wet | free & (-coming[-1] >= ESTABLISHED)
        towards = np.where(starts_wet, 1, -1)
        alone = free & ~started & ((coming[1] == 0) | (coming[-1] == 0))
        towards = np.where(alone, np.where(coming[1] != 0, 1, -1), towards)
        if (done := started | alone).any():
            settle(done, towards, i)
            begins[done] = i + 1
        sign = np.where(started, towards, sign)
        index, received = np.where(started, out[i], index), np.where(started, 0.0, received)
        for s in (1, -1):
            coming[s] = np.where(started, 0.0, coming[s])
    left = (np.arange(n)[:, None] >= begins) & (sign == 0)
    return np.where(left, np.where(wet >= -dry, wet, dry), out)


def pdsi(ppt: np.ndarray, pet: np.ndarray, awc: np.ndarray, years: np.ndarray, months: np.ndarray, pad_years: int = 10, first: int = 1970, last: int = 2000) -> np.ndarray:
    """Drought severity of monthly series (mm; months by cells), spun up on some years of the normal period's climatology and clipped to +-16."""
    if len(ppt) <= 12 * pad_years:
        raise ValueError(f"needs more than {12 * pad_years} months")
    normal = (years >= first) & (years <= last)
    normal = normal if normal.any() else np.ones(len(years), bool)
    mean = lambda x: np.stack([x[normal & (months == m)].mean(axis=0) for m in range(1, 13)])
    p = np.concatenate([np.tile(mean(ppt), (pad_years, 1)), ppt]) / MM_PER_INCH
    e = np.concatenate([np.tile(mean(pet), (pad_years, 1)), pet]) / MM_PER_INCH
    p = np.where(p <= 0, SMALL_PPT, p)
    at = np.flatnonzero(normal) + 12 * pad_years
    calibration = np.zeros((len(p), 1), bool)
    calibration[at[0] : at[-1] + 1] = True
    return np.clip(palmer(p, e, awc / MM_PER_INCH, calibration), -16, 16)[12 * pad_years :]


def water_balance(df: DataFrame, cell: Sequence[str] = CELL, time: str = "time", latitude: str = "lat", with_pdsi: bool = True, normal: tuple[int, int] = (1970, 2000), pad_years: int = 10) -> DataFrame:
    """Monthly rows of tmax, tmin, ppt, srad, ws, tdew (or rh or vap), awc and elevation to aet, def, pet, q, soil, swe (and pdsi).

    Humidity and evapotranspiration are expressions; only the bucket's recurrence runs in a grouped
    function, which steps through the months of many cells at once. The first month starts with a full soil and no snow. Series too
    short for a spin-up, or not starting in January, have no pdsi.
    """
    ready = monthly_pet(humidity(df), cell, time, latitude).withColumn("_melt", melt_fraction(F.col("tmean")))
    kinds = {f.name: f.dataType.simpleString() for f in ready.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in (time, *cell)) + ", aet double, def double, pet double, q double, soil double, swe double, pdsi double"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([*cell, time]).reset_index(drop=True)
        by_cell = rows.groupby(list(cell), sort=False, dropna=False)
        column, step = by_cell.ngroup().to_numpy(), by_cell.cumcount().to_numpy()
        first = np.flatnonzero(step == 0)
        bucket = Bucket.full(rows["awc"].to_numpy(float)[first])
        wide = {c: np.full((step.max() + 1, len(first)), np.nan) for c in ("ppt", "pet", "_melt")}
        for c, matrix in wide.items():
            matrix[step, column] = rows[c].to_numpy(float)
        months = [bucket.step(wide["ppt"][k], wide["pet"][k], wide["_melt"][k]) for k in range(step.max() + 1)]
        result = rows[[time, *cell]].copy()
        for c in ("aet", "def", "pet", "q", "soil", "swe"):
            result[c] = rows["pet"].to_numpy() if c == "pet" else np.stack([m[c] for m in months])[step, column]
        result["pdsi"] = np.nan
        if with_pdsi:
            _add_pdsi(result, rows, column, step, wide, time, normal, pad_years)
        return result

    columns = [time, *cell, "ppt", "pet", "awc", "_melt"]
    groups = max(GROUPS_A_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // GROUP_ROWS))
    grouped = ready.select(*columns).groupBy(F.pmod(F.xxhash64(*cell), F.lit(groups)).alias("_group"))
    return grouped.applyInPandas(run, schema)


def _add_pdsi(result: pd.DataFrame, rows: pd.DataFrame, column: np.ndarray, step: np.ndarray, wide: dict[str, np.ndarray], time: str, normal: tuple[int, int], pad_years: int) -> None:
    """pdsi of the cells whose series begin in January and are long enough, those with the same months together."""
    when = pd.to_datetime(rows[time])
    number = (when.dt.year * 12 + when.dt.month - 1).to_numpy()
    first = np.flatnonzero(step == 0)
    length = np.bincount(column)
    whole = np.bincount(column, number - number[first][column] != step) == 0  # no month is left out
    whole &= np.bincount(column, rows[["ppt", "pet"]].isna().any(axis=1)) == 0
    good = whole & (length > 12 * pad_years) & (number[first] % 12 == 0)
    for begin, n in sorted({(int(number[f]), int(length[c])) for c, f in enumerate(first) if good[c]}):
        cells = np.flatnonzero(good & (number[first] == begin) & (length == n))
        months = begin + np.arange(n)
        found = pdsi(wide["ppt"][:n, cells], wide["pet"][:n, cells], rows["awc"].to_numpy(float)[first[cells]], months // 12, months % 12 + 1, pad_years, *normal)
        place = np.full(len(length), -1)
        place[cells] = np.arange(len(cells))
        here = place[column] >= 0
        result.loc[here, "pdsi"] = found[step[here], place[column[here]]]


def soil_balance(df: DataFrame, ppt: str, pet: str, awc: str, cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """time, cell and ``soil_terms`` of monthly rows (inches); months that a cell lacks are stepped over, values must be there."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = ("et", "r", "ro", "l", "pr", "pro", "pl")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([*cell, time]).reset_index(drop=True)
        by_cell = rows.groupby(list(cell), sort=False, dropna=False)
        column, step = by_cell.ngroup().to_numpy(), by_cell.cumcount().to_numpy()
        wide = {c: np.zeros((step.max() + 1, column.max() + 1)) for c in (ppt, pet)}
        for c, matrix in wide.items():
            matrix[step, column] = rows[c].to_numpy(float)
        terms = soil_terms(wide[ppt], wide[pet], rows[awc].to_numpy(float)[step == 0])
        return rows[[time, *cell]].assign(**{k: terms[k][step, column] for k in names})

    groups = max(GROUPS_A_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // GROUP_ROWS))
    grouped = df.select(time, *cell, ppt, pet, awc).groupBy(F.pmod(F.xxhash64(*cell), F.lit(groups)).alias("_group"))
    return grouped.applyInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in (time, *cell)) + ", " + ", ".join(f"{c} double" for c in names))


def valid_cells(df: DataFrame, cell: Sequence[str] = CELL, time: str = "time") -> DataFrame:
    """Cells within the mask that have soil capacity, elevation and precipitation at the last step."""
    last = df.groupBy(*cell).agg(F.max_by(F.struct("mask", "awc", "elevation", "ppt"), time).alias("s"))
    s = F.col("s")
    return last.filter((s["mask"] == 1) & s["awc"].isNotNull() & s["elevation"].isNotNull() & s["ppt"].isNotNull()).select(*cell)


