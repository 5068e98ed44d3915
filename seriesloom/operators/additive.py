"""Additive model: trend with changepoints, seasonality and holidays, per series.

    y(t) = m + k t + sum_j d_j max(0, t - s_j) + yearly + weekly + holidays + noise

The design columns are functions of the date alone.  One pass gives, per series
(and per stretch between cutoffs), the products of the columns with y and the days
that have a value; the products of the columns with each other are not shipped but
rebuilt from the days by the solver.  Changepoints have a Laplace prior, so most
stay at zero; the other coefficients have Gaussian ones.  Predictions are built-in
expressions, their intervals quantiles of simulated slope changes after the end.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.holidays import Calendar, OwnHoliday
from .blocks import BLOCK_DAYS, attach
from .draws import poisson_table, uniform
from .evaluate import cutoffs, rolling_origin_membership
from .grid import AXES

EPOCH = dt.date(1970, 1, 1)
YEAR, WEEK = 365.25, 7


@dataclass(frozen=True)
class AdditiveConfig:
    changepoints: int = 25
    changepoint_range: float = 0.8
    yearly_order: int = 10
    weekly_order: int = 3
    changepoint_prior_scale: float = 0.05
    seasonality_prior_scale: float = 10.0
    holidays_prior_scale: float = 10.0
    trend_prior_scale: float = 5.0
    interval_width: float = 0.95
    uncertainty_samples: int = 1000
    country_holidays: str | None = None
    own_holidays: tuple[OwnHoliday, ...] = ()

    def __post_init__(self):
        if not 0 < self.interval_width < 1:
            raise ValueError("interval_width must lie between 0 and 1")

    @property
    def calendar(self) -> Calendar:
        return Calendar(self.country_holidays, own=self.own_holidays)

    @property
    def knots(self) -> list[float]:
        step = self.changepoint_range / (self.changepoints + 1)
        return [step * (j + 1) for j in range(self.changepoints)]

    def columns(self, ds: Column, t: Column) -> dict[str, list[Column]]:
        """Design columns by component; ``t`` is time scaled to the training range."""
        day = F.unix_date(ds)

        def waves(period: float, order: int) -> list[Column]:
            angles = [day * F.lit(2 * math.pi * n / period) for n in range(1, order + 1)]
            return [f(a) for a in angles for f in (F.sin, F.cos)]

        groups = {
            "trend": [t, *[F.greatest(t - s, F.lit(0.0)) for s in self.knots]],
            "yearly": waves(YEAR, self.yearly_order),
            "weekly": waves(WEEK, self.weekly_order),
        }
        flags = self.calendar.flags(ds)
        if flags:
            groups["holidays"] = list(flags.values())
        return groups

    def design(self, day: np.ndarray, t: np.ndarray) -> np.ndarray:
        """The same columns for day numbers, a constant first."""
        knots = np.array(self.knots)
        parts = [np.ones((len(day), 1)), t[:, None], np.maximum(t[:, None] - knots, 0.0)]
        for period, order in ((YEAR, self.yearly_order), (WEEK, self.weekly_order)):
            angles = day[:, None] * (2 * math.pi * np.arange(1, order + 1) / period)
            parts.append(np.stack((np.sin(angles), np.cos(angles)), axis=2).reshape(len(day), -1))
        if len(day):
            first, last = (EPOCH + dt.timedelta(int(x)) for x in (day.min(), day.max()))
            flags = self.calendar.dates(first, last).values()
            parts += [np.isin(day, [(d - EPOCH).days for d in days])[:, None].astype(float) for days in flags]
        return np.concatenate(parts, axis=1)

    def penalties(self, groups: dict[str, list[Column]]) -> np.ndarray:
        """Gaussian penalty per design column, the constant first; zero for the changepoints."""
        scales = [self.trend_prior_scale, self.trend_prior_scale]
        scales += [math.inf] * (len(groups["trend"]) - 1)
        scales += [self.seasonality_prior_scale] * (len(groups["yearly"]) + len(groups["weekly"]))
        scales += [self.holidays_prior_scale] * len(groups.get("holidays", []))
        return 1.0 / np.square(scales)

    @property
    def z(self) -> float:
        return NormalDist().inv_cdf(0.5 + self.interval_width / 2)


def _scaled_time() -> Column:
    return F.try_divide(F.datediff("ds", "start").cast("double"), F.col("span"))


def sparse_minimum(a: np.ndarray, b: np.ndarray, weight: float, start: np.ndarray, sweeps: int = 20) -> np.ndarray:
    """The x that minimises ``x'ax / 2 - b'x + weight * sum |x|``.

    Coordinate descent from ``start`` finds most signs; then exact steps: solve for the
    coefficients in use with their signs held, walk there up to the best change of a
    sign, and take in the coefficient that most wants to leave zero, until none does.
    """
    x, diagonal = start.copy(), np.diag(a)
    free = np.flatnonzero(diagonal > 0)
    x[diagonal <= 0] = 0.0
    for _ in range(sweeps):
        for j in free:
            rest = b[j] - a[j] @ x + diagonal[j] * x[j]
            x[j] = math.copysign(max(abs(rest) - weight, 0.0), rest) / diagonal[j]
    sign = np.sign(x)
    loss = lambda v: v @ a @ v / 2 - b @ v + weight * np.abs(v).sum()
    for _ in range(20 * len(x) + 20):
        on = np.flatnonzero(sign)
        if len(on):
            goal = np.zeros_like(x)
            goal[on] = np.linalg.lstsq(a[np.ix_(on, on)], b[on] - weight * sign[on], rcond=None)[0]
            crossing = on[(x[on] != 0) & (np.sign(goal[on]) != sign[on])]
            stops = [goal]
            for j in crossing:
                stop = x + (goal - x) * (x[j] / (x[j] - goal[j]))
                stop[j] = 0.0
                stops.append(stop)
            best = min(stops, key=loss)
            settled = best is goal and not len(crossing)
            if loss(best) > loss(x) - 1e-15 * abs(loss(x)) and not settled:
                settled = True
            else:
                x = best
            sign = np.sign(x)
            if not settled:
                continue
        slope = a @ x - b
        pull = np.where((x == 0) & (diagonal > 0), np.abs(slope), 0.0)
        j = int(pull.argmax())
        if pull[j] <= weight * (1 + 1e-9) + 1e-300:
            break
        sign[j] = -np.sign(slope[j])
    return x


@dataclass
class Products:
    """Sums over rows: design with itself and with y, y with itself, rows, y."""

    gram: np.ndarray
    xy: np.ndarray
    yy: float
    n: int

    def plus(self, other: "Products") -> "Products":
        return Products(self.gram + other.gram, self.xy + other.xy, self.yy + other.yy, self.n + other.n)


def solve_additive(m: Products, penalty: np.ndarray, sparse: slice, scale: float, start: np.ndarray | None = None, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Coefficients (constant first) and noise deviation.

    For a given noise, the Gaussian coefficients are eliminated and the changepoint
    rates solved with a Laplace prior of ``scale``.  The noise is estimated over the
    rows that the coefficients leave free, so a history shorter than the design is
    explained by noise, not fitted exactly.
    """
    p = len(penalty)
    s = np.arange(p)[sparse]
    r = np.setdiff1d(np.arange(p), s)
    # Noise below a ten-thousandth of the level is rounding; less would leave the sums without a digit.
    floor = max(1e-8 * m.yy / m.n, 1e-300)
    var = max((m.yy - m.xy[0] ** 2 / m.n) / m.n, floor)
    beta, rates = np.zeros(p), np.zeros(len(s)) if start is None else start
    for _ in range(rounds):
        ridge = m.gram[np.ix_(r, r)] + var * np.diag(penalty[r])
        solved = np.linalg.solve(ridge, np.column_stack([m.xy[r], m.gram[np.ix_(r, s)], m.gram[np.ix_(r, r)]]))
        alone, cross, hat = solved[:, 0], solved[:, 1 : 1 + len(s)], solved[:, 1 + len(s) :]
        if len(s):
            a = m.gram[np.ix_(s, s)] - m.gram[np.ix_(s, r)] @ cross
            # What the other columns explain but for rounding must not look like freedom.
            a = (a + a.T) / 2 + 1e-9 * np.diag(np.diag(m.gram)[s])
            rates = sparse_minimum(a, m.xy[s] - m.gram[np.ix_(s, r)] @ alone, var / scale, rates)
        beta[s], beta[r] = rates, alone - cross @ rates
        sse = max(m.yy - 2 * beta @ m.xy + beta @ m.gram @ beta, 0.0)
        used = np.trace(hat) + np.count_nonzero(rates)
        before, var = var, max(sse / max(m.n - used, 1e-6 * m.n), floor)
        if abs(var - before) <= 1e-6 * before:
            break
    return beta, math.sqrt(var)


FIT_SCHEMA = "start date, last date, span double, y_scale double, beta array<double>, sigma double, rate double, delta_scale double"


def _facts(train: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        train.groupBy(*keys)
        .agg(
            F.min("ds").alias("start"),
            F.max("ds").alias("last"),
            F.max(F.abs("y")).alias("y_scale"),
        )
        .withColumns(
            {
                "lo": F.col("start"),
                "hi": F.col("last"),
                "span": F.greatest(F.datediff("last", "start"), F.lit(1)).cast("double"),
                "y_scale": F.when(F.col("y_scale") > 0, F.col("y_scale")).otherwise(F.lit(1.0)),
            }
        )
    )


def _products(rows: DataFrame, by: Sequence[str], design: Sequence[Column]) -> DataFrame:
    """``n, yy, xy, days`` per group, from built-in aggregates with map-side combine."""
    y = F.col("y") / F.col("y_scale")
    return rows.where("y is not null").groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(y * y).alias("yy"),
        F.array(F.sum(y), *[F.sum(x * y) for x in design]).alias("xy"), F.collect_list(F.unix_date("ds")).alias("days"),
    )


def _fit(
    rows: DataFrame,
    keys: Sequence[str],
    cfg: AdditiveConfig,
    segment: str | None,
    per: Sequence[str],
) -> DataFrame:
    groups = cfg.columns(F.col("ds"), _scaled_time())
    penalty = cfg.penalties(groups)
    sparse = slice(2, 2 + cfg.changepoints)
    facts = [*per, "start", "last", "span", "y_scale"]
    order = [segment] if segment else []
    sums = _products(rows, [*keys, *facts, *order], reduce(list.__add__, groups.values()))
    columns = [*keys, *facts, "beta", "sigma", "rate", "delta_scale", *order]

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out, total, rates = [], None, None
        # Training sets grow from segment to segment; the last segment holds rows after every cutoff.
        for at in pdf.sort_values(order).to_dict("records") if order else pdf.to_dict("records"):
            day = np.sort(np.asarray(at["days"], float))
            x = cfg.design(day, (day - (at["start"] - EPOCH).days) / at["span"])
            part = Products(x.T @ x, np.asarray(at["xy"], float), float(at["yy"]), int(at["n"]))
            total = part if total is None else total.plus(part)
            beta, sigma = solve_additive(total, penalty, sparse, cfg.changepoint_prior_scale, rates)
            rates = beta[sparse]
            size = float(np.abs(rates).mean()) if len(rates) else 0.0
            out.append([*[at[c] for c in (*keys, *facts)], beta, sigma, float(len(rates)), size, *[at[c] for c in order]])
        return pd.DataFrame(out, columns=columns)

    types = dict(rows.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in (*keys, *per)] + [FIT_SCHEMA] + [f"`{c}` int" for c in order])
    grouped = sums.groupBy(*keys) if keys else sums.groupBy(F.lit(0))
    return grouped.applyInPandas(solve, schema)


def additive_fit(
    train: DataFrame,
    keys: Sequence[str],
    cfg: AdditiveConfig = AdditiveConfig(),
    size: int = BLOCK_DAYS,
) -> DataFrame:
    """One row of coefficients per series."""
    rows = attach(train.select(*keys, "ds", "y"), _facts(train, keys), keys, size)
    return _fit(rows, keys, cfg, None, ())


def _components(cfg: AdditiveConfig) -> dict[str, Column]:
    """Contributions of a fit at ``ds``, in units of y."""
    groups = cfg.columns(F.col("ds"), _scaled_time())
    beta, scale = F.col("beta"), F.col("y_scale")
    out, place = {}, 1
    for name, columns in groups.items():
        total = beta[0] if name == "trend" else F.lit(0.0)
        for x in columns:
            total = total + beta[place] * x
            place += 1
        out[name] = total * scale
    return out


def simulate(seed: int, days: int, span: float, rate: float, size: float, sigma: float, samples: int) -> np.ndarray:
    """(samples, days): deviation from the forecast on each day after the end of training.

    Slope changes come at ``rate`` per training span, their sizes are Laplace with
    mean ``size``; draw i of a series is the same in any task.
    """
    draws = (np.arange(samples, dtype=np.uint64) + np.uint64(1)) ^ np.uint64(seed & 0xFFFFFFFFFFFFFFFF)
    t = np.arange(1, days + 1) / span
    expected = rate * days / span
    number = np.searchsorted(poisson_table(expected), uniform(draws, np.zeros(1)))
    out = np.zeros((samples, days))
    for c in range(int(number.max(initial=0)) if size > 0 else 0):
        when = uniform(draws, np.array([2 * c + 1])) * days / span
        u = uniform(draws, np.array([2 * c + 2])) - 0.5
        change = np.where(c < number, -size * np.sign(u) * np.log1p(-2 * np.abs(u)), 0.0)
        out += change[:, None] * np.maximum(t - when[:, None], 0.0)
    # Noise in equal steps of probability, dealt to the draws by hash: the same on all days of a draw.
    steps = np.array([NormalDist().inv_cdf((i + 0.5) / samples) for i in range(samples)])
    place = np.argsort(np.argsort(uniform(draws, np.array([1 << 32])), kind="stable"), kind="stable")
    return out + sigma * steps[place][:, None]


def with_simulations(fits: DataFrame, seed: Sequence[str | Column], days: int, cfg: AdditiveConfig) -> DataFrame:
    """Add ``low, high``: interval bounds around the forecast for each of the ``days`` after training, in units of y."""
    shares = [0.5 - cfg.interval_width / 2, 0.5 + cfg.interval_width / 2]
    samples = cfg.uncertainty_samples

    @F.pandas_udf("struct<low: array<double>, high: array<double>>")
    def bounds(seed: pd.Series, span: pd.Series, rate: pd.Series, size: pd.Series, sigma: pd.Series, scale: pd.Series) -> pd.DataFrame:
        found = []
        for s, p, r, z, n, y in zip(seed, span, rate, size, sigma, scale):
            low, high = np.quantile(simulate(int(s), days, p, r, z, n, samples), shares, axis=0) * y
            found.append((low, high))
        return pd.DataFrame(found, columns=["low", "high"])

    if days < 1:
        return fits.withColumns({c: F.array().cast("array<double>") for c in ("low", "high")})
    columns = [F.col(c) for c in ("span", "rate", "delta_scale", "sigma", "y_scale")]
    return fits.withColumn("_b", bounds(F.xxhash64(*seed), *columns)).withColumns({c: F.col(f"_b.{c}") for c in ("low", "high")}).drop("_b")


def _bounds(cfg: AdditiveConfig, after: Column) -> dict[str, Column]:
    """Interval: noise alone up to the end of training, simulated slope changes and noise after it."""
    ahead = F.datediff("ds", after)
    noise = cfg.z * F.col("sigma") * F.col("y_scale")

    def off(name: str, sign: int) -> Column:
        return F.when(ahead > 0, F.get(name, ahead - 1)).otherwise(sign * noise)

    return {"yhat_lower": F.col("yhat") + off("low", -1), "yhat_upper": F.col("yhat") + off("high", 1)}


FIT_COLUMNS = ["start", "last", "span", "y_scale", "beta", "sigma", "rate", "delta_scale", "low", "high"]


def _score(rows: DataFrame, cfg: AdditiveConfig, after: Column) -> DataFrame:
    parts = _components(cfg)
    scored = rows.withColumns(parts)
    yhat = reduce(Column.__add__, [F.col(c) for c in parts])
    return scored.withColumn("yhat", yhat).withColumns(_bounds(cfg, after)).drop(*FIT_COLUMNS)


def additive_predict(
    fits: DataFrame,
    keys: Sequence[str],
    cfg: AdditiveConfig = AdditiveConfig(),
    periods: int = 0,
    history: bool = True,
    freq: str = "D",
) -> DataFrame:
    """``ds, yhat, yhat_lower, yhat_upper`` and components on the training grid and beyond.

    The dates are generated from the fits themselves, so scoring needs no join
    and no shuffle of rows.
    """
    ax = AXES[freq]
    end = ax.down("last")
    first = ax.up("start") if history else end + 1
    longest = {"D": 1, "W": 7, "M": 31}[freq]
    dates = (
        with_simulations(fits, keys or [F.lit(0)], (periods + 1) * longest if freq != "D" else periods, cfg)
        .withColumns({"_a": first, "_b": end + periods})
        .where("_a <= _b")
        .withColumn("_p", F.explode(F.sequence("_a", "_b")))
        .withColumn("ds", ax.at("_p"))
        .drop("_a", "_b", "_p")
    )
    return _score(dates, cfg, F.col("last"))


def rolling_origin_cv(
    grid: DataFrame,
    keys: Sequence[str],
    initial: int,
    period: int,
    horizon: int,
    cfg: AdditiveConfig = AdditiveConfig(),
    size: int = BLOCK_DAYS,
) -> DataFrame:
    """Forecasts from every cutoff: ``(keys, cutoff, ds, y, yhat, yhat_lower, yhat_upper)``.

    All cutoffs share one basis (time scale and changepoints of the whole
    series), so the products of the stretches between cutoffs are accumulated
    and every training set is solved from a single pass.  What a stretch ships
    is one number per design column and its days.
    """
    rows = grid.select(*keys, "ds", "y")
    bounds = _facts(rows, keys)
    plan = (
        cutoffs(rows, keys, initial, period, horizon)
        .groupBy(*keys)
        .agg(F.min("cutoff").alias("_first"), F.max("cutoff").alias("_final"))
    )
    facts = bounds.join(plan, list(keys))
    # Segment j holds the rows after cutoff j - 1 up to cutoff j.
    segment = F.greatest(F.ceil(F.datediff("ds", "_first") / F.lit(period)), F.lit(0)).cast("int")
    training = (
        attach(rows, facts, keys, size)
        .where("ds <= _final")
        .withColumn("segment", segment)
        .drop("_final")
    )
    fits = _fit(training, keys, cfg, "segment", ("_first",)).withColumn(
        "cutoff", F.date_add("_first", F.col("segment") * period)
    )
    tests = rolling_origin_membership(rows, keys, initial, period, horizon, size)
    fits = with_simulations(fits.drop("segment", "_first"), [*keys, "cutoff"], horizon, cfg)
    scored = _score(tests.join(fits, [*keys, "cutoff"]), cfg, F.col("cutoff"))
    return scored.select(*keys, "cutoff", "ds", "y", "yhat", "yhat_lower", "yhat_upper")
