"""Black-Scholes prices, Greeks and implied volatility as column expressions, without Python in the tasks."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numerical guards of the price model, and the coefficients of the normal distribution's approximation.
EPS, SIGMA_LOW, SIGMA_HIGH, RATIO_CAP = 1e-10, 1e-4, 5.0, 1000.0
CDF = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
CDF_SCALE = 0.2316419


def norm_pdf(x: Column) -> Column:
    return F.exp(-x * x / 2) / math.sqrt(2 * math.pi)


def norm_cdf(x: Column) -> Column:
    """Within 7.5e-8 of the normal distribution function."""
    t = 1 / (1 + CDF_SCALE * F.abs(x))
    poly = t * (CDF[0] + t * (CDF[1] + t * (CDF[2] + t * (CDF[3] + t * CDF[4]))))
    upper = norm_pdf(x) * poly
    return F.when(x >= 0, 1 - upper).otherwise(upper)


def is_valid(s: Column, k: Column, t: Column, sigma: Column) -> Column:
    return (s > 0) & (k > 0) & (t >= 0) & (sigma >= 0) & (s / k <= RATIO_CAP) & (k / s <= RATIO_CAP)


def d1(s: Column, k: Column, t: Column, r: Column, sigma: Column) -> Column:
    """Clipped to [-10, 10]; without time or volatility it is +1000 or -1000 by the side of the strike."""
    raw = (F.log(s / k) + (r + sigma * sigma / 2) * t) / (sigma * F.sqrt(t))
    return F.when((t <= EPS) | (sigma <= EPS), F.when(s > k, 1000.0).otherwise(-1000.0)).otherwise(F.least(F.greatest(raw, F.lit(-10.0)), F.lit(10.0)))


def d2(s: Column, k: Column, t: Column, r: Column, sigma: Column, ready: Column | None = None) -> Column:
    return _d1(ready, s, k, t, r, sigma) - sigma * F.sqrt(t)


def _d1(ready: Column | None, *args: Column) -> Column:
    """The formulas below take a ready d1, so that a plan can hold it in one column."""
    return d1(*args) if ready is None else ready


def price(kind: Column, s: Column, k: Column, t: Column, r: Column, sigma: Column, ready: Column | None = None) -> Column:
    """Price of a call or put, never under its intrinsic value. Far from the strike (ten times) only parity counts."""
    a, b, disc = _d1(ready, s, k, t, r, sigma), d2(s, k, t, r, sigma, ready), F.exp(-r * t)
    call_in, put_in = F.greatest(s - k, F.lit(0.0)), F.greatest(k - s, F.lit(0.0))
    call = F.when(s / k > 10, s - k * disc).when(k / s > 10, F.lit(0.0)).otherwise(s * norm_cdf(a) - k * disc * norm_cdf(b))
    put = F.when(k / s > 10, k * disc - s).when(s / k > 10, F.lit(0.0)).otherwise(k * disc * norm_cdf(-b) - s * norm_cdf(-a))
    dead = ~is_valid(s, k, t, sigma) | (t <= EPS)
    return F.when(kind == "Call", F.when(dead, call_in).otherwise(F.greatest(call, call_in))).when(kind == "Put", F.when(dead, put_in).otherwise(F.greatest(put, put_in)))


def delta(kind: Column, s: Column, k: Column, t: Column, r: Column, sigma: Column, ready: Column | None = None) -> Column:
    n = norm_cdf(_d1(ready, s, k, t, r, sigma))
    step = F.when(s > k, 1.0).when(s < k, 0.0).otherwise(0.5)
    call = F.when(t <= EPS, step).otherwise(n)
    return F.when(kind == "Call", call).when(kind == "Put", call - 1)


def gamma(s: Column, k: Column, t: Column, r: Column, sigma: Column, ready: Column | None = None) -> Column:
    g = norm_pdf(_d1(ready, s, k, t, r, sigma)) / (s * sigma * F.sqrt(t))
    off = (t <= EPS) | (sigma <= EPS) | (s / k > 5) | (k / s > 5)
    return F.when(off, 0.0).otherwise(F.when(g > 1, 0.0).otherwise(g))


def vega(s: Column, k: Column, t: Column, r: Column, sigma: Column, ready: Column | None = None) -> Column:
    """For a change of one volatility point."""
    v = s * norm_pdf(_d1(ready, s, k, t, r, sigma)) * F.sqrt(t) / 100
    return F.when((t <= EPS) | (s / k > 5) | (k / s > 5) | (v > s), 0.0).otherwise(v)


def theta(kind: Column, s: Column, k: Column, t: Column, r: Column, sigma: Column, ready: Column | None = None) -> Column:
    """For one calendar day."""
    b, disc = d2(s, k, t, r, sigma, ready), F.exp(-r * t)
    decay = -s * norm_pdf(_d1(ready, s, k, t, r, sigma)) * sigma / (2 * F.sqrt(t))
    th = F.when(kind == "Call", decay - r * k * disc * norm_cdf(b)).otherwise(decay + r * k * disc * norm_cdf(-b)) / 365
    return F.when((t <= EPS) | (sigma <= EPS), 0.0).otherwise(F.when(F.abs(th) > price(kind, s, k, t, r, sigma, ready), 0.0).otherwise(th))


def rho(kind: Column, s: Column, k: Column, t: Column, r: Column, sigma: Column, ready: Column | None = None) -> Column:
    """For a change of one percentage point of the rate."""
    b, x = d2(s, k, t, r, sigma, ready), k * t * F.exp(-r * t) / 100
    return F.when(t <= EPS, 0.0).when(kind == "Call", x * norm_cdf(b)).otherwise(-x * norm_cdf(-b))


def vanna(s: Column, k: Column, t: Column, r: Column, sigma: Column, ready: Column | None = None) -> Column:
    return F.when((t <= EPS) | (sigma <= EPS), 0.0).otherwise(-norm_pdf(_d1(ready, s, k, t, r, sigma)) * d2(s, k, t, r, sigma, ready) / sigma / 100)


def charm(s: Column, k: Column, t: Column, r: Column, sigma: Column, ready: Column | None = None) -> Column:
    """Per day, the same for calls and puts."""
    a, b = _d1(ready, s, k, t, r, sigma), d2(s, k, t, r, sigma, ready)
    root = sigma * F.sqrt(t)
    return F.when((t <= EPS) | (sigma <= EPS), 0.0).otherwise(-norm_pdf(a) * (2 * r * t - b * root) / (2 * t * root) / 365)


def greeks(kind: Column, s: Column, k: Column, t: Column, r: Column, sigma: Column, ready: Column | None = None) -> Column:
    return F.struct(
        delta(kind, s, k, t, r, sigma, ready).alias("delta"), gamma(s, k, t, r, sigma, ready).alias("gamma"), theta(kind, s, k, t, r, sigma, ready).alias("theta"), vega(s, k, t, r, sigma, ready).alias("vega"),
        rho(kind, s, k, t, r, sigma, ready).alias("rho"), vanna(s, k, t, r, sigma, ready).alias("vanna"), charm(s, k, t, r, sigma, ready).alias("charm"),
    )


BRENT_STEPS, BRENT_TOLERANCE, MACHINE_EPS = 60, 1e-12, 2.220446049250313e-16
_FIELDS = ("a", "b", "c", "fa", "fb", "fc", "d", "e", "x", "y")
LOW, HIGH, GOING, DONE, NONE = range(5)  # stages of the search: price at the lower end, at the upper one, steps, found, nothing to find


def implied_vol(kind: Column, paid: Column, s: Column, k: Column, t: Column, r: Column) -> Column:
    """Volatility in [1e-4, 5] at which the model gives the price; null where none does, or where the price is no more than that of
    the smallest one, which tells nothing of the volatility.

    Bracketed steps (inverse quadratic or linear interpolation, else halving) as a machine that one fold runs: settle the bracket,
    choose a step, move, and work the price out in four parts. Each phase reads the state's fields alone, so no formula is written
    out more than once, and no row leaves the JVM."""
    paid, s, k, t, r = (x.cast("double") for x in (paid, s, k, t, r))
    usable = (t > EPS) & (paid > 0) & (s > 0) & (k > 0)
    start = F.struct(*[F.lit({"a": SIGMA_LOW, "b": SIGMA_LOW, "c": SIGMA_HIGH, "d": SIGMA_HIGH - SIGMA_LOW, "e": SIGMA_HIGH - SIGMA_LOW}.get(n, 0.0)).alias(n) for n in _FIELDS], F.when(usable, LOW).otherwise(NONE).alias("stage"), F.lit(3).alias("phase"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(8 * (BRENT_STEPS + 2))), start, lambda x, _: _brent(x, kind, paid, s, k, t, r), lambda x: F.when(x["stage"].isin(GOING, DONE), x["b"]))
    return end


def _brent(z: Column, kind: Column, paid: Column, s: Column, k: Column, t: Column, r: Column) -> Column:
    """The next state. b is the best point, [b, c] holds the root, a was b before; d is this step, e the one before; x and y are
    parts of the price at b."""
    a, b, c, fa, fb, fc, d, e, x, y = (z[n] for n in _FIELDS)
    stage, phase, root = z["stage"], z["phase"], F.sqrt(t)

    def state(**new) -> Column:
        value = lambda n: new[n] if n in new else z[n]
        typed = lambda v, kind: (v if isinstance(v, Column) else F.lit(v)).cast(kind)
        return F.struct(*[typed(value(n), "double").alias(n) for n in _FIELDS], *[typed(value(n), "int").alias(n) for n in ("stage", "phase")])

    # 0: where b and c lie on one side, c becomes a; the better of b and c becomes b
    same = F.signum(fb) == F.signum(fc)
    c0, fc0 = F.when(same, a).otherwise(c), F.when(same, fa).otherwise(fc)
    swap = F.abs(fc0) < F.abs(fb)
    settle = state(
        a=F.when(swap, b).otherwise(a), b=F.when(swap, c0).otherwise(b), c=F.when(swap, b).otherwise(c0), fa=F.when(swap, fb).otherwise(fa), fb=F.when(swap, fc0).otherwise(fb), fc=F.when(swap, fb).otherwise(fc0),
        d=F.when(same, b - a).otherwise(d), e=F.when(same, b - a).otherwise(e), phase=1,
    )
    # 1: the step: p / q by interpolation where it stays well within the bracket and shrinks, else half the bracket
    tol, half = 2 * MACHINE_EPS * F.abs(b) + BRENT_TOLERANCE / 2, (c - b) / 2
    u, v, w = fb / fa, fa / fc, fb / fc
    p = F.when(a == c, 2 * half * u).otherwise(u * (2 * half * v * (v - w) - (b - a) * (w - 1)))
    q = F.when(a == c, 1 - u).otherwise((v - 1) * (w - 1) * (u - 1))
    step = -p / F.nullif(q, F.lit(0.0))
    inside = (F.abs(e) >= tol) & (F.abs(fa) > F.abs(fb)) & (F.signum(step) == F.signum(half)) & (F.abs(step) < 1.5 * F.abs(half)) & (F.abs(step) < F.abs(e) / 2)
    taken = F.coalesce(inside, F.lit(False))
    choose = state(e=F.when(taken, d).otherwise(half), d=F.when(taken, step).otherwise(half), stage=F.when((F.abs(half) <= tol) | (fb == 0), DONE).otherwise(stage), phase=2)
    # 2: b moves by the step, but by the tolerance at least
    move = state(a=b, fa=fb, b=b + F.when(F.abs(d) > tol, d).otherwise(F.signum(half) * tol), phase=3)
    # 3 to 6: d1, its distribution, that of d2, the price less the one paid
    disc = F.exp(-r * t)
    call = F.when(s / k > 10, s - k * disc).when(k / s > 10, F.lit(0.0)).otherwise(s * x - k * disc * y)
    put = F.when(k / s > 10, k * disc - s).when(s / k > 10, F.lit(0.0)).otherwise(k * disc * (1 - y) - s * (1 - x))
    off = F.when(kind == "Call", F.greatest(call, s - k, F.lit(0.0))).otherwise(F.greatest(put, k - s, F.lit(0.0))) - paid
    parts = [state(y=d1(s, k, t, r, b), phase=4), state(x=norm_cdf(y), phase=5), state(y=norm_cdf(y - b * root), phase=6), state(fb=off, phase=7)]
    # 7: at the ends of the range, on to the other end or to the first step
    ends = state(
        a=F.lit(SIGMA_LOW), fa=F.when(stage == LOW, fb).otherwise(fa), b=F.lit(SIGMA_HIGH), c=F.lit(SIGMA_HIGH), fc=fb,
        stage=F.when(stage == LOW, F.when(fb < 0, HIGH).otherwise(NONE)).otherwise(F.when(fb >= 0, GOING).otherwise(NONE)), phase=F.when(stage == LOW, 3).otherwise(0),
    )
    out = F.when((stage == DONE) | (stage == NONE), z)
    for n, part in enumerate([settle, choose, move, *parts]):
        out = out.when(phase == n, part)
    return out.when(stage < GOING, ends).otherwise(state(phase=0))


def price_with_yield(kind: Column, s: Column, k: Column, t: Column, r: Column, sigma: Column, q: Column) -> Column:
    """With a continuous dividend yield q."""
    root = sigma * F.sqrt(t)
    a = (F.log(s / k) + (r - q + sigma * sigma / 2) * t) / root
    fs, fk = s * F.exp(-q * t), k * F.exp(-r * t)
    live = F.when(kind == "Call", fs * norm_cdf(a) - fk * norm_cdf(a - root)).otherwise(fk * norm_cdf(root - a) - fs * norm_cdf(-a))
    return F.when((t <= 0) | (sigma <= 0), F.when(kind == "Call", F.greatest(s - k, F.lit(0.0))).otherwise(F.greatest(k - s, F.lit(0.0)))).otherwise(live)


def greeks_with_yield(kind: Column, s: Column, k: Column, t: Column, r: Column, sigma: Column, q: Column) -> Column:
    """delta, gamma, vega (a volatility point) and theta (a calendar day) with a continuous dividend yield q. Without time or
    volatility only a call over its strike has a delta."""
    root = sigma * F.sqrt(t)
    a = (F.log(s / k) + (r - q + sigma * sigma / 2) * t) / root
    carry, fs, fk = F.exp(-q * t), s * F.exp(-q * t), k * F.exp(-r * t)
    n1, n2, density = norm_cdf(a), norm_cdf(a - root), norm_pdf(a)
    call, dead = kind == "Call", (t <= 0) | (sigma <= 0)
    decay = -(fs * density * sigma) / (2 * F.sqrt(t))
    drift = F.when(call, q * fs * n1 - r * fk * n2).otherwise(q * fs * (1 - n1) + r * fk * (1 - n2))
    return F.struct(
        F.when(dead, F.when(call & (s > k), 1.0).otherwise(0.0)).otherwise(carry * F.when(call, n1).otherwise(n1 - 1)).alias("delta"), F.when(dead, 0.0).otherwise(carry * density / (s * root)).alias("gamma"),
        F.when(dead, 0.0).otherwise(fs * density * F.sqrt(t) / 100).alias("vega"), F.when(dead, 0.0).otherwise((decay - drift) / 365).alias("theta"),
    )


def pnl_parts(entry: Column, exit_: Column, vega_: Column, gamma_: Column, theta_: Column, d_iv_points: Column, d_spot: Column, days: Column) -> Column:
    """Profit split into volatility, curvature and time; the rest is what they do not explain."""
    v, g, th = vega_ * d_iv_points, 0.5 * gamma_ * d_spot * d_spot, theta_ * days
    return F.struct((exit_ - entry).alias("total"), v.alias("vega"), g.alias("gamma"), th.alias("theta"), (exit_ - entry - v - g - th).alias("rest"))


# The same distribution function as SQL text, for views that two engines share.
def cdf_sql(x: str) -> str:
    t = f"(1.0 / (1.0 + {CDF_SCALE} * abs({x})))"
    poly = f"({t} * ({CDF[0]} + {t} * ({CDF[1]} + {t} * ({CDF[2]} + {t} * ({CDF[3]} + {t} * {CDF[4]})))))"
    upper = f"(exp(-({x}) * ({x}) / 2.0) / sqrt(2.0 * pi()) * {poly})"
    return f"(CASE WHEN ({x}) >= 0 THEN 1.0 - {upper} ELSE {upper} END)"
