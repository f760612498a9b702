"""Distribution functions needed by the drift tests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TAIL_TERMS = 100


def kolmogorov_tail(statistic: Column, n: Column, m: Column | None = None) -> Column:
    """Asymptotic p-value of a KS statistic: 2 * sum((-1)^(k-1) exp(-2 k^2 lambda^2)).

    ``lambda = D * sqrt(n m / (n + m))`` for two samples, ``D * sqrt(n)`` for one.
    For lambda near zero the series does not settle; its limit there is 1.
    """
    n = n.cast("double")
    size = n if m is None else F.try_divide(n * m.cast("double"), n + m.cast("double"))
    lam = statistic * F.sqrt(size)
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(TAIL_TERMS)),
        lambda k: F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * k.cast("double") * k.cast("double") * lam * lam),
    )
    tail = F.lit(2.0) * F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail))
    return F.when(lam < 0.04, F.lit(1.0)).otherwise(clamped)


def exact_two_sample(statistic: Column, n: Column, m: Column) -> Column:
    """Exact p-value of a two-sided two-sample KS statistic without ties: the share of orders of both samples that reach it.

    An order of ``n`` and ``m`` values is a walk from (0, 0) to (n, m). The chance that a random walk stays where the two
    distribution functions differ by less is carried from diagonal to diagonal, one number per place: (n + m) steps times the smaller sample.
    """
    n, m = F.least(n, m).cast("long"), F.greatest(n, m).cast("long")
    reach = F.round(statistic * n.cast("double") * m.cast("double")).cast("long")
    places = F.sequence(F.lit(0).cast("long"), n)

    def diagonal(before: Column, t: Column) -> Column:
        left = (n + m - t + 1).cast("double")

        def place(x: Column) -> Column:
            y = t - x
            inside = (y >= 0) & (y <= m) & (F.abs(x * m - y * n) < reach)
            came = F.coalesce(F.get(before, (x - 1).cast("int")), F.lit(0.0)) * (n - x + 1).cast("double") + F.get(before, x.cast("int")) * (m - y + 1).cast("double")
            return F.when(inside, came / left).otherwise(F.lit(0.0))

        return F.transform(places, place)

    start = F.transform(places, lambda x: F.when(x == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    stays = F.aggregate(F.sequence(F.lit(1).cast("long"), n + m), start, diagonal)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - F.element_at(stays, -1)))


def normal_pdf(x: Column, mean: Column, std: Column) -> Column:
    z = F.try_divide(x - mean, std)
    return F.try_divide(F.exp(F.lit(-0.5) * z * z), std * F.lit(2.5066282746310002))


# Coefficients of Hart's rational approximation of the normal distribution,
# highest power first (G. West, "Better approximations to cumulative normal functions", 2005).
HART_TOP = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871,
            221.213596169931, 220.206867912376]
HART_BOTTOM = [8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674,
               637.333633378831, 793.826512519948, 440.413735824752]


def _polynomial(x: Column, coefficients: list[float]) -> Column:
    value = F.lit(coefficients[0])
    for c in coefficients[1:]:
        value = value * x + F.lit(c)
    return value


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, to about 1e-15 for abs(z) <= 7 and 0 or 1 beyond."""
    x = F.abs(z)
    tail = F.exp(F.lit(-0.5) * x * x) * _polynomial(x, HART_TOP) / _polynomial(x, HART_BOTTOM)
    tail = F.when(x > 7.0, F.lit(0.0)).otherwise(tail)
    return F.when(z > 0, F.lit(1.0) - tail).otherwise(tail)
