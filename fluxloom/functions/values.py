"""Unit conversion, thresholds and small numeric expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Factor and offset per (from, to) unit pair; value * factor + offset.
UNIT_RULES = [
    ("degC", "K", 1.0, 273.15),
    ("K", "degC", 1.0, -273.15),
    ("kPa", "Pa", 1000.0, 0.0),
    ("mm/30min", "mm/s", 1.0 / 1800.0, 0.0),
    ("umol/m2/s", "gC/m2/s", 1e-6 * 12.01, 0.0),
    ("m", "cm", 100.0, 0.0),
    ("ratio", "%", 100.0, 0.0),
    ("1/s", "1/hour", 3600.0, 0.0),
    ("1/s", "1/day", 86400.0, 0.0),
    ("1/s", "1/year", 86400.0 * 365.0, 0.0),
    ("mm/y", "cm/y", 0.1, 0.0),
]

# Unit tokens with their accepted spelling.
UNIT_TOKENS = {
    "kgC": "kg",
    "gC": "g",
    "gC13": "g",
    "gC14": "g",
    "gN": "g",
    "unitless": "1",
    "years": "common_years",
    "yr": "common_year",
    "meq": "mmol",
    "neq": "nmol",
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def known(x) -> Column:
    """True where a double is neither NULL nor NaN."""
    c = _c(x)
    return c.isNotNull() & ~F.isnan(c)


def convert(x, source: str, target: str, rules=UNIT_RULES) -> Column:
    """Value in the target unit."""
    for a, b, factor, offset in rules:
        if (a, b) == (source, target):
            return _c(x) * F.lit(factor) + F.lit(offset)
    raise KeyError(f"no rule from {source} to {target}")


def carbon_grams(x, molar_mass: float = 12.01) -> Column:
    """µmol to gram of carbon; both 12.01 and 12 are in use."""
    return _c(x) * F.lit(1e-6 * molar_mass)


def vpd_hpa(rh, tair_c) -> Column:
    """Vapour pressure deficit in hPa from relative humidity (%) and °C."""
    t = _c(tair_c)
    saturation = F.lit(6.1078) * F.exp(F.lit(17.08085) * t / (F.lit(234.175) + t))
    return saturation * (1 - _c(rh) / 100.0)


def clean_units(text) -> Column:
    """Replace unit tokens by accepted spellings.

    Tokens end at spaces, brackets, ``^ * /``, digits and minus signs in front
    of digits, so ``gC13`` is seen as ``gC`` followed by ``13``.
    """
    boundary = r"[ ()^*/0-9]"
    out = _c(text)
    for token, spelling in UNIT_TOKENS.items():
        pattern = rf"(?<=^|{boundary}){token}(?=$|{boundary}|-[0-9])"
        out = F.regexp_replace(out, pattern, spelling)
    return out


def clamp(x, lo=None, hi=None) -> Column:
    """Pull values to the nearer bound; NULL stays NULL."""
    c = _c(x)
    out = c
    if hi is not None:
        out = F.when(c > hi, F.lit(float(hi))).otherwise(out)
    if lo is not None:
        out = F.when(c < lo, F.lit(float(lo))).otherwise(out)
    return out


def null_outside(x, lo=None, hi=None) -> Column:
    c = _c(x)
    tests = ([c >= lo] if lo is not None else []) + ([c <= hi] if hi is not None else [])
    return F.when(reduce(lambda a, b: a & b, tests), c)


def zero_below(x, threshold: float = 0.0) -> Column:
    """Keep values above the threshold, everything else (also NULL) becomes 0."""
    c = _c(x)
    return F.when(c > threshold, c).otherwise(F.lit(0.0))


def mask_below(x, other, threshold: float) -> Column:
    return F.when(_c(other) > threshold, _c(x))


def row_mean(*cols) -> Column:
    """Mean over the known values of one row; NULL when there is none."""
    present = F.filter(F.array(*[_c(c) for c in cols]), lambda v: v.isNotNull())
    total = F.aggregate(present, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(F.size(present) > 0, total / F.size(present))


def even_share(total, n) -> Column:
    return F.try_divide(_c(total), _c(n))


def paste(*parts) -> Column:
    """Text concatenation in which a missing part prints as ``NA``."""
    return F.concat(*[F.coalesce(_c(p).cast("string"), F.lit("NA")) for p in parts])
