"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The six age bands of the message report, as (upper bound, label).
AGE_BANDS = ((18, "до 18"), (25, "18–24"), (35, "25–34"), (45, "35–44"), (55, "45–54"))
OLDEST_BAND = "55+"

def poisson_one_cdf(terms: int = 13) -> list[float]:
    """P(X <= k) of a Poisson variable with mean 1, for k = 0..terms-1."""
    total, out = 0.0, []
    for k in range(terms):
        total += math.exp(-1.0) / math.factorial(k)
        out.append(total)
    return out


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def flag_sum(condition: Column) -> Column:
    """Number of rows where a possibly null condition holds."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def unix_day(seconds: Column) -> Column:
    """UTC calendar day of Unix seconds, whatever the session time zone is.

    Values that are not numbers become null; see ``retention`` for how they are rejected.
    """
    days = F.floor(seconds.try_cast("double") / F.lit(86400.0)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def in_days(day: Column, start=None, end=None) -> Column:
    """Inclusive day range; an absent bound is open."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (day >= F.lit(str(start)).cast("date"))
    if end is not None:
        condition = condition & (day <= F.lit(str(end)).cast("date"))
    return condition


def in_period(ts: Column, start=None, end=None) -> Column:
    """Days ``start`` to ``end``, both included, as a half-open timestamp range.

    Comparing the timestamp itself lets the range reach the file scan.
    """
    condition = F.lit(True)
    if start is not None:
        condition = condition & (ts >= F.lit(str(start)).cast("date"))
    if end is not None:
        condition = condition & (ts < F.date_add(F.lit(str(end)).cast("date"), 1))
    return condition


def age_band(age: Column) -> Column:
    """One of six age labels; null for an unknown age."""
    upper, label = AGE_BANDS[0]
    band = F.when(age < upper, label)
    for upper, label in AGE_BANDS[1:]:
        band = band.when(age < upper, label)
    return band.when(age.isNotNull(), OLDEST_BAND)


def fixed_order(value: Column, categories: Sequence[str]) -> Column:
    """Position of a category in a fixed list, 0 for others: a sort key for tables and charts."""
    return F.array_position(F.array(*[F.lit(c) for c in categories]), value)


def recode(value: Column, mapping: dict[str, str]) -> Column:
    """Replace listed values, keep all others."""
    out = value
    for old, new in mapping.items():
        out = F.when(value == old, F.lit(new)).otherwise(out)
    return out


def round_half_even(value: Column) -> Column:
    """Whole number with ties to even."""
    return F.bround(value, 0)


def _md5_word(text: Column) -> Column:
    """First 32 bits of the md5 digest as an unsigned number."""
    return F.conv(F.substring(F.md5(text.cast("string")), 1, 8), 16, 10).cast("long")


def hash_bucket(key: Column, buckets: int, method: str = "xxhash64") -> Column:
    """Bucket number 0..buckets-1, equal for equal keys.

    ``md5`` gives the same bucket in every engine; ``xxhash64`` is the fast choice.
    """
    if method == "md5":
        return F.pmod(_md5_word(key), F.lit(buckets)).cast("int")
    if method == "xxhash64":
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    raise ValueError(f"unknown hash method {method!r}")


def poisson_from_hex(word: Column) -> Column:
    """Poisson(1) weight of a uniform 32-bit number given as eight hexadecimal digits.

    Digits of equal length compare like the numbers, so the bounds are text as well.
    """
    weight, largest = None, 0
    for k, bound in enumerate(poisson_one_cdf()):
        limit = math.ceil(bound * 2**32)
        if limit >= 2**32:
            break
        below = word < F.lit(f"{limit:08x}")
        weight = F.when(below, k) if weight is None else weight.when(below, k)
        largest = k
    return weight.otherwise(largest + 1)


def poisson_digest(key: Column, block: Column, seed: int) -> Column:
    """md5 digest whose four 8-digit words weigh the replicates 4 * block .. 4 * block + 3."""
    return F.md5(F.concat_ws("|", key.cast("string"), block.cast("string"), F.lit(str(seed))))


def poisson_weight(key: Column, replicate: Column, seed: int, method: str = "xxhash64") -> Column:
    """Poisson(1) weight that depends only on (key, replicate, seed).

    A hash gives a uniform number and the inverse of the distribution function turns
    it into a count, so the weight is the same on every retry and partitioning.
    """
    if method == "md5":
        digest = poisson_digest(key, F.floor(replicate / 4), seed)
        return poisson_from_hex(F.substr(digest, F.pmod(replicate, F.lit(4)) * 8 + 1, F.lit(8)))
    if method != "xxhash64":
        raise ValueError(f"unknown hash method {method!r}")
    uniform = F.pmod(F.xxhash64(key, replicate, F.lit(seed)), F.lit(2**32)) / F.lit(4294967296.0)
    bounds = poisson_one_cdf()
    weight = F.when(uniform < bounds[0], 0)
    for k, bound in enumerate(bounds[1:], start=1):
        weight = weight.when(uniform < bound, k)
    return weight.otherwise(len(bounds))


def require_columns(df, columns: Sequence[str], table: str) -> None:
    """Raise ``ValueError`` naming the columns that are missing. No Spark action."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{table} lacks the columns: {', '.join(missing)}")
