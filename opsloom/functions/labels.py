"""Classifications and keys."""
from pyspark.sql import Column, functions as F

from opsloom.params import DORA_DAILY, DURATION_BUCKETS

# Fixed value: the text a NULL stands for in a surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def _c(x):
    return x if isinstance(x, Column) else F.col(x)


def folded(x, default=None, upper=False) -> Column:
    """Trimmed text in one case, with a default for NULL."""
    x = _c(x) if default is None else F.coalesce(_c(x), F.lit(default))
    return F.upper(F.trim(x)) if upper else F.lower(F.trim(x))


def dora_tier(freq, cfr, mttr, cuts=DORA_DAILY) -> Column:
    """Elite, High, Medium or Low delivery performance."""
    freq, cfr, mttr = _c(freq), _c(cfr), _c(mttr)
    elite, high, medium = cuts
    return (
        F.when((freq >= elite) & (cfr <= 0.05) & (mttr <= 60), "Elite")
        .when((freq >= high) & (cfr <= 0.10) & (mttr <= 1440), "High")
        .when((freq >= medium) & (cfr <= 0.15), "Medium")
        .otherwise("Low")
    )


def severity_ladder(z, medium: float = 3.0) -> Column:
    """critical from |z| 5, high from 4, medium from the threshold, else low."""
    a = F.abs(_c(z))
    return F.when(a >= 5, "critical").when(a >= 4, "high").when(a >= medium, "medium").otherwise("low")


def severity_bins(abs_z, threshold: float) -> Column:
    """NORMAL below the threshold, then one class per unit. NULL stays NULL."""
    a = _c(abs_z)
    return (
        F.when(a < threshold, "NORMAL").when(a < threshold + 1, "MEDIUM")
        .when(a < threshold + 2, "HIGH").when(a.isNotNull(), "CRITICAL")
    )


def duration_bucket(seconds) -> Column:
    s = _c(seconds)
    out = F.when(s.isNull(), "unknown")
    for limit, name in DURATION_BUCKETS:
        out = out.when(s < limit, name)
    return out.otherwise(">60m")


def surrogate_key(*cols) -> Column:
    """md5 over the text forms of the columns."""
    return F.md5(F.concat_ws("-", *[F.coalesce(_c(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]))


def event_key(*cols) -> Column:
    """SHA-256 over the text forms of the columns, NULL as empty text."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]), 256)
