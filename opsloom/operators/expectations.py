"""Declarative expectations about one table, evaluated in one aggregation."""
from pyspark.sql import DataFrame, functions as F, types as T

from opsloom.operators.distinct import distinct_counts
from opsloom.operators.quality import combined
from opsloom.params import ENVIRONMENTS, FLEET_EVENT_TYPES, SEVERITIES

# The expectations on staged fleet events.
STAGED_EVENTS = [
    {"kind": "exists", "column": "event_key"},
    {"kind": "not_null", "column": "event_key"},
    {"kind": "unique", "column": "event_key"},
    {"kind": "not_null", "column": "event_timestamp"},
    {"kind": "not_null", "column": "service_name", "mostly": 0.99},
    {"kind": "in_set", "column": "event_type", "values": FLEET_EVENT_TYPES},
    {"kind": "in_set", "column": "severity", "values": SEVERITIES},
    {"kind": "in_set", "column": "environment", "values": ENVIRONMENTS},
    {"kind": "between", "column": "error_budget_burn", "min": 0.0, "max": 100.0, "mostly": 0.99},
    {"kind": "between", "column": "duration_ms", "min": 0, "max": 86_400_000, "mostly": 0.99},
    {"kind": "row_count", "min": 100, "max": 10_000_000},
    {"kind": "distinct_share", "column": "event_id", "min": 0.99},
    {"kind": "date_format", "column": "event_date", "format": "yyyy-MM-dd"},
]


def _share(hits, of):
    """hits / of, where nothing to check counts as fully met."""
    return F.coalesce(F.try_divide(hits.cast("double"), of.cast("double")), F.lit(1.0))


def evaluate(df: DataFrame, expectations=STAGED_EVENTS) -> DataFrame:
    """(no, kind, column, observed, passed). Value expectations look at non-null values; `observed` is
    the share that meets the expectation, or the row count."""
    measures, results, distincts = {"rows": F.count(F.lit(1))}, [], {}

    def measure(name, column):
        measures[name] = column
        return F.col(name)

    for i, e in enumerate(expectations):
        kind, column, rows = e["kind"], e.get("column"), F.col("rows")
        mostly = e.get("mostly", 1.0)
        if column is not None and column not in df.columns:
            observed, passed = F.lit(0.0), F.lit(False)
        elif kind == "exists":
            observed, passed = F.lit(1.0), F.lit(True)
        elif kind == "row_count":
            observed, passed = rows.cast("double"), rows.between(e["min"], e["max"])
        else:
            c = F.col(column)
            known = measure(f"known_{column}", F.count(c))
            if kind == "not_null":
                observed = _share(known, rows)
                passed = observed >= mostly
            elif kind in ("unique", "distinct_share"):
                distincts[f"distinct_{column}"] = column
                distinct = F.col(f"distinct_{column}")
                observed = _share(distinct, known)
                passed = observed >= (1.0 if kind == "unique" else e["min"])
            else:
                if kind == "in_set":
                    ok = c.isin(e["values"])
                elif kind == "between":
                    ok = c.between(e["min"], e["max"])
                elif kind == "date_format" and isinstance(df.schema[column].dataType, (T.DateType, T.TimestampType)):
                    ok = c.isNotNull()
                elif kind == "date_format":
                    ok = F.try_to_timestamp(c, F.lit(e["format"])).isNotNull()
                else:
                    raise ValueError(f"unknown expectation: {kind}")
                observed = _share(measure(f"ok_{i}", F.count_if(ok)), known)
                passed = observed >= mostly
        results.append(F.struct(
            F.lit(i + 1).alias("no"), F.lit(kind).alias("kind"), F.lit(column).cast("string").alias("column"),
            observed.alias("observed"), passed.alias("passed")))
    parts = [distinct_counts(df, distincts)] if distincts else []
    return combined(df.agg(*[c.alias(n) for n, c in measures.items()]), *parts).select(F.inline(F.array(*results)))
