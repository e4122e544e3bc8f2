"""Registered queries of this package and the SQL they are compared with."""
import importlib

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


for part in ("dedup", "manifest", "text", "vectors", "web"):
    importlib.import_module(f"opsloom.llm.queries_{part}")
