"""The driver contract: entry() runs on sf0.001 with a stable schema; registries agree."""

import importlib.util
import os
import re

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_smoke(spark):
    se = _entry_module()
    df = se.entry(spark)
    assert df.columns == ["segment", "customers", "churned", "churn_rate", "avg_monthly_charges"]
    rows = df.collect()
    assert len(rows) == 3 and sum(r["customers"] for r in rows) == 150


def test_registries_agree():
    se = _entry_module()
    q, o = se.queries(), se.oracle_sql()
    assert set(o) <= set(q)
    own = {n for n in q if n != "pipeline" and not re.match(r"op\d+_", n)}       # the rest comes and goes with its subpackage
    assert len(own) == 61 and len(own & set(o)) == 48
    assert all(callable(f) for f in q.values()) and all(isinstance(s, str) for s in o.values())
