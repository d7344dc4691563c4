"""Name -> query callable and name -> oracle SQL, collected from the plan modules."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

PLAN_MODULES = ["recsys", "tables", "content", "text", "dnn", "models"]
ORACLE_MODULES = ["oracle", "oracle_tables", "oracle_content", "oracle_text", "oracle_models"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for m in PLAN_MODULES:
        mod = importlib.import_module(f"tastebud.plans.{m}")
        for name in dir(mod):
            if name.startswith("q_"):
                out[name[2:]] = getattr(mod, name)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ORACLE_MODULES:
        out.update(importlib.import_module(f"tastebud.plans.{m}").ORACLES)
    return out
