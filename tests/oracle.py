"""Side-by-side run of a registered query on Spark and its SQL on DuckDB."""

from __future__ import annotations

import math
import os
import re

import duckdb

from tidemark.catalog.base import TABLES

KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return v


def _rows(rows, order):
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


# Operators no plan may hold: pair products, unsized literal rows, Python workers.
NEVER = ("CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD", "BatchEvalPython", "ArrowEvalPython",
         "MapInPandas", "FlatMapGroups")


def plan(df) -> str:
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def compare(spark, con, folder: str, run, sql: str) -> tuple[int, str | None]:
    """Row count and, when the two sides differ or the plan is not acceptable, why."""
    df = run(spark, folder)
    bad = [word for word in NEVER if word in plan(df)]
    if bad:
        return -1, f"plan holds {bad}"
    names = df.columns
    got = _rows([tuple(r) for r in df.collect()], sorted(range(len(names)), key=lambda i: names[i]))
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = _rows(cur.fetchall(), sorted(range(len(want_names)), key=lambda i: want_names[i]))
    if sorted(names) != sorted(want_names):
        return len(got), f"columns {sorted(names)} != {sorted(want_names)}"
    for name, kind in df.dtypes:
        if kind not in KINDS or (types[name] != KINDS[kind] and types[name] != '"NULL"'):
            return len(got), f"type of {name}: {kind} / {types[name]}"
    if len(got) != len(want):
        return len(got), f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return len(got), f"{sorted(names)}: {a} != {b}"
    return len(got), None


def executed_plans(spark, run) -> list[str]:
    """The plans of all jobs that ``run`` starts, as they ended, staging writes included."""
    store = spark._jsparkSession.sharedState().statusStore()

    def all_ids():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        found = store.executionsList()
        return {found.apply(i).executionId(): found.apply(i).physicalPlanDescription() for i in range(found.size())}

    before = set(all_ids())
    run()
    return [text for i, text in sorted(all_ids().items()) if i not in before]


def executed_nodes(plans: list[str], kind: str, holding: str = "") -> int:
    """How many operators of a kind (whose details hold a text) were executed; reused exchanges hide what is below."""
    n = 0
    for text in plans:
        tree, _, details = text.partition("\n\n")
        if "== Final Plan ==" in tree:
            tree = tree.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
        for part in details.split("\n\n"):
            head = re.match(r"\s*\((\d+)\) (\S[^\n]*)", part)
            if head and head[2].startswith(kind) and holding in part and re.search(rf"\({head[1]}\)", tree):
                n += 1
    return n
