"""Differential check of the analog queries against their DuckDB oracle.

Mirrors the driver's gate: row count, column names, and an order-free hash of
the values (columns sorted by name, doubles rounded to 6 places).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    return v


def table_digest(columns: list[str], rows: Iterable[tuple]) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(lines), h


_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                  "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT",
                  "timestamp_ntz": "TIMESTAMP", "date": "DATE", "tinyint": "TINYINT"}


def type_mismatches(spark_dtypes: list[tuple[str, str]], duck_desc) -> list[str]:
    duck = {d[0]: str(d[1]) for d in duck_desc}
    bad = []
    for name, t in spark_dtypes:
        want = _SPARK_TO_DUCK.get(t, t.upper())
        got = duck.get(name)
        if got is not None and got != want:
            bad.append(f"{name}: spark {t} vs duckdb {got}")
    return bad


def compare(spark, sf_dir: str, names: Iterable[str] | None = None) -> dict[str, dict]:
    from tidepool.plans.analogs import QUERIES
    from tidepool.plans.oracle import ORACLE
    con = duckdb_connection(sf_dir)
    out: dict[str, dict] = {}
    for name in (names or ORACLE):
        if name not in ORACLE or name not in QUERIES:
            continue
        res: dict = {}
        try:
            df = QUERIES[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
            cur = con.execute(ORACLE[name])
            o_cols = [d[0] for d in cur.description]
            o_rows = cur.fetchall()
            sn, sh = table_digest(s_cols, s_rows)
            on, oh = table_digest(o_cols, o_rows)
            res = {"types": type_mismatches(df.dtypes, cur.description), "rows": sn, "oracle_rows": on, "columns_match": sorted(s_cols) == sorted(o_cols),
                   "hash_match": sh == oh, "spark_cols": s_cols, "oracle_cols": o_cols}
            res["ok"] = (res["columns_match"] and res["hash_match"] and sn == on
                         and not res["types"])
        except Exception as e:  # report, keep going
            res = {"ok": False, "error": f"{type(e).__name__}: {str(e)[:500]}"}
        out[name] = res
    return out


def plan_text(df, mode: str = "formatted") -> str:
    """The physical plan as ``explain`` prints it."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
