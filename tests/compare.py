"""Compare catalogue queries with their SQL: ``python tests/compare.py <sf> [names]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from topicloom.plans.checks import SQL  # noqa: E402
from topicloom.plans.queries import CATALOG  # noqa: E402
from topicloom.session import local_session  # noqa: E402

DATA = "/root/testdata"


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return tuple((v is None, str(v)) for v in row)


def differences(spark, con, name: str, sf: str) -> str | None:
    """None when rows agree, else a short description."""
    df = CATALOG[name](spark, sf)
    cols = sorted(df.columns)
    mine = sorted((tuple(r) for r in df.select(*cols).collect()), key=_key)
    ref = con.execute(SQL[name])
    names = [d[0] for d in ref.description]
    if sorted(names) != cols:
        return f"columns {cols} against {sorted(names)}"
    at = [names.index(c) for c in cols]
    other = sorted((tuple(r[i] for i in at) for r in ref.fetchall()), key=_key)
    if len(mine) != len(other):
        return f"{len(mine)} rows against {len(other)}; e.g. {mine[:1]} {other[:1]}"
    bad = [(a, b) for a, b in zip(mine, other, strict=True) if a != b]
    if not bad:
        return None
    close = all(
        x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-3, abs_tol=1e-3))
        for a, b in bad
        for x, y in zip(a, b, strict=True)
    )
    return f"{len(bad)} of {len(mine)} rows differ{' in last digits' if close else ''}; e.g. {str(bad[0])[:400]}"


def main() -> None:
    sf = f"{DATA}/sf{sys.argv[1]}"
    spark, con = local_session(8), connect(sf)
    for name in sys.argv[2:] or list(SQL):
        start = time.time()
        try:
            found = differences(spark, con, name, sf)
        except Exception as error:  # report and go on
            found = f"{type(error).__name__}: {str(error)[:600]}"
        if True:
            print(f"{name:28s} {time.time() - start:5.1f}s {found or 'equal'}", flush=True)
    print("done", len(SQL), "checks;", sorted(set(CATALOG) - set(SQL)), "have none")


if __name__ == "__main__":
    main()
