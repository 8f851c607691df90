"""``python -m topicloom <job> root=<folder> name=value ..`` runs one job."""

from __future__ import annotations

import inspect
import sys

from pyspark.sql import SparkSession

from topicloom.plans.jobs import Jobs
from topicloom.session import ship


def _typed(value: str, kind: str):
    if kind == "bool":
        return value.lower() in ("1", "true", "yes")
    return {"int": int, "float": float}.get(kind, str)(value)


def main(argv: list[str]) -> int:
    names = sorted(n for n, f in inspect.getmembers(Jobs, inspect.isfunction) if n[0] != "_" and n not in ("read", "save"))
    if len(argv) < 2 or argv[0] not in names:
        print(f"usage: python -m topicloom <job> root=<folder> [name=value ..]\njobs: {', '.join(names)}")
        return 2
    given = dict(a.split("=", 1) for a in argv[1:])
    root = given.pop("root")
    wanted = inspect.signature(getattr(Jobs, argv[0])).parameters
    args = {name: _typed(value, str(wanted[name].annotation)) for name, value in given.items()}
    spark = SparkSession.builder.appName(f"topicloom {argv[0]}").getOrCreate()
    ship(spark)
    result = getattr(Jobs(spark, root), argv[0])(**args)
    if result is not None:
        print(result)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
