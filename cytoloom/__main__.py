"""python -m cytoloom run NAME | repro NAME | data --names FILE --md5 FILE PATH | make-fixture NAME

Exit codes: 0 done, 1 a check failed, 2 wrong usage, 3 no data root.
"""

from __future__ import annotations

import argparse
import sys

from . import workspace


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="cytoloom")
    p.add_argument("--configs", default="configs", help="folder of TOML files")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("run", "repro", "make-fixture"):
        sub.add_parser(name).add_argument("dataset")
    d = sub.add_parser("data")
    d.add_argument("path")
    d.add_argument("--md5", required=True)
    try:
        a = p.parse_args(argv)
    except SystemExit as e:
        return 2 if e.code else 0
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from . import publish
    from .config import Config
    from .operators import derive, integrity
    from .operators.validation import ContractError
    from .sources import files

    try:
        volume = workspace.Workspace.open()
        spark = SparkSession.builder.appName("cytoloom").getOrCreate()
        if a.command == "data":
            expected = files.md5_list(spark.read.text(a.md5)).select("name", F.lit("md5").alias("method"), "md5", F.lit(None).cast("double").alias("mb"))
            found = integrity.files(spark, a.path).select(F.substring_index("rel", "/", -1).alias("name"), "bytes", "md5")
            rows = integrity.verified(expected, found).orderBy("name").collect()
            width = max([4, *(len(r["name"]) for r in rows)])
            print("\n".join(f"{r['name']:<{width}}  {r['method']:<8}  {r['status']}" for r in rows))
            return int(any(r["status"] != "ok" for r in rows))
        cfg = Config.read(a.configs, a.dataset)
        out = str(volume.folder("derived", cfg.name))
        journal = workspace.journal(f"{out}/pipeline.log", cfg.visibility == "private")
        if a.command == "run":
            print(publish.render(publish.run(spark, cfg, out)))
            if journal.withheld:
                print(f"{journal.withheld} log records about single cells were dropped")
            return 0
        if a.command == "repro":
            n = publish.reproduce(spark, cfg, str(volume.folder("build", cfg.name))).count()
            print(f"{n} files differ")
            return int(n > 0)
        ds = publish.ADAPTERS[cfg.adapter](spark, cfg)
        files.save(derive.cut_fixture(ds), str(volume.folder("canonical", f"{cfg.name}-fixture")))
        return 0
    except workspace.WorkspaceError as e:
        print(f"ERROR: {e}", file=sys.stderr)
        return 3
    except (ContractError, publish.CheckError) as e:
        print(f"ERROR: {e}", file=sys.stderr)
        return 1
    except (FileNotFoundError, KeyError, ValueError) as e:
        print(f"ERROR: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
