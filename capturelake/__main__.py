"""python -m capturelake BASE VERB ...: parse, deleteparse, isparsed, index, remove, set-fields."""

from __future__ import annotations

import argparse
import os
import sys

from capturelake.config import fields


def arguments(values: list[str]) -> list[str]:
    """Names as given, or the lines of the files that the first of them names."""
    if values and os.path.exists(values[0]) and not values[0].endswith(("arc", "arc.gz")):
        return [line.strip() for path in values for line in open(path, encoding="utf-8") if line.strip()]  # noqa: SIM115
    return values


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="capturelake", description=__doc__)
    p.add_argument("base", help="folder of the tables")
    p.add_argument("verb", choices=["parse", "deleteparse", "isparsed", "index", "remove", "set-fields"])
    p.add_argument("args", nargs="*")
    p.add_argument("-i", "--extraid", default="", help="appended to ids")
    p.add_argument("-f", "--field", action="append", default=[], help="NAME=V1,V2")
    p.add_argument("-q", "--quiet", action="store_true", help="print nothing")
    a = p.parse_intermixed_args(argv)

    from pyspark.sql import SparkSession

    from capturelake.api import Archive

    archive = Archive(SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate(), a.base)
    if a.verb == "set-fields":
        archive.set_fields(a.args[0], fields(a.args[1:] + a.field))
        return 0
    names = arguments(a.args)
    if a.verb == "parse":
        for r in archive.parse(names).collect():
            if not a.quiet:
                print(r["arcname"], r["status"], r["n_records"], sep="\t")
    elif a.verb == "index":
        archive.index(names, a.extraid, fields(a.field))
    elif a.verb == "remove":
        archive.remove(names)
    elif a.verb == "deleteparse":
        for n in names:
            archive.delete_parse(n)
    else:
        found = {n: archive.is_parsed(n) for n in names}
        for n, yes in found.items():
            if not a.quiet:
                print(n, str(yes).lower(), sep="\t")
        return 0 if all(found.values()) else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
