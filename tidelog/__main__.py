"""``python -m tidelog run JOB.yml`` runs a job; ``fields dump MODULE:CLASS [--target FILE]`` writes a class's shape, ``fields load FILE`` reads one."""

from __future__ import annotations

import argparse
import importlib
import json
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser("tidelog", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run")
    run.add_argument("job")
    fields = sub.add_parser("fields").add_subparsers(dest="what", required=True)
    dump = fields.add_parser("dump")
    dump.add_argument("cls")
    dump.add_argument("--target")
    load = fields.add_parser("load")
    load.add_argument("file")
    args = parser.parse_args(argv)
    if args.command == "run":
        from tidelog.plans.jobs import Job
        from tidelog.runtime import session, swept

        spark = session()
        try:
            print(Job.read(args.job).run(spark))
        finally:
            swept(spark)
        return 0
    from tidelog.shapes import Shape, shape_of

    if args.what == "load":
        s = Shape.read(args.file)
        print(s.name, *(f"  {f.name}: {f.dataType.simpleString()}{'?' if f.nullable else ''}" for f in s.schema.fields), sep="\n")
        return 0
    module, _, name = args.cls.partition(":")
    shape = shape_of(getattr(importlib.import_module(module), name))
    if args.target:
        shape.write(args.target)
    else:
        print(json.dumps(shape.to_dict(), indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
