"""python -m tickloom CONFIG: quotes to labelled splits by one flat YAML file.

The file names the quotes (data_path) and the report (reports_name); tables and sidecars go to sample_data/<report>, or --out.
Keys of the targets and validation_portion are idle, so that a file gives the rows that its users know; --all-keys lets
them count. A file of stages (wrangle, features, split, labels) is for plans.pipeline.run with config.load.
"""

from __future__ import annotations

import argparse
import json
import sys

from . import config
from .plans import pipeline
from .session import session


def main(given: list[str] | None = None) -> dict[str, str]:
    p = argparse.ArgumentParser("tickloom", description="Quotes to labelled splits by one flat YAML file.")
    p.add_argument("config")
    p.add_argument("--out", help="folder of the results; sample_data/<reports_name> if not given")
    p.add_argument("--all-keys", action="store_true", help="let the keys of the targets and validation_portion count")
    p.add_argument("--master", help="the cluster; that of spark-submit if not given")
    a = p.parse_args(given)
    c = config.load_flat(a.config, a.all_keys)
    if c.idle:
        print(f"without effect: {', '.join(c.idle)}", file=sys.stderr)
    paths = pipeline.run(session(a.master), c.source, a.out or f"sample_data/{c.report}", c.stages)
    print(json.dumps(paths))
    return paths


if __name__ == "__main__":
    main()
