"""Print the physical plans of registered queries, or write them to PLANS.md.

    python tools/explain_plans.py [sf_dir] name [name ...]
    python tools/explain_plans.py --markdown [sf_dir]      # headline plans -> PLANS.md
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerflow.plans.catalog import QUERIES  # noqa: E402
from ledgerflow.session import local_session  # noqa: E402

HEADLINE = ("post_ledger", "unmapped_entries", "latest_by_key", "latest_by_key_one",
            "apply_changes", "upsert_by_key", "reprocess_candidates", "incremental_since")


def physical_plan(df, width: int = 150) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return "\n".join(line if len(line) <= width else line[:width] + " …"
                     for line in text.splitlines())


def main() -> None:
    args = sys.argv[1:]
    markdown = "--markdown" in args
    args = [a for a in args if a != "--markdown"]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    names = args[1:] or (HEADLINE if markdown else sorted(QUERIES))
    spark = local_session()
    if not markdown:
        for name in names:
            print(f"===== {name}")
            QUERIES[name](spark, sf_dir).explain("formatted")
        return
    out = ["# Physical plans of the headline queries",
           "",
           f"Generated by `python tools/explain_plans.py --markdown` over `{sf_dir}`",
           "(initial adaptive plans, before runtime re-optimisation; long lines cut).",
           ""]
    for name in names:
        doc = (QUERIES[name].__doc__ or "").strip().splitlines()
        out += [f"## `{name}`", ""] + ([doc[0], ""] if doc else [])
        out += ["```", physical_plan(QUERIES[name](spark, sf_dir)), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
