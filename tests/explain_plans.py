"""Write PLANS.md: physical plans of the headline queries (sf0.01).

Keeps only the operator tree and the scan lines (pushed filters, read
schema) so the file stays short.
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = [
    "index_all_resolutions",
    "top_cells_res5",
    "per_capita_res5",
    "continent_totals_res5",
    "index_written_res5",
    "hex_export_bbox_res5",
    "pyramid_quadrant_rows",
    "stored_quadrant_rows",
    "stored_bbox_res5",
    "height_summary",
    "op2_url_lists",
    "op8_secrets",
    "op10_exact_dedup",
]


def main(sf_dir: str = "/root/testdata/sf0.01") -> None:
    import __spark_entry__ as E
    from tessera.session import get_spark

    spark = get_spark()
    out = ["# Physical plans of headline queries (sf0.01, AQE initial plans)", ""]
    for name in NAMES:
        if name not in E.queries():
            continue
        df = E.queries()[name](spark, sf_dir)
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n")[0]
        scans = [
            re.sub(r"#\d+L?", "", line.strip())
            for line in text.splitlines()
            if line.startswith(("PushedFilters", "PartitionFilters", "ReadSchema", "Location"))
        ]
        out += [f"## {name}", "", "```", re.sub(r"#\d+L?", "", tree)[:6000], "", *scans[:24], "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main(*sys.argv[1:])
