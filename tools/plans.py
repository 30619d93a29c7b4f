"""Write the physical plans of the key steps to PLANS.md (operator lines only).

    python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tree(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    keep = []
    for line in buf.getvalue().splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        if len(line) > 170:
            line = line[:167] + "..."
        keep.append(line)
    return "\n".join(keep)


def main():
    from pyspark.sql import functions as F
    from parcelstack.operators import link, parcels as P, rank, score
    from parcelstack.plans import build, queries as Q, standins
    from parcelstack.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(shuffle_partitions=16)
    fe = Q.feeds(spark, sf)
    b = Q.lead_build(spark, sf)
    steps = [
        ("stand-in raw parcels (pruned scans, broadcast dimension joins)", standins.raw_parcels(spark, sf)),
        ("first row per pid (partial WindowGroupLimit before the shuffle)", P.first_row_per_pid(fe.parcels_raw)),
        ("evidence: pid-keyed feeds unioned, one join with parcels; address and name joins",
         build.build_evidence(fe, b.parcels)),
        ("fold (partial aggregates) joined with parcels", score.score_leads(score.fold(b.evidence), b.parcels,
                                                                              "2001-08-02")),
        ("top 3 signals per (pid, pattern)", rank.top_signals(b.evidence.where(F.col("pattern").isNotNull()))),
        ("ranking (range-partitioned sort)", b.ranked()),
    ]
    out = ["# Physical plans of the key steps", "",
           f"Generated by `tools/plans.py` on {os.path.basename(sf)} (local, AQE on: initial plans; AQE may switch",
           "sort-merge joins to broadcast joins at run time from measured sizes).", ""]
    for title, df in steps:
        out += [f"## {title}", "", "```", tree(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
