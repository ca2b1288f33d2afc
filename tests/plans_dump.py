"""Print the final adaptive plans of the main jobs (source of PLANS.md).

Run: python tests/plans_dump.py > plans.md
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterlake.session import build_session
from meterlake.sources import fixtures as FX, lake
from meterlake.plans import pipeline as P, drilldown as D, queries as Q, sql as QS
from meterlake.operators import grid as G, silver as SV
from meterlake.schema import CELLS
spark=build_session()
d='/root/testdata/sf0.1'
root=lake.scratch_root(spark)
P.run(spark, FX.cells(spark,d), root)
gold=lake.read_gold(spark, root)
staged=spark.read.schema(CELLS).parquet(root+"/cells")
prof=spark.read.parquet(root+"/columns")
jobs={
 "drilldown over gold, one hall and a range": D.peak_drilldown(gold, "H2", "2024-01-03", "2024-01-30"),
 "bronze job (staged cells + column profile)": G.bronze_from(staged, prof),
 "silver job": SV.to_silver(lake.read_bronze(spark, root)),
 "top day per hall, Spark SQL text": QS.run(spark, gold, "top_day"),
}
def tree(plan):
    out=[]
    for ln in plan.splitlines():
        if "== Initial Plan ==" in ln:
            break
        m=re.match(r'^([\s:+\-]*)(\*?\s*\(\d+\)\s*)?([A-Za-z][A-Za-z0-9]*)(.*)$', ln)
        if not m: continue
        prefix, _, node, rest = m.groups()
        extra=""
        if node in ("FileScan","Scan"):
            pf=re.search(r'PartitionFilters: (\[[^\]]*\])', ln); pu=re.search(r'PushedFilters: (\[[^\]]*\])', ln); rs=re.search(r'ReadSchema: (struct<.*>)\s*$', ln)
            extra=" " + " ".join(x for x in [f"PartitionFilters {pf.group(1)}" if pf and pf.group(1)!='[]' else "", f"PushedFilters {pu.group(1)}" if pu and pu.group(1)!='[]' else "", f"ReadSchema {rs.group(1)}" if rs else ""] if x)
        elif node in ("BroadcastHashJoin","SortMergeJoin","ShuffledHashJoin"):
            jt=re.search(r'(Inner|LeftOuter|LeftSemi|LeftAnti|FullOuter|RightOuter)', rest); extra=" "+(jt.group(1) if jt else "")
        elif node=="Exchange":
            pt=re.search(r'(hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition|REBALANCE[A-Z_]*)', rest); extra=" "+(pt.group(1) if pt else "")
        out.append(prefix+node+extra)
    return "\n".join(out)
for name, df in jobs.items():
    qe=df._jdf.queryExecution(); qe.toRdd().count()
    p=qe.executedPlan().toString()
    print(f"### {name}\n\n```\n{tree(p)}\n```\n")
