"""Summarise the physical plan of every registered query (counts per node type,
from explain("formatted")). Usage: python tools/plan_summary.py [sf_dir]"""
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session
from tidemark.plans.registry import queries
spark = build_session()
sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
print("| query | fact-table scans | staged-table scans | shuffles | broadcast joins | sort-merge joins | windows | filters pushed to fact scans |")
print("|---|---|---|---|---|---|---|---|")
for name, fn in queries().items():
    df = fn(spark, sf)
    df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    txt = buf.getvalue()
    # detail sections: "(n) NodeName" headers, each node once (main plan and subqueries)
    secs = re.split(r"\n(?=\(\d+\) )", txt)
    raw, staged, pushed, tabs = 0, 0, set(), set()
    shuffles = bhj = smj = win = 0
    seen = set()
    for s in secs:
        m = re.match(r"\((\d+)\) (\w[\w ]*)", s)
        if not m or m.group(1) in seen:
            continue
        seen.add(m.group(1)); node = m.group(2).strip()
        if node.startswith("Scan"):
            loc = re.search(r"Location: [^\n]*", s).group(0) if "Location" in s else ""
            if "testdata" in loc:
                raw += 1; tabs.update(re.findall(r"sf[\d.]+/(\w+)\.parquet", loc))
                pf = re.search(r"PushedFilters: \[([^\]]*)\]", s)
                if pf:
                    pushed.update(f for f in re.findall(r"(\w+\([^()]*\))", pf.group(1)) if not f.startswith("IsNotNull"))
            else:
                staged += 1
        elif node == "Exchange":
            shuffles += 1
        elif node.startswith("BroadcastHashJoin"):
            bhj += 1
        elif node.startswith("SortMergeJoin"):
            smj += 1
        elif node == "Window":
            win += 1
    print(f"| {name} | {raw}{' (' + ', '.join(sorted(tabs)) + ')' if tabs else ''} | {staged} | {shuffles} | {bhj} | {smj} | {win} | {'; '.join(sorted(pushed)) or '-'} |")
