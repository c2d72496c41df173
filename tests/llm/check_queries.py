"""Compare the text queries with their SQL: check_queries.py [folder] [key ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import oracle  # noqa: E402

from tallymark.llm import queries  # noqa: E402
from tallymark.session import local_session  # noqa: E402

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
keys = sys.argv[2:] or list(queries.QUERIES)
spark = local_session("tallymark-llm-check")
duck = oracle.connect(folder)
for key in keys:
    start = time.time()
    df = queries.QUERIES[key](spark, folder)
    if key in queries.ORACLES:
        found = oracle.differences(df, duck, queries.ORACLES[key])
    else:
        found = [] if df.count() else ["no rows"]
    print(f"{key:24s} {time.time() - start:6.2f}s {'ok' if not found else found}", flush=True)
