"""Compare catalog queries with their SQL: check_catalog.py [folder] [key ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import oracle  # noqa: E402

from tallymark.plans import catalog  # noqa: E402
from tallymark.session import local_session  # noqa: E402

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
keys = sys.argv[2:] or list(catalog.QUERIES)
spark = local_session("tallymark-check")
duck = oracle.connect(folder)
bad = 0
for key in keys:
    start = time.time()
    try:
        df = catalog.QUERIES[key](spark, folder)
        if key in catalog.ORACLES:
            found = oracle.differences(df, duck, catalog.ORACLES[key])
        else:
            found = [] if df.count() else ["no rows"]
        kind = "sql" if key in catalog.ORACLES else "rows"
    except Exception as error:  # report and go on with the next key
        found, kind = [f"{type(error).__name__}: {str(error)[:1500]}"], "error"
    bad += bool(found)
    print(f"{key:32s} {kind:5s} {time.time() - start:6.2f}s {'ok' if not found else found}", flush=True)
print("bad:", bad)
