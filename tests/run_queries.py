"""Developer loop: run registered queries against their SQL twins.

python tests/run_queries.py SF [name-prefix ...]
"""

import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
sys.path.insert(0, os.path.dirname(__file__))

import __spark_entry__ as E
from harness import duck, rows_of_duck, rows_of_spark
from exonloom.session import local_session

sf, prefixes = sys.argv[1], sys.argv[2:]
folder = f"/root/testdata/sf{sf}"
spark = local_session()
spark.sparkContext.setLogLevel("ERROR")
if os.environ.get("SMALL_ROWS"):
    spark.conf.set("spark.exonloom.smallRows", os.environ["SMALL_ROWS"])
con = duck(folder)
ora, bad = E.oracle_sql(), []
for name, fn in E.queries().items():
    if prefixes and not any(name.startswith(p) for p in prefixes):
        continue
    t0 = time.time()
    try:
        cols, rows = rows_of_spark(fn(spark, folder))
        t1 = time.time()
        if name not in ora:
            print(f"ROWS {name} {len(rows)} {t1 - t0:.1f}s", flush=True)
            continue
        dcols, drows = rows_of_duck(con, ora[name])
        ok = cols == dcols and rows == drows
        print(f"{'ok  ' if ok else 'DIFF'} {name} {len(rows)} {len(drows)} {t1 - t0:.1f}s duck {time.time() - t1:.1f}s", flush=True)
        if not ok:
            bad.append(name)
            print("   cols", cols, dcols)
            s, d = set(rows), set(drows)
            print("   spark only", sorted(s - d)[:3])
            print("   duck only ", sorted(d - s)[:3], flush=True)
    except Exception as e:  # noqa: BLE001 - report and go on
        bad.append(name)
        print("FAIL", name, str(e)[:700].replace("\n", " | "), flush=True)
print("bad:", bad)
