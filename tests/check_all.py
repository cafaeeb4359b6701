import sys, time, json
sys.path.insert(0, "/root/repo"); sys.path.insert(0, "/root/repo/tests")
from lakestar.session import local_session
import __spark_entry__ as E
from oracle_compare import duck, compare
sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = set(sys.argv[2:])
spark = local_session(8); spark.sparkContext.setLogLevel("ERROR")
con = duck(sf)
qs, sql = E.queries(), E.oracle_sql()
bad = []
for name, q in qs.items():
    if only and name not in only: continue
    t = time.time()
    try:
        r = compare(q(spark, sf), con, sql[name]) if name in sql else {"ok": None}
    except Exception as e:
        r = {"ok": False, "error": repr(e)[:1500]}
    r["sec"] = round(time.time() - t, 2)
    print(name, json.dumps(r, default=str)[:1500] if not r.get("ok") else f"ok {r['spark_rows']} rows {r['sec']}s", flush=True)
    if not r.get("ok"): bad.append(name)
print("BAD", bad)
