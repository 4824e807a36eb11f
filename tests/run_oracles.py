"""python tests/run_oracles.py [sf] [name ...]: prints each query's outcome."""

import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
sys.path.insert(0, __file__.rsplit("/", 1)[0])

from oracle import compare, connect  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from delaylens.session import get_session  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_session(cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    jobs, sqls = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(jobs)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = jobs[name](spark, sf_dir)
            outcome = compare(df, con, sqls[name]) if name in sqls else f"rows only: {df.count()}"
            ok = outcome is None or outcome.startswith("rows only")
        except Exception as e:
            outcome, ok = f"{type(e).__name__}: {str(e)[:600]}", False
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - t0:.1f}s {outcome or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} ok")
