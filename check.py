"""Run registered queries beside their SQL: ``python check.py [tables_dir] [name ...]``."""

import sys
import time

from cliploom.plans import CATALOGUE
from cliploom.session import build_session
from tests.compare import difference, open_tables

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(CATALOGUE)
    spark = build_session("check")
    spark.sparkContext.setLogLevel("ERROR")
    con = open_tables(folder)
    bad = 0
    for name in wanted:
        item = CATALOGUE[name]
        begin = time.time()
        try:
            df = item.run(spark, folder)
            verdict = difference(df, con, item.sql) if item.sql else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            verdict = "ERROR " + str(error)[:1500]
        ok = verdict is None or verdict.startswith("rows only")
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - begin:.2f}s {verdict or ''}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} equal")
    spark.stop()
    sys.exit(bool(bad))
