"""Run every query at a scale and report agreement and time: check_all.py [folder] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from cartwise.session import build_session  # noqa: E402
from oracle import connect, differences  # noqa: E402

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(
        "check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(folder), entry.oracle_sql()
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, folder)
            if name in sql:
                report = differences(df, con, sql[name])
                good = report.get("differing") == 0 and report["rows"][0] == report["rows"][1]
                text = f"rows {report['rows'][0]}" + (f" types {report['types']}" if report.get("types") else "")
                print("OK  " if good else "DIFF", name, text if good else report, end=" ")
            else:
                print("ROWS", name, df.count(), end=" ")
        except Exception as error:  # report and go on with the next query
            print("FAIL", name, str(error)[:400], end=" ")
        print(f"{time.time() - start:.1f}s", flush=True)
