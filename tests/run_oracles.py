"""Compare all (or the named) queries with their SQL: python tests/run_oracles.py FOLDER [PREFIX ...]"""

import sys
import time

sys.path.insert(0, "/root/repo")
sys.path.insert(0, "/root/repo/tests")

import __spark_entry__ as entry  # noqa: E402
from compare import compare, connect  # noqa: E402
from labwatch.session import build_session  # noqa: E402


def main(folder: str, prefixes: list[str]) -> int:
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in oracles:
                problems = compare(df, connect(folder), oracles[name])
                rows = ""
            else:
                rows, problems = f"{df.count()} rows, no SQL", []
        except Exception as error:  # noqa: BLE001
            problems, rows = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok'} {name} {time.time() - start:.1f}s {rows}", flush=True)
        for p in problems:
            print("    ", p[:1800], flush=True)
    print("failing:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
