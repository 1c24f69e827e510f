"""Compare registered queries with their SQL from the command line: ``run_oracle.py FOLDER [name ...]``."""

import sys
import tempfile
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from compare import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from tallyloom.plans import ORACLES, QUERIES  # noqa: E402


def main() -> None:
    folder, names = sys.argv[1], sys.argv[2:]
    if names and names[0].startswith("@"):
        module = names[0][1:]
        names = [n for n, f in QUERIES.items() if module in f.__closure__[0].cell_contents.__module__]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="oracle-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            if name in ORACLES:
                problems = compare(QUERIES[name], ORACLES[name], spark, folder, con)
                note = ""
            else:
                df = QUERIES[name](spark, folder)
                rows = df.collect()
                problems, note = [], f"rows only: {len(rows)} {str(rows[:1])[:200]}"
        except Exception as err:
            problems, note = [f"{type(err).__name__}: {str(err)[:1500]}", traceback.format_exc()[-700:]], ""
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s {note}", flush=True)
        for p in problems:
            print("     ", p[:2200], flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ")


if __name__ == "__main__":
    main()
