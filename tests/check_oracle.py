"""Compare every registered query with its SQL: ``python tests/check_oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as driver  # noqa: E402
from inkfold import build_session  # noqa: E402


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return bytes(value) if isinstance(value, bytearray) else value


def rows_of(names, rows):
    """A bag of rows with their columns in name order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, sf_dir: str, name: str):
    """Both results as (names, bag of rows) and their column types."""
    frame = driver.queries()[name](spark, sf_dir)
    ours = rows_of(frame.columns, frame.collect())
    cursor = connection.execute(driver.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    types = {f.name: f.dataType.simpleString() for f in frame.schema}, {c[0]: str(c[1]) for c in cursor.description}
    return ours, theirs, types


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(driver.queries())
    spark = build_session("check", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(sf_dir), 0
    for name in wanted:
        start = time.time()
        if name not in driver.oracle_sql():
            print(f"{name}: no SQL")
            continue
        try:
            ours, theirs, types = compare(spark, connection, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            failed += 1
            print(f"{name}: ERROR {str(error)[:600]}")
            continue
        same = ours == theirs
        failed += not same
        print(f"{name}: {'same' if same else 'DIFFERENT'} {sum(ours[1].values())} rows {time.time() - start:.1f}s {types}")
        if not same:
            print("   ", ours[0], theirs[0], sum(theirs[1].values()))
            for row in list((ours[1] - theirs[1]))[:2]:
                print("    ours  ", str(row)[:700])
            for row in list((theirs[1] - ours[1]))[:2]:
                print("    theirs", str(row)[:700])
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
