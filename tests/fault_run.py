"""Run in its own process (task retries need a local[N,F] master): inject a task
failure into the replace-by-key write and check the table is still exact."""

from __future__ import annotations

import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import BooleanType  # noqa: E402

from shelfcost.operators import writer  # noqa: E402
from shelfcost.plans import registry  # noqa: E402
from shelfcost.plans.monthly import build_rollup  # noqa: E402
from shelfcost.session import build_session  # noqa: E402
from shelfcost.sources import from_star  # noqa: E402


@F.udf(BooleanType())
def fail_first_attempt(_):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
        raise RuntimeError("injected task loss")
    return True


def main() -> int:
    spark = build_session(cores="4,4", shuffle_partitions=4)
    src = from_star(spark, sys.argv[1])
    run = build_rollup(src, registry.WINDOW)
    path = os.path.join(tempfile.mkdtemp(prefix="shelfcost-fault-"), "rollup")
    writer.replace_by_key(spark, path, run.rollup, run.grid)
    # re-run the same keys with a flaky task in the merge/write job
    flaky = run.rollup.where(fail_first_attempt(F.col("LocationNo")))
    writer.replace_by_key(spark, path, flaky, run.grid)
    got = sorted(map(tuple, writer.read_rollup(spark, path).collect()))
    want = sorted(map(tuple, run.rollup.collect()))
    print("rows", len(got), "equal", got == want)
    return 0 if got == want else 1


if __name__ == "__main__":
    sys.exit(main())
