"""Run a scorecard while the first attempt of some tasks fails; print rows as JSON.

Used by tests/test_retries.py in its own process (master local[4,3]: up to
three attempts per task). The failure is injected by a test-only UDF over the
input; the library itself has none.
"""

from __future__ import annotations

import json
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from plaudit.operators import scorecard  # noqa: E402
from plaudit.session import build_session, ensure_checkpoint_dir  # noqa: E402
from plaudit.sources import load_table, reviews_from_events  # noqa: E402


def main() -> None:
    sf_dir, flaky = sys.argv[1], sys.argv[2] == "flaky"
    spark = build_session("local[4,3]", shuffle_partitions=4)
    ensure_checkpoint_dir(spark)

    @F.udf(T.LongType())
    def fail_first_attempt(value):
        ctx = TaskContext.get()
        if flaky and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            raise RuntimeError("injected task failure")
        return value

    events = load_table(spark, sf_dir, "events").repartition(4)
    events = events.withColumn("user_id", fail_first_attempt("user_id"))
    card = scorecard(reviews_from_events(events), max_pct_negative=20, order_by="points")
    rows = sorted(tuple(r) for r in card.collect())
    print(json.dumps(rows))
    spark.stop()


if __name__ == "__main__":
    main()
