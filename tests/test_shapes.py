"""Queries without SQL against plain loops on small tables."""

import datetime
import math
import random
import shutil

from tesserae.plans import shapes


def test_line_bridge_takes_every_user(spark, sf_dir, tmp_path):
    rng = random.Random(11)
    start = datetime.datetime(2024, 1, 1)
    events = [(i, rng.randrange(45), start + datetime.timedelta(seconds=rng.randrange(2_000_000)), round(rng.uniform(1, 180), 2)) for i in range(300)]
    spark.createDataFrame(events, "event_id long, user_id long, ts timestamp_ntz, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    shutil.copy(f"{sf_dir}/nation.parquet", f"{tmp_path}/nation.parquet")
    want = {}
    for user in {e[1] for e in events}:
        line = [((t - start).total_seconds() / 1e4 * 150, v / 4) for t, _, v in sorted((e[2], e[0], e[3]) for e in events if e[1] == user)]
        for (ax, ay), (bx, by) in zip(line, line[1:]):
            n = max(1, math.ceil(math.hypot(bx - ax, by - ay) / 500.0))
            for k in range(n + 1):
                x, y = ax + (bx - ax) * (k / n), ay + (by - ay) * (k / n)
                for nation in range(25):
                    if nation * 2000 < x < nation * 2000 + 5000 and y < 40:
                        want[user, f"{nation:05d}"] = want.get((user, f"{nation:05d}"), 0) + 1
    have = {(r.id, r.boundary_code): r.sample_hits for r in shapes.line_bridge(spark, str(tmp_path)).collect()}
    assert have == want and max(u for u, _ in have) >= 20
