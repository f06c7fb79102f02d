"""Decisions as data against decisions applied one by one."""

import random
import time

from pyspark.sql import functions as F

from tesserae.operators import gates

COLUMNS = "k long, g string, v string, verification_status string, matching_rule_id string, override_stale boolean, confidence double"


def one_by_one(rows, overrides, shas):
    report = []
    for o in overrides:
        unknown = [c for c in (*o["where"], *o["set"]) if c not in rows[0]]
        stale, n = gates.is_stale(o, shas), 0
        for r in rows if not unknown else []:
            if all(r[c] is not None and r[c] == v for c, v in o["where"].items()):
                n += 1
                r.update({"override_stale": True, "verification_status": "review_required"} if stale else o["set"] | {"matching_rule_id": "manual_override"})
        report.append((o["id"], stale, sorted(unknown), n))
    return report


def test_any_order_of_decisions(spark):
    rng = random.Random(9)
    rows = [{"k": i, "g": rng.choice("abc"), "v": rng.choice(["x", "y", None]), "verification_status": "auto", "matching_rule_id": "R", "override_stale": False, "confidence": 0.5} for i in range(60)]
    overrides = []
    for i in range(120):
        where = rng.choice([{"k": rng.randrange(70)}, {"k": rng.randrange(60), "v": rng.choice("xy")}, {"g": rng.choice("abcd"), "verification_status": rng.choice(["auto", "review_required", "done"])}, {"v": rng.choice("xyz")}, {"nowhere": "1"}])
        values = rng.choice([{"verification_status": "done"}, {"v": rng.choice(["x", "y", None])}, {"confidence": 0.9, "verification_status": "auto"}, {"absent": "1"}])
        overrides.append({"id": f"o{i}", "where": where, "set": values, "source_state": {"s": rng.choice("1112")}})
    table = spark.createDataFrame([tuple(r.values()) for r in rows], COLUMNS)
    out, report = gates.apply_overrides(table, overrides, {"s": "1"})
    want = one_by_one(rows, overrides, {"s": "1"})
    assert out.columns == table.columns and out.dtypes == table.dtypes
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(repr(tuple(r.values())) for r in rows)
    assert [(r["id"], r["stale"], sorted(r["unknown_columns"]), r["rows"]) for r in report] == want


def test_ten_thousand_decisions(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumns({"verification_status": F.lit("auto"), "matching_rule_id": F.lit("R"), "override_stale": F.lit(False)})
    few, many = (
        [{"id": str(i), "where": {"l_orderkey": i % 1500, "l_linenumber": i % 7 + 1}, "set": {"verification_status": f"d{i}"}, "source_state": {"s": "1"}} for i in range(n)] for n in (100, 10_000)
    )
    size = lambda decided: gates.apply_decisions(rows, gates.decision_rows(spark, decided, {"s": "1"}))[0]._jdf.queryExecution().analyzed().toString().count("\n")
    assert size(many) == size(few)
    begin = time.time()
    out, report = gates.apply_overrides(rows, many, {"s": "1"})
    changed = out.filter("matching_rule_id = 'manual_override'").count()
    assert time.time() - begin < 60 and len(report) == 10_000
    last = {(o["where"]["l_orderkey"], o["where"]["l_linenumber"]): o["set"]["verification_status"] for o in many}
    held = [r for r in rows.collect() if (r.l_orderkey, r.l_linenumber) in last]
    assert changed == len(held)
    found = out.filter("matching_rule_id = 'manual_override'").select("l_orderkey", "l_linenumber", "verification_status").collect()
    assert all(last[r.l_orderkey, r.l_linenumber] == r.verification_status for r in found)


def test_no_decisions_and_no_rows(spark):
    table = spark.createDataFrame([], COLUMNS)
    assert gates.apply_overrides(table, [], {}) == (table, [])
    out, report = gates.apply_overrides(table, [{"id": "a", "where": {"k": 1}, "set": {"v": "x"}, "source_state": {"s": "1"}}], {"s": "1"})
    assert out.count() == 0 and report == [{"id": "a", "stale": False, "unknown_columns": [], "rows": 0}]
