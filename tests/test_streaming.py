"""Updates in one run, in several, and in runs that are stopped, against brute force."""

import random

from pyspark.sql import functions as F

from tallyforge.streaming.updates import Updates

SCHEMA = "key string, seq long, stamp long, payload string"


def brute(rows):
    last, out = {}, []
    for key, seq, stamp, payload in sorted(rows, key=lambda r: r[1]):
        if key is None or stamp is None:
            continue
        payload = payload or ""
        if key not in last or stamp > last[key][0]:
            last[key] = (stamp, payload)
            what = "applied"
        else:
            what = "late" if stamp < last[key][0] else "duplicate" if payload == last[key][1] else "conflict"
        out.append((key, seq, stamp, payload, what))
    return sorted(out)


def test_updates(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", "c", "d", None]), k, rng.choice([k // 20, k // 20 - 2, None]), rng.choice(["x", "y", None])) for k in range(500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    cuts = {"one": [500], "three": [120, 121, 500]}
    for name, ends in cuts.items():
        updates, low = Updates(spark, f"file://{tmp_path}/{name}"), 0
        for end in ends:
            updates.put(df.where((F.col("seq") >= low) & (F.col("seq") < end)))
            # each run is a new object, as after a restart; a second run finds nothing to do
            Updates(spark, updates.folder).run(df.schema)
            Updates(spark, updates.folder).run(df.schema)
            assert updates.outcomes().count() == len(brute([r for r in rows if r[1] < end]))
            low = end
        assert sorted(map(tuple, updates.outcomes().collect())) == brute(rows), name
        assert {r.outcome for r in updates.quarantine().collect()} == {"late", "conflict"}
    assert {r[-1] for r in brute(rows)} == {"applied", "late", "duplicate", "conflict"}
