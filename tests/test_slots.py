import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from blotter.operators.windows import trailing_count
from blotter.streaming import pipeline as SP
from blotter.streaming import slots as SL


class Held:
    """Stand-in for the state handle of one group."""

    def __init__(self):
        self.exists, self.get = False, None

    def update(self, value):
        self.exists, self.get = True, value


def counted(batches, window, slots, ring):
    """Run micro-batches of (district, id, t) through the slot functions; ({(district, id): count}, largest group, states)."""
    states, found, largest = {}, {}, 0
    fn = SL.slot_counts(window)
    for batch in batches:
        rows = pd.DataFrame(batch, columns=["district", "id", "t"]).assign(has_id=True)
        halves = [rows.iloc[:len(rows) // 2], rows.iloc[len(rows) // 2:]]
        out = pd.concat(list(SL.routed(iter(halves), window, slots, ring)))
        for key, group in out.groupby(["district", "ring"]):
            largest = max(largest, len(group))
            for r in fn(key, iter([group]), states.setdefault(key, Held())):
                found |= {(x.district, x.id): x.event_count for x in r.itertuples()}
    return found, largest, states


def brute(batches, window):
    seen, found = [], {}
    for batch in batches:
        for d, i, t in sorted(batch, key=lambda r: (r[2], r[1])):
            found[d, i] = 1 + sum(d == e and t - window <= u <= t for e, _, u in seen)
            seen.append((d, i, t))
    return found


@pytest.mark.parametrize("slots,ring", [(1, 3), (4, 12), (6, 9)])
def test_in_order_batches_equal_brute_force(slots, ring):
    rng = random.Random(slots)
    events = sorted(((rng.choice("aab"), i, rng.randrange(-300, 900) // 2) for i in range(400)), key=lambda e: e[2])
    cuts = [0, 7, 8, 150, 400]
    batches = [events[a:b] for a, b in zip(cuts, cuts[1:])]
    assert counted(batches, 60, slots, ring)[0] == brute(batches, 60)


def test_rows_late_by_less_than_two_windows_count_exactly():
    rng = random.Random(3)
    events = sorted(((rng.choice("ab"), i, rng.randrange(2000)) for i in range(500)), key=lambda e: e[2] + rng.randrange(100))
    batches = [events[i:i + 25] for i in range(0, 500, 25)]
    assert any(min(t for *_, t in b) < max(t for *_, t in a) for a, b in zip(batches, batches[1:]))
    assert counted(batches, 60, 4, 12)[0] == brute(batches, 60)


def test_a_very_late_row_is_emitted_and_evicts_nothing():
    first = [("a", i, 10_000 + i) for i in range(20)]
    found, _, states = counted([first, [("a", 99, 5)], [("a", 100, 10_020)]], 60, 4, 12)
    assert found["a", 99] == 1 and found["a", 100] == 21
    assert len(states) <= 12


def test_no_group_holds_a_district_and_state_is_bounded():
    events = [("a", i, i) for i in range(6000)]
    _, largest, states = counted([events], 60, 4, 12)
    assert largest < 3 * 6000 // 10          # own and edge rows of a twelfth of the events, and counts
    assert len(states) == 12 and all(len(s.get[1]) + len(s.get[2]) <= 30 for s in states.values())


def test_stream_with_ties_null_ids_and_a_replayed_restart(spark, scratch):
    t0 = dt.datetime(2024, 3, 1)
    rows = [(i, t0 + dt.timedelta(seconds=(i * i) % 97), "d" if i % 3 else "e") for i in range(120)] + [(None, t0 + dt.timedelta(seconds=200), "d")]
    events = spark.createDataFrame(rows, "id long, ts timestamp_ntz, district string")
    events.coalesce(1).write.parquet(f"{scratch}/src")
    for _ in range(2):                        # the second run has nothing left to do
        stream = spark.readStream.schema(events.schema).parquet(f"{scratch}/src")
        SP.run_available_now(SL.trailing_count_stream(stream, 20), SP.batch_sink(f"{scratch}/out"), f"{scratch}/ckpt")
    key = lambda r: (r.district, str(r.ts), r.event_count, r.id or -1)
    got = sorted(spark.read.parquet(f"{scratch}/out").select("district", "id", "ts", "event_count").collect(), key=key)
    want = sorted(trailing_count(events, 20).select("district", "id", "ts", F.col("event_count").cast("long")).collect(), key=key)
    assert got == want


def test_windows_that_have_no_equal_slots_are_refused(spark):
    events = spark.createDataFrame([], "id long, ts timestamp_ntz, district string")
    for args in [(1, 3), (10, 0), (10, 4, 4)]:
        with pytest.raises(ValueError):
            SL.trailing_count_stream(events, *args)
