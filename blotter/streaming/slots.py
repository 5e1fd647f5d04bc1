"""Per-event trailing counts in the state store, keyed by (district, time slot).

A window of W is cut into ``slots`` slots. An event at t of slot s counts

    the events of slot s up to its own place,
    all events of slots s - slots + 1 to s - 1, as one number,
    the events of slot s - slots at or after t - W,

so each event goes to its own slot and, as a time, to the edge slot W later; the
slots in between get one row a slot and Arrow batch that holds a number. No
group holds a district: the rows of one group are those of one slot, and in a
long catch-up batch those of every ``ring``-th slot, worked on one after another.

State stays bounded without a watermark: a district has ``ring`` places, a slot
lives at its number modulo ``ring``, and a newer slot replaces an older one.
Rows may come late by up to W * (ring / slots - 1) less one slot and still count
exactly with all that came before them (twice the window, less a slot, as set
here); a later row is emitted, counted among what its slot still has, and
replaces nothing. A micro-batch's rows are ordered by time, then id (NULL ids
first); rows of earlier micro-batches come before those of equal time. A single
slot is the smallest unit: a burst inside one slot is one group, so raise
``slots`` for dense streams.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from blotter.operators.windows import micros

COUNT_SCHEMA = "district string, id long, ts timestamp_ntz, event_count long"
STATE_SCHEMA = "slot long, own array<long>, edge array<long>, between long"
ROUTED_SCHEMA = "district string, ring long, slot long, kind int, id long, has_id boolean, t long, n long"
#: Slots of a window, and places of a district.
SLOTS, RING = 4, 12
OWN, EDGE, BETWEEN = 0, 1, 2


def routed(batches: Iterator[pd.DataFrame], window_us: int, slots: int, ring: int) -> Iterator[pd.DataFrame]:
    """Rows ``district, id, has_id, t`` to rows of the slots they matter to."""
    width = window_us // slots
    for rows in batches:
        if not len(rows):
            continue
        own = rows.assign(slot=rows["t"] // width, kind=OWN, n=0)
        edge = own.assign(slot=own["slot"] + slots, kind=EDGE, id=0, has_id=False)
        sums = own.groupby(["district", "slot"], sort=False).size().rename("n").reset_index()
        sums = sums.assign(kind=BETWEEN, id=0, has_id=False, t=0)
        out = pd.concat([own, edge, *(sums.assign(slot=sums["slot"] + j) for j in range(1, slots))], ignore_index=True)
        out["ring"] = out["slot"] % ring
        yield out[["district", "ring", "slot", "kind", "id", "has_id", "t", "n"]]


def slot_counts(window_us: int) -> Callable:
    """State function of one (district, place): events of its slots with their trailing counts."""

    def fn(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(pdfs), ignore_index=True)
        held = state.get if state.exists else None
        for slot, here in rows.groupby("slot", sort=True):
            known = held is not None and held[0] == slot
            before = np.asarray(held[1] if known else [], dtype=np.int64)
            kind = here["kind"].to_numpy()
            edge = np.sort(np.concatenate([np.asarray(held[2] if known else [], dtype=np.int64), here["t"].to_numpy()[kind == EDGE]]))
            between = (held[3] if known else 0) + int(here["n"].to_numpy()[kind == BETWEEN].sum())
            own = here[kind == OWN].sort_values(["t", "has_id", "id"], kind="mergesort")
            t = own["t"].to_numpy(dtype=np.int64)
            if len(t):
                count = np.searchsorted(before, t, side="right") + np.arange(1, len(t) + 1)
                count = count + between + len(edge) - np.searchsorted(edge, t - window_us, side="left")
                ids = pd.arrays.IntegerArray(own["id"].to_numpy(dtype=np.int64), ~own["has_id"].to_numpy(dtype=bool))
                yield pd.DataFrame({"district": key[0], "id": ids, "ts": t.astype("datetime64[us]"), "event_count": count.astype(np.int64)})
            if held is None or slot >= held[0]:
                held = (int(slot), np.sort(np.concatenate([before, t])).tolist(), edge.tolist(), between)
        state.update(held)
    return fn


def trailing_count_stream(accepted: DataFrame, window_seconds: int, slots: int = SLOTS, ring: int = RING) -> DataFrame:
    """Per-event trailing count per district (``district, id, ts, event_count``), kept in the state store by time slot."""
    window_us = int(window_seconds) * 1_000_000
    if slots < 1 or window_us < slots or window_us % slots:
        raise ValueError(f"a window of {window_seconds} seconds has no {slots} equal slots of whole microseconds")
    if ring <= slots:
        raise ValueError("a district needs more places than a window has slots")
    narrow = accepted.select("district", F.coalesce("id", F.lit(0)).cast("long").alias("id"), F.col("id").isNotNull().alias("has_id"), micros(accepted, "ts").alias("t"))
    rows = narrow.mapInPandas(lambda it: routed(it, window_us, slots, ring), ROUTED_SCHEMA)
    return rows.groupBy("district", "ring").applyInPandasWithState(slot_counts(window_us), COUNT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
