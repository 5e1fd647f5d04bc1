import numpy as np
import pytest

from llm.packing import CAPACITY
from llm.training_order import materialise, read_slots, unfeistel, walked
from tests.llm.conftest import odd_rows


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 64, 1000, 4097])
def test_walk_is_a_permutation_and_inverts(n):
    x = np.arange(n, dtype=np.uint64)
    y = walked(x, n, 42)
    assert sorted(y.tolist()) == list(range(n))
    assert (walked(y, n, 42, unfeistel) == x).all()
    if n > 60:
        assert (y != walked(x, n, 43)).mean() > 0.9


def test_shards_hold_every_sequence_once(spark, odd, none, tmp_path):
    path = str(tmp_path / "shards")
    rows = sorted(materialise(odd, path, stride=16).collect())
    n = len(rows)
    assert [r.slot for r in rows] == list(range(n)) and all((r.shard, r.row) == divmod(r.slot, 16) for r in rows)
    assert {d for r in rows for d in r.doc_ids} == {d for d, _ in odd_rows() if d is not None}
    import zlib
    ids = list(read_slots(spark, path, 0, n, stride=16))
    assert [zlib.crc32(x.astype("<u4").tobytes()) for x in ids] == [r.ids_crc32 for r in rows] and all(len(x) <= CAPACITY for x in ids)
    assert [x.tolist() for x in read_slots(spark, path, 13, 9, stride=16)] == [x.tolist() for x in ids[13:22]]
    for k in range((n + 15) // 16):
        files = list((tmp_path / "shards" / f"shard={k}").glob("*.parquet"))
        assert len(files) == 1
    again = sorted(materialise(odd, str(tmp_path / "again"), stride=16).select("slot", "ids_crc32").collect())
    assert again == [(r.slot, r.ids_crc32) for r in rows]
    assert materialise(none, str(tmp_path / "none")).count() == 0
