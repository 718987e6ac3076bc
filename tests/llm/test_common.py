import ctypes

import pyarrow as pa
import pytest

from stockwave.llm.common import freed


def held_mb():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096 / 1e6


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="another C library")
def test_a_task_leaves_no_unused_memory_in_its_worker():
    kept = []

    def task(batches):
        for batch in batches:
            work = [bytearray(1000) for _ in range(100_000)]
            kept.append(bytearray(1000))  # lies above, so that the rest is not returned by itself
            yield batch
            del work

    batch = pa.RecordBatch.from_pydict({"x": [1, 2]})
    before = held_mb()
    found = freed(task(iter([batch, batch])))
    assert next(found) is batch and held_mb() > before + 80
    assert list(found) == [batch]
    assert held_mb() < before + 40


def test_an_empty_task():
    assert list(freed(iter([]))) == []
