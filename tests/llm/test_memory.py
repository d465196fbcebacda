"""Memory of the text helpers that the operators share."""

import tracemalloc

import numpy as np
import pyarrow as pa

from wattlake.llm import quality, textvec


def peak_mb(run) -> float:
    run()
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_chunks_hold_one_chunk_of_a_large_batch():
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(8000)), "text": [b"x" * 3000] * 8000})
    assert peak_mb(lambda: [None for _ in textvec.chunks([batch], "text", 1 << 20)]) < 5


def test_quality_counts_grams_in_bounded_memory():
    rng = np.random.default_rng(2)
    texts = [rng.integers(97, 123, 4000, np.uint8).tobytes() for _ in range(1500)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "doc_id": list(range(1500))})
    part_of = dict.fromkeys(range(1500), quality.TRUSTED)
    assert peak_mb(lambda: [None for _ in quality._count_training([batch], part_of)]) < 40
