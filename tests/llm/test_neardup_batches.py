"""The settling step's differences leave a task in parts, not a whole batch at once."""

import numpy as np
import pyarrow as pa

from strata.llm import neardup


class Captured:
    """Stands for the pairs: keeps the function that a task would run."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        self.run = run
        return self


class Idf:
    value = np.ones(1 << neardup.DF_BITS)


def test_differences_of_few_pairs_at_a_time():
    n = 200
    hub = " ".join(f"w{i}" for i in range(60))
    texts = [hub.replace("w30 ", f"x{i} y{i} ") for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array([f"n{i}" for i in range(n)]), pa.array(["h"] * n), pa.array([f"r{i % 2}" for i in range(n)]),
                                        pa.array(texts), pa.array([hub] * n)], names=["node", "hub", "root", "tn", "th"])
    one = pa.RecordBatch.from_arrays([c.slice(0, 1) for c in batch.columns], names=batch.schema.names)
    pairs = Captured()
    neardup._differences(pairs, Idf, 5, 0.8)
    alone = sum(x.num_rows for x in pairs.run([one]))
    parts = list(pairs.run([batch]))
    assert alone > 0 and max(x.num_rows for x in parts) <= 32 * alone
    assert sum(x.num_rows for x in parts) == n * alone and len(parts) == -(-n // 32)
    assert {r for x in parts for r in x.column("node").to_pylist()} == {f"n{i}" for i in range(n)}
