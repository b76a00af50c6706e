"""Search: a task holds a bounded number of cosines at a time, and its best are the exact ones."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pandas as pd

from tidewire.operators import vectors as V


def test_few_cosines_at_a_time():
    rng = np.random.default_rng(1)
    m, ids = rng.integers(-3, 4, (20000, 8)).astype(float), np.arange(20000)
    m[:3] = m[3]
    qs = ids[:512]
    batch = pd.DataFrame({"id": ids, "v": list(m)})
    tracemalloc.start()
    got = pd.concat(V._nearest(SimpleNamespace(value=(qs, V._unit(m[qs]))), 5)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    for q in (0, 3, 100, 511):
        cos = np.round(V._unit(m) @ V._unit(m[q : q + 1])[0], 6)
        want = [k for k in np.lexsort((ids, -cos)) if k != q][:5]
        assert got[got["q"] == q]["id"].tolist() == want
