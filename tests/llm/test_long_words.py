import math

import numpy as np
import pytest

from acrewise.llm import lm


def test_lattice_of_a_very_long_word(monkeypatch):
    of_bytes = [f"<{i}>" for i in range(256)]
    weights = {"\u2581": 0.1, "a": 0.2, "b": 0.1, "ab": 0.3, "bab": 0.05} | {p: 0.001 for p in of_bytes}
    lattice = lm.Lattice({p: math.log(w) for p, w in weights.items()}, of_bytes)
    short = ["ab\u00e9" * 7, "bab" * 9]
    want, counts = lattice.scores(short), lattice.expected(short, np.array([2.0, 3.0]))
    monkeypatch.setattr(lm, "_STRETCH", 4)  # stretches are invisible in the results
    assert lattice.scores(short) == pytest.approx(want)
    assert lattice.expected(short, np.array([2.0, 3.0])) == pytest.approx(counts)
    monkeypatch.undo()
    word = "ab" * 150_000
    assert np.isfinite(lattice.scores([word, "a"])).all()
    found = dict(zip(lattice.names, lattice.expected([word, "a"], np.array([1.0, 1.0])), strict=True))
    # pieces cover every character once
    assert found["a"] + found["b"] + 2 * found["ab"] + 3 * found["bab"] == pytest.approx(300_001)
    assert found["\u2581"] == pytest.approx(2)
