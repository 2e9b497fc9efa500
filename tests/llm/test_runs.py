"""Runs of equal keys keep every row."""

import pyarrow as pa


def test_run_beyond_two_gib_loses_no_row():
    from strandlake.llm.runs import runs

    blob = pa.array([bytes(1 << 26)], pa.binary())  # shared by all rows
    rows = [pa.record_batch([pa.array([k]), blob], names=["k", "x"]) for k in [0] * 33 + [1] * 2]
    sizes = [(r.column("k")[0].as_py(), r.num_rows, sum(len(v.as_buffer()) for v in r.column("x"))) for r in runs(rows, ["k"])]
    assert sizes == [(0, 33, 33 << 26), (1, 2, 2 << 26)]


def test_tasks_give_memory_back(monkeypatch):
    """What a task freed does not stay with its worker, whether it ends or fails; its batches go through."""
    import re

    import numpy as np
    import pyarrow as pa
    import pytest

    from strandlake.llm import labelled, ngram_join, packing, runs

    for module, task in ((labelled, "choose"), (packing, "pack"), (ngram_join, "measure"), (ngram_join, "emit"), (ngram_join, "meet")):
        assert f"@tidy\n    def {task}(" in open(module.__file__).read()

    def held():
        return int(re.search(r"Pss_Anon:\s+(\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

    @runs.tidy
    def task(batches):
        for batch in batches:
            small = [np.ones(4000) for _ in range(4000)]  # 128 MB that malloc keeps when the last piece stays
            stays.append(small[-1])
            yield batch

    stays, before = [], held()
    rows = pa.record_batch([pa.array([1, 2])], names=["x"])
    assert list(task(iter([rows]))) == [rows]
    assert held() - before < 40
    calls = []
    monkeypatch.setattr(runs, "give_back", lambda: calls.append(1))
    with pytest.raises(ZeroDivisionError):
        list(runs.tidy(lambda batches: (1 / 0 for _ in batches))(iter([rows])))
    assert calls == [1]
