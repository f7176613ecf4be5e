"""What operators leave in the shared folder and keep in memory: no files of checksums, small memos."""

from __future__ import annotations

from pathlib import Path

import numpy as np

from tidemark.llm import alignment, common


def folders(spark):
    return set(Path(common.shared_folder(spark).removeprefix("file:")).glob("*-*"))


def test_staged_files_have_no_checksum_files(spark):
    before = folders(spark)
    assert common.stage(spark.range(10), "small-files").count() == 10
    (new,) = folders(spark) - before
    assert list(new.glob("*.parquet")) and not list(new.glob(".*.crc"))


def test_memo_keeps_what_is_used_most(monkeypatch):
    monkeypatch.setattr(alignment, "MEMO", 64)
    given = []

    def give(parts):
        given.extend(parts)
        return np.concatenate([[int(p), int(p) + 1] for p in parts]).astype(np.int64), np.full(len(parts), 2)

    tokens = alignment.Tokens(give, [b"1"] * 5000)
    often = [str(i) for i in range(16)]
    for turn in range(20):
        parts = often * 3 + [str(100 + 50 * turn + k) for k in range(50)]
        found = tokens.spread(tokens(parts)).reshape(-1, 2)
        assert found.tolist() == [[int(p), int(p) + 1] for p in parts]
        assert len(tokens.memo) == len(tokens.count) == len(tokens.used) == len(tokens.whole) <= 64 + 66
    assert all(given.count(p) == 1 for p in often)
