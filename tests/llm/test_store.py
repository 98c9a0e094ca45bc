"""The array store: which shards are there, and where a folder lies."""

import os

import numpy as np
import pytest

from quarry.llm import store
from quarry.llm.common import shared_dir


def test_find_in_shards(tmp_path):
    folder, rng = str(tmp_path), np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2))
    shard = (keys >> np.uint64(61)).astype(int)
    for i in set(shard.tolist()):
        store.save(folder, f"key-{i:06d}", keys[shard == i])
        store.save(folder, f"n-{i:06d}", np.arange(len(keys))[shard == i])
    there = frozenset(shard.tolist())
    wanted = np.unique(np.r_[keys[::3], keys[::5] + np.uint64(1)])
    hit, (n,) = store.Shards(folder, 3, "key", ("n",), there).find(wanted)
    place = {k: i for i, k in enumerate(keys.tolist())}
    assert hit.tolist() == [k in place for k in wanted.tolist()]
    assert n.tolist() == [place.get(k, 0) for k in wanted.tolist()]


def test_a_missing_shard_raises_and_an_unwritten_one_is_empty(tmp_path):
    store.save(str(tmp_path), "key-000001", np.array([1 << 63], np.uint64))
    low, high = np.array([5], np.uint64), np.array([1 << 63], np.uint64)
    assert not store.Shards(str(tmp_path), 1, "key", (), frozenset([1])).find(low)[0].any()
    assert store.Shards(str(tmp_path), 1, "key", (), frozenset([1])).find(high)[0].all()
    with pytest.raises(FileNotFoundError, match="shared"):
        store.Shards(str(tmp_path), 1, "key", (), frozenset([0, 1])).find(low)


def test_folders_name_their_file_system(spark):
    """Also where spark.checkpoint.dir has no scheme, as here."""
    assert "://" not in spark.conf.get("spark.checkpoint.dir")
    folder = shared_dir(spark, "x")
    assert folder.startswith("file:") and os.path.isabs(store.local(folder))
    assert store.local("hdfs://host/user/x") is None and store.local("viewfs://s/x") is None
