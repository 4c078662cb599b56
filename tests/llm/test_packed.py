import numpy as np
import pytest

from daybridge.llm import common, packed
from daybridge.llm.lm import scramble, train, unscramble
from daybridge.llm.packed import Maps, Table, pack_counts, pack_run, pack_table, range_of, shard_of, unpack_counts, unpack_run


@pytest.mark.parametrize("bits", [1, 2, 5, 16, 31, 33, 42, 63, 64])
def test_runs_and_tables_against_plain_arrays(bits):
    rng = np.random.default_rng(bits)
    for shards in (1, 3, 16, 100):
        for n in (0, 1, 5, 3000):
            keys = np.unique(rng.integers(0, (1 << bits) - 1, n, dtype=np.uint64, endpoint=True))
            shard = shard_of(keys, shards, bits)
            for s in range(shards):
                first, span = range_of(s, shards, bits)
                own = keys[shard == s]
                assert all(first <= int(k) < first + span for k in own)
                assert (unpack_run(pack_run(own, first, span), first, span) == own).all()
                table = Table(np.frombuffer(pack_table(own, first, span), np.uint8), first)
                assert (table.keys() == own).all() and (table.keys(np.arange(len(own))[::3]) == own[::3]).all()
                asked = np.unique(np.r_[own, rng.integers(first, first + span - 1, 40, dtype=np.uint64, endpoint=True)])
                assert (table.find(asked) == np.where(np.isin(asked, own), np.searchsorted(own, asked), -1)).all()


def test_clustered_keys():
    """Keys need not be spread evenly: all in one bucket, or at both ends."""
    for keys in (np.arange(5000), (1 << 40) - 1 - np.arange(5000)[::-1], np.r_[0, 1, (1 << 40) - 1]):
        keys = keys.astype(np.uint64)
        assert (unpack_run(pack_run(keys, 0, 1 << 40), 0, 1 << 40) == keys).all()
        assert (Table(np.frombuffer(pack_table(keys, 0, 1 << 40), np.uint8), 0).find(keys) == np.arange(len(keys))).all()


def test_bytes_a_key():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 42, 1 << 20, dtype=np.uint64))
    assert len(pack_run(keys, 0, 1 << 42)) < 3.2 * len(keys)
    assert len(pack_table(keys, 0, 1 << 42)) < 4.1 * len(keys)


def test_counts():
    counts = np.r_[np.arange(600), 1 << 40, 254, 255, 256, 0]
    assert (unpack_counts(pack_counts(counts)) == counts).all()
    found = packed.counts_of(np.frombuffer(pack_counts(counts), np.uint8))
    at = np.array([0, 254, 255, 256, 600, 599, 604, 255])
    assert (found.at(at) == counts[at]).all()
    assert len(unpack_counts(pack_counts(np.empty(0, np.int64)))) == 0


@pytest.mark.parametrize("bits", [1, 2, 3, 7, 8, 20, 33, 64])
def test_scramble_is_a_bijection(bits):
    x = np.arange(1 << bits, dtype=np.uint64) if bits <= 8 else np.random.default_rng(1).integers(0, 1 << min(bits, 63), 5000, dtype=np.uint64)
    mixed = scramble(x, bits)
    assert (unscramble(mixed, bits) == x).all() and (bits == 64 or int(mixed.max()) < 1 << bits)
    assert bits > 8 or len(np.unique(mixed)) == len(x)


def test_mappings_are_bounded(monkeypatch, documents):
    """However many shards a model has, a process holds a fixed number of mappings, and no handle for any."""
    import os

    made = []
    maps = Maps()
    monkeypatch.setattr(packed, "MAPPED", 5)
    for i in [*range(50), 49, 48, 0]:
        maps.get(i, lambda: made.append(i) or i)
    assert len(maps.held) == 5 and made == [*range(50), 0]
    texts = [(r.text or "").encode() for r in documents.limit(30).collect()]
    model = train(documents, shards=40, order=3)
    before = len(os.listdir("/proc/self/fd"))
    scores = model.score(texts)
    assert len(model.bigrams.maps.held) <= 5 and len(os.listdir("/proc/self/fd")) <= before + 2
    monkeypatch.setattr(packed, "MAPPED", 8192)
    assert model.score(texts) == scores


def test_store_names():
    assert common.store_path("s3a://bucket/a/b") == "s3://bucket/a/b"
    assert common.store_path("hdfs://name:8020/a") == "hdfs://name:8020/a"
    assert common._plain_path("file:///a/b") == common._plain_path("file:/a/b") == "/a/b" and common._plain_path("s3a://x/y") is None


def test_files_of_a_store(monkeypatch, folder):
    """Paths of a store go through its file system; here that is a folder behind another name."""
    from pyarrow import fs

    asked = []

    class Stores:
        @staticmethod
        def from_uri(uri):
            asked.append(uri)
            return fs.LocalFileSystem(), folder + "/" + uri.split("://", 1)[1]

    monkeypatch.setattr(fs, "FileSystem", Stores)
    common.write_shared("s3a://bucket/m/table", b"12345678")
    assert common.map_shared("s3a://bucket/m/table", "<u8").tolist() == [int.from_bytes(b"12345678", "little")]
    assert set(asked) == {"s3://bucket/m/table"}
