"""Near-duplicates by SimHash, found through fuzzy Golay keys."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.llm.common import corpus_session, joined_by_group, located, spaced_words, staged, utf8
from daybridge.llm.components import components
from daybridge.llm.golay import fuzzy_keys

SEED, SEGMENTS, SEGMENT_BITS = 42, 4, 16

# A bucket of more different fingerprints than this is linked through probes, not pair by pair.
CROWD = 8192

# Buckets up to this size are compared all at once, larger ones one after the other.
SMALL = 32

_BIT_OF_BYTE = np.arange(256)[:, None] >> np.arange(7, -1, -1) & 1
_BYTE_PLACE = 256 * np.arange(8)


def fingerprint(text: bytes, words_per_shingle: int) -> int:
    """The 64-bit SimHash of a text, 0 without words; a bit is set if over half the hashes set it."""
    words = spaced_words(text)
    if not words:
        return 0
    if len(words) <= words_per_shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*[words[i:] for i in range(words_per_shingle)]))
    count = len(words) - words_per_shingle + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, count).astype(">u8")
    places = (hashes.view(np.uint8).reshape(-1, 8) + _BYTE_PLACE).ravel()
    votes = (np.bincount(places, minlength=2048).reshape(8, 256) @ _BIT_OF_BYTE).ravel()
    return int.from_bytes(np.packbits(2 * votes > count).tobytes(), "big")


def fingerprints(text: str, words_per_shingle: int) -> Column:
    """The fingerprint of a text column as a long."""

    @F.arrow_udf("bigint")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [fingerprint(t, words_per_shingle) for t in batch.to_pylist()]
            yield pa.array(np.array(found, np.uint64).view(np.int64))

    return run.asNondeterministic()(utf8(text))


def fuzzy_bucket_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (index into prints, key): one segment exactly, the next as the indices of near codewords.

    Up to three differing bits leave one of four segments untouched. If no segment has all three, the
    untouched one's successor has two at most; if one has, three are untouched and two of them come
    before an untouched one. A successor with two differing bits at most shares a codeword index.
    """
    table = fuzzy_keys(SEGMENT_BITS)
    rows, keys = [], []
    segments = [(prints >> np.uint64(SEGMENT_BITS * s)).astype(np.int64) & 0xFFFF for s in range(SEGMENTS)]
    for s in range(SEGMENTS):
        near = table[segments[(s + 1) % SEGMENTS]].astype(np.int64)
        row, column = np.nonzero(near >= 0)
        rows.append(row)
        keys.append(s << 28 | segments[s][row] << 12 | near[row, column])
    return np.concatenate(rows), np.concatenate(keys)


def _bucket_links(keys: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect, within each run of equal keys, all fingerprints a chain of near ones joins."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    sizes = np.diff(np.r_[starts, len(keys)])
    small = np.repeat(sizes <= SMALL, sizes)
    left, right = [], []
    for step in range(1, min(SMALL, sizes.max(initial=0))):
        at = np.flatnonzero((keys[step:] == keys[:-step]) & small[step:])
        near = at[np.bitwise_count(prints[at] ^ prints[at + step]) <= distance]
        left.append(prints[near])
        right.append(prints[near + step])
    for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        rest = prints[start:start + size]
        while len(rest):
            root, front, rest = rest[0], [rest[0]], rest[1:]
            while front and len(rest):
                near = np.bitwise_count(rest ^ front.pop()) <= distance
                if near.any():
                    front.extend(rest[near])
                    left.append(np.full(int(near.sum()), root))
                    right.append(rest[near])
                    rest = rest[~near]
    none = [np.empty(0, np.uint64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def _links_of_sorted(batches: Iterator[pa.RecordBatch], distance: int, crowd: int) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by key: links, and the members of crowded buckets with a null beside them."""

    def links(left, right):
        return pa.record_batch([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], ["a", "b"])

    def members(prints):
        return pa.record_batch([pa.array(prints.view(np.int64)), pa.nulls(len(prints), pa.int64())], ["a", "b"])

    keys, prints, crowded = np.empty(0, np.int64), np.empty(0, np.uint64), None
    for batch in batches:
        keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
        prints = np.concatenate([prints, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        if crowded is not None:
            more = int(np.searchsorted(keys, crowded, "right"))
            yield members(prints[:more])
            keys, prints = keys[more:], prints[more:]
            if not len(keys):
                continue
            crowded = None
        if not len(keys):
            continue
        whole = int(np.searchsorted(keys, keys[-1], "left"))
        yield links(*_bucket_links(keys[:whole], prints[:whole], distance))
        keys, prints = keys[whole:], prints[whole:]
        if len(keys) > crowd:
            crowded = keys[-1]
            yield members(prints)
            keys, prints = keys[:0], prints[:0]
    yield links(*_bucket_links(keys, prints, distance))


def _crowd_links(prints: DataFrame, distance: int) -> DataFrame:
    """Links among fingerprints up to ``distance`` apart, without comparing pairs.

    Each fingerprint marks the 64-bit values up to two bits from it (for three bits apart). Where a
    value has a member one bit away or nearer, all its members are within three bits of that one and
    are linked to it; and two fingerprints three bits apart meet at a value one bit from the first and
    two from the second. Shorter distances split in two in the same way.
    """
    inner = distance // 2
    masks = [sum(1 << b for b in places) for w in range(distance - inner + 1) for places in combinations(range(64), w)]

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.array(masks, np.uint64)
        close = np.bitwise_count(mask) <= inner
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(values), 64):
                some = values[at:at + 64]
                yield pa.record_batch([pa.array((some[:, None] ^ mask).ravel().view(np.int64)),
                                       pa.array(np.repeat(some, len(mask)).view(np.int64)),
                                       pa.array(np.tile(close, len(some)))], ["probe", "a", "close"])

    marked = staged(prints.mapInArrow(probes, "probe bigint, a bigint, close boolean"))
    centres = (marked.groupBy("probe").agg(F.count("*").alias("n"), F.min(F.when(F.col("close"), F.col("a"))).alias("b"))
               .where("n > 1 and b is not null").select("probe", "b"))
    return marked.join(centres, "probe").where("a <> b").select("a", "b").distinct()


def near_links(prints: DataFrame, distance: int = 3, crowd: int = CROWD) -> DataFrame:
    """Links ``a, b`` between different fingerprints that join all that are up to three bits apart.

    Not every pair is listed: a bucket of fingerprints gives fewer links than pairs, and the chains
    of links reach exactly what the chains of pairs reach. ``prints`` is one column of distinct longs.
    """
    if not 0 <= distance <= 3:
        raise ValueError("the segments cover distances up to 3")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            rows, keys = fuzzy_bucket_keys(values.view(np.uint64))
            yield pa.record_batch([pa.array(keys), pa.array(values[rows])], ["key", "print"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _links_of_sorted(batches, distance, crowd)

    buckets = (prints.mapInArrow(keyed, "key bigint, print bigint")
               .repartition("key").sortWithinPartitions("key"))
    found = staged(buckets.mapInArrow(linked, "a bigint, b bigint"))
    links = found.where("b is not null").distinct()
    crowds = found.where("b is null").select("a").distinct()
    if crowds.isEmpty():
        return links
    return links.unionByName(_crowd_links(crowds, distance))


def simhash_components(docs: DataFrame, id: str = "doc_id", text: str = "text", words_per_shingle: int = 3,
                       distance: int = 3) -> tuple[DataFrame, DataFrame, list[str]]:
    """Every row's ``fingerprint`` (long), ``component_id`` and ``kept``, the documents with their row columns, and these columns' names.

    Fingerprints link at ``distance`` or fewer differing bits; a component's id is the smallest id in
    it, and the row with that id stays (of rows with the same id, one). Empty and null texts have
    fingerprint 0 and link like any other; a null id is larger than any. An empty table gives no rows.
    Texts are read once; equal fingerprints are one node, so copies make no links at all, and neither
    a fingerprint nor a component with a large part of all rows is brought together in one task.
    """
    corpus_session(docs.sparkSession)
    placed, place = located(docs)
    rows = staged(placed.select(*place, F.col(f"`{id}`").alias("doc_id"),
                                fingerprints(text, words_per_shingle).alias("fingerprint")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *place))
    classes = staged(rows.groupBy("fingerprint").agg(first.alias("first"), F.count("*").alias("members")))
    roots = components(near_links(classes.select("fingerprint"), distance)).withColumnRenamed("node", "fingerprint")
    rooted = staged(classes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
                    .select("fingerprint", "members", "root", "first"))
    whole = staged(rooted.groupBy("root").agg(F.min("first").alias("stays"), F.count("*").alias("prints")))
    named = staged(joined_by_group(rooted, whole, ["root"], "prints", "inner").select("fingerprint", "members", "stays"))
    is_kept = F.lit(True)
    for name in place:
        is_kept = is_kept & (F.col(name) == F.col(f"stays.{name}"))
    return joined_by_group(rows, named, ["fingerprint"], "members", "inner").select(
        *place, "doc_id", "fingerprint", F.col("stays.doc_id").alias("component_id"), is_kept.alias("kept")), placed, place
