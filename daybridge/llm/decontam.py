"""Benchmark decontamination: test phrases searched in an FM-index of each shard of the corpus."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.llm.common import corpus_session, fresh, map_shared, plain_words, utf8, write_shared
from daybridge.llm.fmindex import FMIndex
from daybridge.session import shared_folder

WINDOW = 13

# Bytes of text indexed together, and bytes of test items searched for together.
SHARD_BYTES, BLOCK_BYTES = 8 << 20, 8 << 20

RESULT = ("struct<n_words bigint, n_hit bigint, items array<string>, "
          "spans array<struct<first: bigint, past: bigint>>>")
_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                    ("spans", pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())])))])


@dataclass
class Phrases:
    """A block of the test set: its words, numbered from 1, and its different windows by length."""

    symbols: dict[bytes, int]
    windows: dict[int, np.ndarray]        # length: one window a row
    owners: dict[int, list[list[int]]]    # length: for each window the items it is from
    items: list[str]

    @property
    def bits(self) -> int:
        return max(1, len(self.symbols).bit_length())


def phrases_of(rows: list[tuple[str | None, bytes]], window: int) -> Phrases:
    symbols: dict[bytes, int] = {}
    items = sorted({str(item) for item, _ in rows})
    number = {item: i for i, item in enumerate(items)}
    owners: dict[int, dict[tuple[int, ...], set[int]]] = {}
    for item, text in rows:
        found = [symbols.setdefault(w, len(symbols) + 1) for w in plain_words(text)]
        if found:
            length = min(window, len(found))
            for at in range(len(found) - length + 1):
                owners.setdefault(length, {}).setdefault(tuple(found[at:at + length]), set()).add(number[str(item)])
    return Phrases(symbols, {n: np.array(list(w), np.int64) for n, w in owners.items()},
                   {n: [sorted(x) for x in w.values()] for n, w in owners.items()}, items)


def write_phrases(benchmark: DataFrame, item: str, text: str, window: int, block_bytes: int) -> list[str]:
    """The test set as files of phrases in the shared folder, each of about ``block_bytes`` of text.

    Items are dealt to blocks by a hash; a task makes and writes a block, and the driver gets the paths.
    """
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), utf8(text).alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    folder = shared_folder(spark)

    def write(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        found = sorted(zip(map(str, table["item"].to_pylist()), table["text"].to_pylist()))
        write_shared(f"{folder}/phrases-{block}", pickle.dumps(phrases_of(found, window)))
        return pa.table({"block": pa.array([block], pa.int64())})

    written = (rows.distinct().withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
               .groupBy("block").applyInArrow(write, "block bigint").collect())
    return [f"{folder}/phrases-{r['block']}" for r in sorted(written)]


def search_shard(words: list[list[bytes]], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences of the phrases in the texts of a shard: first word (over all texts), length, window.

    Windows are numbered through the lengths in their order. Only runs of words that the test set
    has, no shorter than its shortest window, can hold an occurrence; the index is built over these.
    """
    none = np.empty(0, np.int64)
    if not phrases.windows:
        return none, none, none
    get = phrases.symbols.get
    count = sum(map(len, words)) + len(words)
    text = np.zeros(count, np.int64)
    at = 0
    for some in words:  # a 0 after each text
        text[at:at + len(some)] = np.fromiter(map(get, some, repeat(0)), np.int64, len(some))
        at += len(some) + 1
    known = np.r_[False, text > 0, False]
    starts = np.flatnonzero(known[1:] & ~known[:-1])
    lengths = np.flatnonzero(~known[1:] & known[:-1]) - starts
    starts, lengths = starts[lengths >= min(phrases.windows)], lengths[lengths >= min(phrases.windows)]
    if not len(starts):
        return none, none, none
    # the kept runs with the 0 (or unknown word) after each
    offsets = np.r_[0, np.cumsum(lengths + 1)]
    origin = np.repeat(starts - offsets[:-1], lengths + 1) + np.arange(offsets[-1])
    runs = text[np.minimum(origin, count - 1)]
    runs[offsets[1:] - 1] = 0
    index = FMIndex(runs, phrases.bits)
    first, length, window, before = [none], [none], [none], 0
    for size, rows in sorted(phrases.windows.items()):
        low, high = index.ranges(rows)
        times = high - low
        found = np.repeat(low - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())
        first.append(origin[index.locate(found)])
        length.append(np.full(len(found), size))
        window.append(np.repeat(np.arange(len(rows)), times) + before)
        before += len(rows)
    return np.concatenate(first), np.concatenate(length), np.concatenate(window)


def _shard_result(texts: list[bytes], blocks: list[str], cache: dict) -> list[dict]:
    if not texts:
        return []
    words = [plain_words(t) for t in texts]
    begins = np.r_[0, np.cumsum([len(w) + 1 for w in words])]
    items: list[set[str]] = [set() for _ in texts]
    change = np.zeros(begins[-1] + 1, np.int64)
    for path in blocks:
        if path not in cache:  # one block at a time stays in memory
            cache.clear()
            cache[path] = pickle.loads(map_shared(path, "u1").tobytes())
        phrases = cache[path]
        owners = [x for _, w in sorted(phrases.owners.items()) for x in w]
        first, length, window = search_shard(words, phrases)
        np.add.at(change, first, 1)
        np.add.at(change, first + length, -1)
        doc = np.searchsorted(begins, first, "right") - 1
        pairs = np.unique(doc * (len(owners) + 1) + window)
        for d, w in zip((pairs // (len(owners) + 1)).tolist(), (pairs % (len(owners) + 1)).tolist()):
            items[d].update(phrases.items[i] for i in owners[w])
    hit = np.r_[False, np.cumsum(change[:-1]) > 0, False]
    first = np.flatnonzero(hit[1:] & ~hit[:-1])
    past = np.flatnonzero(~hit[1:] & hit[:-1])
    spans: list[list[dict]] = [[] for _ in texts]
    doc = np.searchsorted(begins, first, "right") - 1
    for d, a, b in zip(doc.tolist(), (first - begins[doc]).tolist(), (past - begins[doc]).tolist()):
        spans[d].append({"first": a, "past": b})
    return [{"n_words": len(w), "n_hit": sum(s["past"] - s["first"] for s in spans[d]), "items": sorted(items[d]),
             "spans": spans[d]} for d, w in enumerate(words)]


def contamination(text: str, blocks: list[str], shard_bytes: int = SHARD_BYTES) -> Column:
    """A struct of what ``decontaminate`` finds in a text column."""

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        texts, size, cache = [], 0, {}
        for batch in batches:
            for one in batch.to_pylist():
                texts.append(one)
                size += len(one)
                if size >= shard_bytes:
                    yield pa.array(_shard_result(texts, blocks, cache), _ARROW)
                    texts, size = [], 0
        yield pa.array(_shard_result(texts, blocks, cache), _ARROW)

    return run.asNondeterministic()(utf8(text))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                  shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, str]:
    """The rows as they are with one more column, and its name: a struct of what occurs in the text.

    ``n_words``; ``n_hit`` (words inside an occurrence of a window); ``items`` (ids of test items with
    a window that occurs, as sorted text); ``spans`` (merged stretches of hit words, to remove).
    ``contaminated`` is left to ``is_contaminated``. A window is ``window`` consecutive words of an
    item; a shorter item is one window, an empty or null one none. Null and empty texts have no words;
    repeated rows each get their result; a null item id counts as the text "None"; an empty test set
    hits nothing.

    Rows do not move: each task indexes its texts in shards of bounded size and searches all windows
    in each. A larger test set is searched block after block, so a worker never holds more than one.
    """
    corpus_session(docs.sparkSession)
    blocks = write_phrases(benchmark, item, item_text, window, block_bytes)
    name, = fresh(docs, "found")
    return docs.withColumn(name, contamination(text, blocks, shard_bytes)), name


def is_contaminated(found: str) -> Column:
    """Hit, and at least one word in twenty is."""
    return (F.col(f"{found}.n_hit") > 0) & (20 * F.col(f"{found}.n_hit") >= F.col(f"{found}.n_words"))
