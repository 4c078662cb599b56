"""Interpolated modified Kneser-Ney model of order 2 or 3, counted in Spark and memory-mapped for scoring.

Words are numbered by their place in the sorted array of their hashes, so a bigram is one number of twice as
many bits as a word's, exactly; a trigram is the place of its first two words in the sorted array of bigrams,
and a word. Numbers are scrambled by a bijection of their bits before they are sorted: the sorted arrays then
part evenly into shards whatever words are frequent, and neither a hot word nor a hot context lands
in one task.

Counts travel as Elias-Fano runs and lie in packed tables (``packed``): about four bytes a bigram or trigram
in the shuffle, and as many in the model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.llm.common import corpus_session, fresh, map_shared, spaced_words, utf8, write_shared
from daybridge.llm.packed import (Maps, ShardedTable, pack_counts, pack_run, range_of, shard_of, unpack_counts,
                                  unpack_run)
from daybridge.session import shared_folder

# The end of a text: no word has white space. It also stands before the first word.
END = b"\n"

# Tokens that a task counts before it hands them on, and tokens scored together.
COUNT_TOKENS, SCORE_TOKENS = 2_000_000, 1_000_000

# Bytes of text for each shard, which one task merges: some five million tokens.
SHARD_TEXT = 32 << 20

MOST_WORDS = 1 << 32


def word_hashes(text: bytes) -> np.ndarray:
    words = spaced_words(text)
    words.append(END)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


# Two odd multipliers, and their inverses modulo 2^64.
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_UNMIX = tuple(pow(m, -1, 1 << 64) for m in _MIX)


def _mixed(x: np.ndarray, factors: tuple[int, int], bits: int) -> np.ndarray:
    half, mask = np.uint64((bits + 1) // 2), np.uint64((1 << bits) - 1)
    for factor in factors:
        x = (x ^ (x >> half)) * np.uint64(factor) & mask
    return x ^ (x >> half)


def scramble(x: np.ndarray, bits: int = 64) -> np.ndarray:
    """A bijection of the numbers below ``2 ** bits`` under which any set of them is spread evenly."""
    return _mixed(x, _MIX, bits)


def unscramble(x: np.ndarray, bits: int = 64) -> np.ndarray:
    return _mixed(x, _UNMIX[::-1], bits)


def bits_of(count: int) -> int:
    """Bits that number ``count`` things."""
    return max(1, (count - 1).bit_length())


def _sum_equal(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")  # the parts are sorted: a merge
    keys, values = keys[order], values[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[starts], np.add.reduceat(values, starts) if len(starts) else values


_COUNTED = "shard int, keys binary, counts binary"


def _counted(parts: list[np.ndarray], shards: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Sorted keys and their counts, one row for each shard they fall in."""
    keys, counts = np.unique(np.concatenate(parts), return_counts=True)
    edges = np.searchsorted(shard_of(keys, shards, bits), np.arange(shards + 1))
    filled = np.flatnonzero(np.diff(edges)).tolist()
    yield pa.record_batch([
        pa.array(filled, pa.int32()),
        pa.array([pack_run(keys[edges[s]:edges[s + 1]], *range_of(s, shards, bits)) for s in filled], pa.binary()),
        pa.array([pack_counts(counts[edges[s]:edges[s + 1]]) for s in filled], pa.binary()),
    ], ["shard", "keys", "counts"])


def _flushed(batches: Iterator[pa.RecordBatch], per_text: Callable, shards: int, bits: int) -> Iterator[pa.RecordBatch]:
    parts, size = [], 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            parts.append(word_hashes(text))
            size += len(parts[-1])
            if size >= COUNT_TOKENS:
                yield from _counted(per_text(parts), shards, bits)
                parts, size = [], 0
    if parts:
        yield from _counted(per_text(parts), shards, bits)


def _merged(table: pa.Table, shards: int, bits: int) -> tuple[int, np.ndarray, np.ndarray]:
    shard = table["shard"][0].as_py()
    first, span = range_of(shard, shards, bits)
    keys = np.concatenate([unpack_run(k, first, span) for k in table["keys"].to_pylist()])
    counts = np.concatenate([unpack_counts(c) for c in table["counts"].to_pylist()])
    return shard, *_sum_equal(keys, counts)


def _discounts(n: list[int]) -> list[float]:
    """What is taken off a count of 0, 1, 2 and 3 or more, from the numbers of counts 1 to 4."""
    n1, n2, n3, n4 = n
    if not (n1 and n2 and n3):
        return [0.0, 0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [0.0, *[min(max(d, 0.0), float(k)) for k, d in enumerate(found, 1)]]


def _texts_of(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different words of some texts, each token's place among them, where the texts start, their lengths."""
    lengths = np.array([len(p) for p in parts])
    kinds, token = np.unique(np.concatenate(parts), return_inverse=True)
    return kinds, token, np.cumsum(lengths) - lengths, lengths


# What a shard's job tells the driver: its number, size and tokens, and how many counts are 1, 2, 3 and 4.
_TOLD = "shard int, size bigint, tokens bigint, n1 bigint, n2 bigint, n3 bigint, n4 bigint"


def _told(shard: int, counts: np.ndarray) -> pa.Table:
    row = [len(counts), int(counts.sum()), *[int((counts == k).sum()) for k in (1, 2, 3, 4)]]
    return pa.table({"shard": pa.array([shard], pa.int32()), **{c.split(" ")[0]: [v] for c, v in zip(_TOLD.split(", ")[1:], row)}})


def _sizes(told: list, shards: int) -> list[int]:
    sizes = {r["shard"]: r["size"] for r in told}
    return [sizes.get(s, 0) for s in range(shards)]


def _occurring(told: list) -> list[int]:
    return [sum(r[f"n{k}"] for r in told) for k in (1, 2, 3, 4)]


# --- amounts: what the grams of a shard add to their contexts and shorter grams, which other shards hold ---

_AMOUNTS = "part int, kind string, places binary, amounts binary"


def _amounts(kind: str, places: np.ndarray, columns: list[np.ndarray], starts: np.ndarray) -> Iterator[tuple]:
    """A row for each part that some of the ascending places fall in; ``starts`` are the parts' first places."""
    edges = np.searchsorted(places, starts)
    for p in np.flatnonzero(np.diff(edges)).tolist():
        a, b = edges[p], edges[p + 1]
        yield (p, kind, pack_run(places[a:b].astype(np.uint64), int(starts[p]), int(starts[p + 1] - starts[p])),
               pack_counts(np.concatenate([c[a:b] for c in columns])))


def _context_columns(at: np.ndarray, counts: np.ndarray, size: int) -> list[np.ndarray]:
    """Of each context how often it occurs, and how many words follow it once, twice, and more often."""
    ranks = np.minimum(counts, 3)
    return [np.bincount(at, counts, size).astype(np.int64), *[np.bincount(at, ranks == k, size).astype(np.int64) for k in (1, 2, 3)]]


def _spread(spark, shards: int, amounts: Callable[[int], Iterator[tuple]]) -> DataFrame:
    """The amounts of all shards, each read from its files by a task, and a row for every part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                for row in [(shard, "none", b"", b""), *amounts(shard)]:
                    yield pa.record_batch([pa.array([row[0]], pa.int32()), pa.array([row[1]]), pa.array([row[2]], pa.binary()),
                                           pa.array([row[3]], pa.binary())], ["part", "kind", "places", "amounts"])

    return spark.range(0, shards, 1, shards).mapInArrow(run, _AMOUNTS).groupBy("part")


def _added(table: pa.Table, first: int, size: int) -> tuple[int, np.ndarray, np.ndarray]:
    """A part's number, its contexts' four amounts and how many words go on to each of its grams."""
    context, continued = np.zeros((4, size), np.int64), np.zeros(size, np.int64)
    for kind, places, amounts in zip(*[table[c].to_pylist() for c in ("kind", "places", "amounts")]):
        if kind == "none":
            continue
        at = (unpack_run(places, first, size) - np.uint64(first)).astype(np.int64)
        if kind == "context":
            context[:, at] += unpack_counts(amounts).reshape(4, -1)
        else:
            continued[at] += unpack_counts(amounts)
    return table["part"][0].as_py(), context, continued


def _left(context: np.ndarray, discounts: list[float]) -> np.ndarray:
    """The share of each context that its discounts leave to the shorter ones."""
    taken = discounts[1] * context[1] + discounts[2] * context[2] + discounts[3] * context[3]
    return np.where(context[0] > 0, taken / np.maximum(context[0], 1), 1.0)


@dataclass
class Contexts:
    """How often each gram is a context, and the share that its discounts leave, by place in the shorter array.

    Few contexts differ in these: a shard's file has the different ones, and a small number for each gram.
    """

    folder: str
    name: str
    starts: np.ndarray    # of the shards, and past the last
    maps: Maps = field(default_factory=Maps, repr=False)

    def write(self, shard: int, context: np.ndarray, discounts: list[float]) -> None:
        # nearly all amounts are small: four of them are one number to sort by
        small = (context < 1 << 16).all(0)
        packed, own = np.unique(sum(context[i, small].astype(np.uint64) << np.uint64(16 * i) for i in range(4)), return_inverse=True)
        large, others = np.unique(context[:, ~small], axis=1, return_inverse=True)
        kinds = np.concatenate([np.stack([packed >> np.uint64(16 * i) & np.uint64(0xFFFF) for i in range(4)]).astype(np.int64), large], 1)
        codes = np.empty(context.shape[1], np.int64)
        codes[small], codes[~small] = own, others.reshape(-1) + len(packed)
        width = next(w for w in (1, 2, 4) if kinds.shape[1] <= 1 << 8 * w)
        write_shared(f"{self.folder}/{self.name}-{shard}", b"".join([
            np.array([kinds.shape[1], width], "<u8").tobytes(), kinds[0].astype("<f8").tobytes(),
            _left(kinds, discounts).astype("<f8").tobytes(), codes.astype(f"<u{width}").tobytes()]))

    def _read(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        data = map_shared(f"{self.folder}/{self.name}-{shard}", np.uint8)
        n, width = data[:16].view("<u8").astype(np.int64).tolist()
        return data[16:16 + 16 * n].view("<f8").reshape(2, n), data[16 + 16 * n:].view(f"<u{width}")

    def at(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total, rest = np.zeros(len(place)), np.ones(len(place))
        shard = np.searchsorted(self.starts, place, "right") - 1
        for s in np.unique(shard).tolist():
            own = shard == s
            kinds, codes = self.maps.get(s, lambda: self._read(s))
            total[own], rest[own] = kinds[:, codes[place[own] - self.starts[s]]]
        return total, rest


@dataclass
class TrigramModel:
    """What order 3 adds: trigrams, and what is known of each bigram as a context."""

    trigrams: ShardedTable
    contexts: Contexts
    discounts: list[float]
    word_bits: int

    def chances(self, place: np.ndarray, number: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probabilities after the bigrams in these places of words by number (-1 if unknown), given those of order 2."""
        order = np.argsort(place, kind="stable")  # so that contexts are read in their order
        total, rest = np.empty(len(place)), np.empty(len(place))
        total[order], rest[order] = self.contexts.at(place[order])
        times = np.zeros(len(place), np.int64)
        known = np.flatnonzero(number >= 0)
        key = _pairs(place[known], number[known], self.word_bits, self.trigrams.bits)
        order = np.argsort(key)
        times[known[order]] = self.trigrams.find(key[order])[1]
        off = np.array(self.discounts)[np.minimum(times, 3)]
        return np.maximum(times - off, 0) / np.maximum(total, 1) + rest * lower


def _pairs(left: np.ndarray, number: np.ndarray, word_bits: int, bits: int) -> np.ndarray:
    """The scrambled number of a place, of a word or bigram, and the number of the word after it."""
    return scramble(left.astype(np.uint64) << np.uint64(word_bits) | number.astype(np.uint64), bits)


@dataclass
class NgramModel:
    words: ShardedTable
    bigrams: ShardedTable
    contexts: Contexts    # of words, by number
    continued: ShardedTable    # in its files' counts: how many words each word follows
    tokens: int
    types: int
    bigram_discounts: list[float]
    word_discounts: list[float]
    continuations: int    # different bigrams
    word_rest: float      # share of the words' own distribution that goes to the even one
    longer: TrigramModel | None = None

    def _continued(self, numbers: np.ndarray) -> np.ndarray:
        """How many words each of these follows; they ascend."""
        found, starts = np.zeros(len(numbers), np.int64), self.words.starts
        edges = np.searchsorted(numbers, starts)
        for s in np.flatnonzero(np.diff(edges)).tolist():
            a, b = edges[s], edges[s + 1]
            found[a:b] = self.continued.counts(s).at(numbers[a:b] - starts[s])
        return found

    def score(self, texts: list[bytes]) -> list[tuple[int, int, float, float]]:
        """Of each text the tokens, the known ones, and the log10 probability by base and by model."""
        if not texts:
            return []
        kinds, token, starts, lengths = _texts_of([word_hashes(t) for t in texts])
        number, count = self.words.find(kinds)
        known = number >= 0
        base = np.log10((count + 1) / (self.tokens + self.types + 1))
        own = np.full(len(kinds), 1 / (self.types + 1))
        total, rest = np.zeros(len(kinds)), np.ones(len(kinds))
        if self.types:
            continued = np.zeros(len(kinds), np.int64)
            continued[known] = self._continued(number[known])  # the order of hashes is that of numbers
            total[known], rest[known] = self.contexts.at(number[known])
            off = np.array(self.word_discounts)[np.minimum(continued, 3)]
            own = np.maximum(continued - off, 0) / self.continuations + self.word_rest / (self.types + 1)
        end = int(np.searchsorted(kinds, xxhash.xxh3_64_intdigest(END)))
        before = np.r_[0, token[:-1]]
        before[starts] = end
        both = np.flatnonzero(known[token] & known[before])
        times, place = np.zeros(len(token), np.int64), np.full(len(token), -1, np.int64)
        if len(both):
            pair = _pairs(number[before[both]], number[token[both]], bits_of(self.types), self.bigrams.bits)
            order = np.argsort(pair)
            place[both[order]], times[both[order]] = self.bigrams.find(pair[order])
        off = np.array(self.bigram_discounts)[np.minimum(times, 3)]
        chance = np.maximum(times - off, 0) / np.maximum(total[before], 1) + rest[before] * own[token]
        if self.longer:
            context = np.r_[-1, place[:-1]]
            context[starts] = -1  # the first word has no more than the end before it
            after = np.flatnonzero(context >= 0)
            chance[after] = self.longer.chances(context[after], number[token[after]], chance[after])
        return list(zip(lengths.tolist(), np.add.reduceat(known[token].astype(np.int64), starts).tolist(),
                        np.add.reduceat(base[token], starts).tolist(),
                        np.add.reduceat(np.log10(chance), starts).tolist()))


def train(docs: DataFrame, text: str = "text", shards: int | None = None, order: int = 2) -> NgramModel:
    """Count and write the model of all texts; its files lie in the shared folder.

    Passes of pre-aggregated counts: words; bigrams by word numbers; at order 3 trigrams by bigram places, where a
    bigram counts as often as different words stand before it in one, and those after the end of a text, which
    have no such word, as often as they occur. Then each shard's file is read once, by one task, for what its
    grams add to contexts and shorter grams. The driver sees a row of totals for each shard.
    """
    if order not in (2, 3):
        raise ValueError(f"order {order}: the model is of order 2 or 3")
    spark = corpus_session(docs.sparkSession)
    folder = shared_folder(spark)
    texts = docs.select(utf8(text).alias("text"))
    if not shards:
        size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
        shards = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_TEXT))

    def counted(name: str, bits: int, per_text: Callable, kept: Callable) -> tuple[ShardedTable, list]:
        """A pass over the texts: the sorted table of what ``per_text`` makes of them; ``kept`` writes its counts."""
        table = ShardedTable(folder, name, bits, [0] * shards)

        def count(batches):
            return _flushed(batches, per_text, shards, bits)

        def write(rows: pa.Table) -> pa.Table:
            shard, keys, counts = _merged(rows, shards, bits)
            table.write_keys(shard, keys)
            kept(table, shard, keys, counts)
            return _told(shard, counts)

        told = texts.mapInArrow(count, _COUNTED).groupBy("shard").applyInArrow(write, _TOLD).collect()
        table.sizes = _sizes(told, shards)
        return table, told

    def with_counts(table, shard, keys, counts):
        table.write_counts(shard, counts)

    words, told = counted("words", 64, lambda parts: parts, with_counts)
    types, tokens = sum(words.sizes), sum(r["tokens"] for r in told)
    if types >= MOST_WORDS:
        raise ValueError(f"{types} different words; a bigram of word numbers holds {MOST_WORDS}")
    contexts, continued = Contexts(folder, "word-contexts", words.starts), ShardedTable(folder, "continued", 64, words.sizes)
    if not types:
        return NgramModel(words, ShardedTable(folder, "bigrams", 2, [0] * shards), contexts, continued, 0, 0,
                          _discounts([0] * 4), _discounts([0] * 4), 1, 1.0)
    shared = spark.sparkContext.broadcast(words)
    word_bits = bits_of(types)
    pair_bits = 2 * word_bits

    def placed(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bigrams, the numbers of their second words, and where texts start."""
        kinds, token, starts, lengths = _texts_of(parts)
        number = shared.value.find(kinds, counted=False)[0][token]
        before = np.r_[number[:1], number[:-1]]
        before[starts] = number[starts + lengths - 1]  # the end, which is every text's last token
        return _pairs(before, number, word_bits, pair_bits), number, starts

    if order == 2:
        bigrams, told = counted("bigrams", pair_bits, lambda parts: [placed(parts)[0]], with_counts)
        longer, found = None, _occurring(told)
    else:
        bigrams, longer, found = _trigrams(spark, counted, placed, words, word_bits)
    discounts = _discounts(found)
    starts = words.starts

    def of_bigrams(shard: int) -> Iterator[tuple]:
        if bigrams.sizes[shard]:
            pairs = unscramble(bigrams.table(shard).keys(), pair_bits)
            counts = bigrams.counts(shard).all()
            context, at = np.unique((pairs >> np.uint64(word_bits)).astype(np.int64), return_inverse=True)
            yield from _amounts("context", context, _context_columns(at, counts, len(context)), starts)
            word, times = np.unique((pairs & np.uint64((1 << word_bits) - 1)).astype(np.int64), return_counts=True)
            yield from _amounts("word", word, [times], starts)

    def write_words(rows: pa.Table) -> pa.Table:
        part = rows["part"][0].as_py()
        part, context, follows = _added(rows, int(starts[part]), int(starts[part + 1] - starts[part]))
        contexts.write(part, context, discounts)
        continued.write_counts(part, follows)
        row = _told(part, follows)
        return row.append_column("more", [[int((follows >= 3).sum())]])

    told = _spread(spark, shards, of_bigrams).applyInArrow(write_words, f"{_TOLD}, more bigint").collect()
    ones, total = _occurring(told), sum(r["tokens"] for r in told)
    own = _discounts(ones)
    rest = (own[1] * ones[0] + own[2] * ones[1] + own[3] * sum(r["more"] for r in told)) / total
    return NgramModel(words, bigrams, contexts, continued, tokens, types, discounts, own, total, rest, longer)


def _trigrams(spark, counted: Callable, placed: Callable, words: ShardedTable,
              word_bits: int) -> tuple[ShardedTable, TrigramModel, list[int]]:
    """The tables of bigrams and trigrams, and how many bigrams continue 1, 2, 3 and 4 words.

    Bigrams are first written as keys alone: their places number them. Their counts follow from the trigrams.
    """
    folder, shards, pair_bits, mask = words.folder, words.shards, 2 * word_bits, np.uint64((1 << word_bits) - 1)
    end = int(words.find(np.array([xxhash.xxh3_64_intdigest(END)], np.uint64))[0][0])

    def with_first(table, shard, keys, counts):
        """Of bigrams that begin a text, places in the shard and counts."""
        first = np.flatnonzero(unscramble(keys, pair_bits) >> np.uint64(word_bits) == end)
        write_shared(f"{folder}/first-{shard}", np.r_[first, counts[first]].astype("<i8").tobytes())

    bigrams, _ = counted("bigrams", pair_bits, lambda parts: [placed(parts)[0]], with_first)
    starts = bigrams.starts
    bits = bits_of(int(starts[-1])) + word_bits
    if bits > 64:
        raise ValueError(f"{starts[-1]} different bigrams of {sum(words.sizes)} words; a trigram is a number of 64 bits")
    shared = spark.sparkContext.broadcast(bigrams)

    def places(keys: np.ndarray) -> np.ndarray:
        kinds, at = np.unique(keys, return_inverse=True)
        return shared.value.find(kinds, counted=False)[0][at]

    def trigrams(parts: list[np.ndarray]) -> list[np.ndarray]:
        keys, number, begins = placed(parts)
        inner = np.ones(len(keys), bool)
        inner[begins] = False
        inner = np.flatnonzero(inner)
        return [_pairs(places(keys[inner - 1]), number[inner], word_bits, bits)]

    def with_counts(table, shard, keys, counts):
        table.write_counts(shard, counts)

    table, told = counted("trigrams", bits, trigrams, with_counts)
    discounts = _discounts(_occurring(told))
    contexts = Contexts(folder, "bigram-contexts", starts)

    def of_trigrams(shard: int) -> Iterator[tuple]:
        if not table.sizes[shard]:
            return
        found, counts = unscramble(table.table(shard).keys(), bits), table.counts(shard).all()
        context, at = np.unique((found >> np.uint64(word_bits)).astype(np.int64), return_inverse=True)
        yield from _amounts("context", context, _context_columns(at, counts, len(context)), starts)
        second = np.empty(len(context), np.uint64)
        edges = np.searchsorted(context, starts)
        for s in np.flatnonzero(np.diff(edges)).tolist():
            a, b = edges[s], edges[s + 1]
            second[a:b] = unscramble(shared.value.table(s).keys(context[a:b] - starts[s]), pair_bits) & mask
        last, times = np.unique(places(_pairs(second[at], found & mask, word_bits, pair_bits)), return_counts=True)
        yield from _amounts("last", last, [times], starts)

    def write_bigrams(rows: pa.Table) -> pa.Table:
        part = rows["part"][0].as_py()
        part, context, counts = _added(rows, int(starts[part]), int(starts[part + 1] - starts[part]))
        if len(counts):
            place, times = map_shared(f"{folder}/first-{part}", "<i8").reshape(2, -1)
            counts[place] = times
        contexts.write(part, context, discounts)
        bigrams.write_counts(part, counts)
        return _told(part, counts)

    told = _spread(spark, shards, of_trigrams).applyInArrow(write_bigrams, _TOLD).collect()
    return bigrams, TrigramModel(table, contexts, discounts, word_bits), _occurring(told)


def scored(model, text: str) -> Column:
    """A struct of token counts and log10 probabilities; ``model`` is a broadcast NgramModel."""

    @F.arrow_udf("struct<n_tokens: bigint, n_known: bigint, base: double, score: double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def found(texts):
            columns = list(zip(*model.value.score(texts))) or [[]] * 4
            return pa.StructArray.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 2 + [pa.float64()] * 2)],
                ["n_tokens", "n_known", "base", "score"])

        texts, size = [], 0
        for batch in batches:
            for one in batch.to_pylist():
                texts.append(one)
                size += len(one)
                if size >= 6 * SCORE_TOKENS:
                    yield found(texts)
                    texts, size = [], 0
        yield found(texts)

    return run.asNondeterministic()(utf8(text))


def lm_scores(docs: DataFrame, learned_from: DataFrame, text: str = "text",
              order: int = 2) -> tuple[DataFrame, str, NgramModel]:
    """The rows as they are with one more column, its name, and the model trained on ``learned_from``.

    At ``order`` 2 a word is judged by the one before it, at 3 by the two before it.

    The column is a struct: ``n_tokens`` (words and one end), ``n_known`` (seen in training), ``base``
    (log10 probability by add-one unigrams), ``score`` (by the model) and ``perplexity``. Null and empty
    texts are one token, the end. Repeated rows count each time in training and get equal scores. With
    nothing to learn from, all tokens have probability 1 (the even distribution over no word but the
    unknown one).

    Rows do not move; a worker maps the sorted arrays and reads the pages its texts ask for.
    """
    model = train(learned_from, text, order=order)
    name, = fresh(docs, "lm")
    found = docs.withColumn(name, scored(docs.sparkSession.sparkContext.broadcast(model), text))
    perplexity = F.pow(F.lit(10.0), -F.col(f"{name}.score") / F.col(f"{name}.n_tokens"))
    return found.withColumn(name, F.col(name).withField("perplexity", perplexity)), name, model
