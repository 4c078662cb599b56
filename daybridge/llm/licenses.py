"""License phrases and notices found by voting on diagonals."""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, floor

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybridge.llm.common import corpus_session, located, narrowed, plain_words, staged, utf8

# Words of a gram: the shortest phrase.
GRAM = 2

# Templates of fewer words have to occur exactly; longer ones may lack, add or change some.
EXACT_BELOW = 8

# Share of a long template's words, in order, that an occurrence must have, and the share of its length that an
# occurrence may be longer than the template: words added beyond these end it.
SIMILARITY, ADDED = 0.6, 0.4

# The base phrases and their labels, then statements and notices of public licenses.
BASE = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license "
                   "at http www apache org licenses license 2 0"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is "
                   "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation "
            "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    ("cc0", "dedicated to the public domain under cc0"),
    ("proprietary", "all rights reserved"),
)

# The position after a text's last gram carries this number, so that texts without any match stay.
_END_GRAM = -1


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    base: bool

    @property
    def exact(self) -> bool:
        return len(self.words) < EXACT_BELOW

    @property
    def needed(self) -> int:
        """Words that an occurrence must have in order."""
        return ceil(SIMILARITY * len(self.words) - 1e-9)

    @property
    def longest(self) -> int:
        """Words that an occurrence may span."""
        return floor((1 + ADDED) * len(self.words) + 1e-9)


def templates(base=BASE, notices=NOTICES) -> list[Template]:
    return ([Template(label, tuple(plain_words(p.encode())), True) for label, p in base]
            + [Template(label, tuple(plain_words(p.encode())), False) for label, p in notices])


def grams(words: list[bytes]) -> np.ndarray:
    """Rolling hashes of ``GRAM`` words."""
    if len(words) < GRAM:
        return np.empty(0, np.int64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    rolled = hashes[:len(words) - GRAM + 1]
    for step in range(1, GRAM):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[step:len(words) - GRAM + 1 + step]
    found = rolled.view(np.int64)
    return np.where(found == _END_GRAM, 0, found)


def dense(words: list[bytes], known: list[Template], masks: dict[bytes, int]) -> list[int]:
    """Numbers of the long templates of which some span has as many words, in any order, as an occurrence must.

    No other template can occur, whatever the order. ``masks`` has a bit for each long template of a word.
    """
    found = np.fromiter((masks.get(w, 0) for w in words), np.uint64, len(words))
    numbers = []
    for bit, t in enumerate([t for t, x in enumerate(known) if not x.exact]):
        sums = np.r_[0, np.cumsum((found >> np.uint64(bit) & np.uint64(1)).astype(np.int32))]
        span = min(known[t].longest, len(words))
        if sums[-1] >= known[t].needed and (sums[span:] - sums[:len(sums) - span]).max() >= known[t].needed:
            numbers.append(t)
    return numbers


def _masks(known: list[Template]) -> dict[bytes, int]:
    found: dict[bytes, int] = {}
    for bit, template in enumerate([x for x in known if not x.exact]):
        for w in template.words:
            found[w] = found.get(w, 0) | 1 << bit
    return found


def _rolling(text: str, known: list[Template]) -> Column:
    masks = _masks(known)

    @F.arrow_udf("struct<n_words: bigint, dense: array<int>, grams: array<bigint>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            words = [plain_words(t) for t in batch.to_pylist()]
            found = [np.append(grams(w), _END_GRAM) for w in words]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            yield pa.StructArray.from_arrays(
                [pa.array([len(w) for w in words], pa.int64()), pa.array([dense(w, known, masks) for w in words], pa.list_(pa.int32())),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found or [np.empty(0, np.int64)])))],
                ["n_words", "dense", "grams"])

    return run.asNondeterministic()(utf8(text))


_VERIFIED = ("struct<n_base: bigint, first_word: bigint, last_word: bigint, base_labels: array<string>, "
             "labels: array<string>, score: double, spans: array<struct<label: string, first: bigint, past: bigint>>>")
_VERIFIED_ARROW = pa.struct([
    ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("past", pa.int64())])))])


def occurrences(words: list[bytes], template: Template) -> list[tuple[int, int, int]]:
    """Spans (first, past, words in order) of a long template, in order, that do not overlap.

    A span has at most ``longest`` words, two of them side by side as in the template, and of the template's
    words at least ``needed`` in order: their longest common subsequence, a bit of a number for each word of the
    template. Of those that begin at a word the best, then shortest, counts; of these the best go first, of
    equally good ones the shorter, then the earlier, and those that overlap one taken are left out.
    """
    places: dict[bytes, int] = {}
    for i, w in enumerate(template.words):
        places[w] = places.get(w, 0) | 1 << i
    bits = [places.get(w, 0) for w in words]
    # where the next two words side by side end, at or after each place
    pair = [len(words)] * (len(words) + 1)
    for i in range(len(words) - 2, -1, -1):
        pair[i] = i + 1 if bits[i] << 1 & bits[i + 1] else pair[i + 1]
    ahead = np.r_[0, np.cumsum([b > 0 for b in bits])].tolist()
    size, every = len(template.words), (1 << len(template.words)) - 1

    found = []
    for i in range(len(words)):
        end = min(len(words), i + template.longest)
        if not bits[i] or pair[i] >= end or ahead[end] - ahead[i] < template.needed:
            continue
        rest, best = every, (0, 0)
        for j in range(i, end):
            if bits[j]:
                both = rest & bits[j]
                rest = (rest + both | rest - both) & every
                if j >= pair[i]:
                    best = max(best, (size - rest.bit_count(), i - j))
        if best[0] >= template.needed:
            found.append((*best, -i))
    taken: list[tuple[int, int, int]] = []
    for alike, less, first in sorted(found, reverse=True):
        span = -first, 1 - first - less, alike
        at = bisect(taken, span)
        if (at == 0 or taken[at - 1][1] <= span[0]) and (at == len(taken) or span[1] <= taken[at][0]):
            taken.insert(at, span)
    return taken


def verify(words: list[bytes], candidates: list[dict], known: list[Template]) -> dict:
    """Candidates (template, first, past) held against the words of the text."""
    starts, base, labels, spans, best = [], set(), set(), set(), 0.0
    for c in candidates:
        template = known[c["template"]]
        first, past = max(0, c["first"]), min(len(words), c["past"])
        if template.exact:
            past = first + len(template.words)
            found = [(first, past, len(template.words))] if tuple(words[first:past]) == template.words else []
        else:
            found = [(first + a, first + b, n) for a, b, n in occurrences(words[first:past], template)]
        for a, b, alike in found:
            best = max(best, alike / len(template.words))
            labels.add(template.label)
            spans.add((a, b, template.label))
            if template.base:
                starts.append(a)
                base.add(template.label)
    return {"n_base": len(starts), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
            "base_labels": sorted(base), "labels": sorted(labels), "score": best,
            "spans": [{"label": label, "first": a, "past": b} for a, b, label in sorted(spans)]}


def _verification(text: str, candidates: str, known: list[Template]) -> Column:
    @F.arrow_udf(_VERIFIED)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in batches:
            yield pa.array([verify(plain_words(t), c, known) for t, c in zip(texts.to_pylist(), found.to_pylist())],
                           _VERIFIED_ARROW)

    return run.asNondeterministic()(utf8(text), F.col(candidates))


def license_spans(docs: DataFrame, id: str = "doc_id", text: str = "text",
                  known: list[Template] | None = None) -> DataFrame:
    """A row for each document: ``doc_id, n_words`` and what was found.

    ``n_base`` places of base phrases, ``first_word`` and ``last_word`` (their smallest and largest start,
    null without any), ``base_labels`` and ``labels`` (sorted arrays), ``score`` (the largest share of a
    template found in order, 0 without any) and ``spans`` (label, first word, past the last). Null and
    empty texts have no words and no license; repeated rows each get their result; an empty table
    gives no rows.

    All rolling grams of all texts are joined to the positions of the templates' grams, a fixed broadcast
    table. A match votes for the diagonal, its place in the text minus that in the template; votes are
    summed by document, template and diagonal. Phrases need all votes of one diagonal. Notices may lack, change
    or add words: an occurrence has ``SIMILARITY`` of the notice's words in order, within ``1 + ADDED`` times its
    length, and two of them side by side as there. One vote makes a candidate where some span of the document
    has enough of the notice's words in any order; diagonals whose reaches meet are merged. Only the texts of
    documents with candidates are read again, and each stretch is searched for its best spans.
    """
    spark = corpus_session(docs.sparkSession)
    known = templates() if known is None else known
    placed, place = located(docs)
    entries = [(int(g), t, at) for t, template in enumerate(known) for at, g in enumerate(grams(list(template.words)))]
    long = [t for t, x in enumerate(known) if not x.exact]
    if len(long) > 64:
        raise ValueError(f"{len(long)} notices of {EXACT_BELOW} words or more; a word's mask holds 64")
    table = F.broadcast(spark.createDataFrame([*entries, (_END_GRAM, -1, 0)], "gram long, template int, at int"))
    shape = F.broadcast(spark.createDataFrame(
        [(t, len(x.words), x.exact) for t, x in enumerate(known)], "template int, length int, exact boolean"))
    texts = placed.select(*place, F.col(f"`{id}`").alias("doc_id"), _rolling(text, known).alias("r"))
    possible = ~F.col("template").isin(long) | F.array_contains("dense", F.col("template"))
    hits = staged(texts.select(*place, "doc_id", "r.n_words", "r.dense", F.posexplode("r.grams").alias("pos", "gram"))
                  .join(table, "gram").where(possible).drop("gram", "dense"))
    everyone = hits.where("template = -1").select(*place, "doc_id", "n_words")
    votes = (hits.where("template >= 0").groupBy(*place, "template", (F.col("pos") - F.col("at")).alias("diagonal"))
             .agg(F.count("*").alias("votes"), F.min("pos").alias("first"), F.max("pos").alias("last"))
             .join(shape, "template"))
    phrases = (votes.where(F.col("exact") & (F.col("votes") == F.col("length") - (GRAM - 1)))
               .select(*place, "template", F.col("diagonal").alias("first"), (F.col("diagonal") + F.col("length")).alias("past")))
    order = Window.partitionBy(*place, "template").orderBy("diagonal")
    # an occurrence that holds a vote lies within this many words of where its diagonal starts and ends
    reach = F.ceil((1 + ADDED) * F.col("length"))
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > 2 * reach + F.col("length")
    notices = (votes.where(~F.col("exact")).withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int"))
               .withColumn("island", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
               .groupBy(*place, "template", "island", "length")
               .agg(F.min("diagonal").alias("low"), F.max("diagonal").alias("high"))
               .select(*place, "template", (F.col("low") - reach).alias("first"),
                       (F.col("high") + F.col("length") + reach).alias("past")))
    candidates = staged(phrases.unionByName(notices).groupBy(*place).agg(F.sort_array(F.collect_list(F.struct(
        F.col("template").cast("int").alias("template"), F.col("first").cast("long").alias("first"),
        F.col("past").cast("long").alias("past")))).alias("candidates")))
    suspects = narrowed(placed.select(*place, F.col(f"`{text}`").alias("text")), place, candidates)
    found = staged(suspects.join(candidates, place).select(*place, _verification("text", "candidates", known).alias("v"))
                   .select(*place, "v.*"))
    none = F.array().cast("array<string>")
    return everyone.join(found, place, "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), "spans")
