"""Language identification of texts that may mix languages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.llm.common import corpus_session, fresh, utf8

# Hash bins of byte trigrams.
BIN_BITS = 16

# Documents of each language, about, that the trigram tables are counted from.
SAMPLE_PER_LANGUAGE = 20_000

# Added to each bin's count.
SMOOTHING = 0.05

# What another language in the set must add to the log likelihood, times the logarithm of the trigrams.
PENALTY = 3.0

# Trigrams spread over all languages in the score, so that short texts are less certain.
PRIOR = 2.0

# Texts are scored together up to so many bytes.
BLOCK_BYTES = 1 << 20

_LETTERS = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def trigrams(text: bytes) -> np.ndarray:
    """Hash bins of the byte trigrams of the lower-cased words, with a space around each word."""
    padded = b" ".join([b"", *text.translate(_LETTERS).split(), b""])
    b = np.frombuffer(padded, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.int64)
    return ((b[:-2] | b[1:-1] << 8 | b[2:] << 16) * np.uint32(2654435761) >> np.uint32(32 - BIN_BITS)).astype(np.int64)


@dataclass
class LanguageModel:
    languages: list[str]
    probability: np.ndarray  # bins x languages, float32

    def mixture(self, bins: np.ndarray, start: int) -> tuple[list[int], np.ndarray]:
        """The set of languages and their proportions in one text, from its most likely language on.

        Forward selection: the language with the largest gradient joins, expectation-maximisation
        estimates the proportions over the set, and it stays if that pays the penalty.
        """
        kinds, times = np.unique(bins, return_counts=True)
        table = self.probability[kinds].astype(np.float64)
        penalty = PENALTY * np.log(len(bins) + 1)
        members, share = [start], np.ones(1)
        mixed = table[:, start]
        best = float(times @ np.log(mixed))
        while len(members) < len(self.languages):
            gain = (times / mixed) @ table
            gain[members] = 0
            members_next = [*members, int(gain.argmax())]
            part = np.append(share * 0.8, 0.2)
            within = table[:, members_next]
            likelihood = -np.inf
            for _ in range(200):
                weighted = within * part
                total = weighted.sum(1)
                now = float(times @ np.log(total))
                if now - likelihood < 1e-3:
                    break
                likelihood = now
                part = (times / total) @ weighted / len(bins)
            if now - best <= penalty:
                break
            members, share, mixed, best = members_next, part, within @ part, now
        return members, share

    def predict(self, texts: list[bytes]) -> tuple[list[int], list[float]]:
        """The language with the largest share in each text, and that share."""
        found, sure = [], []
        log = np.log(self.probability)
        at = 0
        while at < len(texts):
            block, size = [], 0
            while at < len(texts) and size < BLOCK_BYTES:
                block.append(trigrams(texts[at]))
                size += len(texts[at])
                at += 1
            lengths = np.array([len(x) for x in block])
            ends = np.cumsum(lengths)
            bins = np.concatenate(block)
            filled = np.flatnonzero(lengths)
            top = np.zeros(len(block), np.int64)
            bound = np.zeros(len(block))
            if len(filled):
                starts = (ends - lengths)[filled]
                likelihood = np.add.reduceat(log[bins], starts, axis=0, dtype=np.float64)
                top[filled] = likelihood.argmax(1)
                chances = self.probability[bins]
                own = chances[np.arange(len(bins)), np.repeat(top, lengths)]
                gradient = np.add.reduceat(chances / own[:, None], starts, axis=0, dtype=np.float64)
                bound[filled] = gradient.max(1) - lengths[filled]  # no mixture gains more than this
            for i, grams in enumerate(block):
                language, share = int(top[i]), 1.0
                if bound[i] > PENALTY * np.log(len(grams) + 1):
                    members, shares = self.mixture(grams, language)
                    language, share = members[int(shares.argmax())], float(shares.max())
                found.append(language)
                sure.append((len(grams) * share + PRIOR / len(self.languages)) / (len(grams) + PRIOR))
        return found, sure


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          sample_per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """Trigram tables counted in Spark from about ``sample_per_language`` documents of each language.

    Documents without a language do not count. The sample takes documents by a hash of their key and
    is all of a language with fewer.
    """
    known = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{lang}`").alias("lang"), utf8(text).alias("text")) \
        .where("lang is not null")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    chance = F.lit(0.0)
    for name in languages:
        chance = F.when(F.col("lang") == name, min(1.0, sample_per_language / sizes[name])).otherwise(chance)
    sample = known.where(F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 30)) < chance * (1 << 30))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = counts.setdefault(name, np.zeros(1 << BIN_BITS, np.int64))
                own += np.bincount(trigrams(content), minlength=1 << BIN_BITS)
        for name, own in counts.items():
            bins = np.flatnonzero(own)
            yield pa.record_batch([pa.array([name] * len(bins), pa.string()), pa.array(bins), pa.array(own[bins])],
                                  ["lang", "bin", "n"])

    rows = (sample.select("lang", "text").mapInArrow(count, "lang string, bin bigint, n bigint")
            .groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas())
    table = np.full((1 << BIN_BITS, len(languages)), SMOOTHING)
    column = rows["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy(dtype=np.int64)
    np.add.at(table, (rows["bin"].to_numpy(dtype=np.int64), column), rows["n"].to_numpy(dtype=np.float64))
    return LanguageModel(languages, (table / table.sum(0)).astype(np.float32))


def language(model, text: str) -> Column:
    """A struct of the predicted language and its score; ``model`` is a broadcast LanguageModel or none."""

    @F.arrow_udf("struct<lang: string, score: double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found, sure = model.value.predict(batch.to_pylist())
            yield pa.StructArray.from_arrays([pa.array([model.value.languages[i] for i in found], pa.string()),
                                              pa.array(sure, pa.float64())], ["lang", "score"])

    return run.asNondeterministic()(utf8(text))


def identify(docs: DataFrame, labelled: DataFrame, text: str = "text", lang: str = "lang",
             key: str = "doc_id", sample_per_language: int = SAMPLE_PER_LANGUAGE) -> tuple[DataFrame, str]:
    """The rows as they are with one more column, and its name: a struct of ``lang`` and ``score``.

    ``lang`` is the learned language with the largest share in the text, ``score`` that share, drawn a
    little to the even one in short texts. It is ``und`` with score 0 where the text is null, empty or
    has no letter, or where nothing was learned from (an empty table, all languages null).

    Each trigram is drawn from one of the text's languages: expectation-maximisation estimates their
    proportions, and a language belongs to the set only if it raises the log likelihood by more than a
    penalty. Rows do not move; the model has a fixed number of bins for each language.
    """
    corpus_session(docs.sparkSession)
    name, = fresh(docs, "language")
    model = learn(labelled, text, lang, key, sample_per_language)
    none = F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"))
    if not model.languages:
        return docs.withColumn(name, none), name
    shared = docs.sparkSession.sparkContext.broadcast(model)
    has_letter = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn(name, language(shared, text)).withColumn(
        name, F.when(has_letter, F.col(name)).otherwise(none)), name
