import itertools
import math
import zlib
from collections import Counter

import numpy as np

from daybridge.llm.langid import PENALTY, LanguageModel, identify, learn, trigrams
from daybridge.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    found = QUERIES["op2_language_id"](spark, sf).collect()
    assert {r.doc_id for r in found} == set(lang)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held_out = [r for r in found if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held_out]) > 0.98


def test_proportions_of_a_mixed_text(spark, documents):
    model = learn(documents)
    texts = {name: " ".join(r.text for r in documents.where(f"lang = '{name}'").limit(6).collect()) for name in ("de", "fr", "es")}
    mixed = (texts["de"][:3000] + " " + texts["fr"][:6000]).encode()
    start = model.predict([mixed])[0][0]
    assert model.languages[start] == "fr"
    members, share = model.mixture(trigrams(mixed), start)
    found = {model.languages[m]: s for m, s in zip(members, share)}
    assert set(found) == {"de", "fr"} and 0.27 < found["de"] < 0.40 and abs(sum(found.values()) - 1) < 1e-9
    members, share = model.mixture(trigrams(texts["es"].encode()), model.languages.index("es"))
    assert [model.languages[m] for m in members] == ["es"]


def _plain_mixture(chances, counts, languages, penalty):
    """The best set of all sets by penalised likelihood: proportions by expectation-maximisation in plain Python."""
    size, best = sum(counts.values()), None
    for members in itertools.chain(*(itertools.combinations(range(languages), k) for k in range(1, languages + 1))):
        share = [1 / len(members)] * len(members)
        for _ in range(150 if len(members) > 1 else 1):
            given = [0.0] * len(members)
            for gram, times in counts.items():
                parts = [s * chances[gram][m] for s, m in zip(share, members)]
                whole = sum(parts)
                for i, part in enumerate(parts):
                    given[i] += times * part / whole
            share = [g / size for g in given]
        likelihood = sum(times * math.log(sum(s * chances[gram][m] for s, m in zip(share, members))) for gram, times in counts.items())
        score = likelihood - penalty * math.log(size + 1) * (len(members) - 1)
        if best is None or score > best[0]:
            best = score, dict(zip(members, share))
    return best[1]


def test_mixtures_against_every_set_of_languages(documents):
    model = learn(documents)
    texts = {name: " ".join(r.text for r in documents.where(f"lang = '{name}'").limit(6).collect()) for name in model.languages}
    first, second, third, fourth = model.languages
    mixed = [texts[first][:900], texts[second][:400] + " " + texts[third][:700], texts[fourth][:500] + " " + texts[first][:1200],
             texts[first][:600] + " " + texts[second][:600] + " " + texts[third][:600], texts[third][:40], texts[second][:1500] + texts[fourth][:60]]
    for text in mixed:
        grams = trigrams(text.encode())
        counts = Counter(grams.tolist())
        wanted = _plain_mixture({g: model.probability[g].astype(float).tolist() for g in counts}, counts, 4, PENALTY)
        start = int(np.log(model.probability[grams].astype(float)).sum(0).argmax())
        members, share = model.mixture(grams, start)
        assert set(members) == set(wanted)
        assert all(abs(s - wanted[m]) < 0.02 for m, s in zip(members, share))
        top, _ = model.predict([text.encode()])
        assert wanted[top[0]] > max(wanted.values()) - 0.02


def test_skipping_is_exact(documents):
    """The gradient bound: where no mixture can pay the penalty, forward selection adds none."""
    model = learn(documents)
    for r in documents.limit(60).collect():
        grams = trigrams(r.text.encode())
        start = int(np.log(model.probability[grams]).sum(0).argmax())
        members, share = model.mixture(grams, start)
        language, _ = model.predict([r.text.encode()])
        assert language == [members[int(share.argmax())]]


def test_hostile(hostile, empty):
    found, name = identify(hostile, hostile)
    assert found.columns == [*hostile.columns, name] and name == "_language"
    rows = found.collect()
    assert len(rows) == hostile.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r[name].lang == "und") == (not letters) and 0 <= r[name].score <= 1
        assert r[name].lang in ("en", "de", "fr", "und")
    assert {r[name].lang for r in identify(hostile, empty)[0].collect()} == {"und"}
    assert identify(empty, empty)[0].count() == 0
    assert isinstance(learn(hostile), LanguageModel)


def test_sample_is_bounded(documents):
    few = learn(documents, sample_per_language=10)
    assert few.languages == ["de", "en", "es", "fr"]
