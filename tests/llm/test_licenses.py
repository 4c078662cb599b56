import random

from daybridge.llm.licenses import BASE, Template, grams, license_spans, occurrences, templates, verify
from daybridge.llm.queries import QUERIES

import brute


def _base(text):
    n, places = brute.phrase_places(text, BASE)
    starts = [i for i, _ in places]
    return (n, len(starts), min(starts, default=None), max(starts, default=None), sorted({label for _, label in places}))


def test_against_brute_force(spark, sf, documents):
    found = {r.doc_id: r for r in QUERIES["op3_license_scan"](spark, sf).collect()}
    some = 0
    for r in documents.collect():
        n, count, first, last, labels = _base(r.text)
        x = found[r.doc_id]
        assert (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) == (n, count, first, last, ",".join(labels))
        assert set(labels) <= set(x.labels.split(",")) and (x.score > 0) == (x.labels != "")
        some += count
    assert some


def test_hostile(hostile, empty):
    found = license_spans(hostile).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found), key=str)
    assert got == sorted(((r.doc_id, *_base(r.text)) for r in hostile.collect()), key=str)
    assert license_spans(empty).count() == 0


def test_changed_notices(spark):
    notice = next(t for t in templates() if t.label == "bsd")
    words = [w.decode() for w in notice.words]
    changed = words[:5] + ["plainly"] + words[5:12] + words[13:]
    half = words[:6] + ["other"] * 14
    rows = [(1, "intro " * 30 + " ".join(changed) + " tail" * 10), (2, " ".join(half)), (3, " ".join(words) + " and " + " ".join(changed)),
            (4, "of the in the to the " * 300)]
    found = {r.doc_id: r for r in license_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1].labels == ["bsd"] and 0.9 < found[1].score < 1 and found[1].spans[0].first == 30
    assert found[2].labels == [] and found[4].labels == []
    assert found[3].score == 1 and found[3].labels == ["bsd"]


def test_verify_is_exact_for_phrases():
    known = [Template("x", (b"mit", b"license"), True)]
    words = b"mit license mit license mit".split()
    found = verify(words, [{"template": 0, "first": i, "past": i + 2} for i in range(4)], known)
    assert (found["n_base"], found["first_word"], found["last_word"]) == (2, 0, 2)
    assert len(grams([b"one"])) == 0


def _subsequence(a, b):
    """Length of the longest common subsequence, by the plain table."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def _plain_notices(text):
    """Label -> largest share in order, over every span of the longest allowed length."""
    words, found = [w.encode() for w in brute.plain(text)], {}
    for t in templates():
        size = len(t.words)
        if t.exact:
            if any(tuple(words[i:i + size]) == t.words for i in range(len(words))):
                found[t.label] = 1.0
            continue
        pairs = set(zip(t.words, t.words[1:]))
        longest = int(1.4 * size + 1e-9)
        for i in range(max(1, len(words) - longest + 1)):
            span = words[i:i + longest]
            if sum(w in t.words for w in span) >= 0.6 * size and any(p in pairs for p in zip(span, span[1:])):
                share = _subsequence(t.words, span) / size
                if share >= 0.6 - 1e-9:
                    found[t.label] = max(share, found.get(t.label, 0))
    return found


def test_all_labels_against_brute_force(spark, documents):
    """Every notice with words changed, taken out and added around the limits, and given documents."""
    rng = random.Random(4)
    texts = [r.text or "" for r in documents.limit(60).collect()]
    for t in [t for t in templates() if not t.exact]:
        for _ in range(12):
            words = [w.decode() for w in t.words]
            for _ in range(rng.randint(0, int(0.5 * len(words)))):
                at, what = rng.randrange(len(words)), rng.random()
                words[at:at + 1] = [] if what < 0.3 and len(words) > 2 else [f"x{rng.random()}"] if what < 0.7 else [words[at], "and", "the"]
            texts.append("of the in " * rng.randint(0, 9) + " ".join(words) + " to the software" * rng.randint(0, 9))
        texts.append(" ".join(f"{w.decode()} y" for w in t.words))  # never two words side by side
        half = [w.decode() for w in t.words]
        texts.append(" ".join(half[:len(half) // 2] + ["z"] * int(0.4 * len(half)) + half[len(half) // 2:]))
        texts.append(" ".join(half[:len(half) // 2] + ["z"] * (int(0.4 * len(half)) + 1) + half[len(half) // 2:]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    some = set()
    for r in license_spans(df).collect():
        want = _plain_notices(texts[r.doc_id])
        assert r.labels == sorted(want), texts[r.doc_id]
        assert abs(r.score - max(want.values(), default=0.0)) < 1e-12, texts[r.doc_id]
        some |= {(label, share < 1) for label, share in want.items()}
    assert len(some) > 15


def test_two_occurrences_beside_each_other():
    notice = next(t for t in templates() if t.label == "bsd")
    changed = notice.words[:5] + (b"x",) + notice.words[6:]
    words = [b"a"] * 7 + [*notice.words] + [b"b"] * 2 + [*changed] + [b"c"] * 5
    size = len(notice.words)
    assert occurrences(words, notice) == [(7, 7 + size, size), (9 + size, 9 + 2 * size, size - 1)]


def test_notices_at_the_limit_of_similarity(spark):
    """As many separate inner words changed as are accepted, in every notice that need not be exact."""
    known = [t for t in templates() if not t.exact]
    rows = []
    for i, t in enumerate(known):
        words = [w.decode() for w in t.words]
        for k in range(len(words) - t.needed):
            words[1 + 2 * k] = f"changed{k}"
        rows.append((i, " ".join(words)))
    found = license_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    for r in found:
        # two words side by side are left only where fewer than half are changed
        assert known[r.doc_id].label in r.labels and r.score >= 0.6 - 1e-9


def test_a_notice_thousands_of_times():
    """Work grows with the text, not with the square of its occurrences."""
    notice = next(t for t in templates() if t.label == "unlicense")
    found = occurrences([*notice.words] * 3000, notice)
    size = len(notice.words)
    assert found == [(i * size, (i + 1) * size, size) for i in range(3000)]
