"""Importance resampling, document fingerprints and spelling variants against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from tellerflow.llm import fingerprints, resample, spelling

# --- resampling


def test_crc_of_runs_from_prefixes():
    words = [random.Random(i).randbytes(i * i % 700 + 1).replace(b" ", b"x") for i in range(60)]
    scan = resample.Prefixes(words)
    for size in (1, 2, 7, 60, 61):
        runs = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
        assert scan.crcs(size).tolist() == [crc32(r) for r in runs]
    assert not len(resample.Prefixes([]).crcs(1))


def features(text, most):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, most + 1)
                        for i in range(len(words) - n + 1)]


def plain_importance(rows, target, percent, least, most, buckets):
    def counts(texts):
        return Counter(crc32(f.encode()) % buckets for t in texts for f in features(t, most)[1])

    s, t = counts(x for _, x in rows), counts(target)
    n_s, n_t = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
            for b in range(buckets)}
    out = []
    for number, text in rows:
        n, found = features(text, most)
        weight = sum(gain[crc32(f.encode()) % buckets] for f in found)
        name = "2024:" + ("" if number is None else str(number))
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        out.append([number, len(found), weight,
                    weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((r for r in out if r[4] >= least),
                  key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in out), key=repr)


@pytest.mark.parametrize("most", [1, 3])
def test_importance_equals_plain_python(spark, docs, rows, most):
    rng = random.Random(most)
    vocabulary = ["Alpha", "beta", "ÉTÉ", "x9", "日本", "don't", "a-b", "Zeta_1", "ß"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(60))) for _ in range(80)]
    given = [*enumerate(texts), (None, texts[0]), (5, texts[5]), (90, None), (91, ""), (92, "\0 ,;")]
    target = [" ".join(rng.choices(vocabulary[:3], k=30)), None, ""]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.importance(docs(*given), frame, 30, 20, most, 97)
    got = rows(got.select("doc_id", "n_features", "weight", "score", "rank"))
    want = plain_importance(given, target, 30, 20, most, 97)
    # Rows alike in id and text may swap their ranks.
    assert got == want


def test_resample_returns_whole_rows(spark, docs):
    given = docs(*((i, "word " * (i + 10)) for i in range(40))).withColumn("__KEY", resample.F.lit(1))
    target = spark.createDataFrame([("word word",)], "text string")
    drawn = resample.resample(given, target, percent=50)
    assert drawn.columns == given.columns and drawn.count() == 15
    assert resample.importance(given.limit(0), target).count() == 0
    assert resample.importance(given, target.limit(0)).filter("rank > 0").count() == 3


# --- fingerprints


def test_equal_texts_near_texts_and_others():
    words = [f"w{random.Random(i).randrange(10**6)}" for i in range(400)]
    a, b = " ".join(words), " ".join([*words[:200], "changed", *words[201:]])
    mark = fingerprints.simhash(a)
    assert mark == fingerprints.simhash(a.upper()) and len(mark) == 32
    assert fingerprints.likeness(mark, fingerprints.simhash(b)) > 0.9
    assert fingerprints.likeness(mark, fingerprints.simhash("some other text " * 9)) < 0.4
    assert fingerprints.simhash(None) == fingerprints.simhash(" \n") == bytes(32)


def plain_half_edits(given):
    given = [(i, t or "") for i, t in given]
    out = []
    for k, (number, text) in enumerate(given):
        following = given[(k + 1) % len(given)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = map(fingerprints.simhash, (text, edited, following))
        out.append((number, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b,
                    fingerprints.likeness(a, b), fingerprints.likeness(a, c)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 70])
def test_half_edits_equal_plain_python(docs, rows, conf, n):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rng = random.Random(n)
    texts = ["".join(rng.choices("ab é日😀", k=rng.randrange(80))) for _ in range(n)]
    texts[3:6] = [None, "", "x" * 100_000][: max(0, n - 3)]
    given = list(zip(range(n, 0, -1), texts))
    assert [tuple(map(bytes_of, r)) for r in rows(fingerprints.half_edits(docs(*given)))] == plain_half_edits(given)


def bytes_of(value):
    return bytes(value) if isinstance(value, bytearray) else value


def test_half_edits_of_null_and_repeated_ids(docs):
    given = docs((None, "no id here"), (7, "one two three"), (7, "one two three"), (8, None))
    found = fingerprints.half_edits(given)
    assert found.count() == 4 and found.filter("doc_id IS NULL").count() == 1


@pytest.mark.parametrize("cell", [4, 2048])
def test_near_fingerprints_equal_all_pairs(spark, cell):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2, (6, 256), dtype=np.uint8)
    marks = []
    for k in range(300):  # groups of near copies, at up to ten bits from their centre
        bits = base[k % 6].copy()
        bits[rng.choice(256, k % 11, replace=False)] ^= 1
        marks.append(np.packbits(bits).tobytes())
    given = [(i, bytearray(m)) for i, m in enumerate(marks)] + [(900, bytearray(marks[0])), (None, None)]
    frame = spark.createDataFrame(given, "doc_id long, fingerprint binary")
    got = {bytes(r[0]): (r[1], r[2]) for r in fingerprints.near_fingerprints(frame, 7, cell).collect()}
    ids = {}
    for i, m in given[:-1]:
        ids.setdefault(bytes(m), []).append(i)
    want = {}
    for a in ids:
        near = [i for b in ids if b != a and fingerprints.distance(a, b) <= 7 for i in ids[b]]
        if near:
            want[a] = (len(near), min(near))
    assert got == want and len(want) > 100


def test_near_fingerprints_refuse_a_radius_beyond_the_blocks(spark):
    frame = spark.createDataFrame([], "doc_id long, fingerprint binary")
    assert fingerprints.near_fingerprints(frame).count() == 0
    with pytest.raises(ValueError):
        fingerprints.near_fingerprints(frame, 8)


def test_with_near_counts_documents(docs):
    found = fingerprints.fingerprints(docs((4, "same text"), (2, "same text"), (3, "else"), (None, "")))
    got = {r.doc_id: (r.n_near, r.group_least) for r in fingerprints.with_near(found).collect()}
    assert got == {4: (1, 2), 2: (1, 2), 3: (0, 3), None: (0, None)}


# --- spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_near_words_equal_all_pairs(spark):
    rng = random.Random(3)
    words = {"".join(rng.choices("abé", k=rng.randrange(1, 9))) for _ in range(300)}
    words |= {"x" * n for n in (1, 2, 3, 40, 41)} | {"y" * 30_000, "y" * 29_999, "y" * 15_000 + "z" + "y" * 14_999}
    words |= {"😀a", "😁a", "a😀", "tellers", "teller", "tallers", "stellers"}
    frame = spark.createDataFrame([(w,) for w in words] + [("",), (None,)], "word string")
    got = {tuple(r) for r in spelling.near_words(frame).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)}
    assert spelling.near_words(frame.limit(0)).count() == 0


def test_variants_follow_chains_and_break_ties(spark, rows):
    counts = [("abcdef", 1000), ("abcdeg", 200), ("abcdhg", 40), ("abcihg", 5), ("zzzzzz", 9),
              ("zzzzzy", 45), ("zzzzzx", 45), ("qqqqqq", 5), ("qqqqqr", 24)]
    got = {r[0]: tuple(r[1:]) for r in rows(spelling.variants(
        spark.createDataFrame(counts, "word string, n long")))}
    assert got["abcihg"] == ("abcdhg", "abcdef", 5, 1, 40)
    assert got["abcdef"] == (None, "abcdef", 1000, 1, None)
    assert got["zzzzzz"] == ("zzzzzx", "zzzzzx", 9, 2, 45)
    assert got["qqqqqq"] == (None, "qqqqqq", 5, 1, None)


def test_variants_of_nothing_and_of_words_without_neighbours(spark, docs, rows):
    given = docs(*((i, "lonely letters") for i in range(9)))
    assert rows(spelling.variants(spelling.word_counts(given))) == [
        ("letters", None, "letters", 9, 0, None), ("lonely", None, "lonely", 9, 0, None)]
    assert rows(spelling.variants(spelling.word_counts(given.limit(3)))) == []


def test_word_counts_with_planted_slips(docs, rows):
    text = "Naïve STRASSE ×÷ abc_Ünder42 naïve ÀÉ"
    given = [(i, text) for i in range(30)] + [(None, text), (3, None), (4, "")]
    want = Counter()
    for number, t in given:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = crc32(f"{'' if number is None else number}:{run}".encode())
            if h % 7 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 4:
                want[run] += 1
    got = rows(spelling.word_counts(docs(*given), 4, 2, slip=7))
    assert got == sorted(((w, n) for w, n in want.items() if n >= 2), key=repr)
