"""Repeated passages and benchmark leaks against brute force."""

import hashlib
import random
from collections import Counter

from tellerflow.llm import decontaminate, language, substring


def brute_cut(texts, length):
    first, words = {}, {i: (t or "").encode().split() for i, t in texts}
    for i in sorted(words):
        for p in range(len(words[i]) - length + 1):
            first.setdefault(tuple(words[i][p : p + length]), (i, p))
    out = {}
    for i, w in words.items():
        gone = set()
        for p in range(len(w) - length + 1):
            if first[tuple(w[p : p + length])] < (i, p):
                gone.update(range(p, p + length))
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_repeated_runs(spark, docs):
    """Passages of random lengths at random places, few words, copies, loops and a long text."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    passages = [[rng.choice(words) for _ in range(rng.randrange(15, 60))] for _ in range(12)]
    texts = []
    for _ in range(200):
        text = []
        for _ in range(rng.randrange(4)):
            text += [rng.choice(words) for _ in range(rng.randrange(30))]
            part = rng.choice(passages)
            at = rng.randrange(10)
            text += part[at : len(part) - rng.randrange(8)]
        texts.append(rng.choice([" ", "\n", "\t "]).join(text))
    texts += texts[:5] + ["a " * 300, "a " * 50, "", None, " ", "W1 " + texts[0]]
    texts.append(" ".join(f"u{i % 7000}" for i in range(20000)))
    numbered = list(enumerate(texts))
    found = substring.dedup_substrings(docs(*numbered)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == brute_cut(
        numbered, 20
    )
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in found)


def test_repeated_runs_of_other_lengths(spark, docs):
    """More windows to an anchor than 15, the most at the default length."""
    rng = random.Random(12)
    passages = [[f"p{rng.randrange(400)}" for _ in range(rng.randrange(60, 140))] for _ in range(5)]
    texts = []
    for _ in range(40):
        part = rng.choice(passages)
        lead = [f"q{rng.randrange(400)}" for _ in range(rng.randrange(30))]
        texts.append(" ".join(lead + part[rng.randrange(10):]))
    numbered = list(enumerate(texts))
    for length in (21, 50):
        found = substring.dedup_substrings(docs(*numbered), length).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == brute_cut(
            numbered, length
        )


def test_a_phrase_in_unlike_surroundings(spark, docs, conf):
    """One anchor with other content in every text, some of which share passages around it."""
    conf(spark__sql__execution__arrow__maxRecordsPerBatch="60", spark__sql__files__maxPartitionBytes="16k")
    rng = random.Random(13)
    phrase = [f"common{i}" for i in range(8)]

    def some(n):
        return [f"r{rng.randrange(5000)}" for _ in range(n)]

    passages = [some(30) + phrase + some(30) for _ in range(3)]
    texts = [" ".join(some(20) + phrase + some(rng.randrange(30))) for _ in range(240)]
    for i in range(0, 240, 9):
        part = rng.choice(passages)
        texts[i] = " ".join(some(3) + part[rng.randrange(25) : 40 + rng.randrange(20)] + some(5))
    rng.shuffle(texts)
    numbered = list(enumerate(texts))
    found = substring.dedup_substrings(docs(*numbered).repartition(4)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == brute_cut(
        numbered, 20
    )
    rows = substring._found([substring._Text(t, 20, 6).spans() for t in texts], list(range(240)), 16)
    anchors = Counter(rows.column(0).to_pylist())
    assert max(anchors.values()) <= 16


def test_columns_named_like_helpers_and_results(spark, docs):
    odd = docs((1, "a b c d e f g"), (2, None)).selectExpr(
        "doc_id", "text", "1 AS N_Words", "2 AS __text", "3 AS __ID", "4 AS __leak", "5 AS Score",
        "6 AS __places", "7 AS __of", "8 AS `Lang_Pred`")
    found = substring.dedup_substrings(odd)
    assert found.columns[-4:] == ["n_words", "n_removed", "kept_text", "kept_sha256"]
    assert sorted(r["n_words"] for r in found.collect()) == [0, 7]
    named = language.identify(odd, language.fit(odd.selectExpr("text", "'xx' AS lang")))
    assert named.count() == 2 and named.columns[-2:] == ["lang_pred", "score"]
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert [r.doc_id for r in decontaminate.clean(odd, items).collect()] == [2]


def test_runs_without_ids_repeats_and_empty(spark, docs):
    text = " ".join(f"t{i}" for i in range(25))
    df = docs((None, text), (7, text), (7, text), (8, text), (9, "z " + text))
    found = sorted((str(r.doc_id), r.n_removed) for r in substring.dedup_substrings(df).collect())
    assert found == [("7", 0), ("7", 0), ("8", 25), ("9", 25), ("None", 0)]
    assert substring.dedup_substrings(docs()).count() == 0


def bag(words):
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_leaks(texts, items, least=0.8):
    found = {}
    for i, text in texts:
        w = (text or "").lower().split()
        for k, item in items:
            v = (item or "").lower().split()
            if len(v) < 5 or len(w) < 5:
                continue
            want = bag(v)
            best = 0
            for s in range(len(w) - 4):
                have = bag(w[s : s + len(v)])
                both = sum((have & want).values())
                best = max(best, both / (sum(have.values()) + sum(want.values()) - both))
            if best >= least:
                found[i, k] = round(best, 9)
    return found


def test_leaks(spark, docs):
    rng = random.Random(2)

    def prose(n):
        return [f"w{rng.randrange(300)}" for _ in range(n)]

    items = [(k, " ".join(prose(rng.randrange(8, 70)))) for k in range(25)]
    items += [(100, "too short"), (101, None), (102, "la " * 30), (103, items[3][1])]
    texts = [" ".join(prose(rng.randrange(3, 120))) for _ in range(40)]
    for k, item in items[:25]:
        w = item.split()
        texts.append(" ".join(prose(20) + w + prose(15)))
        texts.append(" ".join(w[1:] + prose(5)).upper())
        texts.append(" ".join(prose(9) + w[: len(w) * 9 // 10]))
        texts.append(" ".join(prose(9) + w[: len(w) // 2] + prose(4)))
        changed = list(w)
        changed[len(w) // 2] = "other"
        texts.append(" ".join(prose(5) + changed + prose(5)))
    texts += ["la " * 40, "la " * 26, "", None, "x"]
    numbered = list(enumerate(texts))
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS span")
    found = decontaminate.leaks(docs(*numbered), bench).collect()
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in found}
    assert got == brute_leaks(numbered, items)
    left = decontaminate.clean(docs(*numbered), bench)
    assert {r.doc_id for r in left.collect()} == set(range(len(texts))) - {i for i, _ in got}


def test_leaks_without_ids_and_empty(spark, docs):
    item = "one two three four five six"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    df = docs((None, item), (None, "clean"), (4, item), (4, "clean too"), (5, "clean"))
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench).collect()} == {
        (None, 1), (4, 1)
    }
    left = [(r.doc_id, r.text) for r in decontaminate.clean(df, bench).collect()]
    assert sorted(left, key=str) == [(5, "clean"), (None, "clean")]
    assert decontaminate.leaks(docs(), bench).count() == 0
    assert decontaminate.leaks(df, bench.limit(0)).count() == 0


def test_leaks_of_several_documents_and_items_without_ids(spark, docs):
    first, second = "one two three four five six", "red green blue white black grey"
    third = "north south east west up down"
    bench = spark.createDataFrame([(1, first), (None, second), (None, third)],
                                  "item_id long, text string")
    df = docs((None, first), (None, f"{first} tail"), (None, f"{second} and {third}"), (4, second),
              (5, "clean"), (None, "clean"))
    found = [(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench).collect()]
    assert sorted(found, key=str) == sorted(
        [(None, 1), (None, 1), (None, None), (None, None), (4, None)], key=str)
    left = [(r.doc_id, r.text) for r in decontaminate.clean(df, bench).collect()]
    assert sorted(left, key=str) == [(5, "clean"), (None, "clean")]
