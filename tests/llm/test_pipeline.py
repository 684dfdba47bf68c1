"""The pipeline on planted and clean rows, each stage against a plain version of it."""

import random

import pytest

import corpus_pipeline
from tellerflow.llm import queries
from test_near_duplicates import brute
from test_passages import brute_cut

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(corpus_pipeline.STAGES)


def words(rng, letters, n):
    return [rng.choice(letters) + "".join(rng.choices(letters, k=rng.randrange(2, 7))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Two languages of unlike letters: clean texts, copies, near copies, shared passages, leaks of
    the benchmark, texts without letters, nulls, a long text, and ids that repeat."""
    rng = random.Random(21)
    languages = {"xa": "abcdefghij", "xb": "klmnopqrstuvw"}
    texts = [(lang, words(rng, letters, rng.randrange(30, 120)))
             for _ in range(60) for lang, letters in languages.items()]
    passage = words(rng, languages["xa"], 60)
    for i in range(100, 106):
        texts[i] = ("xa", words(rng, "abcdef", 30) + passage + words(rng, "abcdef", 30))
    rows = [(i, " ".join(w), lang, "s", 0) for i, (lang, w) in enumerate(texts)]
    near = list(texts[4][1])
    near[len(near) // 2] = "other"
    near.append("end")
    rows += [
        (200, rows[3][1], "xb", "copy", 0), (201, rows[3][1].upper(), "xb", "copy", 0),
        (202, " ".join(near), "xa", "near", 0), (203, "12 34 .. 5", None, "no letters", 0),
        (204, None, "xa", "null", 0), (205, "", "xa", "empty", 0),
        (206, " ".join(words(rng, "abcdefghij", 30_000)), "xa", "long", 0),
        (207, "abc def", "xa", "short", 0), (None, "aba cad fae", "xa", "no id", 0),
        (10, rows[10][1], "xa", "same row again", 0),
        (11, " ".join(words(rng, "klmnop", 50)), "xb", "same id, other text", 0),
    ]
    return [(*r[:4], len(r[1] or "")) for r in rows]


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def run(spark, name, rows):
    out = STAGES[name](spark, frame(spark, rows), SF_DIR)
    assert out.columns == list(corpus_pipeline.COLUMNS)
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_language_keeps_all_texts_with_letters(spark, corpus):
    kept = run(spark, "language_id", corpus)
    assert kept == sorted((r for r in corpus if r[0] not in (203, 204, 205)), key=repr)


def test_language_threshold_rejects_what_no_language_fits(spark, corpus, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "LEAST_LANGUAGE_SCORE", 1.1)
    assert run(spark, "language_id", corpus) == []
    monkeypatch.setattr(corpus_pipeline, "LEAST_LANGUAGE_SCORE", 0.0)
    assert len(run(spark, "language_id", corpus)) == len(corpus) - 3


def test_one_of_each_group_of_near_duplicates_stays(spark, corpus):
    kept = run(spark, "minhash_neardup", corpus)
    one_text = {r[0]: r[1] for r in corpus if r[3] not in ("same id, other text", "no id")}
    roots = {i: root for i, (_, root) in brute(list(one_text.items()), 80).items()}
    gone = {i for i, root in roots.items() if i != root}
    assert gone == {200, 201, 202}
    want = [r for r in corpus if r[0] not in gone and r[3] != "s" or (r[3] == "s" and r[0] != 10)]
    want = [r for r in want if r[0] not in gone and r[3] != "same row again"]
    want.append(min(r for r in corpus if r[0] == 10))
    assert kept == sorted(want, key=repr)


def test_shared_passages_are_cut_and_clean_texts_untouched(spark, corpus):
    rows = [r for r in corpus if r[0] not in (10, 11, 200, 201, 202)]
    kept = {r[0]: r for r in run(spark, "substring_dedup", rows)}
    cut = brute_cut([(r[0], r[1]) for r in rows if r[0] is not None], 20)
    for r in rows:
        removed = cut[r[0]][1] if r[0] is not None else 0
        if not removed:
            assert kept[r[0]] == r
        else:
            assert 101 <= r[0] <= 105 and removed == 60
            assert len(kept[r[0]][1].split()) == cut[r[0]][0] - 60
            assert kept[r[0]][4] == len(kept[r[0]][1])
    assert len(kept) == len(rows)


def test_benchmark_passages_go_and_clean_texts_stay(spark, corpus):
    items = queries.table(spark, SF_DIR, "benchmark").collect()
    planted = []
    for k, item in enumerate(items[:6]):
        base = corpus[20 + k]
        planted.append((300 + k, f"{base[1]} {item.text.upper() if k % 2 else item.text} {base[1]}", *base[2:]))
    assert run(spark, "decontaminate", corpus + planted) == sorted(corpus, key=repr)


def test_packing_holds_every_token_once(spark, corpus):
    pieces = STAGES["pack"](spark, frame(spark, corpus), SF_DIR).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert by_doc.keys() == {r[0] for r in corpus}
    for doc, found in by_doc.items():
        if doc not in (10, 11):  # ids of two documents
            found.sort(key=lambda p: p.start)
            assert [p.start for p in found] == [sum(q.length for q in found[:i]) for i in range(len(found))]
            assert sum(p.length for p in found) == found[0].doc_tokens
    for found in by_sequence.values():
        found.sort(key=lambda p: p.offset)
        assert [p.offset for p in found] == [sum(q.length for q in found[:i]) for i in range(len(found))]
        assert sum(p.length for p in found) <= 2048


def test_run_equals_the_stages_one_by_one(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "stage")
    left = {r[0] for r in docs.select("doc_id").collect()}
    assert {r[0] for r in corpus_pipeline.run(spark, SF_DIR).select("doc_id").collect()} == left
