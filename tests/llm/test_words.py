"""Quality rules and mixing against plain Python."""
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import mixing, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, None, s, 0) for i, t, s in rows], DOCS)


def texts():
    rng = random.Random(3)
    some = [None, "", " \n\t ", "one", "a b c a b c", "x y z x y z x y", "the of and " * 40, "# $ % é | <> & *", "a\n\na\n a\na\n", "nb\xa0sp em sp", "w " * 30_000]
    return some + [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) + "\n" + "line\nline" * rng.randint(0, 3) for _ in range(60)]


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = {}
    for x in windows:
        count[x] = count.get(x, 0) + 1
    covered = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    base = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), base


def test_measures_equal_brute_force(spark):
    rows = [(i, t, "s") for i, t in enumerate(texts())] + [(None, "a b", None), (0, None, None)]
    docs = documents(spark, rows).selectExpr("*", "'mine' AS kept", "1 AS n_words")
    got = quality_rules.judge(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.source == "s"}
    for i, t, s in rows:
        if s:
            r = by_id[i]
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t), t
            assert r.kept == (not r.base_failed and not r.broken_rules)


def test_clean_prose_is_kept_and_junk_goes(spark):
    rng = random.Random(1)
    clean = " ".join(rng.choice(["the", "of", "water", "river", "and", "mountain", "old", "house", "in"]) + rng.choice(["", "s", "ly", "er"]) for _ in range(400))
    junk = " ".join(rng.choice(["###", "$$$", "a|b", "%%"]) + str(i) for i in range(400))
    got = {r.doc_id: r.kept for r in quality_rules.judge(documents(spark, [(1, clean, "s"), (2, junk, "s")])).collect()}
    assert got == {1: True, 2: False}


def test_stop_words_judge_listed_languages_only(spark):
    rng = random.Random(4)
    prose = {c: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(200))
             for c, letters in {"ru": "абвгдежзиклмнопрст", "el": "αβγδεζηθικλμνξοπρσ", "ar": "ابتثجحخدذرزسشصضطظع", "ko": "가나다라마바사아자차카타", "fi": "äöyktp"}.items()}
    rows = [(i, t, c, "s", 0) for i, (c, t) in enumerate(prose.items())] + [(10, prose["ru"], None, "s", 0), (11, prose["fi"], "en", "s", 0), (12, prose["fi"], "DE-at", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r.broken_rules for r in quality_rules.judge(docs).collect()}
    assert got == {**{i: [] for i in range(5)}, 10: [], 11: ["stop_words"], 12: ["stop_words"]}
    assert {r.doc_id for r in quality_rules.stage(spark, docs, "").collect()} == {0, 1, 2, 3, 4, 10}
    assert all(r.kept for r in quality_rules.judge(docs.drop("lang")).collect())


def test_no_text_is_too_long(spark):
    counts = spark.sql("SELECT struct(20000000L AS n_words, 80000000L AS word_chars, 0L AS n_symbols, 1L AS n_lines, 0L AS n_dup_lines, 0L AS n_repeat_words, 9000000L AS n_stop_words) AS m, 'en' AS lang")
    assert counts.select(quality_rules.verdict(F.col("m"), F.col("lang")).alias("v")).first().v == []


def test_empty_tables(spark):
    docs = documents(spark, [])
    assert quality_rules.judge(docs).count() == 0
    assert mixing.plan(docs).count() == 0
    assert mixing.mix(docs).columns == docs.columns


def mixed(seed=5, n=700):
    rng = random.Random(seed)
    sources = ["a", "b", "c", "d", "é", None, "empty"]
    rows = []
    for i in range(n):
        s = rng.choices(sources, [400, 20, 60, 5, 40, 30, 0])[0]
        rows.append((i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 80, 900]))), s))
    return rows + [(n, None, "empty"), (n + 1, "", "empty"), (None, "x y", "a"), (None, "x y", "a"), (3, "p q r", "b")]


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("group_rows", [20_000, 8])
def test_mix_meets_targets(spark, monkeypatch, group_rows):
    rows = mixed()
    monkeypatch.setattr(mixing, "GROUP_ROWS", group_rows)
    plan = mixing.plan(documents(spark, rows)).collect()
    assert len(plan) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = brute_targets(sizes)
    for s in sizes:
        own = [r for r in plan if r.source == s]
        assert all(r.source_size == sizes[s] and math.isclose(r.target, want[s], rel_tol=1e-12, abs_tol=1e-9) for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= max(0.03 * want[s], 2 * max(r.size for r in own))
    assert all(0 <= r.taken <= 2 * r.size for r in plan)


def test_groups_do_not_change_the_plan(spark, monkeypatch):
    docs = documents(spark, mixed())
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text_hash, r.copies)
    whole = sorted(mixing.plan(docs).collect(), key=key)
    monkeypatch.setattr(mixing, "GROUP_ROWS", 5)
    assert sorted(mixing.plan(docs).collect(), key=key) == whole


def test_mix_emits_the_planned_copies(spark):
    docs = documents(spark, mixed(n=200)).withColumnRenamed("n_chars", "size")
    got = mixing.mix(docs)
    assert got.columns == docs.columns
    count = {}
    for r in got.collect():
        count[(r.doc_id, r.text, r.source)] = count.get((r.doc_id, r.text, r.source), 0) + 1
    assert sum(count.values()) == sum(r.copies for r in mixing.plan(docs).collect())
