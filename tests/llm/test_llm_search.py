"""Runs, ranked search and repeated passages, against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roost.llm import passages, periodic, ranked
from roost.llm.queries import with_periods

SCHEMA = "doc_id bigint, text string, lang string"
CLASH = "1 AS raw, 'own' AS body, 2 AS spans, 'x' AS runs, 3 AS kept, 4 AS score, 5 AS rank, 6 AS words, 7 AS h"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and long texts, repeated rows, one id with two texts, clashing names."""
    part = " ".join(f"w{i}" for i in range(70))
    rows = [
        (1, None, None),
        (None, part, "en"),
        (2, "", "en"),
        (3, " \t\n ", "en"),
        (4, part, "en"),
        (5, "before " + part + " after", "de"),
        (5, "before " + part + " after", "de"),
        (5, "other " + part, "de"),
        (6, "Ab ab AB é É " * 20_000, "fr"),
        (7, "x y x y", "fr"),
    ]
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", *CLASH.split(", "))


# ---- runs ---------------------------------------------------------------------------------


def plain_runs(words, least_length, least_exponent):
    found = []
    for q in range(1, len(words) // least_exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            shorter = any(all(words[k] == words[k + d] for k in range(start, start + length - d)) for d in range(1, q))
            if i > start and length >= max(least_length, least_exponent * q) and not shorter:
                found.append((start, length, q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 7), st.integers(0, 40), st.sampled_from([(6, 4), (2, 2), (5, 3)]))
def test_runs_are_those_of_the_definition(words, period, length, least):
    words = words + [words[k % period] if words and period <= len(words) else k % period for k in range(length)] + words
    assert periodic.runs_of(words, periodic.RunParams(*least)) == plain_runs(words, *least)


def test_fibonacci_words_have_their_many_runs():
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    assert periodic.runs_of(b, periodic.RunParams(2, 2)) == plain_runs(b, 2, 2)


def test_collapse_drops_what_follows_the_first_period():
    words = "a b a b a b a b c x x x x x x".split()
    runs = periodic.runs_of(words)
    assert runs == [(0, 8, 2), (9, 6, 1)]
    assert periodic.collapse(words, runs) == "a b c x".split()


def test_run_digests_of_odd_rows(spark, odd):
    got = periodic.find_runs(odd).collect()
    assert len(got) == odd.count()
    by_text = {r["doc_id"]: r for r in got}
    assert by_text[1]["n_words"] == 0 and by_text[1]["runs"] == [] and by_text[1]["collapsed"] == ""
    assert [tuple(r) for r in by_text[6]["runs"]] == [(0, 100_000, 5)] and by_text[6]["collapsed"] == "Ab ab AB é É"
    assert by_text[7]["n_words"] == 2
    digests = {r["doc_id"]: r for r in periodic.run_digests(odd).collect()}
    assert digests[2]["start"] is None and digests[2]["exponent_milli"] is None and digests[2]["n_runs"] == 0
    assert (digests[6]["length"], digests[6]["period"], digests[6]["exponent_milli"]) == (100_000, 5, 20_000_000)
    assert periodic.run_digests(odd.limit(0)).count() == 0


def test_the_run_of_greatest_exponent_wins_ties_by_start(spark):
    text = "p q p q p q p q z a a a a a a a a z b b b b b b b b"
    row = periodic.run_digests(spark.createDataFrame([(1, text, None)], SCHEMA)).first()
    assert (row["n_runs"], row["start"], row["length"], row["period"]) == (3, 9, 8, 1)


def test_planted_periods(spark):
    import zlib

    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(i % 23)) if i else None, None) for i in range(200)], SCHEMA)
    for r in with_periods(docs).collect():
        h, words = zlib.crc32(str(r["doc_id"]).encode()), [f"w{k}" for k in range(r["doc_id"] % 23)]
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        assert words_of(r["text"]) == words


# ---- ranked search ------------------------------------------------------------------------


def plain_search(docs, queries, k):
    split = [re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) for _, t in docs]
    n_docs, n_terms = sum(map(bool, split)), sum(map(len, split))
    holders = Counter(t for s in split for t in set(s))
    out = []
    for item, text in queries:
        asked = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        scores = []
        for (doc_id, _), s in zip(docs, split, strict=True):
            tf, score = Counter(s), 0
            m = 75 + (25 * len(s) * n_docs) // n_terms if n_terms else 0
            for t in asked:
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1)))
                    score += w * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m))
            if score > 0:
                scores.append((-score, math.inf if doc_id is None else doc_id, doc_id))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: x[:2])[:k])]
    return sorted(out, key=repr)


def invented(seed, n, most):
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(8)]
    rare = [f"r{i}" for i in range(300)]
    return [
        " ".join(rng.choice(common if rng.random() < 0.7 else rare) for _ in range(rng.randrange(most))) for _ in range(n)
    ]


@pytest.mark.parametrize("shard_bytes, block_terms", [(16_000_000, 200_000), (4000, 40)])
def test_search_is_that_of_the_definition(spark, shard_bytes, block_terms):
    docs = [(i, t) for i, t in enumerate(invented(1, 400, 40))]
    docs += [(None, docs[3][1]), (900, docs[3][1]), (3, docs[3][1]), (901, None), (902, ""), (903, "..."), (904, "C1 É c1-R5"), (905, "é")]
    queries = [(i, t) for i, t in enumerate(invented(2, 30, 12))] + [(100, None), (101, ""), (102, "C1, é r5"), (0, "c1"), (103, "nowhere")]
    params = ranked.RankParams(k=20, shard_bytes=shard_bytes, block_terms=block_terms)
    got = ranked.search(
        spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", *CLASH.split(", ")),
        spark.createDataFrame(queries, "item_id bigint, text string").selectExpr("*", "1 AS doc_id", "'x' AS query"),
        params,
    )
    assert sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got.collect()], key=repr) == plain_search(docs, queries, 20)


def test_search_of_empty_tables(spark, odd):
    queries = spark.createDataFrame([(1, "w1 w2")], "item_id bigint, text string")
    assert ranked.search(odd.limit(0), queries).count() == 0
    assert ranked.search(odd, queries.limit(0)).count() == 0
    assert ranked.search(odd.where("doc_id IN (1, 2, 3)"), queries).count() == 0
    got = [(r["doc_id"], r["rank"]) for r in ranked.search(odd, queries).orderBy("rank").collect()]
    assert [r for _, r in got] == list(range(1, 6)) and {d for d, _ in got} == {4, 5, None}


def test_best_positions_stop_before_the_lists_end():
    rng = np.random.default_rng(3)
    n = 20_000
    ids = np.arange(n)
    lists = []
    for _ in range(3):
        docs = np.sort(rng.choice(n, n // 2, replace=False))
        lists.append((ranked.ImpactList(docs, (1e6 * rng.random(len(docs)) ** 8).astype(np.int64)), 1))
    total = np.zeros(n, dtype=np.int64)
    for one, _ in lists:
        total[one.docs] += one.impacts
    best = sorted(zip((-total).tolist(), ids.tolist(), strict=True))[:20]
    found, looked = ranked.best_documents(lists, ids, 20)
    assert [(-s, d) for s, d in found] == best
    assert looked < n // 4


def test_ties_at_the_threshold_are_not_lost():
    ids = np.arange(1000)[::-1].copy()
    one = ranked.ImpactList(np.arange(1000), np.full(1000, 5, dtype=np.int64))
    found, _ = ranked.best_documents([(one, 2)], ids, 3)
    assert [(s, int(ids[d])) for s, d in found] == [(10, 0), (10, 1), (10, 2)]


# ---- passages -----------------------------------------------------------------------------


def plain_removed(docs, size):
    least = {}
    for doc_id, text in docs:
        w = words_of(text)
        for i in range(len(w) - size + 1 if doc_id is not None else 0):
            key = tuple(w[i : i + size])
            least[key] = min(least.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in docs:
        w = words_of(text)
        gone = set()
        for i in range(len(w) - size + 1 if doc_id is not None else 0):
            if least[tuple(w[i : i + size])] < doc_id:
                gone.update(range(i, i + size))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def removed(frame, params):
    got = passages.remove_repeats(frame, params).collect()
    for r in got:
        assert sum(s["length"] for s in r["removed"]) == r["n_words"] - len(words_of(r["kept"]))
    return sorted([(r["doc_id"], r["n_words"], sum(s["length"] for s in r["removed"]), r["kept"]) for r in got], key=repr)


@pytest.mark.parametrize("size, anchor, alphabet", [(50, 20, 400), (8, 3, 2), (6, 6, 3), (9, 1, 2)])
def test_removed_words_are_those_of_the_definition(spark, size, anchor, alphabet):
    rng = random.Random(size)
    passage = [[f"p{k}x{i}" for i in range(size + 2 * k)] for k in range(4)]
    docs = []
    for i in range(120):
        w = [f"w{rng.randrange(alphabet)}" for _ in range(rng.randrange(3 * size))]
        for p in rng.sample(passage, rng.randrange(3)):
            a, b = sorted(rng.sample(range(len(p) + 1), 2))
            w += p if rng.random() < 0.5 else p[a:b]
            w += [f"w{rng.randrange(alphabet)}" for _ in range(rng.randrange(size))]
        docs.append((i if rng.random() < 0.95 else None, " ".join(w)))
    docs += [(200 + i, docs[10 + i % 3][1]) for i in range(9)] + [(11, docs[12][1]), (11, docs[11][1]), (300, None), (301, "")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    params = passages.PassageParams(size, anchor)
    assert removed(frame, params) == plain_removed(docs, size)


def test_passages_of_odd_rows(spark, odd):
    want = plain_removed([(r["doc_id"], r["text"]) for r in odd.collect()], 50)
    assert removed(odd, passages.PassageParams()) == want
    assert passages.passage_digests(odd.limit(0)).count() == 0


def test_crowded_spans_take_their_own_way(spark, monkeypatch):
    monkeypatch.setattr(passages, "share", lambda rows: 2)
    part = " ".join(f"w{i}" for i in range(80))
    docs = [(i, f"a{i} {part} b{i % 4}") for i in range(30)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert removed(frame, passages.PassageParams()) == plain_removed(docs, 50)


def test_the_last_smallest_of_every_window():
    rng = np.random.default_rng(5)
    v = rng.integers(0, 4, 200)
    for n in (1, 2, 3, 7, 31):
        want = [i + max(k for k in range(n) if v[i + k] == v[i : i + n].min()) for i in range(len(v) - n + 1)]
        assert passages.last_smallest(v, n).tolist() == want
