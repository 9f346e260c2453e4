"""Operators that judge one text at a time, against plain versions."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roost.llm import bpe, chat, langid, outliers, pii, toxicity

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and very long texts, repeated rows, and columns with clashing names."""
    rows = [
        (1, None, None, None, None),
        (None, "Some words here.", "en", "a", 16),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "en", None, 4),
        (4, "ab" * 40_000, "en", "a", 80_000),
        (5, "word " * 30_000, "de", "b", 150_000),
        (6, "Call +1 (555) 123-4567 or a.b@mail.example.com", "en", "a", 46),
        (6, "Call +1 (555) 123-4567 or a.b@mail.example.com", "en", "a", 46),
        (7, "<|endoftext|> ΟΔΟΣ 1\x1c2 é é", "fr", "b", 25),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    clash = ("ids", "score", "kept", "toxic", "cls", "g", "n", "copy", "spans", "tokens", "x0", "_copies")
    return frame.select("*", *[F.lit("own").alias(c) for c in clash])


def texts_of(frame):
    return {(r["doc_id"], r["text"]) for r in frame.collect()}


# ---- BPE ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def same_as_library(library, texts):
    own = bpe.vocabulary(PATH)
    for text, ids in zip(texts, own.encode_all(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want, text[:80]
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs", "Cn"]), st.sampled_from("aeiounthstrs '"))))
def test_bpe_any_text(library, text):
    same_as_library(library, [text])


def test_bpe_lengths(library):
    words = ["".join("etaoinshr"[(i * i + k) % 9] for i in range(n)) for k, n in enumerate([*range(1, 140), 500, 3000])]
    same_as_library(library, [*words, " ".join(words), "", "  ", "<|endoftext|>a<|startoftext|>", "don't we'll I'm"])


@given(symbols=st.lists(st.integers(0, 3), max_size=60))
def test_segment_tree_is_the_plain_rule(symbols):
    merges = {(0, 1): (0 << 32, 2), (2, 2): (1 << 32, 3), (3, 0): (2 << 32, 1), (1, 1): (3 << 32, 0)}
    plain = list(symbols)
    while pairs := [(merges[p][0], i) for i, p in enumerate(zip(plain, plain[1:], strict=False)) if p in merges]:
        _, i = min(pairs)
        plain[i : i + 2] = [merges[plain[i], plain[i + 1]][1]]
    assert bpe.merge_all(list(symbols), merges) == plain


def test_bpe_documents(spark, library, odd):
    rows = bpe.decode_documents(bpe.encode_documents(odd, PATH), PATH).collect()
    assert len(rows) == odd.count()
    for r in rows:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False)
        assert r["score"] == "own"
    digests = bpe.round_trip_digests(odd, PATH).collect()
    want = Counter(hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest() for r in rows)
    assert Counter(r["ids_sha256"] for r in digests) == want
    assert bpe.round_trip_digests(odd.limit(0), PATH).count() == 0


# ---- PII ----------------------------------------------------------------------------------


def plain_base(text):
    """The contract's patterns, kind by kind, straight from their definition."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m.group())
        odd, even = digits[-1::-2], digits[-2::-2]
        if 16 <= len(digits) <= 19 and (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.findall("[0-9]", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


@settings(max_examples=500, deadline=None)
@given(text=st.text(alphabet="0123456789.@-+ ()ab%é"))
def test_pii_base_any_text(text):
    assert [s[:3] for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS] == plain_base(text)


def test_pii_documents(docs, odd):
    for r in pii.pii_digests(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        base = plain_base(r["text"])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(b[0] == k for b in base) for k in pii.BASE_KINDS]
        assert set(joined.split(",")) <= set(r["spans"].split(","))
    assert pii.pii_digests(odd).count() == odd.count()
    clean = {r["doc_id"]: r for r in pii.redact(odd).collect()}
    assert clean[6]["text"] == "Call <PHONE> or <EMAIL>" and clean[6]["n_chars"] == 23 and clean[6]["spans"] == "own"
    assert clean[1]["text"] is None
    assert pii.redact(odd.limit(0)).count() == 0


def test_pii_checks_and_context():
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765431")
    spans = pii.find_spans("IBAN GB82 WEST 1234 5698 7654 32 here")
    assert [(k, s, e) for k, s, e, _ in spans] == [("iban", 5, 32)] and spans[0][3] == 1.0
    texts = ("GB82 WEST 1234 5698 7654 32 EUR", "GB82WEST12345698765432 AND DE89 3704 0044 0532 0130 00.", "XX GB82WEST12345698765432X")
    found = [[t[s:e] for k, s, e, _ in pii.find_spans(t) if k == "iban"] for t in texts]
    assert found == [["GB82 WEST 1234 5698 7654 32"], ["GB82WEST12345698765432", "DE89 3704 0044 0532 0130 00"], []]
    assert pii.find_spans("passport 123456789")[0][0] == "number"
    assert pii.find_spans("there were 123456789 of them") == []
    sure, unsure = (pii.find_spans(t)[0][3] for t in ("host 10.0.0.1", "about 10.0.0.1"))
    assert sure > unsure


# ---- languages ----------------------------------------------------------------------------


def test_codewords_differ():
    for n in (2, 3, 4, 6, 7, 40):
        code = langid.codebook(n, 1)
        apart = (code.shape[1] - code @ code.T) / 2
        assert (apart[~np.eye(n, dtype=bool)] >= max(1, code.shape[1] // 5)).all()


def test_languages(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    unseen = [r for r in found if r["held_out"]]
    assert unseen and sum(r["lang"] == r["lang_pred"] for r in unseen) >= 0.97 * len(unseen)
    assert all(0 <= r["score"] <= 1 for r in found)
    held = {r["doc_id"]: r["held_out"] for r in found}
    assert held == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in held}
    rows = {(r["doc_id"], r["lang_pred"]) for r in langid.identify_languages(odd).collect()}
    assert {(1, "und"), (2, "und"), (3, "und")} <= rows
    assert langid.identify_languages(odd.limit(0)).count() == 0


def test_languages_learned_from_repeated_rows_and_many_languages(spark):
    repeated = spark.range(3000).selectExpr("id % 2 AS doc_id", "concat('some words ', id % 2) AS text", "'en' AS lang")
    assert {r["lang_pred"] for r in langid.identify_languages(repeated).select("lang_pred").distinct().collect()} <= {"en", "und"}
    words = spark.range(1200).selectExpr("id AS doc_id", "concat_ws(' ', array_repeat(md5(string(id % 300)), 5)) AS text", "concat('l', id % 300) AS lang")
    model = langid.fit(words, F.lit(True))
    assert len(model.languages) == 300
    found = langid.predict(words, model).join(words.select("doc_id", "lang"), "doc_id")
    assert found.where("lang = lang_pred").count() > 1100


def test_language_is_not_taken_from_columns(spark, docs):
    params = langid.LangIdParams()
    model = langid.fit(docs, F.lit(True), params)
    plain = langid.predict(docs, model).collect()
    blind = langid.predict(docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("x")), model).collect()
    assert [r["lang_pred"] for r in plain] == [r["lang_pred"] for r in blind]


# ---- toxicity -----------------------------------------------------------------------------


def test_toxicity(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    params = toxicity.ToxicityParams()
    unseen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    model = toxicity.fit(docs, labels.where(~unseen), toxicity.CATEGORIES, params)
    scored = toxicity.score_documents(docs, model, params).select("doc_id", "kept")
    found = scored.join(labels.where(unseen).select("doc_id", F.col("toxic").alias("label")), "doc_id").collect()
    clean = [r for r in found if r["label"] == 0]
    bad = [r for r in found if r["label"] == 1]
    assert sum(r["kept"] for r in clean) >= 0.99 * len(clean)
    assert sum(not r["kept"] for r in bad) >= 0.85 * len(bad)
    assert len(model.weights[1]) == len(model.weights[0]) + 1  # the second model sees the first one's probability
    assert toxicity.score_documents(odd, model, params).count() == odd.count()
    assert toxicity.drop_toxic(odd, model, params).columns == odd.columns
    docs = docs.where("doc_id < 300")
    kept = {r["doc_id"] for r in toxicity.score_documents(docs, model, params).where("kept").collect()}
    assert kept == {r["doc_id"] for r in toxicity.drop_toxic(docs, model, params).collect()}
    none = toxicity.fit(docs, labels.limit(0), toxicity.CATEGORIES, params)
    assert toxicity.drop_toxic(docs.limit(0), none, params).count() == 0


def test_nothing_is_toxic_without_positive_labels(spark):
    rows = [(i, ("good plain words", "bad vile words", None)[i % 3]) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    label = "doc_id long, quality int, toxic int"
    empty = spark.createDataFrame([], label)
    unmatched = spark.createDataFrame([(i + 1000, 0, 1) for i in range(20)], label)
    negative = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], label)
    params = toxicity.ToxicityParams()
    for labels in (empty, unmatched, negative):
        model = toxicity.fit(docs, labels, toxicity.CATEGORIES, params)
        scored = toxicity.score_documents(docs, model, params).collect()
        assert len(scored) == 30 and all(r["kept"] and not r["toxic"] and r["p_toxic"] == 0 for r in scored)
        assert toxicity.drop_toxic(docs, model, params).count() == 30
    assert any(r["p_low_quality"] > 0 for r in scored)


# ---- quality ------------------------------------------------------------------------------


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:], strict=False))
    count = Counter(windows)
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len({i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}),
    )


def test_quality(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    stats = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = outliers.quality_rules(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(found) == docs.count()
    for r in found:
        want = plain_statistics(r["text"])
        assert tuple(r[s] for s in stats) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    usable = [r for r in found if not r["base_failed"] and r["doc_id"] in quality]
    assert all(r["kept"] for r in usable if quality[r["doc_id"]] == 1)
    poor = [r for r in usable if quality[r["doc_id"]] == 0]
    assert sum(not r["kept"] for r in poor) >= 0.8 * len(poor)
    rows = {r["doc_id"]: r for r in outliers.quality_rules(odd).collect()}
    assert rows[1]["n_words"] == 0 and rows[1]["base_failed"] and rows[5]["n_repeat_words"] == 30_000
    assert outliers.quality_rules(odd).count() == odd.count()
    assert outliers.quality_rules(odd.limit(0)).count() == 0


def test_small_determinant_is_found(spark):
    """A tenth of far points neither moves the centre nor widens the spread."""
    rng = np.random.default_rng(0)
    good = rng.multivariate_normal(np.zeros(5), np.eye(5) * 0.5 + 0.5, 900)
    rows = np.vstack([good, rng.normal(9, 0.2, (100, 5))])
    whole = np.round(rows * outliers.GRID).astype(int)
    frame = spark.createDataFrame([("a", *map(int, r)) for r in whole], "g string, " + ", ".join(f"x{i} long" for i in range(5)))
    chosen = outliers.minimum_covariance(frame, outliers.OutlierParams(least_spread=(0.0,) * 5))
    got = outliers.measured(frame, chosen.drop("members")).select((outliers.distance() / chosen["scale"]).alias("d"), "x0").collect()
    far = sum(r["d"] > outliers.CHI5_UPPER[0.9999] for r in got)
    assert far >= 100 and far <= 110
    e = chosen.first()
    assert np.abs([e[f"m{i}"] for i in range(5)]).max() < 0.2


def test_nearly_half_of_a_group_may_be_junk(spark):
    """Clean and symbol-laden documents of one source, production parameters."""
    assert abs(outliers.consistency(0.5) - 1.9122082) < 1e-6
    words = ["data", "river", "of", "stone", "a", "morning", "window", "in", "green", "yesterday", "paper", "walk"]
    for bad, n in ((400, 1000), (27, 60)):
        rng = np.random.default_rng(n + bad)
        texts = []
        for i in range(n):
            some = rng.choice(words, int(np.exp(rng.normal(5.6, 0.5))) + 60).tolist()
            junk = rng.random(len(some)) < rng.uniform(0.3, 0.4) if i < bad else np.zeros(len(some), dtype=bool)
            texts.append(" ".join(w + "#$%" if j else f"{w}{k}" for k, (w, j) in enumerate(zip(some, junk, strict=True))))
        frame = spark.createDataFrame([(i, t, "en", "web") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
        kept = {r["doc_id"] for r in outliers.quality_rules(frame).where("kept").collect()}
        assert sum(i not in kept for i in range(bad)) >= 0.95 * bad
        assert sum(i not in kept for i in range(bad, n)) <= 0.005 * n


# ---- chat ---------------------------------------------------------------------------------

CHAT = "conv_id bigint, turn bigint, role string, text string, valid string, formatted string"


def test_chat(spark):
    template = chat.ChatTemplate()
    parts = [*template.controls(), chat.ESCAPE, "e", "0", "<", "/s>", "[", "é\n", ""]
    rows = []
    for c in range(40):
        for t in range(c % 6):
            text = "".join(parts[(c * 7 + t * 3 + k * (c + 1)) % len(parts)] for k in range(c % 9))
            rows.append((c, t, ("system", "user", "assistant", "[/ROLE]x", None)[(c + t) % 5], text, "own", "own"))
    rows += [(100, 0, "user", None, "", ""), (100, 1, "assistant", "yes", "", ""), (101, 1, "user", "b", "", ""), (101, 1, "user", "a", "", "")]
    rows += [(102, 0, "system", "s", "", ""), (102, 1, "user", "q" * 200_000, "", ""), (102, 2, "assistant", "a", "", ""), (None, 0, "user", "x", "", "")]
    frame = spark.createDataFrame(rows, CHAT)
    made = chat.format_chats(frame, template)
    got = {r["conv_id"]: r for r in made.withColumn("turns", chat.read_turns(made["formatted"], template)).collect()}
    want = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2] or "", r[3] or "")):
        want.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert {c: [tuple(t) for t in r["turns"]] for c, r in got.items()} == want
    assert got[100]["valid"] and got[102]["valid"] and not got[101]["valid"] and got[101]["bad_turn"] == 1
    assert [s["text"] for s in got[100]["segments"] if s["loss"]] == ["yes"]
    digests = {r["conv_id"]: r for r in chat.chat_digests(frame).collect()}
    for c, turns in want.items():
        told = "".join(f"{r}\n{t}\n" for r, t in turns)
        lost = "".join(t for r, t in turns if r == "assistant")
        assert digests[c]["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert (digests[c]["loss_chars"], digests[c]["loss_sha256"]) == (len(lost), hashlib.sha256(lost.encode()).hexdigest())
    assert chat.chat_digests(frame.limit(0)).count() == 0
