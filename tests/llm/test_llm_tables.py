"""Operators that compare rows, mix or archive them, against plain versions; the queries and the pipeline."""

import base64
import hashlib
import math
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from conftest import rows as listed
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from roost.llm import bpe, jaccard, mixing, pii, queries, toxicity, vectors, warc
from roost.operators.components import connected

SF = Path("/root/testdata/sf0.001")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, cls string, n string, root string"


def roots_of(nodes, links):
    """Plain union-find: node -> smallest node of its component."""
    above = {n: n for n in nodes}

    def top(n):
        while above[n] != n:
            above[n] = above[above[n]]
            n = above[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        above[b] = a
    return {n: top(n) for n in nodes}


# ---- components ---------------------------------------------------------------------------


def test_components(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (1002, 1002)]
    hub = [(2000, 2000 + i) for i in range(1, 400)]
    found = connected(spark.createDataFrame([*chain, *hub, (None, 5)], "u bigint, v bigint"))
    links = [e for e in chain + hub if e[0] != e[1]]
    want = roots_of({n for e in links for n in e}, links)
    assert {r["node"]: r["root"] for r in found.collect()} == want
    assert found.rounds <= 6
    assert connected(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# ---- vectors ------------------------------------------------------------------------------


def test_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((60, 16))
    close = base[:1] + rng.standard_normal((200, 16)) * 0.12
    copies = np.repeat(base[5:6], 50, axis=0)
    x = np.concatenate([base, base[:20] + rng.standard_normal((20, 16)) * 0.1, close, copies]).astype(np.float32)
    label = np.where(np.arange(len(x)) < 80, np.arange(len(x)) % 2, 0)
    made = [(int(i), v.tolist(), int(k), "own") for i, (v, k) in enumerate(zip(x, label, strict=True))]
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    made += [(1000 + i, v, 0, "own") for i, v in enumerate(bad)] + [(2000, x[0].tolist(), None, "own"), (2001, [1.0, 2.0], 0, "own")]
    schema = "vec_id bigint, embedding array<float>, label int, cls string"
    got = {r["vec_id"]: r for r in vectors.near_vectors(spark.createDataFrame(made, schema), vectors.VectorParams(block_rows=60)).collect()}
    assert len(got) == len(made)
    wide = x.astype(float)
    norm = np.linalg.norm(wide, axis=1)
    link = (wide @ wide.T / np.outer(norm, norm) >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(link, False)
    roots = roots_of(range(len(x)), zip(*np.nonzero(link), strict=True))
    for i in range(len(x)):
        assert (got[i]["component_id"], got[i]["kept"]) == (roots[i], roots[i] == i)
    assert sum(got[i]["n_links"] for i in range(len(x))) >= 0.999 * link.sum()
    assert all(got[i]["n_links"] <= link[i].sum() for i in range(len(x)))
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in got if i >= 1000)
    assert vectors.near_vectors(spark.createDataFrame([], schema)).count() == 0


def test_buckets_grow_in_number_not_in_size(spark):
    """Twice the different vectors, hardly more than twice the pairs that are compared; the recall holds."""
    params = vectors.VectorParams(least_bits=6)

    def candidates(n):
        fitted = params.fitted(n)
        rows = [(i, v.tolist(), "a") for i, v in enumerate(np.random.default_rng(3).standard_normal((n, 24)))]
        classes = vectors.vector_classes(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string"))
        keyed = vectors.bucket_keys(classes.selectExpr("*", "1L AS n"), fitted)
        sizes = keyed.selectExpr("posexplode(keys) AS (tab, key)").groupBy("tab", "key").count()
        return sizes.selectExpr("sum(count * (count - 1) / 2)").first()[0]

    small, large = candidates(2000), candidates(4000)
    assert large <= 2.5 * small
    for largest in (1, 10**5, 10**9):
        fitted = params.fitted(largest)
        same = (1 - np.arccos(0.98) / np.pi) ** fitted.bits
        assert 1 - (1 - same) ** fitted.tables() >= params.recall
    assert vectors.VectorParams(bits=9).fitted(10**9).bits == 9


# ---- Jaccard ------------------------------------------------------------------------------


def plain_sets(texts):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text in texts:
        words = [w for w in (text or "").translate(lower).translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if w]
        yield {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def plain_components(ids, texts):
    sets = list(plain_sets(texts))
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for gram in s:
            where[gram].append(i)
    both = Counter((a, b) for held in where.values() for k, b in enumerate(held) for a in held[:k])
    links = [(ids[a], ids[b]) for (a, b), n in both.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    roots = roots_of(ids, links)
    return {i: (len(s), roots[i]) for i, s in zip(ids, sets, strict=True)}


def varied_texts():
    """Groups of near copies around the threshold, of all sizes, and passages that unrelated texts share."""
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    draw = lambda n: [str(w) for w in rng.choice(vocabulary, n)]
    passage = draw(60)
    texts = [None, "", " \n", "one two", "One  two", "a b c d", "a b c d e", "word " * 3000]
    for size in (5, 6, 7, 9, 12, 17, 25, 40, 70, 130, 300, 900):
        words = draw(size)
        for k in range(14):
            copy = list(words)
            for at in rng.choice(size, min(size, int(rng.integers(0, 2 + size // 30))), replace=False):
                copy[at] = "new" + str(rng.integers(10**6))
            texts.append(" ".join(copy[k % 3 :] if size > 20 else copy))
    texts += [" ".join(draw(20) + passage + draw(20)) for _ in range(40)]
    texts += [" ".join(passage + draw(3)) for _ in range(40)]
    return texts


def test_jaccard(spark):
    texts = varied_texts()
    frame = spark.createDataFrame([(i, t, "en", "a", 0, "own", "own", "own") for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_documents(frame).collect()}
    assert got == plain_components(list(range(len(texts))), texts)
    few = jaccard.JoinParams(rare=2, small=3, rounds=2, field_classes=20, field_tokens=5000)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_documents(frame, few).collect()} == got
    left = jaccard.one_of_each(frame)
    assert left.columns == frame.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(i for i, (_, c) in got.items() if i == c)


def test_jaccard_crowded_tokens_and_blocks(spark, monkeypatch):
    """Crowded tokens by broadcast, and entries that stay open settled in blocks, change no result."""
    texts = varied_texts()
    rng = np.random.default_rng(8)
    # A template in three quarters of each text; the rest is shared by few, so that all of it counts.
    template = " ".join(f"t{i}" for i in range(75))
    parts = [" ".join(f"r{rng.integers(60)}" for _ in range(6)) for _ in range(60)]
    texts += [" ".join([template, *(parts[i] for i in rng.choice(60, 4))]) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    monkeypatch.setattr(jaccard, "CROWDED_SAMPLE", 1)
    monkeypatch.setattr(jaccard, "CROWDED_FROM", 5)
    few = jaccard.JoinParams(rare=2, small=1, rounds=1, field_classes=20, field_tokens=5000, block_classes=30, block_tokens=3000)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_documents(frame, few).collect()}
    assert got == plain_components(list(range(len(texts))), texts)


def test_jaccard_odd_rows(spark):
    same = "a b c d e f g h i j k l"
    close = " ".join("abcdefghijklmnopqrstuvwxyz")
    made = [(7, same), (7, same), (None, same), (9, same), (None, None), (10, None), (11, "é É a b c"), (12, "é É A B C")]
    made += [(None, close), (20, close + " 1")]
    frame = spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in made], SCHEMA)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_documents(frame).collect())
    want = [(7, 8, 7), (7, 8, 7), (None, 8, 7), (9, 8, 7), (None, 0, None), (10, 0, 10), (11, 1, 11), (12, 1, 11)]
    want += [(None, 22, 20), (20, 23, 20)]
    assert got == Counter(want)
    assert jaccard.near_documents(frame.limit(0)).count() == 0
    assert jaccard.one_of_each(frame.limit(0)).count() == 0
    left = Counter((r["doc_id"], r["text"]) for r in jaccard.one_of_each(frame).collect())
    assert left == Counter([(7, same), (None, None), (10, None), (11, "é É a b c"), (20, close + " 1")])


def test_one_of_each_judges_texts_not_ids(spark):
    a, b = "a b c d e f g h", "q r s t u v w x"
    rows = [(1, a), (5, a), (5, b), (None, a), (None, a)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("_key", F.lit("own"))
    left = jaccard.one_of_each(frame)
    assert left.columns == frame.columns
    assert sorted((r["doc_id"], r["text"]) for r in left.collect()) == [(1, a), (5, b)]


# ---- mixing -------------------------------------------------------------------------------


def plain_poisson(mean, draws):
    steps = max(1, math.ceil(mean / 8))
    total = 0
    for i in range(1, steps + 1):
        k, p = 0, math.exp(-mean / steps)
        cdf = p
        while draws(i) >= cdf and k < 60:
            k += 1
            p *= mean / steps / k
            cdf += p
        total += k
    return total if mean > 0 else 0


def test_mixing(spark):
    made = [(i, "t", "en", ("big", "small", "tiny", None)[0 if i % 20 else i // 20 % 4], 10, "", "", "") for i in range(6000)]
    made += [(9001, None, None, "empty", None, "", "", ""), (None, "x", "en", "big", 10, "", "", "")]
    frame = spark.createDataFrame(made, SCHEMA).withColumn("copy", F.lit("own"))
    params = mixing.MixParams(weights={"big": 0.2, "small": 0.3, "tiny": 0.3, "": 0.2}, size="n_chars", scale=2.0)
    rates = {r["source"]: r["rate"] for r in mixing.repetition_rates(frame, params).collect()}
    assert rates["empty"] == 2.0
    unit = lambda *p: int(hashlib.md5(":".join(map(str, p)).encode()).hexdigest()[:13], 16) / 2**52
    want = {r[0]: plain_poisson(rates[r[3]], lambda i, d=r[0]: unit("mix", d, i)) for r in made if r[0] is not None}
    out = mixing.mix_numbered(frame, params).where("doc_id IS NOT NULL").collect()
    got = Counter(r["doc_id"] for r in out)
    assert got == Counter({d: n for d, n in want.items() if n})
    assert all(r["n_copies"] == got[r["doc_id"]] for r in out)
    by_source = Counter(r["source"] for r in out)
    for source, share in (("big", 0.2), ("small", 0.3), ("tiny", 0.3), (None, 0.2)):
        assert abs(by_source[source] / len(out) - share) < 0.03
    plain = mixing.mix(frame, params)
    assert plain.columns == frame.columns and plain.count() == mixing.mix_numbered(frame, params).count()
    order = [r["doc_id"] for r in out[:200]]
    assert order != sorted(order)
    assert mixing.mix(frame.limit(0), params).count() == 0


def test_mixing_without_sizes(spark):
    """Sources whose sizes are null, for some or all, keep their documents."""
    made = [(i, "t" * (i % 5), "en", "ab"[i % 2], None if i % 2 else 10, "", "", "") for i in range(2000)]
    frame = spark.createDataFrame(made, SCHEMA)
    for size in ("n_chars", "coalesce(n_chars, length(text))", "CAST(NULL AS INT)"):
        shares = Counter(r["source"] for r in mixing.mix(frame, mixing.MixParams(size=size)).collect())
        assert min(shares["a"], shares["b"]) > 500
    rates = mixing.repetition_rates(frame, mixing.MixParams(size="CAST(NULL AS INT)", weights={"a": 3.0})).collect()
    assert {r["source"]: r["rate"] for r in rates} == {"a": 1.5, "b": 0.5}


# ---- archives -----------------------------------------------------------------------------


@pytest.mark.parametrize(
    "spark_address, arrow_address",
    [
        ("/tmp/a", "file:///tmp/a"), ("file:/tmp/a", "file:///tmp/a"), ("file:///tmp/a", "file:///tmp/a"),
        ("s3a://bucket/a", "s3://bucket/a"), ("s3n://bucket/a", "s3://bucket/a"), ("gs://bucket/a", "gs://bucket/a"),
        ("abfss://box@store.dfs.core.windows.net/a", "abfss://box@store.dfs.core.windows.net/a"),
        ("hdfs://name:8020/a", "hdfs://name:8020/a"), ("viewfs://cluster/a", "viewfs://cluster/a"),
    ],
)
def test_storage_addresses(spark_address, arrow_address):
    assert warc.store_address(spark_address) == arrow_address


@pytest.mark.parametrize("address", ["dbfs:/a", "relative/a", "wasb://box/a", "s3a:bucket", ""])
def test_storage_without_a_writer_is_refused(spark, address):
    with pytest.raises(ValueError, match="archives need an address"):
        warc.write_archives(spark.range(0), address)


def test_revisits_beyond_a_broadcast(spark):
    frame = spark.createDataFrame([(i, "u", "abc"[i % 4 : i % 4 + 1]) for i in range(20)] + [(None, "u", "a")], "page_id bigint, url string, html string")
    few, many = (warc.with_first(frame, max_broadcast=n).select("page_id", "n_bytes", "refers_to") for n in (100, 0))
    assert Counter(map(tuple, few.collect())) == Counter(map(tuple, many.collect()))


def test_archives(spark):
    long = "é" * 400_000 + "x"
    made = [(1, "http://a/\r\nb", "same", "own"), (2, None, "same", "own"), (2, "u", "same", "own"), (3, "u", None, "own")]
    made += [(4, "u", "", "own"), (5, "u", long, "own"), (6, "u", long, "own"), (7, "u", "WARC/1.1\r\n\r\n", "own"), (None, "u", "same", "own")]
    frame = spark.createDataFrame(made, "page_id bigint, url string, html string, chunk string")
    got = Counter(tuple(r) for r in warc.archive_round_trip(spark, frame).collect())
    want = []
    first = {"same": 1, "": 3, long: 5, "WARC/1.1\r\n\r\n": 7}
    for page, _, html, _ in made:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        refers = None if first[html or ""] == page else first[html or ""]
        want.append((page, len(raw), digest, "revisit" if refers else "response", refers))
    assert got == Counter(want)
    big = warc.archive_round_trip(spark, frame, at_least=5).where("record_type = 'revisit'").collect()
    assert [r["page_id"] for r in big] == [6]
    assert warc.archive_round_trip(spark, frame.limit(0)).count() == 0


def test_chunks_of_a_long_record(spark, tmp_path):
    text = "".join(chr(97 + i % 26) for i in range(10_000))
    frame = spark.createDataFrame([(1, "u", text), (2, "u", "short")], "page_id bigint, url string, html string")
    chunks = warc.chunk_table(warc.with_first(frame), chunk_bytes=4096)
    assert [(r["chunk"], len(r["data"]), r["last"]) for r in chunks.where("page_id = 1").orderBy("chunk").collect()] == [
        (0, 4096, False),
        (1, 4096, False),
        (2, 1808, True),
    ]
    folder = f"file://{tmp_path}/archives"
    back = warc.read_archives(warc.write_archives(chunks, folder), folder, chunk_bytes=3000).where("page_id = 1").orderBy("chunk").collect()
    assert b"".join(bytes(r["data"]) for r in back).decode() == text
    for r in back:
        so_far = hashlib.sha1(text[: 3000 * (r["chunk"] + 1)].encode()).digest()
        assert r["digest_so_far"] == base64.b32encode(so_far).decode()


# ---- queries and pipeline -----------------------------------------------------------------


def test_all_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert names["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_and_twin(spark, name):
    db = duckdb.connect()
    for f in SF.glob("*.parquet"):
        db.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    df = queries.QUERIES[name](spark, str(SF))
    columns = sorted(df.columns)
    found = db.execute(queries.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in found.fetchall()), key=repr)
    assert listed(df, *columns) == want


def test_pipeline_stages_on_odd_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("_key", F.lit("own")).withColumn("ids", F.lit(1))
    nulls = docs.limit(1).selectExpr(*[f"CAST(NULL AS {t}) AS {c}" for c, t in docs.dtypes])
    some = docs.where("doc_id < 20").unionByName(nulls).unionByName(nulls)
    for table in (docs.limit(0), some):
        at = table
        for name, step in corpus_pipeline.STAGES:
            out = step(spark, at, str(SF))
            if name != "bpe":
                assert out.columns == docs.columns
            got = out.collect()
            assert (len(got) > 0) == (table is some)
            if name in ("toxicity", "jaccard", "pii"):
                assert sum(r["text"] is None for r in got) == (2 if table is some else 0)
            at = spark.createDataFrame(got, out.schema)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    by_name, at = {}, docs
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, at, str(SF))
        if name != "bpe":
            assert out.columns == docs.columns
        by_name[name] = {(r["doc_id"], r["text"]) for r in out.collect()} if name != "bpe" else out.collect()
        at = out
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    params = toxicity.ToxicityParams()
    score = toxicity.scorer(toxicity.fit(docs, labels, toxicity.CATEGORIES, params), params)
    kept = {(r["doc_id"], r["text"]) for r in docs.collect() if score(r["text"])[-1] < params.threshold}
    assert by_name["toxicity"] == kept
    ids, texts = zip(*sorted(kept), strict=True)
    single = {i for i, (_, c) in plain_components(list(ids), list(texts)).items() if i == c}
    assert by_name["jaccard"] == {r for r in kept if r[0] in single}
    clean = {(i, pii.redacted(t, pii.find_spans(t))) for i, t in by_name["jaccard"]}
    assert by_name["pii"] == clean
    assert by_name["mixing"] <= clean
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = dict(by_name["mixing"])
    for r in by_name["bpe"]:
        want = tokenizer.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == tokenizer.decode(want, skip_special_tokens=False)
    again = corpus_pipeline.run(spark, str(SF)).collect()
    assert Counter(r["doc_id"] for r in again) == Counter(r["doc_id"] for r in by_name["bpe"])
    assert bpe.vocabulary(public_tokenizers.path("word_bpe_49k.json")).special
