"""Tokenizer, archives, embeddings, classifiers and the pipeline."""

import base64
import gzip
import math
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from strata.llm import byte_bpe, embedding_dedup, graph, langid, quality, toxicity, warc
from strata.llm.common import table

SF = "/root/testdata/sf0.01"
TINY = "/root/testdata/sf0.001"
NAMES = [f"op{i}_" for i in range(1, 14)] + ["pipeline"]


def test_every_dealt_query_is_registered():
    own = [n for n in queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(own, key=lambda n: int(n[2:].split("_")[0])) == [next(n for n in own if n.startswith(p)) for p in NAMES[:-1]]
    assert "pipeline" in queries()
    assert {n for n in oracle_sql() if n in own} == {"op4_line_dedup", "op7_warc", "op11_hard_negatives", "op12_prefix_trie"}


# ---------------------------------------------------------------- tokenizer

@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.tokenizer(byte_bpe.default_ranks(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(byte_bpe.default_ranks(), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_equals_the_library(bpe, reference):
    rng = random.Random(1)
    parts = ["the", " and", "ing", "'s", "'re", "\n", "\n\n", " ", "  ", "\t", "\r\n", "123", "é", "ß", "中文", "😀", "\x85",
             "\xa0", "　", "!!", "###", "aaaa", "zq", ".", ", ", "-", "<|endoftext|>", "\x1c", "́"]
    for _ in range(6000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 25)))
        assert bpe.encode(t) == reference.encode_ordinary(t)
        assert bpe.decode(bpe.encode(t)) == t.encode() == bpe.decode_text(bpe.encode_text(t))


def test_every_token_of_the_vocabulary(bpe, reference):
    for t in bpe.tokens:
        try:
            s = t.decode()
        except UnicodeDecodeError:
            continue
        assert bpe.encode(s) == reference.encode_ordinary(s)


@pytest.mark.parametrize("t", ["", "a" * 9000, " " * 5000, "ab" * 4000, "=" * 3333, "\n" * 2000 + "x", "é" * 2000,
                               "lorem " * 9000, "x  y " * 500])
def test_long_and_odd_texts(bpe, reference, t):
    assert bpe.encode(t) == reference.encode_ordinary(t)


def test_full_memories_change_nothing(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PAIRS", 5)
    monkeypatch.setattr(byte_bpe, "CHUNKS", 4)
    small = byte_bpe.ByteBpe(byte_bpe.read_ranks(byte_bpe.default_ranks()), public_tokenizers.PATTERN)
    rng = random.Random(2)
    for _ in range(300):
        t = " ".join("".join(rng.choice("aeinstrh") for _ in range(rng.randrange(1, 9))) + rng.choice(["", ".", ",", ".."])
                     for _ in range(12))
        assert small.encode(t) == reference.encode_ordinary(t)


def test_op5_and_decoding(spark, reference):
    docs = table(spark, TINY, "documents")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in byte_bpe.op5_byte_bpe(spark, TINY).collect():
        ids = reference.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == brute.sha(" ".join(map(str, ids)))
        assert r["decoded_sha256"] == brute.sha(texts[r["doc_id"]])
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (None, "hi  there", None)], "doc_id long, text string, n_tokens string")
    enc = byte_bpe.encode_texts(odd, byte_bpe.default_ranks(), public_tokenizers.PATTERN)
    dec = byte_bpe.decode_ids(enc, byte_bpe.default_ranks(), public_tokenizers.PATTERN).collect()
    assert [bytes(r["__decoded"]) for r in dec] == [b"", b"", b"hi  there"] and [r["__n_tokens"] for r in dec] == [0, 0, 3]


# ---------------------------------------------------------------- archives

def page_rows():
    rng = random.Random(9)
    long = "".join(rng.choice("abc<>é\r\n ") for _ in range(60000))
    pages = [(i, f"http://x/{i}", rng.choice(["short", "s" * 99, "s" * 100, "é" * 50, long, long[:20000], f"page {i} " * 20]))
             for i in range(60)]
    pages += [(100, None, None), (101, "u", ""), (102, "bad url \r\n", "WARC/1.1\r\n\r\n" * 30), (None, "n", long), (None, "n", long),
              (5, "again", "another " * 40), (5, "again", "another " * 40), (6, "seg", long + "x"), (6, "seg", long + "x")]
    return pages


def wanted_pages(rows):
    first = {}
    for p, _, h in rows:
        if len((h or "").encode()) >= 100 and p is not None:
            first[h] = min(p, first.get(h, p))
    out = []
    for p, _, h in rows:
        data = (h or "").encode()
        f = first.get(h)
        again = len(data) >= 100 and f is not None and p != f
        out.append((p, len(data), brute.sha(data), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment,records", [(16 << 10, 8000), (700, 7)])
def test_archives_round_trip(spark, tmp_path, segment, records):
    rows = page_rows()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    warc.write_archives(pages, str(tmp_path / "a"), segment=segment, archive_records=records)
    responses, revisits = warc.read_archives(spark, str(tmp_path / "a"))
    assert sorted(map(tuple, warc.describe(responses, revisits).collect()), key=str) == wanted_pages(rows)
    html = {(r["page_id"], bytes(r["payload"])) for r in responses.collect()}
    assert html <= {(p, (h or "").encode()) for p, _, h in rows}


def test_archives_of_no_pages(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "e"))
    responses, revisits = warc.read_archives(spark, str(tmp_path / "e"))
    assert warc.describe(responses, revisits).collect() == []


def test_chunked_framing():
    for n in (0, 1, 4095, 4096, 4097, 20000):
        assert warc.unchunked(warc.chunked(b"x\r\n" * n)) == b"x\r\n" * n
    assert warc.unchunked(b"3;name=v\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for bad in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n\r\n", b"3\r\nabc\r\n"):
        with pytest.raises(warc.WarcError):
            warc.unchunked(bad)


def damaged(change):
    payload = b"payload " * 500
    parts = warc.records(1, "u", payload, brute.sha(payload), None, 1000)
    return gzip.compress(b"".join(r + warc.RECORD_END for r in change(parts)))


@pytest.mark.parametrize("change,says", [
    (lambda p: p[:-1], "its segments"), (lambda p: [*p[:1], *p[2:]], "its segments are not"), (lambda p: [*p, p[1]], "segments"),
    (lambda p: [p[0].replace(b"payload", b"daylopa"), *p[1:]], "digest"), (lambda p: [p[0][:-3], *p[1:]], "Content-Length"),
    (lambda p: [b"junk", *p], "no record starts")])
def test_damaged_archives_are_refused(spark, tmp_path, change, says):
    (tmp_path / "x.warc.gz").write_bytes(damaged(change))
    with pytest.raises(Exception, match=says):
        warc.describe(*warc.read_archives(spark, str(tmp_path))).collect()


def test_segments_may_come_in_any_order(spark, tmp_path):
    (tmp_path / "x.warc.gz").write_bytes(damaged(lambda p: p[::-1]))
    got = warc.describe(*warc.read_archives(spark, str(tmp_path))).collect()
    assert [(r["page_id"], r["payload_bytes"]) for r in got] == [(1, 4000)]


# ---------------------------------------------------------------- links

def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    pairs += [(200 + rng.randrange(60), 200 + rng.randrange(60)) for _ in range(50)]
    rng.shuffle(pairs)
    root = {x: x for p in pairs for x in p}
    for _ in range(len(root)):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    got = graph.components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()
    assert {r["node"]: r["component"] for r in got} == {x: r for x, r in root.items() if x != r}


@pytest.mark.parametrize("block", [1024, 8])
def test_embeddings_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(2)
    base = rng.standard_normal((30, 24))
    rows = []
    for i in range(260):
        v = base[i % 30] + rng.standard_normal(24) * rng.choice([0, 0.1, 0.22, 0.3])
        rows.append((i * 2, (v * rng.choice([1, 1, 3e20, 1e-20])).tolist(), 1))
    rows += [(700, None, 0), (701, [], 0), (702, [0.0] * 24, 0), (703, [math.nan] + [1.0] * 23, 0), (704, [math.inf] * 24, 0),
             (705, [None] + [1.0] * 23, 0), (706, [1.0, 0.0], 0), (707, [2.0, 0.01], 0), (708, [5.0], 0), (709, [7.0], 0),
             (710, [-1.0], 0), (None, rows[0][1], 0), (0, rows[0][1], 0), (0, rows[1][1], 0)]
    links, root = [0] * len(rows), list(range(len(rows)))

    def unit(r):
        v = r[1]
        if r[0] is None or not v or None in v or not np.isfinite(v).all() or not any(v):
            return None
        v = np.array(v) / np.abs(v).max()
        return v / np.sqrt((v * v).sum())

    units = [unit(r) for r in rows]
    for _ in range(2):
        for i, a in enumerate(units):
            for j in range(i):
                b = units[j]
                if a is not None and b is not None and len(a) == len(b) and a @ b >= 0.95:
                    links[i] += _ == 0
                    links[j] += _ == 0
                    root[i] = root[j] = min(root[i], root[j], key=lambda k: rows[k][0])
    for _ in range(20):
        root = [root[r] for r in root]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, unit int")).collect()
    wanted = sorted(((r[0], n, rows[k][0], r[0] == rows[k][0]) for r, n, k in zip(rows, links, root)), key=str)
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got), key=str) == wanted
    assert sum(links) > 200


def test_embeddings_of_an_empty_table(spark):
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_hadamard_keeps_lengths_and_hashes_meet():
    x = np.random.default_rng(1).standard_normal((50, 64))
    assert np.allclose(np.linalg.norm(embedding_dedup.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert embedding_dedup.meeting_chance(64, 3, 0.95) > 0.6 > 0.05 > embedding_dedup.meeting_chance(64, 3, 0.3)


# ---------------------------------------------------------------- classifiers

ODD = [(10 ** 6, None), (10 ** 6 + 1, ""), (10 ** 6 + 2, "...123"), (10 ** 6 + 3, "a" * 200000), (10 ** 6 + 3, "again"), (None, "no id")]


def scored(spark, fn, label, mod, rest, sf=SF):
    got = fn(spark, sf).collect()
    truth = {r["doc_id"]: r[label] for r in table(spark, sf, "labels" if label != "lang" else "documents").collect()}
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % mod == rest)
        assert 0 <= r["score"] <= 1
    return [(r, truth[r["doc_id"]]) for r in got if r["held_out"] and truth.get(r["doc_id"]) is not None]


def test_quality_on_held_out_documents(spark):
    held = scored(spark, quality.op9_quality, "quality", 4, 2)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r, _ in held)
    assert np.mean([r["predicted"] == y for r, y in held]) > 0.93


def test_toxicity_on_held_out_documents(spark):
    held = scored(spark, toxicity.op3_toxicity, "toxic", 5, 0, sf="/root/testdata/sf0.1")
    assert all(r["predicted"] == (r["score"] >= 0.5) for r, _ in held)
    assert np.mean([r["predicted"] == y for r, y in held]) > 0.97
    assert np.mean([r["predicted"] for r, y in held if y]) > 0.8


def test_languages_on_held_out_documents(spark):
    held = scored(spark, langid.op8_language_id, "lang", 4, 2)
    assert np.mean([r["lang_pred"] == y for r, y in held]) > 0.97


def test_scores_of_odd_texts(spark):
    docs, labels = table(spark, TINY, "documents").select("doc_id", "text"), table(spark, TINY, "labels")
    odd = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("score", F.lit("clash"))
    model = quality.fit_quality(docs, labels.select("doc_id", "quality"))
    got = [r["__quality"] for r in quality.score_quality(odd, model).collect()]
    assert len(got) == len(ODD) and all(0 <= s <= 1 for s in got) and got[0] == got[1] == model.prior
    tox = toxicity.fit_toxicity(docs, labels.select("doc_id", "toxic"))
    got = [r["__toxicity"] for r in toxicity.score_toxicity(odd, tox).collect()]
    assert len(got) == len(ODD) and all(0 <= s <= 1 for s in got) and got[0] == got[1]
    lang = langid.fit_langid(table(spark, TINY, "documents"))
    got = langid.predict_langs(odd, lang, reject=False).collect()
    assert [r["__lang"] for r in got][:3] == ["und"] * 3 and all(r["__lang"] in lang.langs for r in got[3:])
    assert [r["__score"] for r in got][:3] == [0.0] * 3
    far = spark.createDataFrame([(1, "слово " * 50)], "doc_id long, text string")
    assert langid.predict_langs(far, lang).first()["__lang"] == "und"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_languages_reject_what_they_never_saw(spark, sf):
    docs = table(spark, f"/root/testdata/{sf}", "documents").filter(F.col("doc_id") % 4 != 0)
    model = langid.fit_langid(docs)
    assert (np.minimum(langid.SLACK * model.reach, (1 + model.reach) / 2) < 1).all()
    odd = ["слово " * 50, "中文的文字在这里写了很多", "Το πνεύμα της ελευθερίας", "zq xw qpf vvk jjx qqz xxv wwk " * 6]
    far = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string").withColumn("__lang", F.lit("clash"))
    assert [r["__lang"] for r in langid.predict_langs(far, model).collect()] == ["und"] * len(odd)
    held = table(spark, f"/root/testdata/{sf}", "documents").filter((F.col("doc_id") % 4 == 0) & F.col("lang").isNotNull())
    got = [r["__lang"] == r["lang"] for r in langid.predict_langs(held, model).collect()]
    assert np.mean(got) > 0.95


def test_language_clusters_are_no_outliers():
    rng = np.random.default_rng(2)
    kinds = np.eye(6, 30)[rng.integers(0, 3, 400)] + rng.random((400, 30)) * .2
    x = np.vstack([kinds, np.eye(30)[25:]])                 # five outliers
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    centres = langid._cluster(x)
    assert 2 <= len(centres) <= 4
    assert np.bincount((x @ centres.T).argmax(axis=1), minlength=len(centres)).min() >= 0.05 * len(x)
    assert len(langid._cluster(x[:1])) == 1 and len(langid._cluster(np.repeat(x[:1], 50, axis=0))) == 1


def test_languages_agree_with_a_plain_version(spark):
    docs = table(spark, TINY, "documents")
    model = langid.fit_langid(docs)
    keep = lambda ch: ch if ch.isascii() and ch.isalpha() or not ch.isascii() else " "
    for r in langid.predict_langs(docs.filter(F.col("text").isNotNull()).limit(60), model, reject=False).collect():
        data = ("".join(map(keep, r["text"].lower()))).encode() + b"  "
        v = np.zeros(langid.DIMS)
        for a, b, c in zip(data, data[1:], data[2:]):
            if (a, b) != (32, 32):
                h = ((a * 0x01000193 + b) * 0x01000193 + c) * 0x9E3779B1 & 0xFFFFFFFF
                v[h >> 32 - langid.DIMS.bit_length() + 1] += 1
        v = np.sqrt(v) * model.idf
        cos = model.centroids @ (v / max(np.linalg.norm(v), 1e-12))
        if r["__lang"] != "und":
            assert r["__lang"] == model.langs[model.lang_of[cos.argmax()]]


def test_learning_from_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.fit_langid(docs) is None
    assert langid.predict_langs(docs, langid.fit_langid(table(spark, TINY, "documents"))).collect() == []
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).collect() == []


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "some text here"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    for labels, q, t in ((none, 0.5, 0.0), (one, 1.0, 1.0)):
        model = quality.fit_quality(docs, labels.select("doc_id", "quality"))
        assert [r["__quality"] for r in quality.score_quality(docs, model).collect()] == [q, q]
        model = toxicity.fit_toxicity(docs, labels.select("doc_id", "toxic"))
        assert [r["__toxicity"] for r in toxicity.score_toxicity(docs, model).collect()] == pytest.approx([t, t], abs=1e-6)
    assert langid.fit_langid(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert [r["__lang"] for r in langid.predict_langs(docs, None).collect()] == ["und", "und"]
    empty = docs.limit(0)
    assert quality.score_quality(empty, model=quality.fit_quality(empty, none.select("doc_id", "quality"))).collect() == []


def test_label_model_outvotes_wrong_labels():
    rng = np.random.default_rng(5)
    y = rng.random(3000) < 0.3
    votes = np.where(y[:, None], rng.random((3000, 12)) < 0.6, rng.random((3000, 12)) < 0.05).astype(float)
    votes[:, 6:] = votes[:, 5:6]                            # seven voters that say the same
    gold = np.where(rng.random(3000) < 0.5, -1, np.where(rng.random(3000) < 0.1, ~y, y))
    q = toxicity.label_model(votes, gold, 0.3)
    assert np.mean((q > 0.5) == y) > 0.97
    wrong = (gold >= 0) & (gold != y)
    assert np.mean((q > 0.5)[wrong] == y[wrong]) > 0.7


# ---------------------------------------------------------------- pipeline

def test_pipeline_against_its_stages(spark, reference):
    docs = table(spark, TINY, "documents").withColumn("extra", F.lit(1))
    cols = docs.columns
    model = quality.fit_quality(docs.select("doc_id", "text"), quality.learnable(table(spark, TINY, "labels").select("doc_id", "quality")))
    rows = docs.collect()
    kept = {r["doc_id"] for r, s in zip(rows, model.score([(r["text"] or "").encode() for r in rows])) if s >= 0.7}
    steps = [f for _, f in corpus_pipeline.STAGES]
    one = steps[0](spark, docs, TINY)
    assert one.columns == cols and {r["doc_id"] for r in one.collect()} == kept
    two = steps[1](spark, one, TINY)
    wanted = {d: t for d, t, _, _ in brute.dedup_lines([(r["doc_id"], r["text"]) for r in rows if r["doc_id"] in kept])}
    got = two.collect()
    assert two.columns == cols and {r["doc_id"]: r["text"] for r in got} == wanted
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    three = steps[2](spark, two, TINY)
    pairs = [(r["doc_id"], r["text"]) for r in got]
    stay = {pairs[i][0] for i, (c, _) in brute.jaccard_links(pairs).items() if c == pairs[i][0]}
    assert three.columns == cols and {r["doc_id"] for r in three.collect()} == stay
    four = steps[3](spark, three, TINY)
    n = {r["doc_id"]: r["n"] for r in four.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert four.columns == cols and set(n) <= stay and max(n.values()) <= 3
    five = steps[4](spark, four, TINY).collect()
    assert len(five) == sum(n.values())
    for r in five:
        assert list(r["ids"]) == reference.encode_ordinary(wanted[r["doc_id"]])
        assert r["decoded_sha256"] == brute.sha(wanted[r["doc_id"]])
    run = corpus_pipeline.run(spark, TINY).drop("ids").collect()
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in run) == sorted((r["doc_id"], r["ids_sha256"]) for r in five)


def test_pipeline_stages_of_no_documents(spark):
    docs = table(spark, TINY, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, TINY)
        assert docs.collect() == []


def test_bpe_takes_other_patterns_as_the_library_does():
    pattern = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+[\r\n]*|\s+"
    tokens = byte_bpe.read_ranks(byte_bpe.default_ranks())
    library = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    own = byte_bpe.ByteBpe(tokens, pattern)
    for text in ("one;\ntwo, three.\nfour", "a b c", "end ...\n\nnext (x)\ny", "two  spaces;\nz"):
        assert own.encode(text) == library.encode_ordinary(text)


def test_clashing_columns_are_replaced(spark):
    docs = spark.createDataFrame([(1, "some words here and more of them"), (1, None)], "doc_id long, text string")
    names = ["__quality", "__toxicity", "__fingerprint", "__ids", "__n_tokens", "__ids_sha256", "__decoded_sha256", "key", "node", "size"]
    odd = docs.withColumns({n: F.lit("clash") for n in names})
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    from strata.llm import line_dedup, mixing, ngram_join, simhash
    outs = [quality.score_quality(odd, quality.fit_quality(docs, none.select("doc_id", "quality"))),
            toxicity.score_toxicity(odd, toxicity.fit_toxicity(docs, none.select("doc_id", "toxic"))),
            simhash.fingerprints(odd), byte_bpe.encode_texts(odd, byte_bpe.default_ranks(), public_tokenizers.PATTERN),
            line_dedup.dedup_lines(odd), ngram_join.keep_one(odd), ngram_join.jaccard_join(odd),
            mixing.apply_mix(odd.withColumn("source", F.lit("s")))]
    for out in outs:
        assert len(set(out.columns)) == len(out.columns) and out.count() >= 1
    assert all(r["__quality"] != "clash" for r in outs[0].collect()) and outs[3].filter("__n_tokens > 0").count() == 1


def test_toxic_words_are_mined_outside_the_sample(spark):
    rows = [(i, "plain words of text " * 3 + ("grobzk" if i % 4 == 0 else "fein"), int(i % 4 == 0)) for i in range(400)]
    rows += [(1000 + i, f"other calm lines {'schurf' if i % 2 else 'sanft'}", i % 2) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    texts = docs.selectExpr("cast(toxic as string) as label", "text")
    mined = dict(toxicity._mine(texts, most=1000, least=4))
    assert mined[toxicity.word_feature("grobzk")] > 3 and mined[toxicity.word_feature("schurf")] > 1
    model = toxicity.fit_toxicity(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), per_class=60)
    got = toxicity.score_toxicity(docs, model).select("toxic", "__toxicity").collect()
    assert sum((r["__toxicity"] >= 0.5) == bool(r["toxic"]) for r in got) >= 0.98 * len(got)


def test_words_of_one_class_only_are_mined_first(spark):
    rows = [(i, "0", "calm " + ("mixed" if i % 9 == 0 else "lines")) for i in range(900)]
    rows += [(900 + i, "1", ("grobzk " if i < 60 else "other ") + ("mixed" if i % 2 else "lines")) for i in range(100)]
    texts = spark.createDataFrame(rows, "doc_id long, label string, text string").select("label", "text")
    mined = dict(toxicity._mine(texts, most=1000, least=4))
    assert mined[toxicity.word_feature("grobzk")] > mined[toxicity.word_feature("mixed")] > 3


def test_label_model_keeps_cues_of_a_small_language():
    rng = np.random.default_rng(6)
    y = rng.random(4000) < 0.15
    small = rng.random(4000) < 0.12                         # rows of the other language
    many = (y & ~small)[:, None] & (rng.random((4000, 30)) < 0.4)
    votes = np.concatenate([many, (y & small)[:, None], rng.random((4000, 4)) < 0.1], axis=1).astype(float)
    q = toxicity.label_model(votes, np.where(rng.random(4000) < 0.2, -1, y), 0.15)
    assert np.mean((q > 0.5)[y & small]) > 0.95 and np.mean((q > 0.5) == y) > 0.97
