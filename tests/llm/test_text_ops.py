"""Shingles, line dedup, Jaccard join, mixing and fingerprints against plain Python."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import common, line_dedup, mixing, ngram_join, shingles, simhash

import brute

SCHEMA = "doc_id long, text string"
LINE = "this line is much longer than forty code points, and it repeats"
VOCAB = [f"{a}{b}" for a in "abcdefgh" for b in ("one", "two", "ré", "四")]


def prose(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def near_copy(rng, text, edits):
    w = text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = rng.choice(VOCAB) + "x"
    return " ".join(w)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    rows = []
    for _ in range(40):
        base = prose(rng, rng.choice((6, 40, 120, 300)))
        rows += [base] + [near_copy(rng, base, rng.randrange(1, 5)) for _ in range(rng.choice((0, 0, 1, 3, 9)))]
        rows += [base.upper()] * rng.choice((0, 0, 0, 2)) + [base.replace(" ", " \n ")] * rng.choice((0, 1))
    rows += [None, "", "  \n", "one", "ONE", "two words", "a b c d", "x" * 30000, prose(rng, 9000)]
    return [(i * 3, t) for i, t in enumerate(rows)] + [(None, rows[0]), (0, rows[0])]


def test_shingles_of_whole_batches(corpus):
    texts = [t for _, t in corpus]
    found = []
    for _, _, data, offs in common.slices(pa.array(texts, pa.string()), most=500):
        flat, at = shingles.shingle_hashes(data, offs, 5)
        found += [frozenset(flat[i:j].tolist()) for i, j in zip(at, at[1:])]
    wanted = [brute.shingles(t) for t in texts]
    assert [len(f) for f in found] == [len(w) for w in wanted]
    for i in range(0, len(texts), 7):
        for j in range(i):
            assert len(found[i] & found[j]) == len(wanted[i] & wanted[j])


def test_slices_of_sliced_and_null_columns():
    col = pa.array(["a", None, "bc", "", "déf"], pa.string()).slice(1)
    data, offs = common.column_bytes(col)
    assert data.tobytes() == "bcdéf".encode() and offs.tolist() == [0, 0, 2, 2, 6]
    assert common.column_bytes(pa.array([], pa.string()))[1].tolist() == [0]


@pytest.mark.parametrize("leaf,block,exact,depth", [(100, 512, 128, 4), (3, 4, 3, 2)])
def test_jaccard_join(spark, corpus, monkeypatch, leaf, block, exact, depth):
    for name, v in (("LEAF", leaf), ("BLOCK", block), ("EXACT", exact), ("DEPTH", depth)):
        monkeypatch.setattr(ngram_join, name, v)
    docs = spark.createDataFrame(corpus, SCHEMA).withColumn("size", F.lit("clash")).withColumn("node", F.lit(1))
    got = sorted(ngram_join.jaccard_join(docs, recall=0.9999).collect(), key=str)
    wanted = brute.jaccard_links(corpus)
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got if r["doc_id"] is not None) == sorted(
        (d, *wanted[i]) for i, (d, _) in enumerate(corpus) if d is not None)
    assert [tuple(r)[:3] for r in got if r["doc_id"] is None] == [(None, None, 0)]


def test_keep_one_keeps_a_row_of_each_class(spark, corpus):
    docs = spark.createDataFrame(corpus, SCHEMA).withColumn("extra", F.lit(5))
    got = ngram_join.keep_one(docs, recall=0.9999)
    assert got.columns == ["doc_id", "text", "extra"]
    wanted = brute.jaccard_links(corpus)
    kept = {(d, t) for i, (d, t) in enumerate(corpus) if d is None or wanted[i][0] == d}
    rows = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == kept


def test_keep_one_drops_by_id_and_text(spark):
    rng = random.Random(31)
    near, clean = prose(rng, 120), prose(rng, 120)
    rows = [(1, near), (2, near_copy(rng, near, 1)), (2, clean), (2, clean), (3, near.replace(" ", "  "))]
    got = ngram_join.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(tuple(r) for r in got) == [(1, near), (2, clean)]


def test_keep_one_takes_the_smallest_of_equal_rows(spark):
    text = "one two three four five six seven"
    rows = [(1, text, "z", "en"), (1, text, "b", "fr"), (1, text, None, "de"), (2, text, "a", "en"), (3, "other words", "c", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    for n in (1, 5):
        got = ngram_join.keep_one(df.repartition(n)).collect()
        assert sorted((r["doc_id"], r["source"] or "", r["lang"] or "") for r in got) == [(1, "", "de"), (3, "c", "")]


def test_registered_join_meets_pairs_at_the_threshold():
    n = ngram_join.enough_runs(ngram_join.RECALL, ngram_join.JACCARD)
    assert ngram_join.met_chance(n, 0.8, 0.8) >= 0.9999 > ngram_join.met_chance(n - 1, 0.8, 0.8)
    assert round(ngram_join.met_chance(10, 0.9, 0.8), 4) == 0.9974
    with pytest.raises(ValueError):
        ngram_join.enough_runs(1 - 1e-12, 0.8)


def test_registered_join_splits_large_buckets(spark):
    rng = random.Random(21)
    vocab = [f"v{i}" for i in range(5000)]
    hot = " ".join(rng.choice(vocab) for _ in range(60))    # shingles of all documents: buckets above LEAF
    rows = []
    for _ in range(ngram_join.LEAF):
        own = [rng.choice(vocab) for _ in range(90)]
        other = list(own)
        other[45], other[70] = "x", "y"
        rows += [(len(rows), f"{hot} {' '.join(own)}"), (len(rows) + 1, f"{hot} {' '.join(other)}")]
    got = {r["doc_id"]: r for r in ngram_join.jaccard_join(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(0.8 <= len(a & b) / len(a | b) < 0.9 for a, b in
               [(brute.shingles(rows[i][1]), brute.shingles(rows[i + 1][1])) for i in range(0, len(rows), 2)])
    assert [(got[i]["class_id"], got[i]["n_links"]) for i in range(len(rows))] == [(i - i % 2, 1) for i in range(len(rows))]


def test_runs_reach_the_recall():
    assert ngram_join.runs(0.99, 1) == 5 and ngram_join.runs(0.99, 4) == 13


@pytest.mark.parametrize("empty", [True, False])
def test_line_dedup(spark, empty):
    rng = random.Random(5)
    lines = [LINE, f"  {LINE.upper()}\t", LINE[:39], LINE[:40], "é" * 39, "é" * 40, "", prose(rng, 20), prose(rng, 20)]
    rows = [] if empty else [(i % 50, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    if not empty:
        rows += [(90, None), (91, ""), (None, LINE), (None, "only null ids hold this line, forty points and more"),
                 (92, "\n".join(["no repeat " * 5, LINE] * 3000))]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, key int")
    out = line_dedup.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "key", "__n_lines", "__n_dropped"]
    got = sorted(((r["doc_id"], r["text"] or "", r["__n_lines"], r["__n_dropped"]) for r in out.collect()), key=str)
    assert got == sorted(brute.dedup_lines(rows), key=str)


def test_line_dedup_is_exact_with_a_full_filter(spark):
    rng = random.Random(6)
    lines = [prose(rng, 12) for _ in range(400)]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(20))) for i in range(100)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA), max_bits=1 << 16).collect()
    assert sorted((r["doc_id"], r["text"], r["__n_lines"], r["__n_dropped"]) for r in out) == sorted(brute.dedup_lines(rows))


def test_mixing_targets_and_copies(spark):
    rng = random.Random(8)
    rows = []
    for i in range(900):
        s = rng.choice(["b", "b", "b", "b", "a", "Z", "é", "tiny", None])
        if s != "tiny" or i % 40 == 0:
            rows.append((i, " ".join(["w"] * rng.randrange(0, 60)), s))
    rows += [(5000, None, "a"), (5001, "", None), (5002, " \t ", "void"), (None, "one two", "a"), (7, "seven", "b"), (7, "seven", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", mixing.words("text"))
    got = mixing.mix(docs).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    wanted = brute.targets(sizes)
    assert any(abs(wanted[s] - 3 * sizes[s]) < 1e-6 and sizes[s] for s in sizes)      # a target at the cap
    assert sum(wanted.values()) == pytest.approx(sum(sizes.values()))
    by_size = {}
    for s, n in sizes.items():
        by_size.setdefault(n, set()).add(round(wanted[s], 6))
    taken = {}
    assert len(got) == len(rows)
    for r in got:
        assert round(r["target"], 6) in by_size[r["source_size"]]
        assert 0 <= r["copies"] <= 3
        taken[r["source_size"]] = taken.get(r["source_size"], 0) + r["copies"] * r["size"]
    for s, n in sizes.items():
        if n:
            assert abs(taken[n] - wanted[s]) <= max(3, 0.01 * wanted[s])
    again = mixing.mix(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixing_with_base_rates(spark):
    """Rates are tilts of the base rates by size with one dual variable a source, found by brute force too."""
    rows = [(i, "ab"[i % 2], (10 + i % 7) * (20 if i % 50 == 0 else 1), 1.0 + (i % 5 == 0)) for i in range(2000)] + [(-1, "a", 0, 1.0)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long, base double")
    got = {r["doc_id"]: r for r in mixing.mix(sized).collect()}
    for s in "ab":
        own = [r for r in rows if r[1] == s]
        target, mean = got[own[0][0]]["target"], sum(r[2] for r in own) / len(own)

        def rate(lam, n, base):
            return min(3.0, base * math.exp(lam * n / mean))

        low, high = -50.0, 50.0
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(rate(mid, n, b) * n for _, _, n, b in own) < target else (low, mid)
        for d, _, n, b in own:
            assert got[d]["rate"] == pytest.approx(rate(low, n, b), rel=1e-6)
        assert sum(got[d]["rate"] * n for d, _, n, _ in own) == pytest.approx(target, rel=1e-6)
    assert got[-1]["rate"] == 1.0 and got[-1]["copies"] == 1


def test_mixing_takes_newton_steps(spark):
    """From lam = 0 every source off its target steps; few steps do, also with very long documents."""
    rng = random.Random(5)
    rows = [(i, "abcd"[i % 4], min(20_000, int(rng.paretovariate(0.9) * 20))) for i in range(4000)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long").withColumn("base", F.lit(1.0))
    cells = sized.groupBy("source", "base", "size").agg(F.count(F.lit(1)).alias("n"))
    sources = sized.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"))
    found = mixing.solve(cells, mixing.targets(sources)).collect()
    assert any(r["steps"] > 1 for r in found) and all(r["steps"] <= 30 for r in found)
    again = mixing.solve(cells.repartition(7), mixing.targets(sources.repartition(3))).collect()
    assert {r["source"]: r["lam"] for r in found} == {r["source"]: r["lam"] for r in again}


def test_mixing_says_when_targets_are_missed(spark, monkeypatch):
    rows = [(i, "ab"[i % 2], 10, 400.0 if i % 20 == 0 else 1.0) for i in range(200)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long, base double")
    monkeypatch.setattr(mixing, "STEPS", 1)
    with pytest.raises(ValueError):
        mixing.mix(sized).collect()


def test_apply_mix_repeats_rows(spark):
    rows = [(i, "w " * (i % 9), "ab"[i % 2], 7) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    n = {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs.select("doc_id", "source", mixing.words("text").alias("size"))).collect()}
    assert n == {d: k for d, k in copies.items() if k}


def test_mixing_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id long, source string, size long")).collect() == []


def follow(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for (d, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        half = len(t) // 2
        out[d] = (len(t), brute.sha(t[:len(t) - half] + nxt[:half]))
    return out


@pytest.mark.parametrize("n,rows_per_block", [(1, 2000), (2, 1), (150, 7), (150, 2000)])
def test_edited_texts_follow_descending_ids(spark, corpus, monkeypatch, n, rows_per_block):
    monkeypatch.setattr(simhash, "ROWS", rows_per_block)
    rows = list({d: (d, t) for d, t in corpus if d is not None or n > 2}.values())[-n:]
    got = simhash.edited_fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == follow(rows)
    prints = {}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        prints.setdefault(brute.shingles(dict(rows)[r["doc_id"]]), set()).add(r["fingerprint"])
    assert not any(len(p) > 1 and len(s) == 1 for s, p in prints.items())


def test_edited_fingerprints_of_repeated_ids_and_no_rows(spark):
    rows = [(1, "same text"), (1, "same text"), (1, "same text"), (2, "other")]
    got = simhash.edited_fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 1, 1, 2]
    assert simhash.edited_fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []


def test_fingerprints_vote_by_bits(corpus):
    texts = [t for _, t in corpus]
    got = simhash.simhash(pa.array(texts, pa.string()))
    for t, g in list(zip(texts, got))[::5]:
        data, offs = common.column_bytes(pa.array([t], pa.string()))
        flat, _ = shingles.shingle_hashes(data, offs, 5)
        votes = np.zeros(128)
        for h in flat:
            both = np.array([shingles.mix(np.array([h]))[0], shingles.mix(np.array([h ^ np.uint64(0x5851F42D4C957F2D)]))[0]])
            votes += 2.0 * np.unpackbits(both.view(np.uint8)) - 1
        assert (np.packbits(votes > 0) == g).all()


def test_near_fingerprints_finds_every_pair(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 256, (30, 16), np.uint8)
    rows, prints = [], []
    for i in range(240):
        bits = np.unpackbits(base[i % 30])
        bits[rng.choice(128, rng.integers(0, 6), replace=False)] ^= 1
        prints.append(np.packbits(bits))
        rows.append((i, prints[-1].tobytes().hex()))
    df = spark.createDataFrame(rows, "doc_id long, fingerprint string")
    pairs, members = simhash.near_fingerprints(df, radius=3)
    fp = {r["doc_id"]: r["fp"] for r in members.collect()}
    wanted, near = set(), [0] * 240
    for i in range(240):
        for j in range(240):
            d = int(np.bitwise_count(prints[i] ^ prints[j]).sum())
            near[i] += d <= 3 and i != j
            if fp[i] < fp[j] and d <= 3:
                wanted.add((fp[i], fp[j], d))
    assert {tuple(r) for r in pairs.collect()} == wanted and len(wanted) > 20
    assert {r["doc_id"]: r["n_near"] for r in simhash.count_near(df).collect()} == dict(enumerate(near))
    assert simhash.count_near(df.limit(0)).collect() == []


def hamming(prints):
    raw = np.array([np.frombuffer(bytes.fromhex(p), np.uint8) for p in prints])
    return np.array([np.bitwise_count(raw ^ r).sum(axis=1, dtype=np.int64) for r in raw])


def test_n_near_reaches_near_copies_of_ordinary_length(spark, tmp_path):
    rng = random.Random(12)
    vocab = [f"word{i}" for i in range(3000)]
    rows, copies = [], []
    for _ in range(120):
        words = [rng.choice(vocab) for _ in range(rng.randrange(100, 500))]
        edited = list(words)
        while True:                                         # words replaced down to a similarity of 0.8
            at, old = rng.randrange(len(edited)), list(edited)
            edited[at] = "other"
            a, b = brute.shingles(" ".join(words)), brute.shingles(" ".join(edited))
            if len(a & b) < 0.8 * len(a | b):
                break
        copies.append((len(rows), len(rows) + 1))
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(old))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in simhash.op6_simhash(spark, str(tmp_path)).collect()}
    d = hamming([got[i]["fingerprint"] for i in range(len(rows))])
    assert [got[i]["n_near"] for i in range(len(rows))] == ((d <= 26).sum(axis=1) - 1).tolist()
    assert sum(got[a]["n_near"] > 0 for a, _ in copies) >= 0.9 * len(copies)


@pytest.mark.parametrize("crowd", [8, 64])
def test_count_near_by_keys_meets_wide_pairs_once(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    monkeypatch.setattr(simhash, "WHOLE", 0)
    rng = np.random.default_rng(9)
    base, rows = rng.integers(0, 256, (60, 16), np.uint8), []
    for i in range(600):
        bits = np.unpackbits(base[0 if i % 5 == 0 else i % 60])
        bits[rng.choice(128, rng.integers(0, 15), replace=False)] ^= 1
        rows.append((i, np.packbits(bits).tobytes().hex()))
    rows += [(600 + i, rows[0][1]) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint string")
    near = {r["doc_id"]: r["n_near"] for r in simhash.count_near(df, 26).collect()}
    exact = (hamming([p for _, p in rows]) <= 26).sum(axis=1) - 1
    assert all(near[i] <= n for i, n in enumerate(exact))
    assert sum(near.values()) >= 0.99 * exact.sum() > 1000
    few = {r["doc_id"]: r["n_near"] for r in simhash.count_near(df, 3).collect()}
    assert [few[i] for i in range(len(rows))] == ((hamming([p for _, p in rows]) <= 3).sum(axis=1) - 1).tolist()


def test_count_near_finds_every_pair_at_the_radius(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 64)
    monkeypatch.setattr(simhash, "WHOLE", 0)
    rng = np.random.default_rng(4)
    rows = []
    for i, base in enumerate(rng.integers(0, 256, (2000, 16), np.uint8)):
        bits = np.unpackbits(base)
        bits[rng.choice(128, 26 if i % 4 else 27, replace=False)] ^= 1
        rows += [(2 * i, base.tobytes().hex()), (2 * i + 1, np.packbits(bits).tobytes().hex())]
    exact = (hamming([p for _, p in rows]) <= 26).sum(axis=1) - 1
    assert exact.sum() >= 3000
    df = spark.createDataFrame(rows, "doc_id long, fingerprint string")
    near = {r["doc_id"]: r["n_near"] for r in simhash.count_near(df, 26).collect()}
    assert [near[i] for i in range(len(rows))] == exact.tolist()


@pytest.mark.parametrize("rows", [1, 100, 5000, 200_000])
@pytest.mark.parametrize("radius", [0, 3, 26])
def test_allowances_leave_no_pair_out(rows, radius):
    runs = simhash.allowances(rows, radius)
    assert all(hi <= lo for (_, hi, _), (lo, _, _) in zip(runs, runs[1:])) and runs[-1][1] <= simhash.BITS
    assert min(t for _, _, t in runs) >= 0 and sum(t + 1 for _, _, t in runs) > radius

