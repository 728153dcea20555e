"""Prefix trie, hard negatives and the tokenizer with word ends, against SQL, brute force and the library."""

import itertools
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import hard_negatives, prefix_trie, word_bpe

TURNS = "conv_id long, turn long, role string, text string"


# ---------------------------------------------------------------- prefix trie

def trie_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(con.execute(prefix_trie.OP12_SQL).fetchall(), key=str)


def random_talks(seed, n, longest, words):
    rng = random.Random(seed)
    rows = [(None, 1, "user", "of nobody")]
    for c in range(-25, n):
        for t in range(rng.randrange(0, longest)):
            rows.append((c, None if rng.random() < .05 else t, rng.choice(["user", None]), rng.choice(words)))
    return rows + rows[5:9]                                 # equal rows, and so equal turn numbers


@pytest.mark.parametrize("width,run_rows,longest", [(2, 3, 9), (3, 1000, 11), (32, 8, 7)])
def test_trie_against_sql(spark, monkeypatch, width, run_rows, longest):
    monkeypatch.setattr(prefix_trie, "IDS", 5)
    rows = random_talks(width, 60, longest, ["a b", "c", "", None])
    df = spark.createDataFrame(rows, TURNS).repartition(5).withColumn("len", F.lit(1)).withColumn("rep", F.lit("x"))
    got = sorted(map(tuple, prefix_trie.prefix_trie(df, width, run_rows).collect()), key=str)
    assert got == trie_sql(rows)


def test_long_conversation_and_its_copies(spark):
    """A long conversation with copies is a chain below the root; turnless ones are members of the root."""
    long = [(c, t, "user", f"turn {t} " + "x " * 50) for c in (100, 300, 7) for t in range(90)]
    rows = long + [(21, 0, "user", "lost")]                 # its base is absent, and h may pass its only turn
    got = sorted(map(tuple, prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS)).collect()), key=str)
    assert got == trie_sql(rows)
    assert max(r[1] for r in got) == 90


def test_trie_of_no_conversations(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []


# ---------------------------------------------------------------- hard negatives

def negatives_brute(rows):
    """Plain Python; the smallest row of those that share a vec_id."""
    ok = {}
    for i, v, lab in rows:
        if i is None or v is None or lab is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        lab = (lab + 1) % 10 if i % 7 == 0 else lab
        row = (lab, [int(np.floor(256 * float(np.float32(x)))) for x in v])
        ok[i] = min(ok.get(i, row), row)
    out = []
    for a, (lab, v) in ok.items():
        if a % 100:
            continue
        score = {b: sum(x * y for x, y in zip(v, w)) for b, (_, w) in ok.items()}
        order = sorted((b for b in ok if b != a), key=lambda b: (-score[b], b))
        for p in [b for b in order if ok[b][0] == lab][:5]:
            hard = [b for b in order if ok[b][0] != lab and 30 * score[p] <= 100 * score[b] <= 90 * score[p]][:10]
            out += [(a, p, k, b, score[p], score[b]) for k, b in enumerate(hard, 1)]
    return sorted(out)


VECS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("block,lane", [(7, 1 << 16), (64, 3)])
def test_negatives_against_brute_force(spark, monkeypatch, block, lane):
    monkeypatch.setattr(hard_negatives, "LANE", lane)
    rng = np.random.default_rng(block)
    centres = rng.normal(size=(6, 5))
    rows = [(i, (centres[i % 6] + rng.normal(size=5) * .3).round(1).tolist(), int(i % 6) if i % 11 else 3) for i in range(0, 900, 2)]
    rows += [(i, [1.0, .5, 0.0, 0.0, 0.0], 2) for i in range(1001, 1100, 2)]          # one very common vector
    rows += [(None, [1.0], 1), (1, None, 1), (3, [1.0], None), (5, [float("nan")] * 5, 1), (7, [float("inf")] * 5, 1),
             (9, [None, 1.0], 1), (11, [], 1), (100, [-1.0] * 5, 4), (100, [-1.0] * 5, 3), (1200, [2.0, 1.0], 0), (1300, [1.0] * 7, 0)]
    df = spark.createDataFrame(rows, VECS).repartition(4).withColumn("block", F.lit("clash")).withColumn("score", F.lit(0))
    got = sorted(map(tuple, hard_negatives.mine(df, block_rows=block).collect()))
    assert got == negatives_brute(rows) and len(got) > 100


def test_negatives_without_rows_or_beyond_a_long(spark):
    assert hard_negatives.mine(spark.createDataFrame([], VECS)).collect() == []
    assert hard_negatives.mine(spark.createDataFrame([(100, [1.0], 1)], VECS)).collect() == []
    with pytest.raises(ValueError, match="long"):
        hard_negatives.mine(spark.createDataFrame([(100, [1e30], 1)], VECS))


def test_hilbert_curve_and_bounds():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = hard_negatives.hilbert_keys(cells, bits)
        steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
        assert sorted(keys) == list(range(len(cells))) and (steps == 1).all()
    rng = np.random.default_rng(1)
    rows, anchors = rng.integers(-9, 9, (40, 6)), rng.integers(-9, 9, (20, 6))
    least, most = hard_negatives.intervals(anchors, rows.min(axis=0)[None], rows.max(axis=0)[None])
    scores = anchors @ rows.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= most[:, 0]).all()


def test_leading_rows_take_ties_by_id():
    q, s, i = np.array([0, 0, 0, 1]), np.array([5, 7, 5, 1]), np.array([9, 3, 2, 4])
    assert hard_negatives.leading(q, s, i, 2).tolist() == [1, 2, 3]
    assert len(hard_negatives.leading(*(np.zeros(0, np.int64),) * 3, 2)) == 0


# ---------------------------------------------------------------- words

PARTS = ["the", " and", "ing", "'s", "'RE", "\n", "  ", "\t", "\r\n", "123", "é", "ß", "中文", "😀", "\x85", "\xa0", "　", "!!", "###",
         "aaaa", "zq", ".", ", ", "-", "<|endoftext|>", "<|startoftext|>", "\x1c", "\x00", "́", "Σ", "İ", "ΑΣ", "\x7f", "Hello", " World", "ﬁ", "①"]


@pytest.fixture(scope="module")
def words():
    return word_bpe.WordBpe(word_bpe.default_file())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(word_bpe.default_file())


def same(words, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    return words.encode(text) == want and words.decode_text(words.encode_text(text)) == library.decode(want, skip_special_tokens=False)


def test_words_equal_the_library(words, library):
    rng = random.Random(3)
    assert all(same(words, library, "".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 25)))) for _ in range(6000))


@pytest.mark.parametrize("leaf", [2, 5, 16])
def test_halves_join_to_exact_merges(words, library, monkeypatch, leaf):
    monkeypatch.setattr(word_bpe, "LEAF", leaf)
    rng = random.Random(leaf)
    for letters in ("ab", "ha", "abthe", "etaoinshr"):
        for _ in range(150):
            t = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 150)))
            run = words.run_of(t)
            assert words.encode_run(run) == words.merge(run) == words._merge_by_heap(run) == library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("t", ["a" * 5001, "ab" * 3001, "ha" * 777 + "the" * 333, "中" * 3000 + "aa" * 2000, "!" * 3000 + "'s" * 200])
def test_long_unsplit_texts(words, library, t):
    assert same(words, library, t)


def test_full_memories_and_unknown_patterns_change_nothing(words, library, monkeypatch):
    monkeypatch.setattr(word_bpe, "PIECES", 6)
    other = word_bpe.WordBpe(word_bpe.default_file())
    other.known = False
    rng = random.Random(4)
    for _ in range(200):
        t = " ".join(rng.choice(PARTS) for _ in range(20))
        assert same(words, library, t) and same(other, library, t)


def test_words_of_documents_in_parts(spark, library, monkeypatch):
    """Documents beyond the limit are cut, encoded in tasks and joined; every row keeps its columns."""
    monkeypatch.setattr(word_bpe, "PART", 50)
    rng = random.Random(5)
    texts = [None, "", " ", "\n" * 300, "a" * 900, "<|endoftext|>" * 40, "".join(rng.choice(PARTS) for _ in range(400)),
             " ".join(rng.choice(PARTS) for _ in range(400)), "short", "short"]
    df = spark.createDataFrame([(i % 9 if i != 3 else None, t, "k", 5) for i, t in enumerate(texts)],
                               "doc_id long, text string, key string, __n_tokens int")
    out = word_bpe.decode_words(word_bpe.encode_words(df, word_bpe.default_file(), long_chars=100), word_bpe.default_file()).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in out) == sorted(
        (i == 3, 0 if i == 3 else i % 9, t or "") for i, t in enumerate(texts))
    for r in out:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["__ids"] == want and r["__n_tokens"] == len(want) and r["key"] == "k"
        assert r["__decoded"] == library.decode(want, skip_special_tokens=False)


def test_op13_and_an_empty_table(spark, library):
    import hashlib
    found = {r["doc_id"]: r for r in word_bpe.op13_word_bpe(spark, "/root/testdata/sf0.001").collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert found.keys() == texts.keys()
    for d, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        assert found[d]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[d]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert found[d]["n_tokens"] == len(ids)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert word_bpe.encode_words(none, word_bpe.default_file()).collect() == []


def test_latin_words_are_split_here_and_merged_once(monkeypatch):
    path = word_bpe.default_file()
    rng = np.random.default_rng(8)
    letters = list("aAzZstl'’,.-19 \x0b\x1c\x7f") + [chr(i) for i in range(0x80, 0x180)]
    texts = ["".join(rng.choice(letters, 9)) for _ in range(3000)] + ["Größe's, ñandú'll étés ÀÖØ×÷ßÞ"]
    lib = Tokenizer.from_file(path)
    bpe = word_bpe.WordBpe(path)
    assert [bpe.encode(t) for t in texts] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    alone, runs = word_bpe.WordBpe(path), []
    merge = alone.merge
    monkeypatch.setattr(alone, "lib", None)                 # neither normaliser nor splitter is needed
    monkeypatch.setattr(alone, "merge", lambda run: runs.append(tuple(run)) or merge(run))
    alone.encode_text("grobzk Grobzk, (grobzk) Größe größe, GRÖSSE")
    assert len(runs) == len(set(runs)) == 6
