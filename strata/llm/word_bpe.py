"""BPE encoding and decoding with word ends by tree concatenation (operator 13).

The tokenizer file (a parameter) gives the special strings, the normaliser, the splitting pattern
and the ranked merges. A piece that the pattern leaves whole is a run of byte symbols, the last
one marked as a word's end. Runs of at most ``LEAF`` symbols are merged directly. A longer run is
a tree of halves down to such leaves; each half is encoded on its own, and two results are joined: a window of
tokens around the border is merged anew from its symbols and grows, on the side that disagrees,
until its first and last tokens are the ones that the halves had there. Every two neighbours of the
joined sequence then stood together in some exact encoding, and byte pair encoding is the one
sequence whose neighbours all do, so the join is exact.

Documents of more than ``long_chars`` characters are normalised and split where they are read, cut
into parts of at most ``PART`` symbols, and written out; the parts are encoded in parallel tasks
and then joined pairwise, level by level, for each document.

Cases: a NULL or empty text has no tokens and decodes to an empty text. Rows that share a doc_id
are encoded one by one; an empty table gives an empty result. Every text is encoded whole. Other
columns stay as they are; columns named __n_tokens, __ids, __ids_sha256 or __decoded_sha256 are
replaced, and no other name clashes (a long document's key is called __long). There are no ties:
of equal ranks the leftmost pair merges first, as in the library.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import stored, table

LEAF = 48                                                  # symbols merged directly
PART = 1 << 14                                             # symbols of a part of a long document
LONG_CHARS = 1 << 16                                       # longer documents are encoded in parts
PIECES = 600_000                                           # remembered pieces and words a worker
PIECE_CHARS = 48                                           # longer ones are not remembered
NEVER = 1 << 60
SHIFT = 24                                                 # bits of an id
#: Normaliser and splitting pattern for which white space separates words that can
#: be split off and remembered whole; other files are split by the library alone.
KNOWN_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters of Latin-1 that NFC leaves alone and that have one lower-case letter.
LATIN = "À-ÖØ-öø-ÿ"
_plain = re.compile(f"[\\x00-\\x7f{LATIN}]+").fullmatch
_plain_split = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-z0-9ß-öø-ÿ]+").findall
_odd_space = re.compile("[\x1c-\x1f]").search              # str.split() takes these for white space
_ascii_space = re.compile("[\t-\r ]+").split


class WordBpe:
    """An encoder and decoder for one tokenizer file with byte symbols and a word-end mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges") or model.get("continuing_subword_prefix"):
            raise ValueError("only plain BPE files are read")
        self.end = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.text_of = {i: t for t, i in self.vocab.items()}
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.text_of |= {i: t for t, i in self.added.items()}
        for a in spec["added_tokens"]:
            if a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"]:
                raise ValueError("special strings must be plain")
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else None
        self.lib = Tokenizer.from_file(path)               # its normaliser and splitter only
        steps = spec["pre_tokenizer"]["pretokenizers"]
        if steps[-1]["type"] != "ByteLevel" or steps[-1]["add_prefix_space"] or steps[-1]["use_regex"] or spec["decoder"]:
            raise ValueError("only byte symbols without a decoder are read")
        self.known = (spec["normalizer"] or {}).get("normalizers") == KNOWN_NORMALIZERS and steps[0].get("pattern") == {"Regex": KNOWN_PATTERN}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.symbols: dict[int, tuple[int, ...]] = {i: (i,) for i in self.vocab.values()}
        for rank, m in enumerate(model["merges"]):
            a, b = (self.vocab[x] for x in (m if isinstance(m, list) else m.split(" ")))
            made = self.vocab[self.text_of[a] + self.text_of[b]]
            self.merges[a, b] = (rank, made)
            self.symbols[made] = self.symbols[a] + self.symbols[b]
        self.rank = {p: r for p, (r, _) in self.merges.items()}
        self.made = {p: m for p, (_, m) in self.merges.items()}
        # a pair as one number: its rank and, below it, what it makes
        self.step = {a << SHIFT | b: r << SHIFT | m for (a, b), (r, m) in self.merges.items()}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [i for i in range(256) if i not in printable]
        octet = [chr(i) if i in printable else chr(256 + other.index(i)) for i in range(256)]
        self.octets = {i: "".join(octet[b] for b in chr(i).encode()) for i in range(256)}
        self.id_text = {i: str(i) for i in self.text_of}
        self.by_id_text = {str(i): t for i, t in self.text_of.items()}
        self.young: dict[str, str] = {}                     # when full it becomes the old one
        self.old: dict[str, str] = {}

    # ------------------------------------------------------------- merges

    def merge(self, run: list[int]) -> list[int]:
        """Plain merges of a run of symbols, lowest rank first, leftmost on ties."""
        if len(run) > LEAF:
            return self._merge_by_heap(run)
        step, run = self.step.get, list(run)
        ranks = [step(a << SHIFT | b, NEVER) for a, b in zip(run, run[1:])]
        while ranks:
            low = min(ranks)
            if low == NEVER:
                break
            i = ranks.index(low)
            run[i] = made = low & ((1 << SHIFT) - 1)
            del run[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = step(made << SHIFT | run[i + 1], NEVER)
            if i:
                ranks[i - 1] = step(run[i - 1] << SHIFT | made, NEVER)
        return run

    def _merge_by_heap(self, run: list[int]) -> list[int]:
        n = len(run)
        run, left, right = list(run), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(self.rank[p], i, *p) for i, p in enumerate(zip(run, run[1:])) if p in self.rank]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i] if run[i] == a else n
            if j >= n or run[j] != b:
                continue                                    # one of the two was merged meanwhile
            run[i], run[j] = self.made[a, b], -1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (run[i], run[k]) in self.rank:
                    heapq.heappush(heap, (self.rank[run[i], run[k]], i, run[i], run[k]))
            h = left[i]
            if h >= 0 and (run[h], run[i]) in self.rank:
                heapq.heappush(heap, (self.rank[run[h], run[i]], h, run[h], run[i]))
        return [x for x in run if x >= 0]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring runs from the encodings of each."""
        if not left or not right:
            return left + right
        a = b = 1
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            window = self.merge([s for t in (*left[-a:], *right[:b]) for s in self.symbols[t]])
            left_agrees = a == len(left) or window[0] == left[-a]
            right_agrees = b == len(right) or window[-1] == right[b - 1]
            if left_agrees and right_agrees and (len(window) > 1 or a == len(left) or b == len(right)):
                return left[:len(left) - a] + window + right[b:]
            a, b = a if left_agrees and len(window) > 1 else 2 * a, b if right_agrees and len(window) > 1 else 2 * b

    def encode_run(self, run: list[int]) -> list[int]:
        """Ids of a run of symbols, by halves."""
        if len(run) <= LEAF:
            return self.merge(run)
        done = [self.merge(run[i:i + LEAF]) for i in range(0, len(run), LEAF)]
        return self.join_all(done)

    def join_all(self, done: list[list[int]]) -> list[int]:
        """Neighbouring encodings joined pairwise, level by level."""
        while len(done) > 1:
            done = [self.join(*done[i:i + 2]) if i + 1 < len(done) else done[i] for i in range(0, len(done), 2)]
        return done[0] if done else []

    def run_of(self, piece: str) -> list[int]:
        """The symbols of a piece of byte characters, the last with the word-end mark."""
        v = self.vocab
        return [v[c] for c in piece[:-1]] + [v[piece[-1] + self.end]]

    # ------------------------------------------------------------- pieces

    def segments(self, text: str) -> list[str]:
        """The text cut at special strings, which stand at odd places."""
        return self.cut(text) if self.cut and any(a in text for a in self.added) else [text]

    def pieces(self, text: str) -> list[str]:
        """Byte-character pieces of a text without special strings."""
        return [p for p, _ in self.lib.pre_tokenizer.pre_tokenize_str(self.lib.normalizer.normalize_str(text))]

    def _remember(self, key: str, ids: str) -> str:
        if len(key) <= PIECE_CHARS:
            if len(self.young) >= PIECES // 2:
                self.old, self.young = self.young, {}
            self.young[key] = ids
        return ids

    def _piece(self, piece: str) -> str:
        """Ids of one piece as decimal text. A-Z and a-z stand for themselves, so such a piece is
        remembered as the word it would be, others after a line feed, which no word holds."""
        key = piece if piece.isalpha() and piece.isascii() else "\n" + piece
        got = self.young.get(key) or self.old.get(key)
        if got is None:
            got = " ".join(map(self.id_text.__getitem__, self.encode_run(self.run_of(piece))))
        return self._remember(key, got)

    def _word(self, word: str) -> str:
        """Ids of a word between white space as decimal text; may be empty."""
        got = self.old.get(word)
        if got is None:
            if word.isascii() or _plain(word):
                low = word.lower()
                found = [p.translate(self.octets) for p in ([low] if low.isalpha() else _plain_split(low))]
            else:
                found = self.pieces(word)
            if len(found) == 1 and found[0] == word:
                got = " ".join(map(self.id_text.__getitem__, self.encode_run(self.run_of(word))))
            else:
                got = " ".join(map(self._piece, found))
        return self._remember(word, got)

    def encode_text(self, text: str) -> str:
        """The ids of a text as decimal text, joined by one space."""
        out = []
        for i, part in enumerate(self.segments(text)):
            if i % 2:
                out.append(self.id_text[self.added[part]])
            elif not self.known:
                out += map(self._piece, self.pieces(part))
            else:
                known = self.young
                for w in (_ascii_space(part) if _odd_space(part) else part.split()):
                    got = known.get(w)
                    if got is None:
                        got = self._word(w) if w else ""
                        known = self.young
                    if got:
                        out.append(got)
        return " ".join(out)

    def encode(self, text: str) -> list[int]:
        return [int(x) for x in self.encode_text(text).split()]

    def decode_text(self, ids: str) -> str:
        """The text of ids given as decimal text: the tokens joined by one space, as the library's
        decode does for a file without a decoder."""
        return " ".join(map(self.by_id_text.__getitem__, ids.split()))

    def parts(self, text: str) -> Iterator[tuple[int, list[int], bool]]:
        """(piece number, run, whether it is a finished id) of a long text, runs of at most PART."""
        number = 0
        for i, part in enumerate(self.segments(text)):
            if i % 2:
                yield number, [self.added[part]], True
                number += 1
                continue
            for p in self.pieces(part):
                run = self.run_of(p)
                for lo in range(0, len(run), PART):
                    yield number, run[lo:lo + PART], False
                number += 1


_loaded: dict[str, WordBpe] = {}


def tokenizer(path: str) -> WordBpe:
    """The encoder of a file, built once per Python worker."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def _digests(bpe: WordBpe, ids: str) -> tuple[int, str, str]:
    return (ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
            hashlib.sha256(bpe.decode_text(ids).encode()).hexdigest())


ADDED = ("__ids", "__n_tokens", "__ids_sha256", "__decoded_sha256")


def _schema(base: T.StructType, with_ids: bool) -> T.StructType:
    out = T.StructType(list(base.fields))
    if with_ids:
        out = out.add("__ids", T.ArrayType(T.IntegerType()))
    return out.add("__n_tokens", "long").add("__ids_sha256", "string").add("__decoded_sha256", "string")


def _columns(bpe: WordBpe, texts: list[str], with_ids: bool) -> dict:
    found = [_digests(bpe, x) for x in texts]
    out = {"__ids": pa.array([[int(i) for i in x.split()] for x in texts], pa.list_(pa.int32()))} if with_ids else {}
    return out | {"__n_tokens": pa.array([f[0] for f in found], pa.int64()),
                  "__ids_sha256": pa.array([f[1] for f in found], pa.string()),
                  "__decoded_sha256": pa.array([f[2] for f in found], pa.string())}


def encode_words(docs: DataFrame, path: str, text: str = "text", with_ids: bool = True,
                 long_chars: int = LONG_CHARS) -> DataFrame:
    """``docs`` with __ids (array of int, if asked for), __n_tokens, __ids_sha256, __decoded_sha256.

    ``path`` must name the tokenizer file on every executor (it is part of an installed package).
    """
    docs = docs.drop(*ADDED)
    chars = F.coalesce(F.length(text), F.lit(0))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                ids = [bpe.encode_text(t or "") for t in b.column(text).to_pylist()]
                yield pa.RecordBatch.from_pydict(dict(zip(b.schema.names, b.columns)) | _columns(bpe, ids, with_ids))

    done = docs.filter(chars <= long_chars).mapInArrow(short, _schema(docs.schema, with_ids))
    # written, so that every later step sees the same keys
    long = stored(docs.filter(chars > long_chars).withColumn("__long", F.monotonically_increasing_id()))
    if not long.limit(1).count():
        return done

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for b in batches:
            for r in range(b.num_rows):
                at, held, size = 0, [], 0
                key = b.column("__long")[r].as_py()
                for piece in bpe.parts(b.column(text)[r].as_py()):
                    held.append(piece)
                    size += len(piece[1])
                    if size >= PART:
                        yield _part(key, at, held)
                        at, held, size = at + 1, [], 0
                if held:
                    yield _part(key, at, held)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for b in batches:
            runs = [[list(r) if done else bpe.encode_run(r) for r, done in zip(rs, ds)]
                    for rs, ds in zip(b.column("runs").to_pylist(), b.column("done").to_pylist())]
            yield pa.RecordBatch.from_pydict({"key": b.column("key"), "at": b.column("at"), "piece": b.column("piece"),
                                              "runs": pa.array(runs, pa.list_(pa.list_(pa.int32())))})

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)

        def finish(key: int, out: list[int], last: list[list[int]]) -> pa.RecordBatch:
            ids = " ".join(map(str, out + bpe.join_all(last)))
            return pa.RecordBatch.from_pydict({"__long": pa.array([key], pa.int64())} | _columns(bpe, [ids], with_ids))

        now, number, out, last = None, -1, [], []
        for b in batches:
            for key, pieces, runs in zip(*(b.column(c).to_pylist() for c in ("key", "piece", "runs"))):
                if key != now:
                    if now is not None:
                        yield finish(now, out, last)
                    now, number, out, last = key, -1, [], []
                for p, run in zip(pieces, runs):
                    if p != number:
                        out += bpe.join_all(last)
                        number, last = p, []
                    last.append(run)
        if now is not None:
            yield finish(now, out, last)

    kind = "key long, at int, piece array<int>, runs array<array<int>>"
    parts = long.select("__long", text).mapInArrow(cut, kind + ", done array<boolean>").repartition("key", "at")
    joined = (parts.mapInArrow(encode, kind).repartition("key").sortWithinPartitions("key", "at")
              .mapInArrow(put_together, _schema(T.StructType().add("__long", "long"), with_ids)))
    # a long text may hold no token at all
    ids = [F.coalesce("__ids", F.array().cast("array<int>")).alias("__ids")] if with_ids else []
    empty = F.sha2(F.lit(""), 256)
    whole = long.join(joined, "__long", "left").select(
        *[long[c] for c in docs.columns], *ids, F.coalesce("__n_tokens", F.lit(0)).alias("__n_tokens"),
        F.coalesce("__ids_sha256", empty).alias("__ids_sha256"), F.coalesce("__decoded_sha256", empty).alias("__decoded_sha256"))
    return done.unionByName(whole)


def _part(key: int, at: int, held: list[tuple[int, list[int], bool]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "key": pa.array([key], pa.int64()), "at": pa.array([at], pa.int32()),
        "piece": pa.array([[n for n, _, _ in held]], pa.list_(pa.int32())),
        "runs": pa.array([[r for _, r, _ in held]], pa.list_(pa.list_(pa.int32()))),
        "done": pa.array([[d for _, _, d in held]], pa.list_(pa.bool_()))})


def decode_words(encoded: DataFrame, path: str, ids: str = "__ids") -> DataFrame:
    """``encoded`` with ``__decoded``, the text of its ids; NULL ids give NULL."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for b in batches:
            out = [None if x is None else bpe.decode_text(" ".join(map(str, x))) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_pydict(dict(zip(b.schema.names, b.columns)) | {"__decoded": pa.array(out, pa.string())})

    encoded = encoded.drop("__decoded")
    return encoded.mapInArrow(run, encoded.select("*").schema.add("__decoded", "string"))


def default_file() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode_words(docs, default_file(), with_ids=False)
    return out.select("doc_id", F.col("__n_tokens").alias("n_tokens"), F.col("__ids_sha256").alias("ids_sha256"),
                      F.col("__decoded_sha256").alias("decoded_sha256"))
