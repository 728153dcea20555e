"""Byte-level BPE encoding and decoding (operator 5).

A piece of text is encoded without simulating merges. Its bytes are mapped to Latin-1, an
Aho-Corasick automaton over the vocabulary gives every token that starts at every byte, and a walk
takes the longest token first. Two neighbouring tokens may stand together only if merging their
joined bytes gives back exactly those two; where they may not, the walk shortens the last token or
steps back. Byte pair encoding of a piece is the one token sequence whose neighbours are all
compatible, so the walk ends with the exact merges. A byte position that was found to be a dead end
is never entered twice, so the walk is linear in the piece.

Whether two tokens are compatible is remembered for all pairs met, and finished chunks of text are
remembered too; both memories are emptied when full (``PAIRS``, ``CHUNKS``), which changes no
result. The vocabulary is read from a rank file (a parameter) once per Python worker.

Cases: a NULL or empty text has no tokens. Every text is encoded whole, whatever its length. Rows that
share a doc_id are encoded one by one, and an empty table gives an empty result. Columns named __ids,
__n_tokens, __ids_sha256 or __decoded_sha256 are replaced; no other name clashes. There are no ties: of
equal ranks the leftmost pair merges first.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

PAIRS = 500_000                                            # remembered pair decisions a worker
CHUNKS = 800_000                                            # remembered pieces a worker
CHUNK_CHARS = 64                                            # longer pieces are not remembered
#: White space that isn't a single space or line feed.
_ODD = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\x0b", "\x0c")


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by id from a rank file (base64 token and rank on each line)."""
    with open(path, "rb") as f:
        found = {int(r): base64.b64decode(t) for t, r in (line.split() for line in f if line.strip())}
    return [found[i] for i in range(len(found))]


def merge_pieces(piece: bytes, ids: dict[bytes, int], below: int) -> list[bytes]:
    """Plain byte pair merges of ``piece`` with tokens of a rank under ``below``."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ids.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= below:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class ByteBpe:
    """An encoder and decoder for one vocabulary and one splitting pattern."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.ids = {t: i for i, t in enumerate(tokens)}
        self.length = [len(t) for t in tokens]
        self.split = regex.compile(pattern).findall
        self.known_borders = pattern == public_tokenizers.PATTERN
        self.wide_space = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(tokens):
            self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.made_of = [self._halves(i, t) for i, t in enumerate(tokens)]
        self.shorter = [self._shorter(t) for t in tokens]
        self.joined = {p: i for i, p in enumerate(self.made_of) if p}
        self.text_of = [str(i) for i in range(len(tokens))]
        self.by_text = dict(zip(self.text_of, tokens))
        self.line_feed = str(self.ids[b"\n"])
        self.most = CHUNKS
        self.pairs: dict[int, bool] = {}
        self.young: dict[str, str] = {}                     # when full it becomes the old one
        self.old: dict[str, str] = {}

    def forget(self) -> None:
        """Empty the memories."""
        self.pairs, self.young, self.old = {}, {}, {}

    def _halves(self, i: int, t: bytes) -> tuple[int, int] | None:
        """The two tokens whose merge makes token ``i``; None for a single byte."""
        for cut in range(1, len(t)):                        # most tokens split in one way only
            a, b = self.ids.get(t[:cut]), self.ids.get(t[cut:])
            if a is not None and b is not None and max(a, b) < i:
                parts = merge_pieces(t, self.ids, i)
                if len(parts) != 2:
                    raise ValueError(f"token {i} is not the merge of two lower tokens")
                return self.ids[parts[0]], self.ids[parts[1]]
        if len(t) > 1:
            raise ValueError(f"token {i} is not the merge of two lower tokens")
        return None

    def _shorter(self, t: bytes) -> int:
        """The longest token that is a proper prefix of ``t``, or -1."""
        return next((self.ids[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.ids), -1)

    def compatible(self, left: int, right: int) -> bool:
        """True if the merges of both tokens' joined bytes end with exactly these two tokens.

        Merges run in rank order, so the later of the two tokens was made last. Taking it apart
        again shows which tokens met at the border before; a pair that merges, and does so
        earlier than either side was finished, would have joined across the border.
        """
        pair = left * len(self.tokens) + right
        seen = self.pairs.get(pair)
        if seen is not None:
            return seen
        a, b, limit, fits = left, right, len(self.tokens), True
        while True:
            if self.joined.get((a, b), limit) < limit:
                fits = False
                break
            halves_a, halves_b = self.made_of[a], self.made_of[b]
            if halves_a is None and halves_b is None:
                break
            # on equal ranks the left one is merged first, so the right one is undone first
            if halves_b is None or (halves_a is not None and a > b):
                limit, a = a, halves_a[1]
            else:
                limit, b = b + 1, halves_b[0]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[pair] = fits
        return fits

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece of text."""
        whole = self.ids.get(piece)
        if whole is not None:
            return [whole]
        longest = [-1] * len(piece)
        length = self.length
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            start = end + 1 - length[token]
            if longest[start] < 0 or length[token] > length[longest[start]]:
                longest[start] = token
        out: list[int] = []
        dead = bytearray(len(piece) + 1)
        at, token = 0, longest[0]
        while True:
            while token >= 0:
                end = at + length[token]
                if not dead[end] and (not out or self.compatible(out[-1], token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                if at == len(piece):
                    return out
                token = longest[at]
            elif out:
                dead[at] = 1
                token = out.pop()
                at -= length[token]
            else:
                raise ValueError("the vocabulary can't encode this piece")

    def _ids_text(self, piece: str) -> str:
        """The ids of a piece of text as decimal text, remembered."""
        got = self.young.get(piece)
        if got is None:
            got = self.old.get(piece)
            if got is None:
                got = " ".join(map(self.text_of.__getitem__, self.encode_piece(piece.encode())))
            if len(piece) <= CHUNK_CHARS:
                if len(self.young) >= self.most // 2:
                    self.old, self.young = self.young, {}
                self.young[piece] = got
        return got

    def _chunk(self, chunk: str) -> str:
        """A word with the space before it, which may hold several matches of the pattern."""
        core, last = chunk.rstrip(".,"), len(chunk)
        if core.isascii() and core[1:].isalpha() and last - len(core) <= 1 and (core[0] == " " or core[0].isalpha()):
            if len(core) == last:
                return self._ids_text(chunk)                # one match: letters after a space
            return self._ids_text(core) + " " + self.text_of[self.ids[chunk[-1:].encode()]]
        return " ".join(map(self._ids_text, self.split(chunk)))

    def plain_space(self, text: str) -> bool:
        """True if all white space is single spaces and line feeds between other characters."""
        if any(x in text for x in _ODD) or text[0] in " \n" or text[-1] in " \n":
            return False
        return text.isascii() or self.wide_space(text) is None

    def encode_text(self, text: str) -> str:
        """The ids of a text as decimal text, joined by one space.

        Where all white space is single (``plain_space``), no match of public_tokenizers.PATTERN
        crosses a border before a space or at a line feed, so words can be split off and remembered
        whole. Other patterns may have other borders and split the whole text.
        """
        if not text:
            return ""
        if not self.known_borders or not self.plain_space(text):
            return " ".join(map(self._ids_text, self.split(text)))
        known, out = self.young, []
        for line in text.split("\n"):
            first = True
            for w in line.split(" "):
                chunk = w if first else " " + w
                first = False
                got = known.get(chunk)
                if got is None:
                    got = self._chunk(chunk)
                    known = self.young
                out.append(got)
            out.append(self.line_feed)
        out.pop()
        return " ".join(out)

    def encode(self, text: str) -> list[int]:
        return [int(x) for x in self.encode_text(text).split()]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_text(self, ids: str) -> bytes:
        """The bytes of ids given as decimal text."""
        return b"".join(map(self.by_text.__getitem__, ids.split()))


_loaded: dict[tuple[str, str], ByteBpe] = {}


def tokenizer(path: str, pattern: str) -> ByteBpe:
    """The encoder of a rank file, built once per Python worker."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteBpe(read_ranks(path), pattern)
    return _loaded[path, pattern]


def encode_texts(docs: DataFrame, path: str, pattern: str, text: str = "text",
                 with_ids: bool = True, keep: bool = True, remember: int = CHUNKS) -> DataFrame:
    """``docs`` with __ids (array of int, if asked for), __n_tokens, __ids_sha256, __decoded_sha256.

    ``path`` must name the rank file on every executor (it is part of an installed package).
    A worker remembers ``remember`` pieces at most. Without ``keep`` it gives them back after each
    task, so that other work in the same workers has their memory.
    """
    docs = docs.drop("__ids", "__n_tokens", "__ids_sha256", "__decoded_sha256")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path, pattern)
        bpe.most = remember
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                ids_of, n, a, d = [], [], [], []
                for t in b.column(text).to_pylist():
                    ids = bpe.encode_text(t or "")
                    if with_ids:
                        ids_of.append([int(x) for x in ids.split()])
                    n.append(ids.count(" ") + 1 if ids else 0)
                    a.append(hashlib.sha256(ids.encode()).hexdigest())
                    d.append(hashlib.sha256(bpe.decode_text(ids)).hexdigest())
                cols = dict(zip(b.schema.names, b.columns))
                if with_ids:
                    cols["__ids"] = pa.array(ids_of, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(cols | {"__n_tokens": pa.array(n, pa.int64()),
                                                         "__ids_sha256": a, "__decoded_sha256": d})
        if not keep:
            bpe.forget()

    schema = docs.select("*").schema
    if with_ids:
        schema = schema.add("__ids", T.ArrayType(T.IntegerType()))
    return docs.mapInArrow(run, schema.add("__n_tokens", "long").add("__ids_sha256", "string")
                           .add("__decoded_sha256", "string"))


def decode_ids(encoded: DataFrame, path: str, pattern: str, ids: str = "__ids") -> DataFrame:
    """``encoded`` with ``__decoded`` (binary), the bytes of its ids; NULL ids give NULL."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path, pattern)
        for b in batches:
            out = [None if x is None else bpe.decode(x) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_pydict(dict(zip(b.schema.names, b.columns))
                                             | {"__decoded": pa.array(out, pa.binary())})

    return encoded.mapInArrow(run, encoded.select("*").schema.add("__decoded", "binary"))


def default_ranks() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode_texts(docs, default_ranks(), public_tokenizers.PATTERN, with_ids=False)
    return out.select("doc_id", F.col("__n_tokens").alias("n_tokens"),
                      F.col("__ids_sha256").alias("ids_sha256"),
                      F.col("__decoded_sha256").alias("decoded_sha256"))
