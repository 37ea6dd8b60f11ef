"""BPE encoding and decoding by dynamic programming over prefixes.

A byte-pair encoding of a string is the only token sequence in which every two neighbours are compatible: encoding their joined
bytes gives back just these two. So each prefix has exactly one possible last token: the one that ends there and is compatible with
the last token of the prefix before it. An automaton over the vocabulary lists the tokens that end at each position; the stored
last tokens are followed backwards to give the ids.

Null and empty text: no tokens. A text of any length is encoded whole. Equal rows give equal results; other columns pass through.
"""
from __future__ import annotations

import functools
import hashlib
import json
import re
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from labelloom.llm.common import annotate, portions, texts

#: The pattern of byte-level pre-tokenization, over classes of characters (see ``Classes``).
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t\n\r\f\vA-Za-z0-9]+|[ \t\n\r\f\v]+(?![^ \t\n\r\f\v])|[ \t\n\r\f\v]+")
#: Pieces and pairs that a worker remembers; only speed depends on them.
REMEMBERED = 100_000


def byte_of_char() -> dict[str, int]:
    """The vocabulary file writes each byte as a character: printable ones as themselves, the others from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


#: Unicode's white space beyond ASCII, and the planes that hold assigned characters.
SPACES = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
PLANES = [0, 1, 2, 3, 14]


@functools.lru_cache(4)
def classes(path: str) -> bytes:
    """For every code point its class as one byte: letter A, digit 0, white space \\n, other a point.

    Letters and digits are asked from the pre-tokenizer of the file, as Unicode versions differ: a letter joins the a before it, a
    digit the 1 before it.
    """
    from tokenizers import Tokenizer
    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    out = bytearray(b".") * 0x110000
    for low in (p << 16 | x for p in PLANES for x in range(0, 0x10000, 0x100)):
        points = [p for p in range(low, low + 0x100) if not 0xD800 <= p <= 0xDFFF]
        for lead, name in (("a", b"A"), ("1", b"0")):
            ends = {end for _, (_, end) in split("".join(f"{lead}{chr(p)}\n" for p in points))} if points else set()
            for i, p in enumerate(points):
                if 3 * i + 1 not in ends:
                    out[p] = name[0]
    for p in SPACES:
        out[p] = 0x0A
    return bytes(out)


def packed(flags: bytes) -> list[tuple[int, int]]:
    """Runs (class, length)."""
    return [(k, sum(1 for _ in run)) for k, run in groupby(flags)]


class Vocabulary:
    """Tables of one byte-level vocabulary; ids of merged tokens grow with the rank of their merge."""

    def __init__(self, source: str, runs: list[tuple[int, int]]):
        data = json.loads(source)
        self.kind = np.concatenate([np.full(n, k, np.uint8) for k, n in runs])
        as_byte = byte_of_char()
        vocab: dict[str, int] = data["model"]["vocab"]
        latin = {token: "".join(chr(as_byte[c]) for c in token) for token in vocab}
        self.bytes_of = {str(i): latin[token].encode("latin-1") for token, i in vocab.items()}
        self.special = {x["content"]: x["id"] for x in data["added_tokens"]}
        self.bytes_of |= {str(i): token.encode() for token, i in self.special.items()}
        self.at_special = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        #: the two tokens whose merge made a token; the merge of two tokens, and the rank of each merge
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.rank: dict[int, int] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            made = vocab[a + b]
            self.merged[vocab[a], vocab[b]] = made
            if made not in self.parts:
                self.parts[made], self.rank[made] = (vocab[a], vocab[b]), rank
        self.learnt = 0
        self.build_automaton([(self.bytes_of[str(i)], i) for i in vocab.values()])
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, str] = {}
        self.older: dict[str, str] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether the bytes of both tokens together encode to these two.

        Undo the merges of both, the latest first. If at some time the two tokens at the seam have a merge that ranks before the one
        undone last, encoding would have joined over the seam.
        """
        never = len(self.rank)
        last = never
        rank, parts, merged = self.rank, self.parts, self.merged
        while True:
            over = merged.get((left, right))
            if over is not None and rank[over] < last:
                return False
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:  # of two equal merges the left one is made first, so the right one is undone first
                last, left = a, parts[left][1]
            else:
                last, right = b + 1, parts[right][0]

    def build_automaton(self, tokens: list[tuple[bytes, int]]) -> None:
        """Nodes are prefixes of tokens. ``step``: node * 256 + byte -> node; ``ends``: the tokens that end a node's string, longest first."""
        step: dict[int, int] = {}
        own: list[tuple[int, int] | None] = [None]
        for raw, token in tokens:
            node = 0
            for b in raw:
                key = node << 8 | b
                node = step.get(key, 0)
                if not node:
                    node = step[key] = len(own)
                    own.append(None)
            own[node] = (len(raw), token)
        self.step, self.fall, self.ends = step, [0] * len(own), [()] * len(own)
        level = [(key, node) for key, node in step.items() if key < 256]
        below: dict[int, list[tuple[int, int]]] = {}
        for key, node in list(step.items()):
            below.setdefault(key >> 8, []).append((key, node))
        while level:
            following = []
            for key, node in level:
                if key >> 8:
                    self.fall[node] = self.advance(self.fall[key >> 8] << 8 | key & 255)
                self.ends[node] = ((own[node],) if own[node] else ()) + self.ends[self.fall[node]]
                following += below.get(node, [])
            level = following

    def advance(self, key: int) -> int:
        """The node of the longest suffix that is a prefix of a token; remembered as a step."""
        node, b = key >> 8, key & 255
        while node and node << 8 | b not in self.step:
            node = self.fall[node]
        found = self.step.get(node << 8 | b, 0)
        self.learnt += 1
        if self.learnt < 4 * REMEMBERED:
            self.step[key] = found
        return found

    def encode_pieces(self, pieces: list[str]) -> list[str]:
        """Ids of each piece, joined by commas. Sorted pieces share what is known of the prefixes they have in common."""
        step, ends, pairs = self.step, self.ends, self.pairs
        last, size, nodes, before, out = [-1], [0], [0], b"", []
        for piece in pieces:
            raw = piece.encode()
            at = 0
            for x, y in zip(raw, before):
                if x != y:
                    break
                at += 1
            del last[at + 1:], size[at + 1:], nodes[at + 1:]
            node, before = nodes[at], raw
            for b in raw[at:]:
                at += 1
                key = node << 8 | b
                node = step.get(key)
                if node is None:
                    node = self.advance(key)
                for length, token in ends[node]:
                    if length == at:
                        break
                    key = last[at - length] << 20 | token
                    fits = pairs.get(key)
                    if fits is None:
                        if len(pairs) > 3 * REMEMBERED:
                            pairs.clear()
                        fits = pairs[key] = self.compatible(key >> 20, token)
                    if fits:
                        break
                last.append(token)
                size.append(length)
                nodes.append(node)
            ids = []
            while at:
                ids.append(str(last[at]))
                at -= size[at]
            ids.reverse()
            out.append(",".join(ids))
        return out

    def pieces(self, text: str) -> list[str]:
        if text.isascii():
            return PIECES.findall(text)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        alike = np.where(points < 128, points, self.kind[points]).astype(np.uint8).tobytes().decode("latin-1")
        out, at = [], 0
        for piece in PIECES.findall(alike):
            out.append(text[at:at + len(piece)])
            at += len(piece)
        return out

    def split(self, text: str) -> list[str]:
        """Pieces and special tokens, in order."""
        if self.at_special is None or not any(x in text for x in self.special):
            return self.pieces(text)
        parts = self.at_special.split(text)
        return [y for i, x in enumerate(parts) for y in ([f"\ud800{x}"] if i % 2 else self.pieces(x))]  # no text holds a lone surrogate

    def encode(self, some: list[str]) -> list[str]:
        """Ids of each text, joined by commas."""
        found = [self.split(x) for x in some]
        known, older, new = self.known, self.older, []
        for piece in set().union(*found).difference(known):
            if (ids := older.get(piece)) is not None:  # what comes again is taken over from the older half
                known[piece] = ids
            elif piece[0] == "\ud800":
                known[piece] = str(self.special[piece[1:]])
            else:
                new.append(piece)
        new.sort()
        known.update(zip(new, self.encode_pieces(new)))
        out = [",".join(map(known.__getitem__, x)) for x in found]
        if any(len(x) > 99 for x in new):
            self.known = known = {k: v for k, v in known.items() if len(k) < 100}
        if len(known) > REMEMBERED:
            self.known, self.older = {}, known
        return out

    def decode(self, ids: str) -> str:
        """Text of ids joined by commas; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids.split(","))).decode("utf-8", "replace") if ids else ""


@functools.lru_cache(1)
def _built(source: str, runs: tuple) -> Vocabulary:
    return Vocabulary(source, list(runs))


def vocabulary(spark: SparkSession, path: str):
    """Broadcast of the file and the character classes: 1.6 MB, whatever the documents."""
    with open(path, encoding="utf-8") as f:
        source = f.read()
    return spark.sparkContext.broadcast((source, tuple(packed(classes(path)))))


def encode_documents(docs: DataFrame, path: str, text: str = "text", ids: str | None = None) -> DataFrame:
    """Appends n_tokens, ids_sha256 and decoded_sha256; with ``ids`` also the ids themselves, as an array of that name."""
    shared = vocabulary(docs.sparkSession, path)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        words = _built(*shared.value)
        n, digest, decoded, whole = [], [], [], []
        for some in portions(texts(batch, text)):
            for out in words.encode(some):
                n.append(out.count(",") + 1 if out else 0)
                digest.append(hashlib.sha256(out.encode()).hexdigest())
                decoded.append(hashlib.sha256(words.decode(out).encode()).hexdigest())
                if ids:
                    whole.append([int(i) for i in out.split(",")] if out else [])
        return [pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(decoded, pa.string())] + ([pa.array(whole, pa.list_(pa.int32()))] if ids else [])

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return annotate(docs, run, fields + ([T.StructField(ids, T.ArrayType(T.IntegerType()))] if ids else []))
