"""Byte-level BPE encoding and decoding as streaming transducers.

Encoding reads pre-tokens (the pattern's matches) and runs each through a
bounded-lookahead transducer.  It rests on a property of merge lists: the
encoding of a byte string ends in token t exactly if t is the one token ending
there that is *compatible* with the token before it, i.e. the pair is left
alone when its bytes are encoded by themselves.  So the state is, for each of
the last ``longest`` byte positions, the token that ends there; a token is
stable, and emitted, once every state that can still be extended has it on its
path.  The longest token of the merge list is the lookahead that suffices to
extend the state, so memory is that many positions plus tokens not yet stable,
whatever the length of a pre-token.

The tokens that end at a position come, longest first, from a suffix-link
automaton of all tokens (one step a byte).

Texts are cut into pieces at places where the pattern must end a match whatever
stands around them (before white space, and where letters, digits and other
symbols meet), so a long text is never matched whole, and a pre-token without
such a place is streamed: beside the text, memory is bounded.  Short pre-tokens
repeat, so their ids are kept in a bounded memo, which keeps the words of the
latest texts when it is full.

Decoding gathers token bytes from one flat table, chunk by chunk, through an
incremental UTF-8 state machine; ill-formed input gives U+FFFD for each maximal
part.

Defined results: null and empty texts give no ids and decode to the empty
text; added tokens (special ones too) are taken out of the text first, the
leftmost and longest; repeated rows give equal results; an empty table gives
an empty result.  Extra columns of the input are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import struct
from collections.abc import Iterable, Iterator
from itertools import islice
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import lean, ready, table, worker_model
from .words import slices

# Fixed value of byte-level BPE: how text is cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE = 1 << 16  # code points matched at once
MEMO = 1 << 19  # pre-tokens whose ids are kept
MEMO_LENGTH = 64
CHUNK = 1 << 14  # ids of a long pre-token that are held at once
# no match goes on over one of these places, nor does it depend on what follows there
CUT = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])|(?<=[^\s\p{L}\p{N}'])(?=[\p{L}\p{N}])")


def byte_symbols() -> dict[str, int]:
    """The vocabulary's letter for each byte: printable Latin-1 stands for itself, the others follow from 256."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Transducer:
    """Vocabulary and merge list of a tokenizer file, with both directions."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = byte_symbols()
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.bytes_of: dict[int, bytes] = {i: bytes(letter[c] for c in t) for t, i in model["vocab"].items() if all(c in letter for c in t)}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        ids = model["vocab"]
        self.rank = {(ids[a], ids[b]): (n, ids[a + b]) for n, (a, b) in reversed(list(enumerate(merges))) if a in ids and b in ids and a + b in ids}
        # tokens that merging makes from their own bytes; others never appear
        made = [self.id_of[bytes([b])] for b in range(256)] + sorted({m for _, m in self.rank.values()})
        self.tokens = {self.bytes_of[i]: i for i in made if len(self.bytes_of[i]) <= 2 or self.merge(self.bytes_of[i]) == [i]}
        self.longest = max(map(len, self.tokens))
        self.added = sorted(((t["content"], t["id"]) for t in spec.get("added_tokens", [])), key=lambda x: -len(x[0]))
        for text, i in self.added:
            self.bytes_of[i] = text.encode("utf-8")
        self.split = regex.compile("|".join(regex.escape(t) for t, _ in self.added)) if self.added else None
        self.added_id = dict(self.added)
        self.pattern = regex.compile(PATTERN)
        self.never = len(merges)
        self.pairs: dict[int, bool] = {}
        self.spines: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.half: dict[int, tuple[int, int, int] | None] = {}
        self.memo: dict[str, bytes] = {}
        self.sizes = {t: len(b) for b, t in self.tokens.items()}
        self.link()
        top = max(self.bytes_of, default=-1) + 1
        self.flat = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(top)), np.uint8)
        self.width = np.array([len(self.bytes_of.get(i, b"")) for i in range(top)], np.int64)
        self.place = np.cumsum(self.width) - self.width

    def link(self) -> None:
        """The automaton of all tokens: a state is the longest prefix of a token that ends at a position."""
        self.go: dict[int, int] = {}  # state << 8 | byte -> state
        token: list[int | None] = [None]
        for data, t in self.tokens.items():
            state = 0
            for b in data:
                key = state << 8 | b
                if key not in self.go:
                    self.go[key] = len(token)
                    token.append(None)
                state = self.go[key]
            token[state] = t
        self.back = [0] * len(token)  # the longest proper suffix that is a state too
        self.found: list[tuple[tuple[int, int], ...]] = [()] * len(token)  # (token, length) that end in a state, longest first
        self.jump: dict[int, int] = {}  # steps over suffix links, bounded
        edges: dict[int, list[int]] = {}
        for key in self.go:
            edges.setdefault(key >> 8, []).append(key)
        level = [0]
        while level:
            below = []
            for state in level:
                for key in edges.get(state, ()):
                    new, at = self.go[key], self.back[state]
                    if state:
                        while at and at << 8 | key & 255 not in self.go:
                            at = self.back[at]
                        self.back[new] = self.go.get(at << 8 | key & 255, 0)
                    own = token[new]
                    more = self.found[self.back[new]]
                    self.found[new] = more if own is None else ((own, len(self.bytes_of[own])), *more)
                    below.append(new)
            level = below

    def step(self, state: int, byte: int) -> int:
        """The state after one more byte, over suffix links."""
        key = first = state << 8 | byte
        while key >> 8 and key not in self.go:
            key = self.back[key >> 8] << 8 | byte
        new = self.go.get(key, 0)
        if len(self.jump) >= MEMO:
            self.jump.clear()
        self.jump[first] = new
        return new

    def merge(self, data: bytes, least: int = 1) -> list[int]:
        """The merge list applied to a short byte string, until ``least`` ids are left."""
        ids = [self.id_of[data[i : i + 1]] for i in range(len(data))]
        rank = self.rank
        while len(ids) > least:
            best, at = None, -1
            for i in range(len(ids) - 1):
                r = rank.get((ids[i], ids[i + 1]))
                if r is not None and (best is None or r[0] < best[0]):
                    best, at = r, i
            if best is None:
                break
            pair, out, i = (ids[at], ids[at + 1]), [], 0
            while i < len(ids):
                if i + 1 < len(ids) and (ids[i], ids[i + 1]) == pair:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(token, rank of the merge that ends it) of the pieces that are first
        (side 0) or last (side 1) in a token while its bytes are merged."""
        known = self.spines.get((token, side))
        if known is None:
            known = [(token, self.never)]
            part = token
            while (two := self.halves(part)) is not None:
                known.append((two[side], two[2]))
                part = two[side]
            self.spines[token, side] = known
        return known

    def halves(self, token: int) -> tuple[int, int, int] | None:
        """The last merge that makes a token from its bytes: (left, right, rank)."""
        known = self.half.get(token, 0)
        if known == 0:
            data, known = self.bytes_of[token], None
            if len(data) > 1:
                left, right = self.merge(data, 2)
                known = (left, right, self.rank[left, right][0])
            self.half[token] = known
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens encode to just them: no merge of the
        last piece of one and the first of the other comes before either piece
        ends (at equal rank the merge further left goes first)."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            known, rank = True, self.rank
            for b, b_ends in self.spine(right, 0):
                for a, a_ends in self.spine(left, 1):
                    r = rank.get((a, b))
                    if r is not None and r[0] < a_ends and r[0] <= b_ends:
                        known = False
                        break
                if not known:
                    break
            self.pairs[key] = known
        return known

    def ending(self, state: int, end: int, ends: list[int] | dict[int, int]) -> int:
        """The token that ends at a position: the longest that fits after the one before it."""
        pairs = self.pairs
        for t, size in self.found[state]:
            if size == end:
                return t
            left = ends[end - size]
            fits = pairs.get(left << 32 | t)
            if self.compatible(left, t) if fits is None else fits:
                return t
        raise ValueError("the vocabulary lacks a byte")

    def stream(self, data: bytes) -> Iterator[int]:
        """Ids of one pre-token, emitted as soon as they are stable."""
        longest = self.longest
        ends: dict[int, int] = {}  # position -> token that ends there
        done = state = 0  # everything before done is emitted
        for end, byte in enumerate(data, 1):
            key = state << 8 | byte
            state = self.go[key] if key in self.go else self.step(state, byte)
            ends[end] = self.ending(state, end, ends)
            if end - done >= 4 * longest:
                # what lies on the paths of all positions that a later token can start from
                common: list[tuple[int, int]] | None = None
                for p in range(end - longest + 1, end + 1):
                    path = []
                    while p > done:
                        path.append((p, ends[p]))
                        p -= len(self.bytes_of[ends[p]])
                    path.reverse()
                    common = path if common is None else [x for x, y in zip(common, path) if x == y]  # noqa: B905
                for p, t in common or []:
                    yield t
                    done = p
                for p in [p for p in ends if p <= min(done, end - longest)]:
                    del ends[p]
        path, p = [], len(data)
        while p > done:
            path.append(ends[p])
            p -= len(self.bytes_of[ends[p]])
        yield from reversed(path)

    def prepare(self, words: set[str]) -> None:
        """Puts the ids of short pre-tokens into the memo.  In order, a word goes on
        from the state at the prefix it shares with the word before."""
        memo = self.memo
        if len(memo) >= MEMO:
            memo = self.memo = {w: memo[w] for w in words if w in memo}
        before, ends, states = b"", [0], [0]
        go, jump, found, pairs, size = self.go, self.jump, self.found, self.pairs, self.sizes
        for data, word in sorted((w.encode("utf-8", "replace"), w) for w in words if w not in memo and len(w) <= MEMO_LENGTH):
            same = len(commonprefix((before, data)))
            del ends[same + 1 :], states[same + 1 :]
            state = states[-1]
            for end in range(same + 1, len(data) + 1):
                key = state << 8 | data[end - 1]
                new = go.get(key)
                if new is None:
                    new = jump.get(key)
                    if new is None:
                        new = self.step(state, data[end - 1])
                state = new
                for t, n in found[state]:
                    if n == end:
                        break
                    left = ends[end - n]
                    fits = pairs.get(left << 32 | t)
                    if self.compatible(left, t) if fits is None else fits:
                        break
                ends.append(t)
                states.append(state)
            path, p = [], len(data)
            while p:
                path.append(ends[p])
                p -= size[ends[p]]
            path.reverse()
            memo[word] = struct.pack(f"<{len(path)}I", *path)
            before = data

    def packed(self, word: str) -> Iterator[bytes]:
        """Ids of one pre-token, a bounded number at once."""
        known = self.memo.get(word)
        if known is not None:
            yield known
            return
        ids = self.stream(word.encode("utf-8", "replace"))
        while part := list(islice(ids, CHUNK)):
            yield struct.pack(f"<{len(part)}I", *part)

    def pieces(self, text: str) -> Iterator[str]:
        """A long text in pieces whose matches are the text's."""
        at = 0
        while len(text) - at > PIECE:
            cut = CUT.search(text, at + PIECE)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids as little-endian 32-bit integers, piece by piece."""
        parts = [(text, None)]
        if self.split is not None and self.split.search(text):
            parts, at = [], 0
            for m in self.split.finditer(text):
                parts += [(text[at : m.start()], None), ("", self.added_id[m[0]])]
                at = m.end()
            parts.append((text[at:], None))
        for part, added in parts:
            if added is not None:
                yield added.to_bytes(4, "little")
            elif part:
                for piece in self.pieces(part):
                    words = self.pattern.findall(piece)
                    self.prepare(set(words))
                    known = []
                    for w in words:
                        if len(w) <= MEMO_LENGTH:
                            known.append(self.memo[w])
                            continue
                        yield b"".join(known)
                        known = []
                        yield from self.packed(w)
                    yield b"".join(known)

    def encode_all(self, texts: list[str]) -> Iterator[Iterable[bytes]]:
        """Chunks of ids for several texts, one text after the other; their new pre-tokens are prepared together."""
        plain = [len(t) <= PIECE and not (self.split and self.split.search(t)) for t in texts]
        words = [self.pattern.findall(t) if ok else [] for t, ok in zip(texts, plain, strict=True)]
        self.prepare(set().union(*words))
        for t, ok, w in zip(texts, plain, words, strict=True):
            if not ok:
                yield self.encode(t)
                continue
            try:
                yield [b"".join(map(self.memo.__getitem__, w))]
            except KeyError:  # a long pre-token is among them, or another text emptied the memo
                yield self.encode(t)

    def decode(self, chunks: Iterable[bytes]) -> Iterator[str]:
        """Text of packed ids, chunk by chunk."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for chunk in chunks:
            ids = np.frombuffer(chunk, "<u4")
            width = self.width[ids]
            ends = np.cumsum(width)
            yield machine.decode(self.flat[np.arange(width.sum()) + np.repeat(self.place[ids] - ends + width, width)].tobytes())
        yield machine.decode(b"", True)


def _round_trip(path: str, names: list[str], full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = worker_model(("tokens", path), lambda: Transducer(path))
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                n, ids_sha, text_sha, ids = [], [], [], []
                for chunks in t.encode_all([x or "" for x in batch.column("text").to_pylist()]):
                    a, b = hashlib.sha256(), hashlib.sha256()
                    size, own = 0, []

                    def seen(chunks=chunks, a=a, own=own):
                        nonlocal size
                        for c in chunks:
                            a.update(c)
                            size += len(c)
                            if full:
                                own.append(c)
                            yield c

                    for s in t.decode(seen()):
                        b.update(s.encode("utf-8"))
                    n.append(size // 4)
                    ids_sha.append(a.hexdigest())
                    text_sha.append(b.hexdigest())
                    if full:
                        ids.append(np.frombuffer(b"".join(own), "<u4").astype(np.int32))
                cols = [*[batch.column(c) for c in names], pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
                if full:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=[*names, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * full])

    return lean(run)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, path: str, keep: str = "doc_id", ids: bool = False) -> DataFrame:
    """(keep, n_tokens, ids_sha256, decoded_sha256) of every text, with the ids themselves if asked for."""
    ready(docs.sparkSession)
    kind = dict(docs.dtypes)[keep]
    schema = f"`{keep}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return docs.select(keep, "text").mapInArrow(_round_trip(path, [keep], ids), schema)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with the 50k byte-level vocabulary and decoded again."""
    return encode(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path())


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the token ids of every document."""
    return encode(docs, tokenizer_path(), ids=True)
