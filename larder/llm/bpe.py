"""Byte-pair encoding as a streaming transducer, and decoding as an incremental state machine.

The encoder reads bytes one after another and keeps, for every place in its window, the last token
of the encoding of everything up to there. That token is unique: it is the one that ends there and
forms a valid pair with the token before it, where a pair is valid if the merge list would not
merge across their border (:meth:`Merges.fits`). A later byte can only build on a place that a
token still reaches, so what all those places share is stable and is emitted. The merge list's
sufficient lookahead (:attr:`Merges.lookahead`) is the longest chain of overlapping merges in which
each comes before the last; the window is settled once it is longer than that, so memory stays
constant on texts without any break.

The decoder maps ids to bytes and feeds them to a UTF-8 state machine that keeps at most three
bytes; bytes that form no character become U+FFFD.

Defined results: null and empty texts give no tokens and an empty text; repeated rows and null ids
are rows like any other; an empty table gives no rows. Special tokens of the vocabulary file are
matched in texts, as its library does. Only the id and text (or ids) columns are read.
"""

from __future__ import annotations

import codecs
import functools
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import slices

#: Fixed value: the pattern that the vocabulary's library splits texts with.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: From here on Unicode versions disagree on what is a letter, so the library itself splits.
LIMIT = 0x558
DISPUTED = re.compile("[\u0558-\U0010ffff]")
#: Cached pieces in a Python worker while a task runs, those it keeps for the next task, pairs of
#: tokens remembered, and characters of a text split at a time.
CACHE, KEPT, PAIRS, SEGMENT = 400_000, 250_000, 400_000, 1 << 18


def plain_split() -> re.Pattern:
    """:data:`SPLIT` for texts without disputed letters, with its classes written out."""
    kinds = {"L": "", "N": ""}
    for code in range(LIMIT):
        kind = unicodedata.category(chr(code))[0]
        if kind in kinds:
            kinds[kind] += re.escape(chr(code))
    space = r"\t-\r \x85\xa0"
    return re.compile(SPLIT.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{kinds['L']}{kinds['N']}]")
                      .replace(r"\p{L}", f"[{kinds['L']}]").replace(r"\p{N}", f"[{kinds['N']}]")
                      .replace(r"\s", f"[{space}]").replace(r"\S", f"[^{space}]"))


def byte_letters() -> dict[str, int]:
    """The letter by which the vocabulary file shows each byte: printable Latin-1 letters stand
    for themselves, the others follow from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """A vocabulary and its merge list, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        vocab = {as_bytes(token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = vocab
        self.bytes_of = {i: token for token, i in vocab.items()} | {
            i: content.encode() for content, i in self.special.items()}
        self.rank, self.parts, self.joined = {}, {}, {}
        for rank, (left, right) in enumerate(spec["model"]["merges"]):
            a, b = as_bytes(left), as_bytes(right)
            whole = vocab[a + b]
            self.rank[whole], self.parts[whole] = rank, (vocab[a], vocab[b])
            self.joined[vocab[a], vocab[b]] = rank
        self.longest = max(map(len, vocab))
        # Lengths of the tokens that end in each three bytes, longest first, down to 1.
        tails: dict[bytes, set[int]] = {}
        for token in vocab:
            if len(token) > 2:
                tails.setdefault(token[-3:], {1, 2}).add(len(token))
        self.lengths = {tail: sorted(found, reverse=True) for tail, found in tails.items()}
        self.lookahead = self._lookahead()
        self.fits = _Fits(self)

    def _lookahead(self) -> int:
        """Bytes after which no merge can change a border any more. A merge is prevented only by
        an earlier one that takes a piece from the right end of its right part; ``best`` has the
        longest such chain that begins with each left part, among the merges seen so far."""
        best: dict[int, int] = {}
        for whole in sorted(self.rank, key=self.rank.get):
            left, right = self.parts[whole]
            reach, piece = 0, right
            while True:
                reach = max(reach, best.get(piece, 0))
                if piece not in self.parts:
                    break
                piece = self.parts[piece][1]
            best[left] = max(best.get(left, 0), reach + len(self.bytes_of[right]))
        return max(best.values(), default=0) + self.longest

    def _fits(self, left: int, right: int) -> bool:
        """Whether the merge list leaves the border between two tokens alone. Both tokens are
        taken apart, the one made last first; no merge across may come before that one."""
        limit = len(self.rank)
        rank, parts, joined = self.rank, self.parts, self.joined
        while True:
            if joined.get((left, right), limit) < limit:
                return False
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, parts[left][1]
            else:  # of equal merges the left one comes first
                limit, right = b + 1, parts[right][0]


class _Fits(dict):
    """:meth:`Merges._fits` by (left << 32 | right), for the pairs met so far."""

    def __init__(self, merges: Merges):
        self.merges = merges

    def __missing__(self, pair: int) -> bool:
        if len(self) >= PAIRS:
            self.clear()
        self[pair] = found = self.merges._fits(pair >> 32, pair & 0xFFFFFFFF)
        return found


class Encoder:
    """Feed bytes of one pre-token with :meth:`push`; each call returns the tokens now stable."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.before: int | None = None  # the last token emitted
        self.window = b""
        self.start, self.token = [0], [None]

    def push(self, data: bytes) -> list[int]:
        out, step = [], 2 * self.merges.lookahead
        for at in range(0, len(data), step):
            self._extend(data[at:at + step])
            if len(self.window) > step:
                out += self._settle()
        return out

    def finish(self) -> list[int]:
        """The remaining tokens; the encoder is ready for the next pre-token."""
        rest = self._chain(len(self.window))
        self.__init__(self.merges)
        return rest

    def _extend(self, data: bytes) -> None:
        first = len(self.window)
        self.window += data
        ids, fits, lengths, window = (self.merges.ids, self.merges.fits, self.merges.lengths,
                                      self.window)
        start, token = self.start, self.token
        token[0] = self.before
        for end in range(first + 1, len(window) + 1):
            for length in lengths.get(window[max(0, end - 3):end], (2, 1)):
                begin = end - length
                if begin < 0:
                    continue
                found = ids.get(window[begin:end])
                if found is not None and (
                        token[begin] is None or fits[token[begin] << 32 | found]):
                    start.append(begin)
                    token.append(found)
                    break
            else:
                raise ValueError("a byte is missing from the vocabulary")

    def _chain(self, end: int) -> list[int]:
        out = []
        while end:
            out.append(self.token[end])
            end = self.start[end]
        return out[::-1]

    def _settle(self) -> list[int]:
        """Emit what every place that a coming token can begin at has in common."""
        size = len(self.window)
        places = set(range(max(0, size + 1 - self.merges.longest), size + 1))
        while len(places) > 1:
            last = max(places)
            places.remove(last)
            places.add(self.start[last])
        border = places.pop()
        out = self._chain(border)
        if out:
            self.before = out[-1]
            self.window = self.window[border:]
            self.start = [max(0, s - border) for s in self.start[border:]]
            self.token = [None, *self.token[border + 1:]]
        return out


class Decoder:
    """Feed ids with :meth:`push`; each call returns the text that is complete by then."""

    def __init__(self, merges: Merges):
        self.bytes_of = merges.bytes_of
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", final=True)


class _Cache(dict):
    """Token ids by pre-token. A pre-token is kept for good when it comes a second time while it is
    still among the last new ones, so the many that occur once do not crowd out the others."""

    def __init__(self, merges: Merges):
        self.encoder = Encoder(merges)
        self.new: dict[str, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.new.pop(piece, None)
        if ids is not None:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = ids
            return ids
        ids = (*self.encoder.push(piece.encode()), *self.encoder.finish())
        if len(piece) <= 64:
            if len(self.new) >= CACHE // 2:
                self.new.clear()
            self.new[piece] = ids
        return ids

    def trim(self) -> None:
        """Keep the pre-tokens that came again first, which are the frequent ones: workers wait for
        their next task beside those of other stages."""
        self.new.clear()
        if len(self) > KEPT:
            first = list(islice(self.items(), KEPT))
            self.clear()
            self.update(first)


class Tokenizer:
    def __init__(self, path: str):
        self.merges = Merges(path)
        self.cache = _Cache(self.merges)
        self.split = plain_split()
        self.special = re.compile("|".join(
            re.escape(s) for s in sorted(self.merges.special, key=len, reverse=True)) or "(?!)")

    def _pieces(self, text: str) -> Iterator[list[str]]:
        """Pre-tokens, a segment at a time; a segment ends where white space follows a letter or
        sign, as no pre-token goes over such a place."""
        if DISPUTED.search(text):
            from tokenizers.pre_tokenizers import ByteLevel

            splitter = ByteLevel(add_prefix_space=False, use_regex=True)
            yield [text[a:b] for _, (a, b) in splitter.pre_tokenize_str(text)]
            return
        at = 0
        while at < len(text):
            cut = SAFE.search(text, at + SEGMENT)
            end = cut.end() if cut else len(text)
            yield self.split.findall(text, at, end) if end == len(text) else self.split.findall(
                text[at:end])
            at = end

    def encode(self, text: str) -> Iterator[Iterable[int]]:
        """Token ids, in portions."""
        at = 0
        for mark in chain(self.special.finditer(text), [None]):
            plain = text[at:mark.start() if mark else len(text)]
            for pieces in self._pieces(plain):
                yield chain.from_iterable(map(self.cache.__getitem__, pieces))
            if mark:
                yield [self.merges.special[mark[0]]]
                at = mark.end()

    def decode(self, ids: np.ndarray, step: int = 1 << 16) -> str:
        machine = Decoder(self.merges)
        parts = [machine.push(ids[i:i + step].tolist()) for i in range(0, len(ids), step)]
        return "".join([*parts, machine.finish()])


#: The end of a non-space that white space follows.
SAFE = re.compile(r"[^\t-\r \x85\xa0](?=[\t-\r \x85\xa0])")


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """One tokenizer for each file and Python worker."""
    return Tokenizer(path)


def encoded(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
            read_back: bool = False) -> DataFrame:
    """doc_id and ``ids`` (array of int) for every row of ``docs``; with ``read_back`` also
    ``text``, decoded from those ids by the same task."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in slices(batches):
            values = [np.fromiter(chain.from_iterable(own.encode(t.as_py() or "")), np.int32)
                      for t in batch["text"]]
            columns = {"doc_id": batch["doc_id"], "ids": _lists(values)}
            if read_back:
                columns["text"] = pa.array(map(own.decode, values), pa.string())
            yield pa.RecordBatch.from_pydict(columns)
        own.cache.trim()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc_id {kind}, ids array<int>" + ", text string" * read_back)


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(
        [np.empty(0, np.int32), *values])))


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """Rows with doc_id and ids, and their ``text``."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in slices(batches):
            flat, ends = batch["ids"].values.to_numpy(), batch["ids"].offsets.to_numpy()
            texts = [own.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["ids"], pa.array(texts, pa.string())],
                names=["doc_id", "ids", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")) \
        .mapInArrow(decode, f"doc_id {kind}, ids array<int>, text string")
