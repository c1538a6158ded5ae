"""Byte-level BPE over a rank file, in linear time by backtracking.

A sequence of tokens is the encoding of its bytes exactly when each token, and each two neighbours
taken alone, encode to themselves. So the encoder takes the longest token that matches (bytes are
mapped to Latin-1 for the automaton), steps back to a shorter one where neighbours are not compatible,
and never tries a position again from which there was no way on. Compatibility is found by plain
merging of the two tokens' bytes and remembered.

Defined cases: a null text is an empty one, with no tokens; ids are of any type, null or repeated ids
are handed on; further columns are not looked at; an empty table gives no rows; a text is never cut,
and one long piece takes memory in proportion to its length.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable

import ahocorasick
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm import common

#: Pieces whose ids a worker remembers, and the longest piece it remembers.
REMEMBERED = 300_000
REMEMBERED_BYTES = 64
#: Pairs of tokens whose compatibility a worker remembers.
PAIRS = 300_000


def read_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """Token bytes and rank from the lines of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(raw: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of ``raw`` by definition: merge the neighbours of lowest rank until none can be merged."""
    parts = [raw[i : i + 1] for i in range(len(raw))]
    while len(parts) > 1:
        rank, at = min(
            (ranks.get(parts[i] + parts[i + 1], len(ranks) + 1), i) for i in range(len(parts) - 1)
        )
        if rank > len(ranks):
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[part] for part in parts]


class Tokenizer:
    """Encodes and decodes with one rank file and the pattern that cuts texts into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        missing = [byte for byte in range(256) if bytes([byte]) not in ranks]
        if missing:
            raise ValueError(f"the rank file lacks the bytes {missing}")
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pieces = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for token in ranks:
            self.automaton.add_word(token.decode("latin-1"))
        self._sound: dict[int, bool] = {}
        self._pairs: dict[tuple[int, int], bool] = {}

    def sound(self, token: int) -> bool:
        """Whether merging can arrive at the token at all."""
        known = self._sound.get(token)
        if known is None:
            known = self._sound[token] = merge(self.tokens[token], self.ranks) == [token]
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are when they stand side by side."""
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            raw = self.tokens[left] + self.tokens[right]
            known = self._pairs[left, right] = merge(raw, self.ranks) == [left, right]
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:  # a piece in the file is one token, whether or not merging gets there
            return [whole]
        text = piece.decode("latin-1")
        found: list[int] = []
        closed: set[int] = set()
        at, length = 0, self._reach(text, 0)
        while at < len(piece):
            token = None
            while length:
                token = self.ranks.get(piece[at : at + length])
                if token is not None and at + length not in closed:
                    if self.compatible(found[-1], token) if found else self.sound(token):
                        break
                token = None
                length -= 1
            if token is not None:
                found.append(token)
                at += length
                length = self._reach(text, at)
            else:
                closed.add(at)
                length = len(self.tokens[found.pop()])
                at -= length
                length -= 1
        return found

    def _reach(self, text: str, at: int) -> int:
        """Length of the longest start of a token at a position."""
        return self.automaton.longest_prefix(text[at : at + self.longest])

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.pieces(text) for i in self.encode_piece(piece.encode())]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Written(dict):
    """The ids of a piece as decimal text, remembered up to a bound."""

    def __init__(self, tokenizer: Tokenizer) -> None:
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, piece: str) -> str:
        raw = piece.encode()
        ids = ",".join(map(str, self.tokenizer.encode_piece(raw)))
        if len(raw) <= REMEMBERED_BYTES:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


def _loaded(content: bytes, pattern: str) -> tuple[Tokenizer, _Written]:
    """One tokenizer for all tasks of a worker."""

    def make() -> tuple[Tokenizer, _Written]:
        tokenizer = Tokenizer(read_ranks(content.splitlines()), pattern)
        return tokenizer, _Written(tokenizer)

    return common.loaded(hashlib.sha256(content).hexdigest() + pattern, make)


def _broadcast_file(docs: DataFrame, path: str):
    """The rank file, read where the job is started; vocabularies are a few megabytes at most."""
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def digests(
    docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document the number of ids, and digests of the ids and of the bytes they decode to."""
    shared = _broadcast_file(docs, path)

    def start() -> Callable:
        tokenizer, written = _loaded(shared.value, pattern)
        raw = {str(token): piece for token, piece in tokenizer.tokens.items()}

        def one(content: str) -> tuple[int, str, str]:
            ids = ",".join([written[piece] for piece in tokenizer.pieces(content)])
            tokens = ids.split(",") if ids else []
            decoded = b"".join([raw[token] for token in tokens])
            return (
                len(tokens),
                hashlib.sha256(ids.encode()).hexdigest(),
                hashlib.sha256(decoded).hexdigest(),
            )

        return one

    return common.map_rows(
        docs.select(F.col(doc_id), common.text_or_empty(text)),
        "n_tokens long, ids_sha256 string, decoded_sha256 string",
        start,
    )


def encode(
    docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document its ids, in column ``ids``."""
    shared = _broadcast_file(docs, path)

    def start() -> Callable:
        tokenizer, written = _loaded(shared.value, pattern)

        def one(content: str) -> tuple[list[int]]:
            ids = ",".join([written[piece] for piece in tokenizer.pieces(content)])
            return ([int(i) for i in ids.split(",")] if ids else [],)

        return one

    return common.map_rows(
        docs.select(F.col(doc_id), common.text_or_empty(text)), "ids array<int>", start
    )


def decode(
    encoded: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """Per document the bytes its ids stand for, in column ``content``; null ids are none."""
    shared = _broadcast_file(encoded, path)

    def start() -> Callable:
        tokenizer, _ = _loaded(shared.value, pattern)
        return lambda given: (tokenizer.decode(given or ()),)

    return common.map_rows(encoded.select(doc_id, ids), "content binary", start)
