"""Byte-level BPE encoding and decoding by a rank queue over a hierarchical bitmap (operator 8)."""

from __future__ import annotations

import base64
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.llm import words

#: Pre-tokens whose ids a worker remembers, and their bytes; when either is reached the table starts anew.
TOKENS, TOKENS_BYTES = 800_000, 32 << 20
GROUP_BYTES = 1 << 18  # of pre-tokens that go through the queue together


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a line for each token, base64 and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class RankQueue(dict):
    """The merges that are open: rank → positions, lowest rank first. Three levels of 64-bit words say
    which ranks have positions, so that the next rank is three find-first-sets away. A position is
    never taken out when its pair goes; it is stale then, and passed over when its rank comes."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        super().__init__()
        self.ranks = ranks
        size = max(ranks.values(), default=0) + 1
        if size > 1 << 18:
            raise ValueError("more than 262,144 ranks")
        self.leaf, self.middle, self.top = [0] * ((size >> 6) + 1), [0] * 64, 0
        # The ranks of single bytes and of pairs of bytes, -1 where there is none.
        self.one, self.two = np.full(1 << 8, -1, np.int32), np.full(1 << 16, -1, np.int32)
        for token, rank in ranks.items():
            if len(token) == 1:
                self.one[token[0]] = rank
            elif len(token) == 2:
                self.two[token[0] << 8 | token[1]] = rank

    def __missing__(self, rank: int) -> list[int]:
        self.leaf[rank >> 6] |= 1 << (rank & 63)
        self.middle[rank >> 12] |= 1 << ((rank >> 6) & 63)
        self.top |= 1 << (rank >> 12)
        bucket = self[rank] = []
        return bucket

    def first(self) -> int:
        """The lowest rank that has positions, or -1."""
        word = self.top
        if not word:
            return -1
        a = (word & -word).bit_length() - 1
        word = self.middle[a]
        b = a << 6 | (word & -word).bit_length() - 1
        word = self.leaf[b]
        return b << 6 | (word & -word).bit_length() - 1

    def take(self, rank: int) -> list[int]:
        """Remove a rank with its positions."""
        self.leaf[rank >> 6] &= ~(1 << (rank & 63))
        if not self.leaf[rank >> 6]:
            self.middle[rank >> 12] &= ~(1 << ((rank >> 6) & 63))
            if not self.middle[rank >> 12]:
                self.top &= ~(1 << (rank >> 12))
        return self.pop(rank)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pre-tokens as little-endian 32-bit integers: within each, always the pair of lowest
        rank is merged, leftmost first. All go through the queue together, laid end to end, so that
        a rank is found once for all of them; no pair goes across two. None may be empty."""
        data, find = b"".join(pieces), self.ranks.get
        n = len(data)
        heads = np.cumsum([0, *map(len, pieces)])
        chars = np.frombuffer(data, np.uint8)
        ids = self.one[chars]
        if (ids < 0).any():
            raise ValueError("a byte that the vocabulary lacks")
        pairs = np.full(n, -1, np.int32)
        pairs[:-1] = self.two[chars[:-1].astype(np.int32) << 8 | chars[1:]]
        pairs[heads[1:] - 1] = -1
        places = np.argsort(pairs, kind="stable")
        places = places[np.count_nonzero(pairs < 0) :]
        found, cuts = np.unique(pairs[places], return_index=True)
        for rank, some in zip(found.tolist(), np.split(places, cuts[1:]), strict=bool(len(found))):
            self[rank].extend(some.tolist())
        # before is -1 at the first byte of each pre-token and at the end.
        links = np.arange(-1, n, dtype=np.int32)
        links[heads] = -1
        before, after = array("i", links.tobytes()), array("i", np.arange(1, n + 1, dtype=np.int32).tobytes())
        pair, alive, ids, heads = array("i", pairs.tobytes()), bytearray(b"\1" * n), array("i", ids.tobytes()), heads.tolist()
        while (rank := self.first()) >= 0:
            held = 0  # positions before this one wait for a lower rank
            for i in sorted(self.take(rank)):
                if pair[i] != rank:
                    continue
                if i < held:
                    self[rank].append(i)
                    continue
                gone = after[i]
                after[i] = end = after[gone]
                ids[i], alive[gone], pair[gone], pair[i] = rank, 0, -1, -1
                least = rank
                if before[end] >= 0:
                    before[end] = i
                    new = find(data[i : after[end]])
                    if new is not None:
                        pair[i] = new
                        self[new].append(i)
                        if new < least:
                            least = new
                left = before[i]
                if left >= 0:
                    new = find(data[left:end])
                    if new is None:
                        pair[left] = -1
                    else:
                        pair[left] = new
                        self[new].append(left)
                        if new < least:
                            least = new
                if least < rank:
                    held = heads[bisect_right(heads, i)]
        alive = np.frombuffer(alive, bool)
        out = np.frombuffer(ids, np.int32)[alive].astype("<u4").tobytes()
        cuts = (4 * np.concatenate([[0], np.cumsum(alive)])[heads]).tolist()
        return [out[a:b] for a, b in pairwise(cuts)]


class Encoder:
    """Texts → their ids, with the pre-tokens remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        # White space as Unicode has it, as some regex engines add four control characters.
        pattern = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.matches = regex.compile(pattern).findall
        self.ranks, self.queue = ranks, RankQueue(ranks)
        self.known: dict[str, bytes] = {}
        self.size = 0

    def _learn(self, tokens: set[str]) -> None:
        group, size = [], 0
        for token in tokens:
            piece = token.encode()
            self.size += len(piece)
            whole = self.ranks.get(piece)
            if whole is not None:
                self.known[token] = whole.to_bytes(4, "little")
                continue
            group.append((token, piece))
            size += len(piece)
            if size >= GROUP_BYTES:
                self._merge(group)
                group, size = [], 0
        self._merge(group)

    def _merge(self, group: list[tuple[str, bytes]]) -> None:
        if group:
            names, pieces = zip(*group, strict=True)
            self.known.update(zip(names, self.queue.encode(pieces), strict=True))

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        if len(self.known) >= TOKENS or self.size >= TOKENS_BYTES:
            self.known.clear()
            self.size = 0
        matched = [self.matches(text) for text in texts]
        self._learn(set().union(*matched) - self.known.keys())
        return [b"".join(map(self.known.__getitem__, tokens)) for tokens in matched]


def bpe_encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ids, n_tokens): the ids of each whole text as little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded alone; text that no match covers has no ids. There are no
    special tokens. A null text counts as empty and has no ids. Nulls and repeats in ``id_col`` stay
    as they are, a row for each row; other columns are ignored.
    """
    # A vocabulary file's fixed size. A worker keeps what a broadcast holds, and so its encoder, from
    # task to task.
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": ranks})
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        encoder = held.get(pattern)
        if encoder is None:
            encoder = held[pattern] = Encoder(held["ranks"], pattern)
        for batch in batches:
            for part, _, _ in words.slices(batch, "text"):
                ids = encoder.encode_all([text or "" for text in part.column("text").to_pylist()])
                yield pa.record_batch([part.column("id"), pa.array(ids, pa.binary())], ["id", "ids"])

    encoded = rows.mapInArrow(run, f"id {id_type}, ids binary")
    tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return encoded.select(F.col("id").alias(id_col), "ids", tokens)


def bpe_decode(encoded: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id") -> DataFrame:
    """(``id_col``, ids, n_tokens, decoded): the bytes that the ids stand for. An id that the
    vocabulary lacks raises."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    rows = encoded.select(F.col(id_col).alias("id"), "ids", "n_tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: data for data, rank in shared.value.items()}.__getitem__
        for batch in batches:
            for a in range(0, len(batch), 500):
                part = batch.slice(a, 500)
                texts = [b"".join(map(token, np.frombuffer(x.as_buffer(), "<u4").tolist())) for x in part["ids"]]
                yield pa.record_batch([*part.columns, pa.array(texts, pa.binary())], ["id", "ids", "n_tokens", "decoded"])

    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids binary, n_tokens long, decoded binary")
    return out.withColumnRenamed("id", id_col)
