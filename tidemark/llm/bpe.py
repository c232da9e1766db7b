"""Byte-level BPE by dynamic programming over prefixes.

Of all tokens that end a prefix of some bytes, exactly one can be the last token of that prefix's encoding: the one
that may follow the last token of the prefix before it. Storing that one token for each prefix gives

* the encoding of the whole (walk back from the end),
* exact appends (later prefixes never change earlier ones), and
* cheap edits: after an edit, entries are computed only until as many as the longest token has bytes agree with the
  old ones; from there on all old entries still hold.

Tables are built on the driver from a rank file of bounded size (a vocabulary) and broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship, whole_text

NEVER = 1 << 40
CACHE_ENTRIES = 200_000


class MergeTable:
    """Tokens by rank, and for each the two tokens whose merge makes it."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        if any(len(self.tokens[rank]) != 1 for rank in range(256)):
            raise ValueError("the 256 single bytes must have the lowest ranks")
        self.longest = max(map(len, ranks))
        # How long the tokens are that end in a given byte pair, so that few spans are looked up.
        ends: dict[bytes, set[int]] = {}
        for token in ranks:
            ends.setdefault(token[-2:], set()).add(len(token))
        self.sizes = {tail: sorted(sizes - {1}) for tail, sizes in ends.items()}
        self.met: dict[int, bool] = {}
        self.left = [-1] * len(self.tokens)
        self.right = [-1] * len(self.tokens)
        self.merged: dict[int, int] = {}
        for rank in range(256, len(self.tokens)):
            token = self.tokens[rank]
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut], NEVER), ranks.get(token[cut:], NEVER)
                if a < rank and b < rank and self.made(a) and self.made(b) and self.may_meet(a, b):
                    self.left[rank], self.right[rank] = a, b
                    self.merged[a << 20 | b] = rank
                    break

    def made(self, rank: int) -> bool:
        """Whether merges can make the token at all."""
        return rank < 256 or self.left[rank] >= 0

    def may_meet(self, left: int, right: int) -> bool:
        """Whether an encoding can hold these two tokens side by side.

        The merges are undone from the latest to the earliest. While the two tokens at the border have been there
        together, a merge across the border must not have come first; of equal merges, the left one comes first.
        """
        before = NEVER
        while True:
            if self.merged.get(left << 20 | right, NEVER) < before:
                return False
            if left > right:
                if left < 256:
                    return True
                before, left = left, self.right[left]
            else:
                if right < 256:
                    return True
                before, right = right + 1, self.left[right]


    def meets(self, left: int, right: int) -> bool:
        """``may_meet``, with answers kept up to a fixed number."""
        key = left << 20 | right
        answer = self.met.get(key)
        if answer is None:
            if len(self.met) >= CACHE_ENTRIES:
                self.met.clear()
            answer = self.met[key] = self.may_meet(left, right)
        return answer

    def last_token(self, data: bytes, end: int, last: list[int]) -> int:
        """The last token of the prefix data[:end], where ``last`` has those of all shorter prefixes."""
        ranks, meets = self.ranks, self.meets
        token = ranks[data[end - 1 : end]]
        if end == 1 or meets(last[end - 2], token):
            return token
        for size in self.sizes.get(data[end - 2 : end], ()):
            if size > end:
                break
            token = ranks.get(data[end - size : end])
            if token is not None and self.made(token) and (size == end or meets(last[end - size - 1], token)):
                return token
        raise ValueError("bytes without an encoding")


class PrefixTokens:
    """The last token of each prefix of some bytes, kept up to date under appends and edits."""

    def __init__(self, merges: MergeTable, data: bytes = b""):
        self.merges = merges
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        for end in range(len(self.last) + 1, len(self.data) + 1):
            self.last.append(self.merges.last_token(self.data, end, self.last))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of data[start:stop]; returns the number of entries that were computed."""
        old_last, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old_last[:start]
        agreed = 0
        for end in range(start + 1, len(self.data) + 1):
            token = self.merges.last_token(self.data, end, self.last)
            self.last.append(token)
            past = end - shift
            agreed = agreed + 1 if past > stop and old_last[past - 1] == token else 0
            if agreed >= self.merges.longest:
                self.last += old_last[past:]
                return end - start
        return len(self.data) - start

    def tokens(self) -> list[int]:
        out, end = [], len(self.last)
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(self.merges.tokens[token])
        return out[::-1]


def load_merges(path: str) -> MergeTable:
    """Read a rank file: base64 token and rank on each line."""
    with open(path, "rb") as lines:
        return MergeTable({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


def encode_word(table: MergeTable, data: bytes) -> list[int]:
    """The encoding of one short match; a whole token is its own encoding."""
    token = table.ranks.get(data)
    if token is not None and table.made(token):
        return [token]
    return PrefixTokens(table, data).tokens()


# The public splitting pattern for texts of these characters alone, where the standard library's faster engine
# gives the same matches.
PLAIN_TEXT = re.compile("[^\t\n\r -~À-ÖØ-öø-ÿ]")
PLAIN_PATTERN = {
    public_tokenizers.PATTERN: r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ÿ]+|\s+(?!\S)|\s+"
}


class Words(dict):
    """Packed ids of short matches. Missing ones are encoded; when the newer half is full, the older half is forgotten,
    so that frequent matches stay and the number kept is bounded."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(word) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Splitter:
    """Cuts texts into the pattern's matches."""

    def __init__(self, pattern: str):
        self.any = regex.compile(pattern).findall
        self.plain = re.compile(PLAIN_PATTERN[pattern]).findall if pattern in PLAIN_PATTERN else None

    def __call__(self, text: str) -> list[str]:
        if self.plain and not PLAIN_TEXT.search(text):
            return self.plain(text)
        return self.any(text)


class Encoder:
    """Encodes and decodes texts; encodings of repeated short matches are kept, up to a fixed number."""

    def __init__(self, table: MergeTable, pattern: str):
        self.table = table
        self.split = Splitter(pattern)
        self.words = Words(lambda word: np.array(encode_word(table, word.encode("utf-8")), "<u4").tobytes())
        self.names = [str(i) for i in range(len(table.tokens))]

    def packed(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        return b"".join(map(self.words.__getitem__, self.split(text)))

    def digests(self, text: str) -> tuple[int, str, str]:
        ids = np.frombuffer(self.packed(text), "<u4").tolist()
        names, tokens = self.names, self.table.tokens
        spelled = " ".join(map(names.__getitem__, ids)).encode("ascii")
        decoded = b"".join(map(tokens.__getitem__, ids))
        return len(ids), hashlib.sha256(spelled).hexdigest(), hashlib.sha256(decoded).hexdigest()


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(shared, pattern: str) -> Encoder:
    """One encoder for each Python worker, so that its kept words serve all of the worker's tasks."""
    key = (len(shared.value.tokens), shared.value.tokens[-1], pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value, pattern)
    return _ENCODERS[key]


def encode_documents(
    documents: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False
) -> DataFrame:
    """Encode and decode every text; one row for each input row.

    Columns: the id column, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, on request, ``ids``. A null text is
    the empty text (0 tokens, digests of the empty string); null and repeated ids are passed through row by row; other
    columns are not read. The only shared data is the vocabulary, whose size does not depend on the documents.
    """
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(load_merges(ranks_path))
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared, pattern)
        for batch in batches:
            texts = batch.column(1)
            rows = [encoder.digests(texts[i].as_py()) for i in range(len(texts))]
            columns = [batch.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string())))]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                ids = [np.frombuffer(encoder.packed(texts[i].as_py()), "<u4").astype(np.int32) for i in range(len(texts))]
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    narrow = documents.select(F.col(id_column).cast("long").alias("id"), whole_text(text_column).alias("body"))
    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_column)
