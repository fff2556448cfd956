"""Byte-level BPE with a given public vocabulary: encode and decode whole texts.

A word's symbols form a doubly linked list; a priority queue holds the merge
rank of each neighbouring pair. The lowest rank is merged first (ties: the
leftmost); an entry whose two symbols have changed since is stale and skipped.
So a word of n bytes costs n log n, however long it is. Decoding concatenates
the vocabulary's byte strings.

The vocabulary is read once on the driver and broadcast: its size is that of
the tokenizer file (about 50,000 entries), whatever the input.

Defined results: a null text counts as empty, an empty text has no ids;
repeated rows are encoded alike; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import json
import sys
from array import array
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinion_spark.llm.common import map_text, table

#: Fixed value: the published byte-level pre-tokenisation pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Encoded words that a task remembers: a generation of the words met lately, and the one before it.
CACHE_WORDS, CACHE_CHARS = 200_000, 64

@dataclass
class Vocabulary:
    """ids: token bytes to id; ranks: pair of ids to (rank, merged id); special: whole strings kept as one id."""

    ids: dict
    ranks: dict
    special: dict

    def __post_init__(self):
        #: the id of each byte, the rank of a right-hand id for each left-hand one, and the merged id of each rank
        self.byte_ids = [self.ids.get(bytes([b])) for b in range(256)]
        after = [{} for _ in range(1 + max(self.ids.values(), default=0))]
        self.made = {}
        for (left, right), (rank, merged) in self.ranks.items():
            after[left][right] = rank
            self.made[rank] = merged
        self.rank_after = [x.get for x in after]


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files: itself where printable, else the next code point from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def load(path: str) -> Vocabulary:
    """Read a tokenizer file of the public JSON form."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    alphabet = byte_alphabet()
    raw = lambda token: bytes(alphabet[c] for c in token)
    ids = {raw(t): i for t, i in spec["model"]["vocab"].items()}
    ranks = {}
    for rank, pair in enumerate(spec["model"]["merges"]):
        a, b = map(raw, pair if isinstance(pair, list) else pair.split(" "))
        ranks[ids[a], ids[b]] = rank, ids[a + b]
    return Vocabulary(ids, ranks, {t["content"]: t["id"] for t in spec["added_tokens"]})


def merge_word(word: bytes, vocab: Vocabulary) -> list[int]:
    """Ids of one pre-token."""
    byte_ids, rank_after, made = vocab.byte_ids, vocab.rank_after, vocab.made
    sym = [byte_ids[b] for b in word]
    n = len(sym)
    if n == 1:
        return sym
    # the rank that the pair starting at each place has now, or -1: a queue entry of another rank is stale
    now = [rank_after[a](b, -1) for a, b in zip(sym, sym[1:])]
    # an entry is one integer, rank and place
    bits = n.bit_length()
    place = (1 << bits) - 1
    queue = [r << bits | i for i, r in enumerate(now) if r >= 0]
    now.append(-1)
    heapq.heapify(queue)
    push, pop = heapq.heappush, heapq.heappop
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    while queue:
        entry = pop(queue)
        i, rank = entry & place, entry >> bits
        if now[i] != rank:
            continue
        j = after[i]
        symbol = sym[i] = made[rank]
        sym[j] = now[j] = now[i] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            r = now[i] = rank_after[symbol](sym[k], -1)
            if r >= 0:
                push(queue, r << bits | i)
        h = before[i]
        if h >= 0:
            r = now[h] = rank_after[sym[h]](symbol, -1)
            if r >= 0:
                push(queue, r << bits | h)
    return [x for x in sym if x >= 0]


def encoder(vocab: Vocabulary, cache_words: int = CACHE_WORDS):
    """A function from a text to its ids as little-endian unsigned 32-bit integers."""
    import struct

    import regex

    find = regex.compile(PATTERN).findall
    specials = regex.compile("(" + "|".join(map(regex.escape, sorted(vocab.special, key=len, reverse=True))) + ")") if vocab.special else None
    recent: dict[str, bytes] = {}
    older: dict[str, bytes] = {}

    def miss(word: str) -> bytes:
        nonlocal older
        if (packed := older.get(word)) is None:
            ids = array("I", merge_word(word.encode("utf-8", "surrogatepass"), vocab))
            if sys.byteorder == "big":
                ids.byteswap()
            packed = ids.tobytes()
        if len(word) <= CACHE_CHARS:
            if len(recent) >= cache_words:  # words not met since the last turn are forgotten
                older = recent.copy()
                recent.clear()
            recent[word] = packed
        return packed

    def plain(text: str) -> bytes:
        get = recent.get
        return b"".join([get(w) or miss(w) for w in find(text)])

    def encode(text: str) -> bytes:
        if specials is None or not any(s in text for s in vocab.special):
            return plain(text)
        return b"".join(struct.pack("<I", vocab.special[part]) if part in vocab.special else plain(part) for part in specials.split(text))

    return encode


def decoder(vocab: Vocabulary):
    """A function from packed ids to text; bytes that are no UTF-8 become U+FFFD."""
    import numpy as np

    strings = [b""] * (1 + max([*vocab.ids.values(), *vocab.special.values()], default=0))
    for token, i in vocab.ids.items():
        strings[i] = token
    for token, i in vocab.special.items():
        strings[i] = token.encode()

    def decode(packed: bytes) -> str:
        return b"".join([strings[i] for i in np.frombuffer(packed, "<u4").tolist()]).decode("utf-8", "replace")

    return decode


def _codec(shared, keep_ids: bool):
    def make():
        import hashlib

        import numpy as np

        vocab = Vocabulary(**shared.value)
        encode, decode = encoder(vocab), decoder(vocab)

        def of(text):
            packed = encode(text)
            back = decode(packed)
            row = (len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
            return (*row, np.frombuffer(packed, "<u4").astype("int32"), back) if keep_ids else row

        return of

    return make


def encode_decode(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` of every row and, on request, ``ids`` and ``decoded`` themselves."""
    shared = docs.sparkSession.sparkContext.broadcast(asdict(load(vocabulary_path)))
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep_ids
    return map_text(docs, [key], F.coalesce(F.col(text), F.lit("")), _codec(shared, keep_ids), schema, 256 if keep_ids else None)


def vocabulary() -> str:
    """Where this machine keeps the public vocabulary that the registered query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark, sf_dir):
    """op2: every document encoded and decoded."""
    return encode_decode(table(spark, sf_dir, "documents"), vocabulary())
