"""Byte-pair encoding and decoding with a segment tree over pair ranks.

A word's adjacent pairs are the leaves of a segment tree; a leaf holds the
pair's merge rank and its place, so the root is the leftmost pair of lowest
rank. A merge changes three leaves, each in logarithmic time, until the root
says that no pair can be merged. A word of n symbols takes O(n log n), so a
text without spaces costs no more than any other.

The vocabulary is a ``tokenizers`` file of the word-end kind: NFC and lower
case, words cut by the file's own pattern, bytes shown as printable
characters, a suffix on a word's last symbol.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roost.llm.batches import ready_workers, slices


# The Unicode property White_Space: fixed values.
SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
SPACE_RUN = regex.compile(f"[{SPACES}]+")
# str.split() also cuts at these four, which are not White_Space.
SEPARATORS = re.compile("[\x1c-\x1f]")

# A leaf is rank and place in one number, so the least leaf is the leftmost of lowest rank.
NONE = 1 << 62
PLACE = 32
MASK = (1 << PLACE) - 1
CACHED_CHUNKS = 120_000
# Words up to this many bytes are merged side by side, so many at a time.
BATCHED_LENGTH = 128
BATCHED_WORDS = 20_000
# Characters of text that are split at a time.
TEXT_CHARS = 1_000_000
IDS = pa.list_(pa.int32())


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Bpe:
    """One vocabulary; keeps the ids of chunks seen lately."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.tokens = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        # Pair of ids -> (rank, shifted past the place; id of the merged symbol).
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[self.ids[a], self.ids[b]] = (rank << PLACE, self.ids[a + b])
        (split,) = [p for p in file["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.word = regex.compile(split["pattern"]["Regex"])
        letters = byte_letters()
        self.pairs = np.array([a << 32 | b for a, b in self.merges], dtype=np.int64)
        order = np.argsort(self.pairs)
        self.pairs, self.pair_rank = self.pairs[order], order.astype(np.int64)
        self.merged = np.array([m for _, m in self.merges.values()], dtype=np.int32)
        self.inner = [self.ids[c] for c in letters]
        self.final = [self.ids[c + self.suffix] for c in letters]
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        # Two generations: what was used since the last change, and what was used before it.
        self.cache: dict[str, list[int]] = {s: [i] for s, i in self.special.items()}
        self.older: dict[str, list[int]] = {}

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text. Special tokens are found in the text as it is."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of several texts; chunks not seen lately are merged all at once."""
        split = [self.chunks(text) for text in texts]
        unseen = {c for chunks in split for c in chunks if c not in self.cache}
        if unseen:
            self.learn(unseen)
        cache, out = self.cache, []
        for chunks in split:
            ids: list[int] = []
            for chunk in chunks:
                ids += cache[chunk]
            out.append(ids)
        if len(cache) > CACHED_CHUNKS:
            self.cache, self.older = {s: [i] for s, i in self.special.items()}, cache
        return out

    def chunks(self, text: str) -> list[str]:
        """Stretches between spaces and special tokens.

        No word holds white space, and nothing composes or cases across it,
        so each stretch stands for itself.
        """
        if any(s in text for s in self.special):
            parts = enumerate(self.specials.split(text))
            return [c for i, part in parts for c in ([part] if i % 2 else plain_chunks(part))]
        return plain_chunks(text)

    def learn(self, unseen: set[str]) -> None:
        """Put the ids of these chunks into the cache."""
        words, todo = {}, {}
        for chunk in unseen:
            ids = self.older.get(chunk)
            if ids is not None:
                self.cache[chunk] = ids
                continue
            # Case folding is by character: no special form of a final sigma.
            text = chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
            todo[chunk] = found = self.word.findall(text.lower())
            words.update(dict.fromkeys(found))
        short = [w for w in words if len(w) <= BATCHED_LENGTH // 4]
        words.update(zip(short, self.merge_many(short), strict=True))
        for word, ids in words.items():
            if ids is None:
                words[word] = merge_all(self.symbols(word), self.merges)
        for chunk, found in todo.items():
            self.cache[chunk] = words[found[0]] if len(found) == 1 else [i for w in found for i in words[w]]

    def symbols(self, word: str) -> list[int]:
        raw = word.encode("utf-8")
        symbols = [self.inner[b] for b in raw]
        symbols[-1] = self.final[raw[-1]]
        return symbols

    def merge_many(self, words: list[str]) -> list[list[int]]:
        """Merge many short words side by side: one segment tree per row."""
        out: list[list[int]] = [[]] * len(words)
        raw = [w.encode("utf-8") for w in words]
        lengths = np.array([len(r) for r in raw], dtype=np.int64)
        leaves = 2
        while leaves <= BATCHED_LENGTH and len(words):
            at = np.flatnonzero((lengths <= leaves) & (lengths > (leaves // 2 if leaves > 2 else 0)))
            for k in range(0, len(at), BATCHED_WORDS):
                part = at[k : k + BATCHED_WORDS]
                rows = merge_rows(self, [raw[i] for i in part], lengths[part], leaves)
                for i, ids in zip(part.tolist(), rows, strict=True):
                    out[i] = ids
            leaves *= 2
        return out

    def pair_ranks(self, a: np.ndarray, b: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Leaf values: rank and place of pairs that can be merged, NONE for others."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_rank[at] << PLACE | place, NONE)

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space, as the file names no decoder. Unknown ids are skipped."""
        tokens = self.tokens
        try:
            return " ".join([tokens[i] for i in ids])
        except KeyError:
            return " ".join([tokens[i] for i in ids if i in tokens])


def plain_chunks(text: str) -> list[str]:
    return [c for c in SPACE_RUN.split(text) if c] if SEPARATORS.search(text) else text.split()


def merge_rows(bpe: Bpe, raw: list[bytes], lengths: np.ndarray, leaves: int) -> list[list[int]]:
    """``merge_all`` for words of at most ``leaves`` bytes, row by row in the same arrays."""
    n = len(raw)
    symbols = np.full((n, leaves), -1, dtype=np.int32)
    inside = np.arange(leaves) < lengths[:, None]
    letters = np.frombuffer(b"".join(raw), dtype=np.uint8)
    symbols[inside] = np.array(bpe.inner, dtype=np.int32)[letters]
    rows = np.arange(n)
    symbols[rows, lengths - 1] = np.array(bpe.final, dtype=np.int32)[[r[-1] for r in raw]]

    tree = np.full((n, 2 * leaves), NONE, dtype=np.int64)
    place = np.arange(leaves - 1)
    pairs = bpe.pair_ranks(symbols[:, :-1], symbols[:, 1:], place)
    tree[:, leaves : 2 * leaves - 1] = np.where(inside[:, 1:], pairs, NONE)
    k = leaves
    while k > 1:
        tree[:, k // 2 : k] = np.minimum(tree[:, k : 2 * k : 2], tree[:, k + 1 : 2 * k : 2])
        k //= 2
    after = np.where(np.arange(1, leaves + 1) < lengths[:, None], np.arange(1, leaves + 1), leaves)
    before = np.tile(np.arange(-1, leaves - 1), (n, 1))

    while len(rows := rows[tree[rows, 1] != NONE]):
        root = tree[rows, 1]
        i = root & MASK
        j = after[rows, i]
        symbols[rows, i] = bpe.merged[root >> PLACE]
        symbols[rows, j] = -1
        k, h = after[rows, j], before[rows, i]
        after[rows, i] = k
        tree[rows, leaves + j] = NONE
        tree[rows, leaves + i] = NONE
        right, left = np.flatnonzero(k < leaves), np.flatnonzero(h >= 0)
        r, x, y = rows[right], i[right], k[right]
        before[r, y] = x
        tree[r, leaves + x] = bpe.pair_ranks(symbols[r, x], symbols[r, y], x)
        r, x, y = rows[left], h[left], i[left]
        tree[r, leaves + x] = bpe.pair_ranks(symbols[r, x], symbols[r, y], x)
        paths = [(rows, leaves + j), (rows, leaves + i), (r, leaves + x)]
        for _ in range(leaves.bit_length() - 1):
            paths = [(r, x >> 1) for r, x in paths]
            for r, x in paths:
                tree[r, x] = np.minimum(tree[r, 2 * x], tree[r, 2 * x + 1])
    left = symbols >= 0
    flat, ends = symbols[left].tolist(), np.cumsum(left.sum(axis=1)).tolist()
    return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def merge_all(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge the leftmost pair of lowest rank until no pair is in ``merges``."""
    n, rank = len(symbols), merges.get
    if n < 2:
        return symbols
    row = [NONE if f is None else f[0] | i for i, f in enumerate(map(rank, zip(symbols, symbols[1:])))]  # noqa: B905
    leaves = 1 << (n - 1).bit_length()
    row += [NONE] * (leaves - len(row))
    levels = [row]
    while len(row) > 1:
        row = [a if a < b else b for a, b in zip(row[::2], row[1::2])]  # noqa: B905
        levels.append(row)
    tree = [NONE]
    for row in reversed(levels):
        tree += row

    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while tree[1] != NONE:
        i = tree[1] & MASK
        j = after[i]
        symbols[i] = merges[symbols[i], symbols[j]][1]
        symbols[j] = -1
        k, h = after[j], before[i]
        after[i] = k
        changed = [(j, NONE)]
        found = None
        if k < n:
            before[k] = i
            found = rank((symbols[i], symbols[k]))
        changed.append((i, NONE if found is None else found[0] | i))
        if h >= 0:
            found = rank((symbols[h], symbols[i]))
            changed.append((h, NONE if found is None else found[0] | h))
        for x, value in changed:
            x += leaves
            if tree[x] != value:
                tree[x] = value
                while x > 1:
                    x >>= 1
                    a, b = tree[2 * x], tree[2 * x + 1]
                    if b < a:
                        a = b
                    if tree[x] == a:
                        break
                    tree[x] = a
    return [s for s in symbols if s >= 0]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Bpe:
    return Bpe(path)


def encoded(bpe: Bpe, column: pa.Array) -> list[list[int]]:
    """Ids of each text; a null one counts as empty."""
    return bpe.encode_all([t or "" for t in column.to_pylist()])


def encode_documents(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids`` (array<int>) to every row. A null text counts as empty: no ids.

    ``path`` names the vocabulary file on every machine. Whole texts are
    encoded; an input column called like ``ids`` is replaced.
    """
    return with_arrow(docs, text, path, {ids: "array<int>"}, lambda bpe, t: [pa.array(encoded(bpe, t), IDS)])


def decode_documents(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text``: the decoded ids of every row. Null ids count as none: empty text."""

    def made(bpe: Bpe, column: pa.Array) -> list[pa.Array]:
        return [pa.array([bpe.decode(i or []) for i in column.to_pylist()], pa.string())]

    return with_arrow(rows, ids, path, {text: "string"}, made)


def tokenize_documents(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``encode_documents`` and ``decode_documents`` in one pass: one vocabulary in memory instead of two."""

    def made(bpe: Bpe, column: pa.Array) -> list[pa.Array]:
        found = encoded(bpe, column)
        return [pa.array(found, IDS), pa.array([bpe.decode(i) for i in found], pa.string())]

    return with_arrow(docs, text, path, {ids: "array<int>", decoded: "string"}, made)


def with_arrow(rows: DataFrame, source: str, path: str, added: dict[str, str], made) -> DataFrame:
    """Add columns that ``made`` computes from ``source``; input columns so called go."""
    ready_workers(rows.sparkSession)
    kept = [c for c in rows.columns if c not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for part in slices(batch, source, TEXT_CHARS):
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), *made(bpe, part.column(source))], [*kept, *added]
                )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in kept]
    return rows.mapInArrow(run, ", ".join([*fields, *(f"`{n}` {t}" for n, t in added.items())]))


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every whole text encoded, its ids decoded.

    One pass: the ids of all documents are several times their texts, and only
    their digests are wanted here. A null text counts as empty.
    """
    ready_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        numbers = {i: str(i) for i in bpe.tokens}
        for part in (p for batch in batches for p in slices(batch, "text", TEXT_CHARS)):
            found = encoded(bpe, part.column("text"))
            first = [sha256(" ".join([numbers[i] for i in ids]).encode()).hexdigest() for ids in found]
            second = [sha256(bpe.decode(ids).encode("utf-8")).hexdigest() for ids in found]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(map(len, found), pa.int64()), *(pa.array(x, pa.string()) for x in (first, second))],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
