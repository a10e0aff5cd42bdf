"""Encoding with a public byte-level BPE vocabulary.

Words are merged on a contiguous rank array: the boundaries of the parts and the rank of each neighbouring pair stand side by side; the smallest rank is
looked for again and again, its boundary deleted and the ranks beside it refreshed. Words of more than 64 bytes, for which
repeated scans would be slow, use a heap over linked parts; both give the same ids. Every worker keeps the ids of words it has met.

Cases: null and empty texts have an empty list; strings that look like special tokens are ordinary text; texts of any length are encoded whole;
a text that isn't valid Unicode (lone surrogates) is read with replacement characters, as in UTF-8 output.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the byte-level vocabularies cut text into words.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
SHORT = 64
#: Words a worker remembers before it forgets all and begins anew; memory only, the ids don't depend on it.
REMEMBERED = 400_000
_NO_RANK = 1 << 60


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return parse_ranks(f.read())


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


def encode_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(word)
    starts = list(range(n + 1))
    get = ranks.get
    pair = [get(word[i : i + 2], _NO_RANK) for i in range(n - 1)]
    while pair:
        low = min(pair)
        if low == _NO_RANK:
            break
        i = pair.index(low)
        del starts[i + 1]
        del pair[i]
        if i < len(pair):
            pair[i] = get(word[starts[i] : starts[i + 2]], _NO_RANK)
        if i:
            pair[i - 1] = get(word[starts[i - 1] : starts[i + 1]], _NO_RANK)
    return [ranks[word[a:b]] for a, b in zip(starts, starts[1:], strict=False)]


def encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(word)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        r, i, e = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or end[j] != e or ranks.get(word[i:e]) != r:
            continue
        alive[j] = False
        end[i], after[i] = e, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (q := ranks.get(word[i : end[after[i]]])) is not None:
                heapq.heappush(heap, (q, i, end[after[i]]))
        if (b := before[i]) >= 0 and (q := ranks.get(word[b:e])) is not None:
            heapq.heappush(heap, (q, b, e))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = after[i]
    return out


def encoder(ranks: dict[bytes, int], pattern: str = PATTERN) -> Callable[[str | None], list[int]]:
    find = regex.compile(pattern).findall
    known: dict[str, list[int]] = {}

    def word_ids(w: str) -> list[int]:
        b = w.encode("utf-8", "replace")
        whole = ranks.get(b)
        return [whole] if whole is not None else encode_short(b, ranks) if len(b) <= SHORT else encode_long(b, ranks)

    def encode(text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        extend = out.extend
        for w in find(text):
            ids = known.get(w)
            if ids is None:
                ids = word_ids(w)
                if len(w) <= SHORT:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[w] = ids
            extend(ids)
        return out

    return encode


def _mapped(df: DataFrame, text: str, keep: list[str], path: str, count_only: bool, pattern: str) -> DataFrame:
    with open(path, "rb") as f:
        vocabulary = f.read()
    # under 1 MB for 50,000 words: the size is that of the vocabulary, not of the data
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(parse_ranks(shared.value), pattern)
        for b in batches:
            for part in (b.slice(i, 256) for i in range(0, b.num_rows, 256)):
                ids = [encode(t) for t in part.column(part.num_columns - 1).to_pylist()]
                out = pa.array([len(x) for x in ids], pa.int64()) if count_only else pa.array(ids, pa.list_(pa.int32()))
                yield pa.record_batch([*part.columns[:-1], out], names=[*keep, "n_tokens" if count_only else "ids"])

    chosen = df.select(*keep, text)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]])
    return chosen.mapInArrow(run, schema + (", n_tokens bigint" if count_only else ", ids array<int>"))


def encode_texts(df: DataFrame, text: str, keep: list[str], path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """`keep` and ids (array of int) of every row."""
    return _mapped(df, text, keep, path, False, pattern)


def count_tokens(df: DataFrame, text: str, keep: list[str], path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """`keep` and n_tokens of every row."""
    return _mapped(df, text, keep, path, True, pattern)
