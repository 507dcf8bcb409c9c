"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a pre-token (its UTF-8 bytes) form a linked list. A heap holds
every adjacent pair that merges, by rank and place; the least is popped and
merged again and again, and the pairs the merge makes are pushed. The count is
the number of symbols minus the number of merges: no token ids are emitted.
A pre-token of n bytes takes O(n log n) steps, so one long run of letters is
no burden.

Every text is one row of one task and needs nothing of the others: no shuffle.
A task remembers the counts of the pre-tokens it met, within a bound in bytes;
the bound costs time alone, never a count.
"""
from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verity.llm.common import bound_arrow_batches

LIMIT = 512  # tokens of a context window
REMEMBERED = 64 << 20  # bytes of pre-tokens whose counts a task remembers
LONG_WORD = 256  # longer pre-tokens are not remembered
LONG_TEXT = 1 << 20  # longer texts are walked match by match

# The pre-token pattern of byte-level BPE, in general and as it
# reads on ASCII text.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_PRETOKEN = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
NON_ASCII = re.compile(r"[^\x00-\x7F]")


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    itself if it is a printable Latin-1 character, else the next one from
    code point 256 on."""
    out, spare = [], 256
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class Merges:
    """The merge table of a byte-level BPE file."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") or model.get("continuing_subword_prefix") \
                or model.get("ignore_merges") or spec.get("normalizer"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        number = model["vocab"]
        self.of_byte = [number[c] for c in byte_symbols()]
        self.width = max(number.values()) + 1
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.rank[number[left] * self.width + number[right]] = rank
            self.made.append(number[left + right])

    def count(self, word: bytes) -> int:
        n = len(word)
        if n < 2:
            return n
        rank, made, width = self.rank.get, self.made, self.width
        of_byte = self.of_byte
        # Lists are fast, arrays small: only a long word's size matters.
        numbers = list if n <= LONG_WORD else partial(array, "l")
        symbol = numbers([of_byte[b] for b in word])
        after, before = numbers(range(1, n + 1)), numbers(range(-1, n - 1))
        # A heap entry is rank * n + place: least rank first, then leftmost.
        heap = [r * n + i for i in range(n - 1)
                if (r := rank(symbol[i] * width + symbol[i + 1])) is not None]
        heapify(heap)
        merged = 0
        while heap:
            r, i = divmod(heappop(heap), n)
            j = after[i]
            # An entry is stale if its place holds another pair by now.
            if symbol[i] < 0 or j == n or rank(symbol[i] * width + symbol[j]) != r:
                continue
            symbol[i], symbol[j] = new, _ = made[r], -1
            k = after[i] = after[j]
            merged += 1
            if k < n:
                before[k] = i
                if (r := rank(new * width + symbol[k])) is not None:
                    heappush(heap, r * n + i)
            h = before[i]
            if h >= 0 and (r := rank(symbol[h] * width + new)) is not None:
                heappush(heap, r * n + h)
        return n - merged


class Remembered(dict):
    """Counts of pre-tokens, computed on first sight."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges, self.room = merges, REMEMBERED

    def __missing__(self, word: str) -> int:
        n = self.merges.count(word.encode())
        if len(word) <= LONG_WORD:
            self.room -= 100 + len(word)
            if self.room < 0:
                self.clear()
                self.room = REMEMBERED
            self[word] = n
        return n


class Counter:
    """Counts the tokens of texts as the tokenizer file's library does, without
    begin, end or added special tokens; the strings of special tokens inside a
    text are one token each."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        step = spec.get("pre_tokenizer") or {}
        if step.get("type") != "ByteLevel" or step.get("add_prefix_space") or not step.get("use_regex", True):
            raise ValueError(f"{path}: another pre-tokenizer than plain ByteLevel")
        added = spec.get("added_tokens", [])
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"{path}: added tokens that take in their surroundings")
        contents = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, contents))) if contents else None
        self.counts = Remembered(Merges(spec))
        self.pattern = regex.compile(PRETOKEN)
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.alike: dict[str, str] = {}  # non-ASCII character -> one that the pattern classes as the library does it

    def stand_in(self, char: str) -> str:
        """The library and the pattern may know different Unicode versions:
        a letter, number or other sign the two class apart is read as one of the
        library's class, and white space as a tab."""
        found = self.alike.get(char)
        if found is None:
            kind, other = next(((k, o) for k, o in (("a", "é"), ("1", "²"), ("!", "¡"))
                                if len(self.cut(k + char)) == 1), (" ", "\t"))
            found = self.alike[char] = char if len(self.pattern.findall(kind + char)) == 1 else other
        return found

    def plain(self, text: str) -> int:
        """Tokens of a text without special tokens."""
        if text.isascii():
            pattern, odd = ASCII_PRETOKEN, False
        else:
            pattern = self.pattern
            odd = any(self.stand_in(c) != c for c in set(NON_ASCII.findall(text)))
        if odd:
            read = NON_ASCII.sub(lambda m: self.stand_in(m[0]), text)
            return sum(self.counts[text[m.start():m.end()]] for m in pattern.finditer(read))
        if len(text) > LONG_TEXT:
            return sum(self.counts[m.group()] for m in pattern.finditer(text))
        return sum(map(self.counts.__getitem__, pattern.findall(text)))

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        n, start = 0, 0
        for m in self.special.finditer(text):
            n += self.plain(text[start:m.start()]) + 1
            start = m.end()
        return n + self.plain(text[start:])


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs``: its id, ``n_bytes`` (UTF-8), ``n_tokens`` under the
    byte-level BPE file at ``path`` and ``over_limit`` (more than ``limit``).

    A null text counts as empty: 0 bytes, 0 tokens. Rows with a null or
    repeated id, and equal rows, each give a row of their own. Texts are
    counted whole at any length. An empty table gives no rows. Other columns
    are not read, whatever their names.
    """
    bound_arrow_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            tokens = pa.array([count(t.as_py()) for t in texts], pa.int64())
            yield pa.record_batch([batch.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), tokens,
                                   pc.greater(tokens, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    id_type = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
