"""BPE encoding and decoding by tree concatenation.

A text is cut into leaves that are encoded in parallel, and the leaves'
encodings are joined pairwise, level by level. A cut at white space needs no
repair, because no token crosses it. A long run without white space is
normalised and pre-tokenised in one linear pass; a pre-token that is still
long is cut anywhere, its halves are encoded apart, and at every join a window
around the cut is encoded again, growing until its first token is the left
side's and its last token the right side's own. A sequence of BPE tokens is
the encoding of its text exactly if every two neighbours are, so from there on
both sides agree and the joined encoding is that of the whole.

Documents of one leaf are whole after the leaf step and are never shuffled;
longer ones are spread over tasks by leaf. Inside a leaf every distinct word
of a batch is encoded once.
"""
from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verity.llm.common import Staging, bound_arrow_batches, releasing, text_of

LEAF = 32_768  # characters of a leaf
PIECE = 2_048  # characters of a piece of a long pre-token
# Words that are one pre-token of letters, each of which stays a
# letter when folded, and perhaps one of stops.
PLAIN_WORD = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+[.,;:!?]*$"
STOPS = r"[.,;:!?]$"
WINDOW = 4  # tokens on each side of the first window


class Vocabulary:
    """One tokenizer file: its tokens, its encoder, and its merges with and
    without the word-end suffix."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = [self.tokenizer.id_to_token(i) for i in range(size)]
        self.token_array = pa.array(self.tokens, pa.string())

        self.ends = np.array([t.endswith(self.suffix) for t in self.tokens]) if self.suffix else None

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of tokens of each word, and all their ids in order.

        Words whose pre-tokens are known beforehand (letters, then perhaps
        stops) are encoded many to a text: each pre-token ends in a token with
        the word-end suffix, which tells the words apart again. The others are
        encoded one by one.
        """
        n = len(words)
        plain = pc.match_substring_regex(words, PLAIN_WORD).to_numpy(zero_copy_only=False) \
            if self.ends is not None and n else np.zeros(n, bool)
        pre = 1 + pc.match_substring_regex(words, STOPS).to_numpy(zero_copy_only=False).astype(np.int64) if n \
            else np.zeros(0, np.int64)
        lengths, ids = np.zeros(n, np.int64), np.zeros(0, np.int32)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        easy = words.filter(pa.array(plain)).to_pylist()
        texts = [" ".join(easy[i:i + 1000]) for i in range(0, len(easy), 1000)]
        flat = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate([ids, *flat])
        last = np.flatnonzero(self.ends[flat])[np.cumsum(pre[plain]) - 1] if easy else np.zeros(0, np.int64)
        lengths[plain] = np.diff(np.concatenate([[-1], last]))
        rest = [e.ids for e in self.tokenizer.encode_batch_fast(
            words.filter(pa.array(~plain)).to_pylist(), add_special_tokens=False)]
        lengths[~plain] = [len(x) for x in rest]
        flat = np.concatenate([flat, np.array([i for x in rest for i in x], np.int32)])
        # From "plain ones first" to the order of the words.
        starts = np.zeros(n, np.int64)
        starts[order] = np.concatenate([[0], np.cumsum(lengths[order])])[:-1]
        shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
        return lengths, flat[np.arange(int(lengths.sum())) + shift]

    def parts(self, run: str) -> list[tuple[str | None, int | None]]:
        """A run without ASCII white space as its pre-tokens, in order: (the
        pre-token's characters, null) or (null, an added token's id)."""
        out: list[tuple[str | None, int | None]] = []
        while run:
            cut = min(((run.find(a), -len(a), a) for a in self.added if a in run), default=None)
            plain = run if cut is None else run[:cut[0]]
            if plain:
                plain = self.tokenizer.normalizer.normalize_str(plain) if self.tokenizer.normalizer else plain
                out += [(t, None) for t, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)]
            if cut is None:
                break
            out.append((None, self.added[cut[2]]))
            run = run[cut[0] + len(cut[2]):]
        return out

    @cached_property
    def merges(self):
        """The merges for the inside and for the end of a pre-token; only long
        ones need them."""
        from tokenizers import models
        with open(self.path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        return (models.BPE(vocab=model["vocab"], merges=merges),
                models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=self.suffix or None))

    def merge(self, chars: str, last: bool) -> list[int]:
        """The tokens of one pre-token, or of a piece from its inside."""
        return [t.id for t in self.merges[last].tokenize(chars)]

    def join(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """The encoding of two neighbouring pieces of one pre-token from
        theirs; ``last``: the right one ends the pre-token."""
        if not left or not right:
            return left + right
        w = WINDOW
        while True:
            a, b = left[-w:], right[:w]
            whole_a, whole_b = w >= len(left), w >= len(right)
            end = last and whole_b
            text = "".join(self.tokens[i] for i in a + b)
            again = self.merge(text.removesuffix(self.suffix) if end else text, end)
            if (whole_a or again[0] == a[0]) and (whole_b or again[-1] == b[-1]):
                return left[:-w] + again + right[w:]
            w *= 2


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_texts(v: Vocabulary, texts: pa.Array) -> pa.ListArray:
    """Token ids of non-null texts. White space divides pre-tokens, so a text
    is the concatenation of its words' encodings."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    rows, words = pc.list_parent_indices(lists).to_numpy(), lists.flatten()
    coded = words.dictionary_encode()
    lengths, flat = v.encode_words(coded.dictionary)
    ids = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(lengths)]), pa.array(flat))
    at = coded.indices.to_numpy()
    per_row = np.bincount(rows, weights=lengths[at] if len(at) else None, minlength=len(texts)).astype(np.int64) \
        if len(at) else np.zeros(len(texts), np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_row)]), pa.int32()),
                                    ids.take(coded.indices).flatten())


def decode_ids(v: Vocabulary, ids: pa.ListArray) -> pa.Array:
    """The texts of token lists, special tokens included: without a decoder of
    its own the tokenizer joins its tokens by spaces."""
    if v.tokenizer.decoder is not None:
        return pa.array([v.tokenizer.decode(x, skip_special_tokens=False) for x in ids.to_pylist()], pa.string())
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, v.token_array.take(ids.values)), " ")


def digest_columns(v: Vocabulary, ids: pa.ListArray) -> list[pa.Array]:
    sha = lambda column: pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in column])
    numbers = pa.array([str(i) for i in range(len(v.tokens))])
    return [pc.list_value_length(ids).cast(pa.int64()),
            sha(pc.binary_join(pa.ListArray.from_arrays(ids.offsets, numbers.take(ids.values)), " ")),
            sha(decode_ids(v, ids))]


DIGESTS = ["n_tokens", "ids_sha256", "decoded_sha256"]


def _token_rows(v: Vocabulary, doc_ids: pa.Array, ids: pa.ListArray, digest: bool, keep_ids: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [doc_ids, *([ids] if keep_ids else []), *(digest_columns(v, ids) if digest else [])],
        names=["doc_id", *(["ids"] if keep_ids else []), *(DIGESTS if digest else [])])


def _leaf_mapper(path: str, digest: bool, keep_ids: bool):
    """doc_id and text to doc_id and ids, their digests, or both."""
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            ids = encode_texts(v, pc.fill_null(batch.column(batch.num_columns - 1), ""))
            yield _token_rows(v, batch.column(0), ids, digest, keep_ids)
    return run


def _token_mapper(path: str, digest: bool, keep_ids: bool):
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            yield _token_rows(v, batch.column(0), pa.concat_arrays([batch.column(1)]), digest, keep_ids)
    return run


LEAVES = "doc_id long, uid long, copies long, seq long, part long, piece long, pieces long, chars string, id int"


def cut_leaves(text: str, leaf: int) -> list[tuple[bool, str]]:
    """(long run?, characters) in order: stretches of about ``leaf``
    characters that end before white space, and runs without any that are
    longer than that."""
    out, start = [], 0
    while start < len(text):
        end = min(start + leaf, len(text))
        if end < len(text):
            while end > start and text[end] not in " \t\n\v\f\r":
                end -= 1
            if end == start:  # one run fills the leaf
                end = start + leaf
                while end < len(text) and text[end] not in " \t\n\v\f\r":
                    end += 1
                out.append((True, text[start:end]))
                start = end
                continue
        out.append((False, text[start:end]))
        start = end
        while start < len(text) and text[start] in " \t\n\v\f\r":
            start += 1
    return out


def _leaf_rows(path: str, leaf: int, piece: int):
    """doc_id, uid, copies, text to one row a leaf: a stretch of text (part
    null), an added token, or a piece of a pre-token."""
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for doc_id, uid, copies, text in zip(*(c.to_pylist() for c in batch.columns)):
                rows = []
                for seq, (long, chars) in enumerate(cut_leaves(text, leaf)):
                    if not long:
                        rows.append((doc_id, uid, copies, seq, None, 0, 1, chars, None))
                        continue
                    # The leading characters may be white space of the cut.
                    for part, (token, added) in enumerate(v.parts(chars.strip(" \t\n\v\f\r"))):
                        if token is None:
                            rows.append((doc_id, uid, copies, seq, part, 0, 1, None, added))
                            continue
                        n = max(1, -(-len(token) // piece))
                        rows += [(doc_id, uid, copies, seq, part, k, n, token[k * piece:(k + 1) * piece], None)
                                 for k in range(n)]
                columns = list(zip(*rows)) or [[]] * 9
                kinds = [pa.int64()] * 7 + [pa.string(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "uid", "copies", "seq", "part", "piece", "pieces", "chars", "id"])
    return run


KEY = ["doc_id", "uid", "copies", "seq", "part"]
PIECES = "doc_id long, uid long, copies long, seq long, part long, piece long, pieces long, ids array<int>"


def _encode_leaves(path: str):
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            part, piece, pieces, chars, added = (batch.column(i).to_pylist() for i in range(4, 9))
            plain = encode_texts(v, pa.array([c if p is None else "" for c, p in zip(chars, part)], pa.string()))
            ids = [plain[i].as_py() if p is None else [a] if a is not None else v.merge(c, k == n - 1)
                   for i, (p, k, n, c, a) in enumerate(zip(part, piece, pieces, chars, added))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(ids, pa.list_(pa.int32()))],
                                             names=[*batch.schema.names[:7], "ids"])
    return run


def _join_pairs(path: str):
    """Key, piece, pieces and one or two neighbours' ids to the joined ids."""
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            piece, pieces, halves = (batch.column(i).to_pylist() for i in (5, 6, 7))
            ids = [h[0] if len(h) == 1 else v.join(h[0], h[1], k == n - 1) for k, n, h in zip(piece, pieces, halves)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(ids, pa.list_(pa.int32()))],
                                             names=[*batch.schema.names[:7], "ids"])
    return run


def encode_long(docs: DataFrame, path: str, staging: Staging, leaf: int = LEAF, piece: int = PIECE) -> DataFrame:
    """``doc_id, ids`` of documents cut into leaves. Equal rows are encoded
    once and returned as often as they occur."""
    rows = (docs.groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
            .select("doc_id", F.xxhash64("text").alias("uid"), "copies", "text"))
    leaves = rows.mapInArrow(_leaf_rows(path, leaf, piece), LEAVES).repartition("doc_id", "uid", "seq", "part", "piece")
    level = staging.write(leaves.mapInArrow(_encode_leaves(path), PIECES), "level-0")
    most = level.agg(F.max("pieces")).first()[0] or 1
    n = 0
    while most > 1:  # neighbours 2k and 2k + 1 become piece k of the next level
        pairs = (level.withColumn("half", F.col("piece")).withColumn("piece", F.floor(F.col("piece") / 2))
                 .withColumn("pieces", F.floor((F.col("pieces") + 1) / 2))
                 .groupBy(*KEY, "piece", "pieces").agg(F.sort_array(F.collect_list(F.struct("half", "ids"))).alias("h"))
                 .withColumn("h", F.col("h")["ids"]))
        n += 1
        level = staging.write(pairs.mapInArrow(_join_pairs(path), PIECES), f"level-{n}")
        staging.drop(f"level-{n - 1}")
        most = -(-most // 2)
    whole = (level.groupBy("doc_id", "uid", "copies")
             .agg(F.sort_array(F.collect_list(F.struct("seq", "part", "ids"))).alias("all"))
             .withColumn("ids", F.flatten(F.col("all")["ids"])))
    return whole.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc_id", "ids")


def _rows(docs: DataFrame) -> DataFrame:
    bound_arrow_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), text_of("text").cast("string").alias("text"))


def _encoded(docs: DataFrame, path: str, leaf: int, digest: bool, keep_ids: bool) -> DataFrame:
    rows = _rows(docs)
    schema = "doc_id long" + ", ids array<int>" * keep_ids \
        + ", n_tokens long, ids_sha256 string, decoded_sha256 string" * digest
    short = rows.filter(F.length("text") <= leaf).mapInArrow(_leaf_mapper(path, digest, keep_ids), schema)
    long = encode_long(rows.filter(F.length("text") > leaf), path, Staging(docs.sparkSession, "bpe"), leaf)
    return short.unionAll(long.mapInArrow(_token_mapper(path, digest, keep_ids), schema) if digest else long)


def encode(docs: DataFrame, path: str, leaf: int = LEAF) -> DataFrame:
    """``doc_id, ids`` of every document, as the tokenizer file encodes the
    whole text without added special tokens, truncation or padding.

    A null text is empty, an empty one has no tokens. Special tokens spelt out
    in a text are encoded as such, as the file's tokenizer does. Repeated rows
    give one row each; other columns are not read.
    """
    return _encoded(docs, path, leaf, False, True)


def _decode_mapper(path: str):
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), decode_ids(v, pa.concat_arrays([batch.column(1)]))], names=["doc_id", "text"])
    return run


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``; special tokens are kept. A null
    list decodes to the empty text."""
    bound_arrow_batches(tokens.sparkSession)
    rows = tokens.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(_decode_mapper(path), "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, leaf: int = LEAF, keep_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``): digests
    of ``encode`` and of ``decode`` after it. Encoding, decoding and digests
    of a one-leaf document share one pass."""
    return _encoded(docs, path, leaf, True, keep_ids)
