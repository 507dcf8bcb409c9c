"""Fill-in-the-middle transformation as a pyarrow.compute pipeline.

Per Arrow batch: every text is split into a list of units, the lists are
flattened with the index of their parent, each unit's ordinal in its parent
decides its role (prefix, middle, suffix), the flat units are filtered by role,
rebuilt into lists, and joined into the pieces of the output. The cuts come
from a hash of the id, which Spark computes beforehand, so a rerun cuts alike
and no row depends on another: no shuffle.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verity.llm.common import bound_arrow_batches, text_of

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
# On bytes: letters, one other ASCII character, or one longer code point.
UNIT = rb"([A-Za-z]+|[\x00-\x40\x5B-\x60\x7B-\x7F]|[\xC0-\xFF][\x80-\xBF]*)"
MARK = b"\xff"  # never part of UTF-8 text
REARRANGED = 90  # percent of the documents that are cut
SUFFIX_FIRST = 20  # percent of these whose suffix goes first


def _modulo(x: pa.Array, m) -> pa.Array:
    return pc.subtract(x, pc.multiply(pc.divide(x, m), m))


def _starts(lengths: pa.Array) -> pa.Array:
    """Offsets of lists of the given lengths: one more than lists."""
    return pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(lengths)])


def _join(*pieces) -> pa.Array:
    return pc.binary_join_element_wise(*[pa.scalar(p, pa.large_binary()) if isinstance(p, bytes) else p
                                         for p in (*pieces, b"")])


def _chars(piece: pa.Array) -> pa.Array:
    return pc.utf8_length(piece.cast(pa.large_string())).cast(pa.int64())


def _has(text: pa.Array, *words: bytes) -> pa.Array:
    found = pc.match_substring(text, words[0])
    for word in words[1:]:
        found = pc.or_(found, pc.match_substring(text, word))
    return found


def rearrange(text: pa.Array, h: list[pa.Array], rearranged: int, suffix_first: int) -> dict[str, pa.Array]:
    """The columns of ``fill_in_middle`` for non-null texts as large binary;
    ``h`` holds the four numbers of each row."""
    units = pc.split_pattern(pc.replace_substring_regex(text, UNIT, rb"\1" + MARK), MARK)
    n = pc.subtract(pc.list_value_length(units).cast(pa.int64()), 1)  # less the empty rest after the last mark
    cut_1, cut_2 = (_modulo(x, pc.add(n, 1)) for x in h[:2])
    low, high = pc.min_element_wise(cut_1, cut_2), pc.max_element_wise(cut_1, cut_2)

    flat, parent = pc.list_flatten(units), pc.list_parent_indices(units)
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(_starts(pc.add(n, 1)), parent))
    in_prefix = pc.less(ordinal, pc.take(low, parent))
    before_suffix = pc.less(ordinal, pc.take(high, parent))
    is_unit = pc.less(ordinal, pc.take(n, parent))

    def piece(role: pa.Array, lengths: pa.Array) -> pa.Array:
        lists = pa.LargeListArray.from_arrays(_starts(lengths), flat.filter(role))
        return pc.binary_join(lists, pa.scalar(b"", pa.large_binary()))

    prefix = piece(in_prefix, low)
    middle = piece(pc.and_not(before_suffix, in_prefix), pc.subtract(high, low))
    suffix = piece(pc.and_not(is_unit, before_suffix), pc.subtract(n, high))

    plain = pc.or_(pc.or_(pc.equal(n, 0), _has(text, PREFIX, SUFFIX, MIDDLE)),
                   pc.greater_equal(_modulo(h[2], 100), rearranged))
    spm = pc.less(_modulo(h[3], 100), suffix_first)
    output = pc.if_else(plain, text, pc.if_else(
        spm, _join(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle),
        _join(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)))
    none = pa.scalar(None, pa.int64())
    return {"n": n, "form": pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
            "prefix_chars": pc.if_else(plain, none, _chars(prefix)),
            "middle_chars": pc.if_else(plain, none, _chars(middle)), "output": output}


def rebuild(output: pa.Array, form: pa.Array) -> pa.Array:
    """The text behind each output (large binary). A cut text held none of the
    three marks, so each mark occurs once in its output, where it was put."""
    def halves(x: pa.Array, mark: bytes) -> tuple[pa.Array, pa.Array]:
        both = pc.split_pattern(x, mark, max_splits=1)
        return pc.list_element(both, 0), pc.list_element(both, 1)

    plain, spm = pc.equal(form, "plain"), pc.equal(form, "spm")
    cut = pc.if_else(plain, pa.scalar(PREFIX + SUFFIX + MIDDLE, pa.large_binary()), output)
    # Read alike: mark, first piece, mark, second piece, mark, middle.
    rest = halves(pc.replace_substring(cut, PREFIX, SUFFIX), SUFFIX)[1]
    first, rest = halves(rest, SUFFIX)
    second, middle = halves(rest, MIDDLE)
    return pc.if_else(plain, output, pc.if_else(spm, _join(second, middle, first), _join(first, middle, second)))


SLICE = 4 << 20  # bytes of text per pass, a longer text alone


def _slices(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most SLICE bytes, a longer row alone."""
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if i > start and held + n > SLICE:
            yield start, i - start
            start, held = i, 0
        held += n
    if len(lengths) > start:
        yield start, len(lengths) - start


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1",
                   rearranged: int = REARRANGED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Per row of ``docs``: its id, ``n`` (units of the text), ``form``
    (plain, psm or spm), ``prefix_chars`` and ``middle_chars`` (code points;
    null if plain) and ``output`` (the text of that form).

    Both cuts, whether to cut at all (``rearranged`` percent) and which piece
    goes first (``suffix_first`` percent of these) follow from the sha256 of
    ``<seed>:<id>``; rows with equal ids and texts come out equal, and a null
    id hashes as no digits. A null or empty text, and one that holds a mark,
    stays plain. Texts are cut whole at any length. An empty table gives no
    rows. Other columns are not read, whatever their names.
    """
    bound_arrow_batches(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    picked = docs.select(
        F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"),
        *[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, rows in _slices(pc.binary_length(batch.column("text")).to_numpy()):
                part = batch.slice(start, rows)
                out = rearrange(part.column("text").cast(pa.large_binary()),
                                [part.column(f"h{i}") for i in range(1, 5)], rearranged, suffix_first)
                out["output"] = out["output"].cast(pa.large_string()).cast(pa.string())
                yield pa.record_batch([part.column("doc_id"), *out.values()], ["doc_id", *out])

    id_type = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, "
                                  "output string")


def restored(cut: DataFrame) -> DataFrame:
    """``cut`` (rows of ``fill_in_middle``, or any with ``form`` and
    ``output``, neither null) with ``restored``: the text each output was made
    from. A column of that name is replaced."""
    bound_arrow_batches(cut.sparkSession)
    cut = cut.drop("restored")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = rebuild(batch.column("output").cast(pa.large_binary()), batch.column("form"))
            yield batch.append_column("restored", text.cast(pa.large_string()).cast(pa.string()))

    return cut.mapInArrow(run, T.StructType([*cut.schema.fields, T.StructField("restored", T.StringType())]))
