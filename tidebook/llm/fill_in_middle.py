"""Fill-in-the-middle transformation: texts cut at lines into prefix, middle and suffix, and written in another order.

Each batch goes through one chain of Arrow compute calls: texts are split into lists of lines, the lists are
flattened with the row each line came from, ordinals say which piece a line belongs to, each piece's lines are
filtered and made lists again, and the pieces are joined.  No row is looked at by itself in Python.

A unit is a line with its newline, or what follows the last one.  Cuts and form come from a digest of the seed and the doc_id, so
any executor draws the same ones, in any order.  Sentinels are found again without doubt: a text that holds one stays plain, and
no sentinel can begin in a piece and end in the next one, as ``<`` is nothing but a sentinel's first character.

Null text counts as empty; an empty text stays plain, with no units.  A null doc_id is drawn as if its number were empty.  Rows with one doc_id
draw alike, and rows are never merged.  A very long text is a group of its own.  An empty table gives no rows.  Columns that are not
named in ``carry`` are not read, so none can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, small_batches, whole_text
from .hashing import groups

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def _joined(*parts: pa.Array | str) -> pa.Array:
    return pc.binary_join_element_wise(*parts, "")


def lines_of(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All units of all rows, the row of each, and its ordinal there."""
    lists = pc.split_pattern(text, "\n")
    flat, row = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    size = pc.list_value_length(lists).to_numpy().astype(np.int64)
    ordinal = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    last = pa.array(ordinal == size[row] - 1)
    unit = _joined(flat, pc.if_else(last, "", "\n"))
    some = pc.greater(pc.binary_length(unit), 0)
    use = some.to_numpy(zero_copy_only=False)
    return unit.filter(some), row[use], ordinal[use]


def _piece(unit: pa.Array, mine: np.ndarray, count: np.ndarray) -> pa.Array:
    """The chosen units of each row as one string."""
    offsets = np.append(0, np.cumsum(count)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), unit.filter(pa.array(mine))), "")


def rearranged(text: pa.Array, draws: list[np.ndarray], rate: int, spm: int) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars, output of each row."""
    unit, row, ordinal = lines_of(text)
    n = np.bincount(row, minlength=len(text)).astype(np.int64)
    one, two = draws[0] % (n + 1), draws[1] % (n + 1)
    low, high = np.minimum(one, two), np.maximum(one, two)
    prefix = _piece(unit, ordinal < low[row], low)
    middle = _piece(unit, (ordinal >= low[row]) & (ordinal < high[row]), high - low)
    suffix = _piece(unit, ordinal >= high[row], n - high)
    taken = pc.equal(pc.binary_length(text), 0)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        taken = pc.or_(taken, pc.match_substring(text, mark))
    plain = pc.or_(taken, pa.array(draws[2] % 100 >= rate))
    first = pa.array(draws[3] % 100 < spm)
    form = pc.if_else(plain, "plain", pc.if_else(first, "spm", "psm"))
    moved = pc.if_else(first, _joined(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle), _joined(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    none = pa.scalar(None, pa.int64())
    chars = [pc.if_else(plain, none, pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle)]
    return [pa.array(n), form, *chars, pc.if_else(plain, text, moved)]


def put_back(output: pa.Array, form: pa.Array) -> pa.Array:
    """The texts that rearranged() was given."""

    def between(a: str, b: str | None, which: pa.Array) -> pa.Array:
        """What lies between two sentinels that each of the strings has once."""
        tail = pc.list_element(pc.split_pattern(which, a, max_splits=1), 1)
        return tail if b is None else pc.list_element(pc.split_pattern(tail, b, max_splits=1), 0)

    back = output
    for name, order in (("psm", (PREFIX, SUFFIX, MIDDLE)), ("spm", (SUFFIX, PREFIX, MIDDLE))):
        mask = pc.equal(form, name)
        own = output.filter(mask)
        if len(own):
            piece = {a: between(a, b, own) for a, b in zip(order, (*order[1:], None), strict=True)}
            back = pc.replace_with_mask(back, mask, _joined(piece[PREFIX], piece[MIDDLE], piece[SUFFIX]))
    return back


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output, then the carried columns in one struct ``given``, a row for each row.

    rate: per cent of texts that are rearranged; spm: per cent of those that put the suffix first.
    """
    small_batches(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    given = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("int")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"), *draws, given.alias("given"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in groups(batch, 1):
                h = [part.column(k).to_numpy() for k in range(2, 6)]
                yield pa.RecordBatch.from_arrays([part.column(0), *rearranged(part.column(1), h, rate, spm), part.column(6)], names=names)

    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "given"]
    kind = rows.schema["given"].dataType.simpleString()
    out = rows.mapInArrow(lean(task), f"doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, given {kind}")
    return out if carry else out.drop("given")


def restored(moved: DataFrame) -> DataFrame:
    """A frame with the columns form and output, with the texts they stand for in a last column ``restored``."""
    moved = moved.drop("restored")
    at = {c: k for k, c in enumerate(moved.columns)}
    schema = moved.withColumn("restored", F.col("output")).schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in groups(batch, at["output"]):
                yield pa.RecordBatch.from_arrays([*part.columns, put_back(part.column(at["output"]), part.column(at["form"]))], names=schema.names)

    return moved.mapInArrow(lean(task), schema)
