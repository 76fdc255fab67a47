"""Best-fit packing of tokenised documents into sequences.

A document's token ids and one end id form one piece, or, where they exceed a sequence, pieces of full
length of which the first may be shorter.  Pieces are packed best-fit, longest first, in bulk-synchronous rounds over bands of
lengths, from the longest (``BANDS``):

* Range-sort: the band's pieces and the gaps of open sequences are range-partitioned together by descending size.  A gap that
  holds several pieces of the band's greatest length stands there as often, a row each, and once more with what is left beyond them.
* Successor sweep: in that order a piece wants the gap that came last and is free, which is the least gap that it fits into.
  Gaps open and pieces close brackets, so each task matches its own range by depths; what it leaves, open gaps and pieces
  without one, has a place in the depth over all ranges, known from one pair of counts a range.
* Conflicts by rank: pieces of different ranges that want the same gap get different depths by their rank, and meet the gap of
  their depth in a window over depths.
* Gaps are updated, and the round repeats until next to no piece of the band finds one (``FEW``).  The rest opens new sequences by
  the ranks that the last sweep gave, as many pieces together as always fit, and the next band follows.

Every round's tables lie in the shared folder.  Ranges grow in number with the brackets (``RANGE_ROWS``), and the driver holds one
triple of counts for each.  Rounds move sizes and numbers of pieces, never texts or ids.

Token ids are those of the tokenizers library's plain call: the string of an added token (``<|endoftext|>``) in a text is that
token's one id.

Null or empty text is one piece that holds the end id.  Ties go by number.  Repeated rows are packed one by one, and rows keep a
null doc_id.  A very long text is cut into pieces like any other.  An empty table gives no rows.  Further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, lean, shuffle_partitions, whole_text
from .hashing import groups
from .tokens import encoder

SEQUENCE = 1024
END_ID = 2
#: Bands of lengths end at the sequence's length over these.
BANDS = (1, 2, 3, 4, 6, 8, 16, 64)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# --- tokens ---------------------------------------------------------------------------------------


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all full but maybe the first."""
    first = n % most or most
    return [(0, min(first, n)), *((a, most) for a in range(first, n, most))]


def _pieces(tokenizer: Callable[[], str], sequence: int, end_id: int, keep_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer())
        for batch in batches:
            for part in groups(batch, 1):
                ids, counts = enc.encode(part.column(1).to_pylist())
                rows: list[tuple] = []
                at = 0
                for doc, n in zip(part.column(0).to_pylist(), counts.tolist(), strict=True):
                    own = np.append(ids[at : at + n], np.uint32(end_id)).astype("<u4")
                    at += n
                    for k, (a, length) in enumerate(cut(n + 1, sequence)):
                        rows.append((doc, k, a, length, zlib.crc32(own[a : a + length].tobytes()), *([own[a : a + length]] if keep_ids else [])))
                cols = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * keep_ids
                if keep_ids:
                    cols[5] = [x.astype(np.int32) for x in cols[5]]
                names = [x.split()[0] for x in PIECES.split(", ")] + ["ids"] * keep_ids
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return lean(run)


def tokenise(docs: DataFrame, tokenizer: Callable[[], str], sequence: int = SEQUENCE, end_id: int = END_ID, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs -> pieces: doc_id, piece, start, length, ids_crc32 and, with keep_ids, ids."""
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return given.mapInArrow(_pieces(tokenizer, sequence, end_id, keep_ids), PIECES + ", ids array<int>" * keep_ids)


# --- rounds ---------------------------------------------------------------------------------------


MATCHED, GAP_LEFT, PIECE_LEFT, COUNTS = range(4)
SWEPT = "what int, part int, level long, pid long, size long, sequence_id long, slot long"
#: A band ends once a sweep places fewer than one in this many of all pieces.
FEW = 1000
#: Brackets of a range, at most about.
RANGE_ROWS = 1_000_000


def match_brackets(opens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """opens: whether a bracket opens -> closing places with their opening ones, opening ones that are left with their depths,
    and closing ones that are left, in order."""
    depth = np.cumsum(np.where(opens, 1, -1))
    low = np.minimum.accumulate(np.minimum(depth, 0))
    level = depth - low + ~opens  # where it stands, counted from 1
    lost = ~opens & (low < np.append(0, low[:-1]))
    at = np.flatnonzero(~lost)
    order = at[np.argsort(level[at], kind="stable")]
    closes = np.flatnonzero(~opens[order])
    taken = np.zeros(len(opens), dtype=bool)
    taken[order[closes - 1]] = True
    left = np.flatnonzero(opens & ~taken)
    return order[closes], order[closes - 1], left, level[left], np.flatnonzero(lost)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A range of (size, is_piece, id, slot), by descending size and gaps before pieces -> what meets in it, what is left, and how many."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    given = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
    if not given:
        return
    size, is_piece, key, slot = (np.concatenate(c) for c in zip(*given, strict=True))
    given.clear()
    closing, opening, left, level, lost = match_brackets(~is_piece)

    def rows(what: int, n: int, level: np.ndarray | int = 0, piece: np.ndarray | None = None, gap: np.ndarray | None = None) -> pa.RecordBatch:
        none = np.full(n, -1)
        own = [
            np.full(n, what, np.int32), np.full(n, part, np.int32), np.broadcast_to(level, n).astype(np.int64),
            none if piece is None else key[piece], none if piece is None else size[piece],
            none if gap is None else key[gap], none if gap is None else slot[gap],
        ]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in own], names=[x.split()[0] for x in SWEPT.split(", ")])

    yield rows(MATCHED, len(closing), 0, closing, opening)
    yield rows(GAP_LEFT, len(left), level, gap=left)
    yield rows(PIECE_LEFT, len(lost), np.arange(1, len(lost) + 1), piece=lost)
    counts = rows(COUNTS, 1, len(lost))  # with how many met as pid, and how many gaps are left as slot
    yield counts.set_column(3, "pid", pa.array([len(closing)], pa.int64())).set_column(6, "slot", pa.array([len(left)], pa.int64()))


class _Rounds:
    """How many sequences are open, their gaps as a ledger of (sequence_id, gap) entries to be summed up, what was found so far
    (pid, size, sequence_id, turn), and what a round does."""

    def __init__(self, scratch: Scratch, sequence: int, pieces: int):
        self.scratch, self.sequence, self.pieces = scratch, sequence, pieces
        self.opened = self.done = self.entries = 0
        self.ledger: DataFrame | None = None
        self.found: DataFrame | None = None

    def _enter(self, entries: DataFrame, n: int) -> None:
        self.ledger = entries if self.ledger is None else self.ledger.unionByName(entries)
        self.entries += n

    def _brackets(self, waiting: DataFrame, low: int, high: int) -> DataFrame:
        """Waiting pieces, and gaps as often as they hold pieces of the band."""
        pieces = waiting.select("size", F.lit(True).alias("is_piece"), F.col("pid").alias("id"), F.lit(0).cast("long").alias("slot"))
        if self.ledger is None:
            return pieces
        gaps = self.ledger.groupBy("sequence_id").agg(F.sum("gap").alias("gap"))
        if self.entries > 2 * self.opened:  # sequences hold many pieces: the sums are written in place of the entries
            gaps = self.ledger = self.scratch.keep(gaps.filter("gap > 0"), "gaps")
            self.entries = self.opened
        whole = F.greatest(F.lit(1), F.floor(F.col("gap") / high)).cast("long")
        full = F.transform(F.sequence(F.lit(0).cast("long"), whole - 1), lambda k: F.struct(F.col("gap").alias("size"), k.alias("slot")))
        rest = F.col("gap") % high
        slots = F.when((F.col("gap") > high) & (rest > low), F.array_append(full, F.struct(rest.alias("size"), whole.alias("slot")))).otherwise(full)
        gaps = gaps.filter(F.col("gap") > low).select("sequence_id", F.explode(slots).alias("s"))
        return pieces.unionByName(gaps.select("s.size", F.lit(False).alias("is_piece"), F.col("sequence_id").alias("id"), "s.slot"))

    def sweep(self, waiting: DataFrame, n: int, low: int, high: int) -> tuple[DataFrame, int]:
        """One round of a band over the gaps: the pieces that wait on, and how many.  Where few pieces found a gap, the rest opens
        new sequences in descending order, as many pieces in each as always fit, and none waits."""
        each = self.sequence // high
        by = [F.col("size").desc(), F.col("is_piece"), F.col("id"), F.col("slot")]
        ranges = -(-(n + self.opened * (each + 1)) // RANGE_ROWS)  # Spark's own number is merged by size
        brackets = self._brackets(waiting, low, high)
        ranged = brackets.repartitionByRange(ranges, *by) if ranges > shuffle_partitions(self.scratch.spark) else brackets.repartitionByRange(*by)
        swept = self.scratch.keep(ranged.sortWithinPartitions(*by).mapInArrow(_sweep, SWEPT), "swept")
        tasks, depth, lost = [], 0, 0
        for r in sorted(swept.filter(F.col("what") == COUNTS).collect(), key=lambda r: r["part"]):
            base = max(depth - r["level"], 0)
            tasks.append({"part": r["part"], "depth": depth, "base": base, "before": lost})
            lost += max(r["level"] - depth, 0)
            depth = base + r["slot"]
        opens = (n - lost) * FEW <= self.pieces
        # One row per task: small enough to send to all.
        per_task = F.broadcast(self.scratch.spark.createDataFrame(pa.Table.from_pylist(tasks, pa.schema([("part", pa.int32()), *((x, pa.int64()) for x in ("depth", "base", "before"))]))))
        edges = swept.filter(F.col("what").isin(GAP_LEFT, PIECE_LEFT)).join(per_task, "part")
        rank = F.col("before") + F.col("level") - F.col("depth") - 1  # of a piece that no gap is left for
        edges = edges.withColumn("rank", rank).withColumn("level", F.when(F.col("what") == GAP_LEFT, F.col("base") + F.col("level")).otherwise(F.col("depth") - F.col("level") + 1))
        # Levels below 1 have no gap.  Within a range, pieces that are left come before gaps that are.
        by_level = Window.partitionBy("level").orderBy("part", F.col("what").desc())
        meets = F.lag("what").over(by_level) == GAP_LEFT
        across = edges.filter("level > 0").select("what", "pid", "size", F.when(meets, F.lag("sequence_id").over(by_level)).alias("sequence_id"), F.when(meets, F.lag("slot").over(by_level)).alias("slot"))
        local = swept.filter(F.col("what") == MATCHED).select("pid", "size", "sequence_id", "slot")
        new_sequence = (F.lit(self.opened) + F.floor(F.col("rank") / each)).cast("long") if opens else F.lit(None).cast("long")
        unmet = edges.filter("level <= 0").select("pid", "size", new_sequence.alias("sequence_id"), (F.col("rank") % each).alias("slot"))
        self.done += 1
        turn = (F.lit(self.done * self.sequence) + F.col("slot")).cast("long").alias("turn")
        round_ = local.unionByName(across.filter(F.col("what") == PIECE_LEFT).drop("what")).unionByName(unmet)
        round_ = self.scratch.keep(round_.select("pid", "size", "sequence_id", turn), "round")
        self.scratch.drop(swept)
        own = round_.filter("sequence_id is not null")
        self.found = own if self.found is None else self.found.unionByName(own)
        self._enter(own.select("sequence_id", (-F.col("size")).alias("gap")), n if opens else n - lost)
        if not opens:
            return round_.filter("sequence_id is null").select("pid", "size"), lost
        begin, self.opened = self.opened, self.opened - (-lost // each)
        if lost:
            self._enter(self.scratch.spark.range(begin, self.opened).select(F.col("id").alias("sequence_id"), F.lit(self.sequence).cast("long").alias("gap")), self.opened - begin)
        return waiting, 0


def pack(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """pieces (doc_id, piece, length, ...) -> the same with sequence_id and offset."""
    scratch = Scratch(pieces.sparkSession, "packing")
    numbered = scratch.keep(pieces.withColumn("number of piece", F.monotonically_increasing_id()), "pieces")
    sizes = numbered.select(F.col("number of piece").alias("pid"), F.col("length").alias("size"))
    highs = sorted({sequence // k for k in BANDS if k <= sequence}, reverse=True)
    lows = [*highs[1:], 0]
    counts = sizes.agg(*[F.count(F.when((F.col("size") > low) & (F.col("size") <= high), 1)).alias(f"n{high}") for low, high in zip(lows, highs, strict=True)]).first()
    rounds = _Rounds(scratch, sequence, sum(counts))
    for low, high in zip(lows, highs, strict=True):
        left = counts[f"n{high}"]
        waiting = sizes.filter((F.col("size") > low) & (F.col("size") <= high))
        while left:
            waiting, left = rounds.sweep(waiting, left, low, high)
    if rounds.found is None:
        return pieces.withColumns({"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})
    ahead = F.sum("size").over(Window.partitionBy("sequence_id").orderBy("turn")) - F.col("size")
    placed = numbered.join(rounds.found.select("pid", "sequence_id", ahead.alias("offset")), F.col("number of piece") == F.col("pid"))
    return placed.select(*pieces.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: Callable[[], str], sequence: int = SEQUENCE, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """docs -> one row per piece with its sequence and its place there."""
    return pack(tokenise(docs, tokenizer, sequence, end_id, keep_ids), sequence)
