"""Removal of long passages that occur again, in the same document or another, by external suffix sorting.

A byte goes if it lies in a string of ``length`` bytes (UTF-8) that starts anywhere else, too.

* Candidates.  The least of the hashes of its 64-byte strings names an anchor in every window of ``length`` bytes;
  equal windows have equal anchors, at the same place.  Windows in a row with one anchor make a context.  Anchors
  are counted over all documents, and contexts whose anchor occurs once hold no window that occurs again.  This is exact.
* Shards.  The other contexts go to shards by their anchor, so that equal windows meet, however far apart their
  documents are.  Only one document of those with a context sends its bytes, however many there are.
* Hot anchors.  Where different surroundings of one passage make an anchor's contexts large (``HOT``), its windows are split by the place of
  the anchor in them: windows of either half of the places have more bytes in common than the anchor, whose hash is the new
  shard.  Halves are split again as long as they are hot; at single places all windows of a shard are equal, and equal contexts
  are summed before they meet.  This is exact, too.
* Suffix sorting.  A shard's contexts are sorted in chunks that end between anchors, by external induced sorting with
  common-prefix values (``induced``).  A run of suffixes that share ``length`` bytes is one string; where its contexts
  count two at least, its places are marked.
* The marks return to the documents as byte ranges, which are merged and cut out.  Places of one context that follow each other closely,
  as in text that repeats a few characters, are one row.

Matches never cross documents, and texts are judged as they were given.  Null text counts as empty.  Repeated rows are
places of their own, so both lose what they share.  Rows keep a null doc_id.  Texts shorter than ``length`` stay
whole.  A very long text is worked in pieces that overlap.  Texts move between tasks compressed.  An empty table gives no rows.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, lean, whole_text
from .hashing import Rolling, U, bytes_of, groups, mix, range_hashes
from .induced import suffix_order

LENGTH = 200
ANCHOR = 64
#: Bytes of a text looked at together, and bytes of contexts sorted together.
PIECE = 4_000_000
CHUNK = 1_000_000
#: Bytes of one anchor's different contexts above which its windows are split.
HOT = 2_000_000
_PLACE = 24
#: Contexts above so many bytes are hashed one by one.
RANGE = 1024
END = 0xFF  # never a byte of UTF-8


class Contexts:
    """Runs of windows with one anchor: bounds of their bytes, the anchor's hash, the row."""

    def __init__(self, data: np.ndarray, rows: np.ndarray, length: int):
        n = len(data)
        self.data = data
        self.start = self.stop = self.row = self.place = np.zeros(0, np.int64)
        self.anchor = np.zeros(0, np.uint64)
        if n < length:
            return
        size = np.diff(rows)
        first = rows[:-1][size >= length]
        valid = np.zeros(n + 1, dtype=np.int32)
        np.add.at(valid, first, 1)
        np.add.at(valid, (rows[1:] - length + 1)[size >= length], -1)
        at = np.flatnonzero(np.cumsum(valid[: n - length + 1]))
        if not len(at):
            return
        roll = Rolling(data)
        place = np.arange(n - ANCHOR + 1)
        full = mix(roll.of(place, place + ANCHOR))
        wide = length - ANCHOR + 1
        key = np.full(-(-len(full) // wide) * wide, ~U(0), dtype=np.uint64)
        key[: len(full)] = (full >> U(_PLACE)) << U(_PLACE) | place.astype(np.uint64)
        block = key.reshape(-1, wide)
        before = np.minimum.accumulate(block, axis=1).reshape(-1)
        after = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        least = (np.minimum(after[at], before[at + wide - 1]) & U((1 << _PLACE) - 1)).astype(np.int64)
        new = np.append(True, (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1))
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(at)) - 1
        self.start, self.stop = at[begin], at[end] + length
        self.place = least[begin]
        self.anchor = full[self.place]
        self.row = np.searchsorted(rows, self.start, side="right") - 1

    def marks(self) -> np.ndarray:
        """64 bits of each context's bytes, which identify it together with its anchor."""
        return range_hashes(self.data, self.start, self.stop, RANGE)


def _slices(text: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, bounds of rows in them, where they start in the row): all rows, or slices of one very long row."""
    data, rows = bytes_of(text)
    if len(data) <= 2 * PIECE:
        yield data, rows, 0
        return
    for k in range(len(rows) - 1):
        own = data[rows[k] : rows[k + 1]]
        for a in range(0, max(1, len(own) - length + 1), PIECE):
            part = own[a : a + PIECE + length - 1]
            bounds = np.zeros(len(rows), np.int64)
            bounds[k + 1 :] = len(part)
            yield part, bounds, a


def _anchors(length: int):
    """Rows -> the different contexts of each: (anchor, mark, did, row_key, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in groups(batch, 2):
                for data, rows, _ in _slices(part.column(2), length):
                    c = Contexts(data, rows, length)
                    mark = c.marks()
                    order = np.lexsort((mark, c.anchor, c.row))
                    h, m, row = c.anchor[order], mark[order], c.row[order]
                    first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (m[1:] != m[:-1]) | (row[1:] != row[:-1]))) if len(h) else np.zeros(0, np.int64)
                    at = pa.array(row[first])
                    n = np.diff(np.append(first, len(h)))
                    yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(m[first].view(np.int64)), part.column(0).take(at), part.column(1).take(at), pa.array(n)], names=["anchor", "mark", "did", "row_key", "n"])

    return lean(run)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by (anchor, mark, did) -> those whose anchor occurs again.

    sends: 0, or for the first row of each context how often the context occurs (2: twice at least).  One row is held back
    until the next one is seen.
    """
    held: list[np.ndarray] | None = None
    was = (False, False)  # whether the row before the held one has its anchor, its context

    def emit(cols: list[np.ndarray], same_anchor: np.ndarray, same_mark: np.ndarray, next_anchor: np.ndarray, next_mark: np.ndarray) -> pa.RecordBatch:
        anchor, mark, did, row_key, n = cols
        sends = np.where(same_mark, 0, np.where(next_mark | (n > 1), 2, 1)).astype(np.int8)
        use = same_anchor | next_anchor | (n > 1)
        return pa.RecordBatch.from_arrays([pa.array(x[use]) for x in (did, row_key, anchor, mark, sends)], names=["did", "row_key", "anchor", "mark", "sends"])

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy() for c in batch.columns]
        if held is not None:
            cols = [np.append(h, c) for h, c in zip(held, cols, strict=True)]
        same_a = np.append(was[0], cols[0][1:] == cols[0][:-1])
        same_m = np.append(was[1], same_a[1:] & (cols[1][1:] == cols[1][:-1]))
        yield emit([c[:-1] for c in cols], same_a[:-1], same_m[:-1], same_a[1:], same_m[1:])
        held, was = [c[-1:] for c in cols], (bool(same_a[-1]), bool(same_m[-1]))
    if held is not None:
        no = np.zeros(1, dtype=bool)
        yield emit(held, np.array([was[0]]), np.array([was[1]]), no, no)


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    z = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        bodies = pa.array([z.compress(x) for x in batch.column(3).cast(pa.binary()).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], bodies], names=["doc_id", "did", "row_key", "body"])


def _texts(bodies: pa.Array) -> list[bytes]:
    import zstandard

    z = zstandard.ZstdDecompressor()
    return [z.decompress(b) for b in bodies.to_pylist()]


ROWS = "kind string, doc_id long, did long, row_key long, body binary, anchor long, mark long, n long, start long, size long, sha string"


def stretches(row: np.ndarray, key: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places sorted by row, context and start -> where runs of one context begin, and how far their last start lies from the first.

    A context's marked ranges hold ``length`` bytes at least, so at starts no further apart than that they join into one.
    """
    new = np.append(True, (row[1:] != row[:-1]) | (key[1:] != key[:-1]) | (start[1:] - start[:-1] > length))
    first = np.flatnonzero(new)
    return first, start[np.append(first[1:], len(start)) - 1] - start[first]


def _contexts(length: int):
    """Rows with their repeated contexts -> places of contexts, contexts to sort, and the texts concerned or finished."""
    fields = [x.split() for x in ROWS.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}

    def rows_of(n_rows: int, **columns: pa.Array) -> pa.RecordBatch:
        kind = columns.pop("kind")
        return pa.RecordBatch.from_arrays([pa.array([kind] * n_rows, pa.string()) if name == "kind" else columns.get(name, pa.nulls(n_rows, types[t])) for name, t in fields], names=[f[0] for f in fields])

    def signed(x: np.ndarray) -> pa.Array:
        return pa.array(x.view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = _texts(batch.column(3))
                again = batch.column(4).is_valid().to_numpy(zero_copy_only=False)
                k = pa.array(np.flatnonzero(~again))
                if len(k):
                    bodies = [texts[i] for i in k.to_pylist()]
                    yield rows_of(len(k), kind="done", doc_id=batch.column(0).take(k), did=batch.column(1).take(k), row_key=batch.column(2).take(k), n=pa.array([len(b) for b in bodies], pa.int64()), sha=pa.array([hashlib.sha256(b).hexdigest() for b in bodies], pa.string()))
                k = pa.array(np.flatnonzero(again))
                if not len(k):
                    continue
                own = batch.take(k)
                yield rows_of(len(k), kind="text", doc_id=own.column(0), did=own.column(1), row_key=own.column(2), body=own.column(3))
                concerned = pa.RecordBatch.from_arrays([*own.columns[1:3], pa.array([texts[i] for i in k.to_pylist()], pa.binary()).cast(pa.string()), *own.columns[4:]], names=["did", "row_key", "text", "anchors", "marks", "sends"])
                for part in groups(concerned, 2):
                    yield from of_part(part)

    def of_part(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        did, row_key, text, anchors, marks, sends = part.columns
        for data, rows, offset in _slices(text, length):
            c = Contexts(data, rows, length)
            if not len(c.start):
                continue
            mark = c.marks()
            key = mix(c.anchor) ^ mark
            times = np.full(len(key), -1, dtype=np.int64)
            bound = np.searchsorted(c.row, np.arange(part.num_rows + 1))
            for k in range(part.num_rows):
                a, b = bound[k], bound[k + 1]
                known = mix(anchors[k].values.to_numpy().view(np.uint64)) ^ marks[k].values.to_numpy().view(np.uint64)
                given = sends[k].values.to_numpy()
                order = np.lexsort((-given, known))  # a repeated row has an entry of each of its copies
                place = np.minimum(np.searchsorted(known, key[a:b], sorter=order), len(known) - 1)
                hit = known[order[place]] == key[a:b]
                times[a:b][hit] = given[order[place]][hit]
            use = np.flatnonzero(times >= 0)
            if not len(use):
                continue
            start = c.start[use] - rows[c.row[use]] + offset
            order = np.lexsort((start, key[use], c.row[use]))
            use, start = use[order], start[order]
            first, reach = stretches(c.row[use], key[use], start, length)
            use, row = use[first], pa.array(c.row[use[first]])
            yield rows_of(len(use), kind="place", did=did.take(row), row_key=row_key.take(row), anchor=signed(c.anchor[use]), mark=signed(mark[use]), start=pa.array(start[first]), n=pa.array(reach))
            sent = np.flatnonzero(times > 0)
            _, first = np.unique(key[sent], return_index=True)
            sent = sent[first]
            body = data.tobytes()
            bodies = [body[a:b] for a, b in zip(c.start[sent].tolist(), c.stop[sent].tolist(), strict=True)]
            yield rows_of(len(sent), kind="context", anchor=signed(c.anchor[sent]), mark=signed(mark[sent]), body=pa.array(bodies, pa.binary()), n=pa.array(times[sent]), start=pa.array(c.place[sent] - c.start[sent]), size=pa.array(c.stop[sent] - c.start[sent]))

    return lean(run)


PARTS = "shard long, mark long, child long, child_mark long, shift long, n long, body binary, place long, low long, high long"


def _split(length: int):
    """Contexts with the places low to high of their anchor -> both halves of their windows, by what these have in common."""

    def key(*parts: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(b"".join(parts), digest_size=8).digest(), "little", signed=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for shard, mark, n, body, place, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mid = (low + high) // 2
                for a, b in ((low, mid), (mid + 1, high)):
                    first, last = max(0, place - b), min(len(body) - length, place - a)
                    if a > b or first > last:
                        continue
                    own = body[first : last + length]
                    bounds = np.array([shard, a, b], dtype="<i8").tobytes()
                    child = key(bounds, body[place - a : place - b + length])
                    rows.append((shard, mark, child, key(own, np.int64(place - first).tobytes()), first, n, own, place - first, a, b))
            cols = list(zip(*rows, strict=True)) or [[]] * 10
            names = [x.split() for x in PARTS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary() if t == "binary" else pa.int64()) for c, (_, t) in zip(cols, names, strict=True)], names=[n for n, _ in names])

    return lean(run)


def repeated_starts(contexts: list[bytes], counts: np.ndarray, length: int) -> list[np.ndarray]:
    """For each context the starts of windows that occur twice at least, all contexts' numbers together."""
    size = np.array([len(c) for c in contexts], dtype=np.int64)
    begin = np.cumsum(size + 1) - size - 1
    data = np.frombuffer(bytes([END]).join(contexts) + bytes([END]), dtype=np.uint8)
    order, common = suffix_order(data, length)
    owner = np.repeat(np.arange(len(contexts)), size + 1)
    inside = np.arange(len(data)) - begin[owner] <= (size - length)[owner]
    first = np.flatnonzero(common < length)
    weight = np.where(inside[order], counts[owner[order]], 0)
    total = np.add.reduceat(weight, first)
    marked = np.repeat(total >= 2, np.diff(np.append(first, len(order)))) & inside[order]
    hit = np.sort(order[marked])
    bound = np.searchsorted(hit, np.append(begin, len(data)))
    return [hit[a:b] - s for a, b, s in zip(bound[:-1].tolist(), bound[1:].tolist(), begin.tolist(), strict=True)]


def _sort_shard(length: int):
    """Contexts by anchor -> (anchor, mark, starts and stops of the byte ranges that go)."""

    def emit(marks: list[tuple[int, int]], bodies: list[bytes], counts: list[int]) -> pa.RecordBatch:
        found = repeated_starts(bodies, np.array(counts, dtype=np.int64), length)
        rows = []
        for (a, m), s in zip(marks, found, strict=True):
            if len(s):
                cut = np.append(True, s[1:] > s[:-1] + length)
                rows.append((a, m, s[cut].tolist(), (np.append(s[:-1][cut[1:]], s[-1]) + length).tolist()))
        cols = list(zip(*rows, strict=True)) or [[]] * 4
        types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=["anchor", "mark", "starts", "stops"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks: list[tuple[int, int]] = []
        bodies: list[bytes] = []
        counts: list[int] = []
        held, anchor = 0, None
        for batch in batches:
            for a, m, n, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if a != anchor and held > CHUNK:
                    yield emit(marks, bodies, counts)
                    marks, bodies, counts, held = [], [], [], 0
                if a == anchor and marks and marks[-1] == (a, m):
                    counts[-1] += n
                    continue
                anchor = a
                marks.append((a, m))
                bodies.append(body)
                counts.append(n)
                held += len(body)
        if marks:
            yield emit(marks, bodies, counts)

    return lean(run)


SPANS = "doc_id long, n_bytes long, spans array<struct<start:bigint,stop:bigint>>, kept_sha256 string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, bodies, ranges = batch.columns
        spans, shas, sizes = [], [], []
        for body, r in zip(_texts(bodies), ranges.to_pylist(), strict=True):
            own: list[list[int]] = []
            for x in sorted((y["start"], y["stop"]) for y in r or []):
                if own and x[0] <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], x[1])
                else:
                    own.append(list(x))
            h, at = hashlib.sha256(), 0
            for a, b in own:
                h.update(body[at:a])
                at = b
            h.update(body[at:])
            spans.append([{"start": a, "stop": b} for a, b in own])
            shas.append(h.hexdigest())
            sizes.append(len(body))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays([doc, pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(shas, pa.string())], names=["doc_id", "n_bytes", "spans", "kept_sha256"])


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, spans (byte ranges that go, merged), kept_sha256."""
    scratch = Scratch(docs.sparkSession, "repeats")
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    given = given.select("doc_id", F.coalesce("doc_id", F.lit(-(2**63))).alias("did"), F.xxhash64("text").alias("row_key"), "text")
    found = given.select("did", "row_key", "text").mapInArrow(_anchors(length), "anchor long, mark long, did long, row_key long, n long")
    again = found.repartition("anchor").sortWithinPartitions("anchor", "mark", "did", "row_key").mapInArrow(_repeated, "did long, row_key long, anchor long, mark long, sends byte")
    lists = again.groupBy("did", "row_key").agg(F.collect_list(F.struct("anchor", "mark", "sends")).alias("c"))
    lists = lists.select("did", "row_key", F.col("c.anchor").alias("anchors"), F.col("c.mark").alias("marks"), F.col("c.sends").alias("sends"))
    bodies = given.select("doc_id", "did", "row_key", "text").mapInArrow(_compress, "doc_id long, did long, row_key long, body binary")
    joined = bodies.join(lists, ["did", "row_key"], "left").select("doc_id", "did", "row_key", "body", "anchors", "marks", "sends")
    rows = scratch.keep(joined.mapInArrow(_contexts(length), ROWS), "rows", by=("kind",))

    level = rows.filter("kind = 'context'").select(F.col("anchor").alias("shard"), "mark", "n", "body", F.col("start").alias("place"), F.lit(0).cast("long").alias("low"), F.lit(length - ANCHOR).cast("long").alias("high"), "size")
    leaves, links = [], []
    while True:
        hot = scratch.keep(level.groupBy("shard").agg(F.sum("size").alias("held")).filter(F.col("held") > HOT).select("shard"), "hot")
        if hot.isEmpty():
            leaves.append(level)
            break
        leaves.append(level.join(hot.hint("merge"), "shard", "left_anti"))
        parts = scratch.keep(level.join(hot.hint("merge"), "shard").select("shard", "mark", "n", "body", "place", "low", "high").mapInArrow(_split(length), PARTS), "parts")
        links.append(parts.select("shard", "mark", "child", "child_mark", "shift"))
        each = [F.first(c).alias(c) for c in ("body", "place", "low", "high")]
        level = parts.groupBy(F.col("child").alias("shard"), F.col("child_mark").alias("mark")).agg(F.sum("n").alias("n"), *each)
        level = scratch.keep(level.withColumn("size", F.octet_length("body").cast("long")), "level")
    contexts = reduce(DataFrame.unionByName, leaves).select(F.col("shard").alias("anchor"), "mark", "n", "body")
    shards = contexts.repartition("anchor").sortWithinPartitions("anchor", "mark")
    ranges = shards.mapInArrow(_sort_shard(length), "anchor long, mark long, starts array<bigint>, stops array<bigint>")
    if links:
        ranges = scratch.keep(ranges, "ranges")
    for link in reversed(links):
        below = ranges.select(F.col("anchor").alias("child"), F.col("mark").alias("child_mark"), "starts", "stops")
        moved = [F.transform(c, lambda x: x + F.col("shift")).alias(c) for c in ("starts", "stops")]
        up = link.join(below.hint("merge"), ["child", "child_mark"]).select(F.col("shard").alias("anchor"), "mark", *moved)
        ranges = scratch.keep(ranges.unionByName(up), "ranges")
    places = rows.filter("kind = 'place'").select("anchor", "mark", "did", "row_key", "start", F.col("n").alias("reach"))
    here = F.zip_with("starts", "stops", lambda a, b: F.struct((a + F.col("start")).alias("start"), (b + F.col("start") + F.col("reach")).alias("stop")))
    per_doc = places.join(ranges.hint("merge"), ["anchor", "mark"]).select("did", "row_key", here.alias("r")).groupBy("did", "row_key").agg(F.flatten(F.collect_list("r")).alias("ranges"))
    texts = rows.filter("kind = 'text'").select("doc_id", "did", "row_key", "body")
    cut = texts.join(per_doc, ["did", "row_key"], "left").select("doc_id", "body", "ranges").mapInArrow(_cut, SPANS)
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans")
    done = rows.filter("kind = 'done'").select("doc_id", F.col("n").alias("n_bytes"), none, F.col("sha").alias("kept_sha256"))
    return cut.unionByName(done)
