"""Best-fit packing whose bin counts are certified by lower bounds.

Documents are cut into pieces of at most one sequence; only pieces that leave room are packed.  They are dealt to groups
of bounded size, each packed best-fit decreasing and held against the largest bound that dual feasible functions give
for its sizes.  A group whose bins exceed its bound has a gap: the documents of its bins with room, and of the emptiest
bin of every other group, whose room the whole-numbered bound cannot see, are exchanged and packed anew, in as few
groups as hold them.  Rounds end when a bound certifies what was exchanged, or when a round saves no sequence.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.llm.common import stash
from leadmill.llm.tokens import ByteLevel

LENGTH = 1024
END_ID = 2
#: Pieces that one task packs together.
GROUP = 1 << 16
ROUNDS = 8
#: Largest parameter of the rounding functions.
STEPS = 24
#: Texts of which a worker holds the ids at once.
ROWS = 250

_ENCODERS: dict[str, ByteLevel] = {}


def best_fit_decreasing(sizes: Sequence[int], capacity: int) -> list[int]:
    """The bin of each size, bins counted from 0: largest first, each into the fullest bin that has room."""
    bins, count, room, rooms = [0] * len(sizes), 0, [[] for _ in range(capacity + 1)], 0
    for n in np.argsort(-np.asarray(sizes), kind="stable").tolist():
        size = int(sizes[n])
        fits = rooms >> size  # bit r of ``rooms``: some bin has r left
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            own = room[left].pop()
            if not room[left]:
                rooms &= ~(1 << left)
        else:
            left, own, count = capacity, count, count + 1
        bins[n], left = own, left - size
        if left:
            room[left].append(own)
            rooms |= 1 << left
    return bins


def lower_bound(often: np.ndarray, capacity: int) -> int:
    """The fewest bins that any packing needs, by dual feasible functions: functions of a size whose sum over the sizes
    of one bin never exceeds their value at ``capacity``. ``often[s]`` counts the pieces of size s.

    Taken are the size itself; for each threshold, sizes beyond its complement as whole bins and those below it as none;
    rounding to steps, for sizes that are no whole step; and rounding down to multiples of each threshold, mirrored at half."""
    if not often.sum():
        return 0
    sizes = np.flatnonzero(often)
    count, best = often[sizes], -(-int((sizes * often[sizes]).sum()) // capacity)

    def tried(values: np.ndarray, whole: int) -> None:
        nonlocal best
        best = max(best, -(-int((values * count).sum()) // whole))

    for least in range(1, capacity // 2 + 1):
        tried(np.where(sizes > capacity - least, capacity, np.where(sizes < least, 0, sizes)), capacity)
        whole = capacity // least
        mirrored = 2 * (whole - (capacity - sizes) // least)
        tried(np.where(2 * sizes > capacity, mirrored, np.where(2 * sizes == capacity, whole, 2 * (sizes // least))), 2 * whole)
    for steps in range(1, STEPS + 1):
        scaled = (steps + 1) * sizes
        tried(np.where(scaled % capacity == 0, sizes * steps, scaled // capacity * capacity), steps * capacity)
    return best


def pieces(docs: DataFrame, path: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """(item, doc_id, piece, start, length, ids): a text's ids and the end id, in pieces of ``length``; the first piece
    has what does not fill one. ``item`` numbers the pieces."""
    out = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
                        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())])
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = ByteLevel(path, marks=True)
        encode, item = _ENCODERS[path].ids, TaskContext.get().partitionId() << 33
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            owners, rows = [], []
            for n, text in enumerate(batch.column(1).to_pylist()):
                ids = array("I", encode(text)).tobytes() + end if text else end
                first = (len(ids) // 4 - 1) % length + 1
                for piece, stop in enumerate(range(first, len(ids) // 4 + 1, length)):
                    start = max(0, stop - length) if piece else 0
                    owners.append(n)
                    rows.append((item, piece, start, stop - start, ids[4 * start:4 * stop]))
                    item += 1
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            made = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([made[0], batch.column(0).take(pa.array(owners, pa.int64())), *made[1:]], names=out.names)

    return docs.select(id_col, text_col).mapInArrow(run, out)


_PACKED = "item long, size long, round long, group long, bin long, offset long, used long, emptiest boolean, bins long, bound long"


def _pack_groups(items: DataFrame, groups: int, capacity: int, turn: int) -> DataFrame:
    """``items`` (item, size) dealt to ``groups`` by hash, each packed and bounded."""
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("item", "ascending")])
        sizes = table.column("size").to_numpy()
        bins = np.array(best_fit_decreasing(sizes, capacity), np.int64)
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(sizes[order]) - sizes[order]
        starts = np.searchsorted(bins[order], bins[order])
        offset = np.empty_like(before)
        offset[order] = before - before[starts]
        used = np.bincount(bins, sizes).astype(np.int64)
        emptiest = (bins == int(np.argmin(used))) & (used.min() < capacity)
        count, bound, rows = len(used), lower_bound(np.bincount(sizes, minlength=capacity + 1), capacity), len(sizes)
        return pa.table({"item": table.column("item"), "size": sizes, "round": np.full(rows, turn), "group": table.column("group"), "bin": bins, "offset": offset,
                         "used": used[bins], "emptiest": emptiest, "bins": np.full(rows, count), "bound": np.full(rows, bound)})

    dealt = items.select("item", "size", F.pmod(F.xxhash64(F.lit(turn), "item"), F.lit(groups)).alias("group"))
    return stash(dealt.groupBy("group").applyInArrow(pack, _PACKED), "packed")


def repack(items: DataFrame, capacity: int, group: int = GROUP, rounds: int = ROUNDS) -> DataFrame:
    """Bins for (item, size), sizes below ``capacity``: the columns of ``_PACKED``. A bin is named by round, group and bin."""
    count = items.count()
    packed = _pack_groups(items, max(1, -(-count // group)), capacity, 0)
    for turn in range(1, rounds + 1):
        moves = ((F.col("bins") > F.col("bound")) & (F.col("used") < capacity)) | F.col("emptiest")
        moved = packed.where(moves)
        sizes = moved.groupBy("size").agg(F.count("*").alias("n"), F.count_if(F.col("offset") == 0).alias("bins")).collect()  # a row per size
        often = np.zeros(capacity + 1, np.int64)
        for row in sizes:
            often[row["size"]] = row["n"]
        bins = sum(row["bins"] for row in sizes)
        if bins <= lower_bound(often, capacity):
            break
        again = _pack_groups(moved, max(1, -(-int(often.sum()) // group)), capacity, turn)
        if again.where("offset = 0").count() >= bins:
            break
        packed = stash(packed.where(~moves).unionByName(again), "repacked")
    return packed


def pack(docs: DataFrame, path: str, length: int = LENGTH, carry: Sequence[Column] | None = None, group: int = GROUP, rounds: int = ROUNDS, **options) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ``carry`` (columns over ``ids``, by default the little-endian
    unsigned 32-bit ids themselves), sequence_id and offset.

    Null and empty texts have the end id alone; repeated rows are packed each; an empty table gives no rows; texts of any
    length are cut into pieces of ``length``, of which only the first may be shorter. Other columns are not read. Pieces
    that fill a sequence have a negative sequence_id. ``carry`` is stored and shuffled once, to the piece's place."""
    carry = [F.col("ids")] if carry is None else list(carry)
    own = ["doc_id", "piece", "start", "length"]
    made = stash(pieces(docs, path, length, **options).select("item", *own, *carry), "pieces")
    names = made.columns[5:]
    full = made.where(F.col("length") == length).select(*own, *names, (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    packed = repack(made.where(F.col("length") < length).select("item", F.col("length").alias("size")), length, group, rounds)
    named = F.shiftleft("round", 58) + F.shiftleft("group", 20) + F.col("bin")
    placed = made.where(F.col("length") < length).join(packed.select("item", named.alias("sequence_id"), "offset"), "item")
    return full.unionByName(placed.select(*own, *names, "sequence_id", "offset"))
