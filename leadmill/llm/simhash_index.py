"""SimHash near-duplicates over a byte-position inverted index with count filtering.

Two fingerprints that differ in three bits or fewer have at least five of their eight bytes in common, each at its own
position. The index therefore lists fingerprints under positional bytes, the shared ones are tallied per pair, pairs
with at least five are kept and their bits compared.

Lists of single bytes would pair a fixed share of all fingerprints, so the index intersects them: a list holds the
fingerprints that agree in three positions of one half of the bytes. Five shared positions put at least three into one
half, so every pair with five meets in at least one of these eight kinds of list, and lists stay short.

Equal fingerprints are one class before any of this. A list of more than ``long_list`` different fingerprints is not
paired up: its members go on to finer lists, which agree in two of the other five bytes as well. A pair with five shared
bytes has two more in common besides the list's three, so it meets in one of these ten. Only members of a five-byte list
that is still long are joined through common neighbours in its 24 free bits, which costs a fixed number of rows per
member. All ways find the same components.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.llm.common import join_facts, repeat_rows, row_key, stash
from leadmill.llm.components import components

SHINGLE = 3
BITS = 3
#: At least so many of eight bytes are shared by fingerprints that differ in BITS bits.
SHARED = 8 - BITS
LONG_LIST = 1024
#: Which bytes (0 is the lowest) each kind of list agrees in.
LISTS = [p for half in (range(4), range(4, 8)) for p in combinations(half, 3)]
#: Which bytes the finer lists agree in.
FINER = list(combinations(range(8), SHARED))
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The 64-bit fingerprint as a signed number; 0 without words."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        hashes = np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist())),
                             np.uint64, len(words) - size + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (default: all) and the long ``bits``."""
    names = docs.columns if keep is None else keep
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField("bits", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = pa.array(list(map(fingerprint, batch.column(len(names)).to_pylist())), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], bits], names=schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text_col}`").cast("string").alias("hashed_text")).mapInArrow(run, schema)


def list_number(kind: int, places: Iterable[int]) -> Column:
    """The number of the list that ``bits`` falls into: the kind, then the bytes at ``places``."""
    value = F.lit(kind).cast("long")
    for p in places:
        value = F.shiftleft(value, 8).bitwiseOR(F.shiftrightunsigned("bits", 8 * p).bitwiseAND(F.lit(255)))
    return value


def index(prints: DataFrame) -> DataFrame:
    """(list, bits): each fingerprint in its eight lists."""
    return prints.select("bits", F.explode(F.array(*[list_number(kind, places) for kind, places in enumerate(LISTS)])).alias("list"))


def finer_index(entries: DataFrame) -> DataFrame:
    """(list, bits) of three-byte lists as entries of the ten five-byte lists that hold the list's three positions."""
    finer = F.lit(None)
    for kind, three in enumerate(LISTS):
        own = F.array(*[list_number(n, five) for n, five in enumerate(FINER) if set(three) <= set(five)])
        finer = F.when(F.shiftright("list", 24) == kind, own).otherwise(finer)
    return entries.select("bits", F.explode(finer).alias("list")).distinct()


def shared_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many positional bytes each pair shares."""
    return ((a ^ b)[..., None].view(np.uint8) == 0).sum(-1)


def short_list_links(lists: DataFrame) -> DataFrame:
    """(u, v) of the pairs in (list, members) that pass the count filter and the comparison of bits."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for members in frame["members"]:
                m = np.asarray(members, np.int64)
                for n in range(len(m) - 1):
                    rest = m[n + 1:]
                    rest = rest[shared_bytes(rest, m[n]) >= SHARED]
                    rest = rest[np.bitwise_count((rest ^ m[n]).view(np.uint64)) <= BITS]
                    if len(rest):
                        us.append(rest)
                        vs.append(np.full(len(rest), m[n]))
            yield pd.DataFrame({"u": np.concatenate(us), "v": np.concatenate(vs)})

    return lists.select("members").mapInPandas(run, "u long, v long")


def long_list_links(entries: DataFrame) -> DataFrame:
    """Links for (list, bits) entries of long five-byte lists, a fixed number of rows per entry.

    Members at distance three or less have a common neighbour: one of them at distance one or less from it (near), the
    other at two or less. All near members of a neighbour are linked, as are its others to any near one; others without
    a near member are not. Only the 24 bits that a list leaves free are varied."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        masks = {}
        for kind, places in enumerate(FINER):
            free = [np.uint64(1) << np.uint64(n) for n in range(64) if n // 8 not in places]
            near = np.array([np.uint64(0), *free], np.uint64)
            masks[kind] = np.concatenate([near, np.array([a | b for a, b in combinations(free, 2)], np.uint64)]), len(near)
        for frame in frames:
            for at in range(0, len(frame), 100):
                part, made = frame.iloc[at:at + 100], []
                for where, bits in zip(part["list"].tolist(), part["bits"].to_numpy(np.int64).view(np.uint64)):
                    mask, near = masks[where >> 8 * SHARED]
                    made.append(pd.DataFrame({"hub": (bits ^ mask).view(np.int64), "bits": np.full(len(mask), bits).view(np.int64),
                                              "near": np.arange(len(mask)) < near, "list": where}))
                yield pd.concat(made)

    hubs = entries.mapInPandas(run, "hub long, bits long, near boolean, list long")
    grouped = hubs.groupBy("list", "hub").agg(F.min(F.when(F.col("near"), F.col("bits"))).alias("v")).where("v is not null")
    return hubs.join(grouped, ["list", "hub"]).select(F.col("bits").alias("u"), "v").where("u <> v").distinct()


def by_length(entries: DataFrame, long_list: int) -> tuple[DataFrame, DataFrame]:
    """Stored ``entries`` as the members of each short list, and as the entries of long ones."""
    sizes = entries.groupBy("list").count()
    long = stash(sizes.where(F.col("count") > long_list), "long-lists").select("list")
    short = (entries.join(long, "list", "left_anti").groupBy("list").agg(F.collect_list("bits").alias("members"))
             .where(F.size("members") > 1))
    return short, entries.join(long, "list", "left_semi").select("list", "bits")


def links(prints: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """Links (u, v) between different fingerprints of ``prints`` (bits, all different) that give its components."""
    short, long = by_length(stash(index(prints), "index"), long_list)
    finer, longest = by_length(stash(finer_index(long), "finer-index"), long_list)
    return short_list_links(short).unionByName(short_list_links(finer)).unionByName(long_list_links(longest)).distinct()


def groups(rows: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """(bits, root, component_id, members) for stored ``rows`` (doc_id, bits): one row per fingerprint; component_id is the
    smallest doc_id of its component, members the number of rows with the fingerprint."""
    classes = stash(rows.groupBy("bits").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("members")), "classes")
    roots = stash(components(links(classes.select("bits"), long_list)).withColumnRenamed("node", "bits"), "roots")
    rooted = stash(classes.join(roots, "bits", "left").withColumn("root", F.coalesce("root", "bits")), "rooted")
    firsts = stash(rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("classes")), "firsts")
    return join_facts(rooted, firsts, "root", "classes").select("bits", "root", "component_id", "members")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_list: int = LONG_LIST) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Null texts and texts without words have fingerprint zero and are linked like others; repeated rows are members of
    one class; null ids never name a component unless it has no other; an empty table gives no rows."""
    rows = stash(with_fingerprint(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), keep=["doc_id"]), "prints")
    found = join_facts(rows, stash(groups(rows, long_list), "components"), "bits", "members")
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_list: int = LONG_LIST) -> DataFrame:
    """One row of each component of ``docs``, that of the smallest id (of rows that share it, any one)."""
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *row_key(docs))
    rows = stash(with_fingerprint(keyed, keep=["doc_id", "row_key_a", "row_key_b"]), "prints")
    found = join_facts(rows, stash(groups(rows, long_list), "components"), "bits", "members")
    kept = (found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("root").agg(F.min(F.struct("row_key_a", "row_key_b")).alias("own")))
    return repeat_rows(docs, kept.select("own.*", F.lit(1).alias("times")))
