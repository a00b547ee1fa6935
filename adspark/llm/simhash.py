"""SimHash near-duplicates by tables of distances to reference fingerprints.

Every fingerprint gets its Hamming distances to many reference fingerprints (pivots): zero, sixteen masks of four bits,
and eight random ones. Two fingerprints that differ in at most two bits differ by at most two in every distance, and their
distances agree exactly for all masks but those that hold a differing bit. The masks lie in six groups; two differing bits touch two
groups at most, so of the fifteen sets of four groups at least one agrees in all its distances. Fingerprints meet if such a set agrees
(an equi-join on distances, never all pairs); of those pairs, any whose largest difference over the random pivots is above two
is discarded; Hamming distance decides on the rest.

A bucket of more than ``BUCKET`` fingerprints isn't paired: its members list the 65 fingerprints within one bit. Two
fingerprints lie within two bits just if they list one in common, so linking members through what they list is exact and linear.

Null texts count as empty. Documents without words have fingerprint zero and are linked like others. Rows with equal doc_id each
get a row. A null doc_id is kept; it never names a component unless no document of it has an id. Columns besides doc_id and text are ignored.
Groups with one component_id (texts that share an id, groups without ids) stay apart: the stage keeps a document of each.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adspark.llm.common import PIECE, components, keep, map_arrow, numbered, pieces, table, without
from adspark.llm.words import Words

SEED, SHINGLE, BITS, MOST = 42, 3, 64, 2
GROUPS, BUCKET, RANDOM_PIVOTS = 6, 64, 8
#: Shingles whose bits are counted at once.
AT_ONCE = 1 << 17


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


MASKS = [0xF << (4 * j) for j in range(16)]
PIVOTS = [random.Random(1).getrandbits(64)] + [random.Random(i).getrandbits(64) for i in range(2, RANDOM_PIVOTS + 1)]


def fingerprint_arrays(column: pa.Array) -> np.ndarray:
    """A 64-bit fingerprint for each text of a column."""
    w = Words(column, "space_lower")
    n, rows = len(w), len(column)
    if not n:
        return np.zeros(rows, np.uint64)
    data = w.bytes.copy()
    inside = np.zeros(len(data) + 1, np.int64)  # words with one space after each, from which shingles are cut
    inside[w.start] += 1
    inside[w.end] -= 1
    used = np.cumsum(inside[:-1]) > 0
    gap = w.end[w.end < len(data)]
    gap = gap[~used[gap]]
    used[gap] = True
    data[gap] = 32
    place = np.cumsum(used) - 1
    joined = data[used].tobytes()
    start, end = place[w.start], place[w.end - 1] + 1
    row = np.repeat(np.arange(rows), w.count)
    last = w.first[1:][row] - 1
    i = np.arange(n)
    first = w.first[:-1][row]
    is_start = (i + SHINGLE - 1 <= last) | ((i == first) & (last - first + 1 < SHINGLE))
    s, row = i[is_start], row[is_start]
    e = np.minimum(s + SHINGLE - 1, last[is_start])
    total, ones = np.bincount(row, minlength=rows), np.zeros((rows, BITS), np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(s), AT_ONCE):
        part = slice(k, k + AT_ONCE)
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(start[s[part]].tolist(), end[e[part]].tolist())], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        new = np.flatnonzero(np.diff(row[part], prepend=-1))
        ones[row[part][new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int64)
    set_bits = (2 * ones > total[:, None]).astype(np.uint8)
    return np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, *also: str) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, and the columns ``also``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", PIECE):
                fp = fingerprint_arrays(part.column("text")).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp), *map(part.column, also)], ["doc_id", "fp", *also])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *also), run,
                     ", ".join(["doc_id long", "fp long", *[f"{c} {docs.schema[c].dataType.simpleString()}" for c in also]]))


def distance(fp: Column, pivot: int) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(_signed(pivot)).cast("long")))


#: The bits of :func:`_counts` that belong to each set of groups of masks.
SETS = [sum(0xF << (4 * j) for j in range(len(MASKS)) if j % GROUPS in chosen) for chosen in combinations(range(GROUPS), GROUPS - MOST)]


def _counts(fp: Column) -> Column:
    """For each mask the distance to zero less the distance to the mask, as the number of bits set under it, four bits each."""
    packed = F.lit(0).cast("long")
    for j, m in enumerate(MASKS):
        bits = ((distance(fp, 0) - distance(fp, m) + 4) / 2).cast("long")
        packed = packed.bitwiseOR(F.shiftleft(bits, 4 * j))
    return packed


def _table(fp: Column) -> Column:
    """The distances to the random pivots, a byte each."""
    packed = F.lit(0).cast("long")
    for i, p in enumerate(PIVOTS):
        packed = packed.bitwiseOR(F.shiftleft(distance(fp, p).cast("long"), 8 * i))
    return packed


def _largest_difference(a: Column, b: Column) -> Column:
    at = lambda x, i: F.shiftrightunsigned(x, 8 * i).bitwiseAND(F.lit(255).cast("long"))
    return F.greatest(*[F.abs(at(a, i) - at(b, i)) for i in range(RANDOM_PIVOTS)])


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges a, b that connect the distinct fingerprints ``fp`` just as links at two bits or fewer do."""
    key = ["chosen", "key"]
    keyed = fps.select("fp", _table(F.col("fp")).alias("distances"), _counts(F.col("fp")).alias("counts")).select(
        "fp", "distances", F.posexplode(F.array(*[F.col("counts").bitwiseAND(F.lit(_signed(x)).cast("long")) for x in SETS])).alias(*key))
    shared = keep(keyed.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1"))
    met = keep(keyed.join(shared, key))
    few, many = met.where(F.col("n") <= bucket), met.where(F.col("n") > bucket)
    x = few.select(*key, F.col("fp").alias("a"), F.col("distances").alias("da"))
    y = few.select(*key, F.col("fp").alias("b"), F.col("distances").alias("db"))
    pairs = x.join(y, key).where((F.col("a") < F.col("b")) & (_largest_difference(F.col("da"), F.col("db")) <= MOST)
                                   & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST)).select("a", "b")
    one_bit = F.array(*[F.lit(0).cast("long"), *[F.lit(_signed(1 << j)).cast("long") for j in range(BITS)]])
    around = many.select("fp").distinct().select("fp", F.explode(one_bit).alias("bit")).select(
        F.col("fp").alias("a"), F.col("fp").bitwiseXOR(F.col("bit")).alias("b"))
    common = around.groupBy("b").agg(F.count("*").alias("n")).where("n > 1").select("b")
    return pairs.unionByName(around.join(common, "b").select("a", "b"))


def _rooted(fps: DataFrame) -> DataFrame:
    """The rows of ``fps``, one for each fingerprint ``fp``, with the smallest fingerprint of its group as ``root``."""
    roots = components(links(fps.select("fp")), "a", "b")
    return keep(fps.join(roots, F.col("fp") == F.col("node"), "left").select(*fps.columns, F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id reachable over links."""
    each = keep(fingerprints(docs))
    fps = keep(each.groupBy("fp").agg(F.min("doc_id").alias("low")))
    rooted = _rooted(fps)
    lowest = keep(rooted.groupBy("root").agg(F.min("low").alias("component_id")))
    named = keep(rooted.join(lowest, "root").select("fp", "component_id"))
    return each.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the smallest doc_id, null last, then the smallest hash of its text; of rows equal in both, any one.

    Groups and their kept rows are found by numbers of rows alone; texts meet the numbers of the rows that go once.
    """
    docs, row = numbered(docs)
    narrow = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"), F.col(row).alias("row"))
    each = keep(fingerprints(narrow, "hash", "row"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash", "row"))
    rooted = _rooted(keep(each.groupBy("fp").agg(first.alias("first"))))
    kept = keep(rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.row"))
    return without(docs, row, each.select("row").join(kept, "row", "left_anti"))
