"""Repeated passages by seed and extend.

Seeds are winnowed: of the word sequences of ``SEED_WORDS`` inside a window of ``WINDOW`` words, the leftmost with the least hash. Every window thus
has one seed, which depends on its words alone, so equal windows have equal seeds at equal places. The windows of one seed
are consecutive; the stretch that they cover is the seed, extended both ways as far as windows hold it.

Occurrences of a seed with equal stretches form a class and match wholly: all but the smallest document of a class lose the stretch.
Only where a seed has several classes, one occurrence of each class compares its stretch window by
window with the others', again by grouping. So repeats are found to the word (maximal repeats are unions of
their windows), and no group is paired up or gathered: a class costs its members one row each.

A seed's hash only brings occurrences together. Stretches and windows are equal if the 128-bit digests (BLAKE2b) of their words are. Null texts have no words. A null doc_id ranks after all
others. Rows that share a doc_id don't count as copies of one another. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from adspark.llm.common import keep, map_arrow, pieces, table
from adspark.llm.words import Words, gram, sums

WINDOW, SEED_WORDS = 50, 12
GRAMS = WINDOW - SEED_WORDS + 1
LAST_ID = (1 << 63) - 1
STRETCH = "array<struct<lo:int,n:int,off:int,seed:long,stretch:long,more:long>>"
#: What occurrences of a class have in common: the hash of the seed, both halves of the stretch's digest, the number of windows, and the seed's place.
CLASS = ["seed", "stretch", "more", "n", "off"]


def _least(g: np.ndarray) -> np.ndarray:
    """For each run of ``GRAMS`` values the place of the leftmost smallest."""
    best, width = np.arange(len(g)), 1
    while width * 2 <= GRAMS:
        a, b = best[:-width], best[width:]
        best, width = np.where(g[a] <= g[b], a, b), width * 2
    if width < GRAMS:
        a, b = best[:width - GRAMS], best[GRAMS - width:]
        best = np.where(g[a] <= g[b], a, b)
    return best


def _digests(w: Words, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Both halves of the digest of the words [lo, hi), a row for each."""
    text, start, end = w.joined()
    made = b"".join([hashlib.blake2b(text[a:b], digest_size=16).digest() for a, b in zip(start[lo].tolist(), end[hi - 1].tolist())])
    return np.frombuffer(made, "<i8").reshape(-1, 2)


def stretches(column: pa.Array) -> tuple[np.ndarray, ...]:
    """row, first window, number of windows, place of the seed, the hash of the seed, and the digests of the stretches."""
    w = Words(column, "space")
    nothing = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64), np.zeros((0, 2), np.int64))
    if len(w) < WINDOW:
        return nothing
    total = sums(w.hashes())
    i = np.arange(len(w) - SEED_WORDS + 1)
    g = gram(total, i, i + SEED_WORDS)
    seed = _least(g)
    row = np.repeat(np.arange(len(column)), w.count)[:len(seed)]
    window = np.flatnonzero(np.arange(len(seed)) + WINDOW <= w.first[1:][row])  # windows within a row
    if not len(window):
        return nothing
    seed, row = seed[window], row[window]
    new = np.flatnonzero((np.diff(window, prepend=-2) != 1) | (np.diff(seed, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
    n = np.diff(new, append=len(window))
    lo, row = window[new], row[new]
    return (row, lo - w.first[row], n, seed[new] - lo, g[seed[new]], _digests(w, lo, lo + n - 1 + WINDOW))


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text"):
            row, lo, n, off, seed, whole = stretches(part.column("text"))
            at = np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32)
            found = pa.StructArray.from_arrays(
                [pa.array(lo, pa.int32()), pa.array(n, pa.int32()), pa.array(off, pa.int32()),
                 pa.array(seed.view(np.int64)), pa.array(whole[:, 0]), pa.array(whole[:, 1])], ["lo", "n", "off", "seed", "stretch", "more"])
            yield pa.RecordBatch.from_arrays(
                [part.column("rank"), part.column("hash"), pa.ListArray.from_arrays(pa.array(at), found)],
                ["rank", "hash", "found"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of every window of the stretches that must be compared."""
    for batch in batches:
        for part in pieces(batch, "text"):
            w = Words(part.column("text"), "space")
            asked = part.column("asked")
            of = np.repeat(np.arange(len(part)), pc.list_value_length(asked).to_numpy(zero_copy_only=False))
            s = asked.flatten()
            get = lambda k: s.field(k).to_numpy(zero_copy_only=False)
            n = get("n").astype(np.int64)
            each = np.repeat(np.arange(len(n)), n)
            o = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            i = w.first[of[each]] + get("lo")[each] + o
            rank = part.column("rank").to_numpy(zero_copy_only=False)
            window = _digests(w, i, i + WINDOW)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rank[of[each]], *[get(k)[each] for k in CLASS], o.astype(np.int32), window[:, 0], window[:, 1])],
                                             ["rank", *CLASS, "o", "window", "rest"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words that the ranges [a, b) cover."""
    for batch in batches:
        out = []
        for doc_id, text, ranges in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "ranges"))):
            words = (text or "").encode().split()
            gone = 0
            if ranges:
                left, at = [], 0
                for r in sorted((r["a"], r["b"]) for r in ranges):
                    if r[1] <= at:
                        continue
                    left += words[at:r[0]]
                    gone += r[1] - max(at, r[0])
                    at = r[1]
                kept = left + words[at:]
            else:
                kept = words
            joined = b" ".join(kept)
            out.append((doc_id, len(words), gone, hashlib.sha256(joined).hexdigest(), joined.decode()))
        cols = list(zip(*out)) if out else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """rank, hash and ranges: for each document that loses words, the ranges of its words that go.

    ``docs`` has rank (doc_id, null last), hash (of the text) and text.
    """
    found = keep(map_arrow(docs, _occurrences, f"rank long, hash long, found {STRETCH}"))
    each = found.select("rank", "hash", F.explode("found").alias("f")).select("rank", "hash", "f.*")
    key = CLASS
    classes = keep(each.groupBy(*key).agg(F.min(F.struct("rank", "hash", "lo")).alias("first"), F.max("rank").alias("last")))
    several = classes.groupBy("seed").agg(
        F.count("*").alias("k"), F.min("first.rank").alias("low"), F.max("first.rank").alias("high")).where("k > 1 and low < high")
    asked = classes.join(several.select("seed"), "seed").select("first.rank", "first.hash", F.struct(F.col("first.lo").alias("lo"), *key).alias("s"))
    asked = asked.groupBy("rank", "hash").agg(F.collect_list("s").alias("asked"))
    texts = docs.join(asked, ["rank", "hash"]).dropDuplicates(["rank", "hash"])
    windows = keep(map_arrow(texts.select("rank", "text", "asked"), _windows,
                             "rank long, seed long, stretch long, more long, n int, off int, o int, window long, rest long"))
    place = (F.col("off") - F.col("o")).alias("place")
    earliest = keep(windows.groupBy("seed", place, "window", "rest").agg(F.min("rank").alias("low"), F.max("rank").alias("high"))
                    .where("low < high").drop("high"))
    partly = (windows.withColumn("place", place).join(earliest, ["seed", "place", "window", "rest"]).where("rank > low")
              .groupBy(*key).agg(F.collect_list("o").alias("gone")))
    verdict = keep(classes.join(partly, key, "left").where("last > first.rank or gone is not null")
                   .select(*key, F.col("first.rank").alias("first"), "gone"))
    whole = F.array(F.struct(F.col("lo").alias("a"), (F.col("lo") + F.col("n") + (WINDOW - 1)).alias("b")))
    single = F.transform("gone", lambda o: F.struct((F.col("lo") + o).alias("a"), (F.col("lo") + o + WINDOW).alias("b")))
    hit = each.join(verdict, key).select("rank", "hash", F.explode(F.when(F.col("rank") > F.col("first"), whole).otherwise(single)).alias("r"))
    return hit.groupBy("rank", "hash").agg(F.collect_set("r").alias("ranges"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept_text for each row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumns(
        {"rank": F.coalesce("doc_id", F.lit(LAST_ID)), "hash": F.xxhash64("text")})
    ranges = keep(repeated_ranges(docs.select("rank", "hash", "text")))
    return map_arrow(docs.join(ranges, ["rank", "hash"], "left").select("doc_id", "text", "ranges"), _cut,
                     "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)),
low AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM win JOIN low USING (h) WHERE doc_id > m),
each AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
