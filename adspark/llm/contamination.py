"""Benchmark contamination by a prefix-filtered join of shingles.

Items are cut into windows of ``WINDOW`` words (a shorter item is one window), windows into shingles of three words (of all words if there are
fewer). A window occurs only where all its shingles do, so its prefix is one shingle: the one that is rarest in the documents.
Documents are scanned once. A bit map of fixed size, which holds the shingles of all items, picks the runs of words that
can hold a window; runs shorter than the shortest window go. Rarity is counted from these runs, rarest shingles are
joined with the runs' shingles, start and length must fit the run, and the words at that place must then equal the window's words.

Nothing that grows with documents or benchmark is broadcast by hand or collected: the bit map has ``MAP_BITS`` bits whatever the input.
Null texts have no words. An item without id marks words as hit but isn't listed. Rows that share a doc_id are judged each by its own text.
Other columns are ignored. An empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from adspark.llm.common import PIECE, keep, map_arrow, numbered, pieces, table, without
from adspark.llm.words import Words, gram, sums

WINDOW, SHINGLE, MAP_BITS = 13, 3, 1 << 24
RUN = "array<struct<size:int,start:int,words:array<string>,keys:array<long>>>"


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for part in pieces(batch, "text"):
            w = Words(part.column("text"), "alnum")
            total, ids = sums(w.hashes()), part.column("item_id").to_pylist()
            for r, item in enumerate(ids):
                lo, hi = int(w.first[r]), int(w.first[r + 1])
                if lo == hi:
                    continue
                words = [x.decode("utf-8", "replace") for x in w.text(lo, hi)]
                width = min(WINDOW, hi - lo)
                size = min(SHINGLE, width)
                at = np.arange(lo, hi - size + 1)
                keys = gram(total, at, at + size).view(np.int64).tolist()
                out += [(item, " ".join(words[i:i + width]), width, size, keys[i:i + width - size + 1]) for i in range(hi - lo - width + 1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64())))],
            ["item_id", "window", "width", "size", "keys"])


def _bit_map(windows: DataFrame) -> tuple[np.ndarray, dict[int, int]]:
    """The bit map of all shingles (at most MAP_BITS bits) and, by shingle size, the shortest window."""
    bit = F.col("key").bitwiseAND(F.lit(MAP_BITS - 1).cast("long"))
    rows = (windows.select(F.explode("keys").alias("key")).select(F.shiftright(bit, 5).alias("at"), bit.bitwiseAND(F.lit(31).cast("long")).alias("bit"))
            .groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("bits")).collect())
    bits = np.zeros(MAP_BITS // 32, np.uint32)
    for r in rows:
        bits[r["at"]] = r["bits"]
    shortest = {r["size"]: r["width"] for r in windows.groupBy("size").agg(F.min("width").alias("width")).collect()}
    return bits, shortest


def _runs(spark: SparkSession, docs: DataFrame, windows: DataFrame) -> DataFrame:
    """n_words and the runs of words that can hold windows, and the columns of ``docs`` but the text."""
    also = [c for c in docs.columns if c != "text"]
    bits, shortest = _bit_map(windows)
    shared = spark.sparkContext.broadcast(bits)  # MAP_BITS / 8 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            for part in pieces(batch, "text", PIECE):
                w = Words(part.column("text"), "alnum")
                total = sums(w.hashes()) if shortest and len(w) else None
                rows = np.repeat(np.arange(len(part)), w.count)
                found: list[list[dict]] = [[] for _ in range(len(part))]
                for size, width in shortest.items():
                    at = np.arange(len(w) - size + 1)
                    if total is None or not len(at):
                        continue
                    key = gram(total, at, at + size)
                    low = (key & np.uint64(MAP_BITS - 1)).astype(np.int64)
                    hit = ((held[low >> 5] >> (low & 31).astype(np.uint32)) & 1).astype(bool) & (rows[:len(at)] == rows[size - 1:])
                    i = np.flatnonzero(hit)
                    if not len(i):
                        continue
                    new = np.flatnonzero((np.diff(i, prepend=-2) != 1) | (np.diff(rows[i], prepend=-1) != 0))
                    n = np.diff(new, append=len(i))
                    for lo, k in zip(i[new][n + size - 1 >= width].tolist(), n[n + size - 1 >= width].tolist()):
                        r = int(rows[lo])
                        found[r].append({"size": size, "start": lo - int(w.first[r]),
                                         "words": [x.decode("utf-8", "replace") for x in w.text(lo, lo + k + size - 1)],
                                         "keys": key[lo:lo + k].view(np.int64).tolist()})
                kind = pa.list_(pa.struct([("size", pa.int32()), ("start", pa.int32()), ("words", pa.list_(pa.string())), ("keys", pa.list_(pa.int64()))]))
                yield pa.RecordBatch.from_arrays(
                    [*map(part.column, also), pa.array(w.count.astype(np.int64)), pa.array(found, kind)], [*also, "n_words", "runs"])

    return map_arrow(docs, run, ", ".join([*[f"{c} {docs.schema[c].dataType.simpleString()}" for c in also], "n_words long", f"runs {RUN}"]))


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *also: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the columns ``also`` for each row of ``docs``."""
    items = keep(map_arrow(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), _item_windows,
                           "item_id long, window string, width int, size int, keys array<long>"))
    windows = items.select("window", "width", "size", "keys").dropDuplicates(["window"])
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *also)
    each = keep(_runs(spark, docs, items).withColumn("row", F.monotonically_increasing_id()))
    runs = each.select("row", F.explode("runs").alias("r")).select("row", "r.*")
    places = runs.select("row", F.col("start").alias("run"), "size", F.size("words").alias("run_words"), F.posexplode("keys").alias("at", "key"))
    counts = keep(places.groupBy("key", "size").agg(F.count("*").alias("n")))
    # A shingle that no document has makes the window impossible: it has no count, and the window no full set of counts.
    ranked = (windows.select("window", "width", "size", F.size("keys").alias("k"), F.posexplode("keys").alias("p", "key"))
              .join(counts, ["key", "size"]).groupBy("window", "width", "size", "k")
              .agg(F.count("*").alias("seen"), F.min(F.struct("n", "key", "p")).alias("rarest")).where("seen = k"))
    prefix = keep(ranked.select("size", "width", F.col("rarest.key").alias("key"), F.col("rarest.p").alias("p")).distinct())
    start = F.col("at") - F.col("p")
    tried = (places.join(prefix, ["key", "size"]).where((start >= 0) & (start + F.col("width") <= F.col("run_words")))
             .select("row", "run", "size", start.alias("from"), "width").distinct()
             .groupBy("row", "run", "size").agg(F.collect_list(F.struct("from", "width")).alias("tried")))
    cut = (runs.withColumnRenamed("start", "run").join(tried, ["row", "run", "size"])
           .select("row", "run", "words", F.explode("tried").alias("t"))
           .select("row", (F.col("run") + F.col("t.from")).alias("lo"), F.col("t.width").alias("width"),
                   F.array_join(F.slice("words", F.col("t.from") + 1, F.col("t.width")), " ").alias("window")))
    texts = keep(windows.select("window"))
    equal = keep(cut.join(texts, "window"))  # the words at that place are the window's
    before = Window.partitionBy("row").orderBy("lo", "width").rowsBetween(Window.unboundedPreceding, -1)
    spans = equal.select("row", "lo", (F.col("lo") + F.col("width")).alias("hi"), "width").distinct()
    hits = (spans.withColumn("done", F.max("hi").over(before))
            .select("row", F.greatest(F.lit(0), F.col("hi") - F.greatest("lo", F.coalesce("done", "lo"))).alias("fresh"))
            .groupBy("row").agg(F.sum("fresh").cast("long").alias("n_hit")))
    of = items.select("window", F.col("item_id").cast("string").alias("item")).distinct()
    listed = (equal.select("row", "window").distinct().join(of, "window").select("row", "item").distinct()
              .groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items")))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (each.select("row", "doc_id", "n_words", *also).join(hits, "row", "left").join(listed, "row", "left")
            .select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
                    ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), *also))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go, each row by its own text."""
    docs, row = numbered(docs)
    found = contamination(spark, docs.select("doc_id", "text", F.col(row).alias("of")), table(spark, sf_dir, "benchmark"), "of")
    return without(docs, row, found.where("contaminated").select("of"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS t
       FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i
             FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS t
       FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, ks WHERE len(w) >= k)),
m AS (SELECT doc_id, i, dw.k AS k, item_id FROM dw JOIN bw ON dw.t = bw.t AND dw.k = bw.k),
h AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS l
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(it.n, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id
"""
