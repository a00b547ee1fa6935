"""Token ids as length-limited canonical Huffman code.

Texts are encoded once; whole-corpus counts of ids give code lengths by package-merge, limited to ``LIMIT`` bits. Documents go in ascending
doc_id order into shards and, inside them, into blocks of about ``BLOCK`` ids. A block stands alone: its documents' ids and lengths, its bits, and the bit offset of
every ``STEP``-th id. Decoding looks up ``LIMIT`` bits at a time in a table and advances all checkpoints of a block in step. The file
is a table of blocks (Parquet as container) beside the table of code lengths; both survive lost executors as any written table does.

White space separates words for this tokenizer, and so do borders between letters and punctuation. Arrow splits some megabytes of text into words and numbers the distinct
ones; of those only new ones are cut into pieces, and only new pieces go through the library. The ids of a batch are then gathered by
number. Words and pieces already seen stay in tables of at most ``TABLE_BYTES``; long ones aren't kept. Texts that hold the start of
a special token (``<|``) go through the library whole. Null texts count as empty and get the end id alone. A null doc_id sorts first. Rows with
equal doc_id stand in order of a hash of their ids. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from adspark.llm.common import gathered, keep, map_arrow, table

END, LIMIT, BLOCK, STEP, SHARD = 1, 18, 1 << 18, 256, 1 << 22
#: Bytes of the tables of words and of pieces, what Python needs for an entry, and the longest word kept (characters).
TABLE_BYTES, ENTRY, LONGEST = 128 << 20, 200, 64
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"
#: Letters up to punctuation, punctuation (no apostrophe) up to a letter, whatever else stands between white space, or the border of two words.
PIECE = re.compile(rf"[{LETTERS}]+(?![^\s{MARKS}])|[{MARKS}]+(?![^\sA-Za-z])|\S+|\n", re.ASCII)

#: Stands for the border of two words; no vocabulary is that large.
BORDER = b"\xff\xff"
SIMPLE = re.compile(rf"[{LETTERS}]+|[{MARKS}]+")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of texts as little-endian unsigned 16-bit integers, the end id after each."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() >= 1 << 16:
            raise ValueError("ids of more than 16 bits")
        self.ends = np.zeros(1 << 16, bool)  # pieces that end a word
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.pieces: dict[str, bytes] = {}
        self.piece_bytes = 0
        self._empty()

    def _empty(self) -> None:
        """No words but the end id, which stands as word 0."""
        self.numbers: dict[str, int] = {}
        self.ids, self.used = np.array([END], "<u2"), 1
        self.offset = np.array([0, 2], np.int32)  # where each word's ids begin, in bytes, and where the last ends
        self.words, self.word_bytes = 1, 0

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> list[tuple[str, bytes]]:
        """Pieces of letters or punctuation alone are encoded as one text and parted after the pieces that end a word."""
        simple = [w for w in pieces if SIMPLE.fullmatch(w)]
        rest = [w for w in pieces if not SIMPLE.fullmatch(w)]
        found: list[tuple[str, bytes]] = []
        for k in range(0, len(simple), 1000):
            part = simple[k:k + 1000]
            ids = self._ids([" ".join(part)])[0]
            at = (2 * np.flatnonzero(self.ends[np.frombuffer(ids, "<u2")]) + 2).tolist()
            if len(at) == len(part):
                found += zip(part, map(ids.__getitem__, map(slice, [0, *at], at)))
            else:
                rest += part
        return found + list(zip(rest, self._ids(rest)))

    def _of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, one after the other, and how many each has."""
        if self.piece_bytes > TABLE_BYTES:
            self.pieces, self.piece_bytes = {}, 0
        split = PIECE.findall("\n".join([*words, ""]))
        found = self._learn(list(set(split) - self.pieces.keys() - {"\n"}))
        pieces = self.pieces
        pieces.update(found)
        pieces["\n"] = BORDER
        flat = np.frombuffer(b"".join(map(pieces.__getitem__, split)), "<u2")
        self.piece_bytes += ENTRY * len(found) + sum(len(p) + len(ids) for p, ids in found)
        for p, ids in found:
            if len(p) > LONGEST:
                del pieces[p]
                self.piece_bytes -= ENTRY + len(p) + len(ids)
        border = flat == 0xFFFF
        return flat[~border], np.diff(np.flatnonzero(border), prepend=-1) - 1

    def _append(self, new: np.ndarray, size: np.ndarray) -> None:
        need, words = self.used + len(new), self.words + len(size)
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.empty(need, "<u2")])  # doubles at least
        self.ids[self.used:need] = new
        if words >= len(self.offset):
            self.offset = np.concatenate([self.offset[:self.words + 1], np.zeros(words, np.int32)])
        self.offset[self.words + 1:words + 1] = 2 * (self.used + np.cumsum(size))
        self.used, self.words = need, words

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The number of each distinct word; those of words that aren't kept hold until :meth:`encode` is done."""
        out = np.fromiter(map(self.numbers.get, words, repeat(-1)), np.int64, len(words))
        new = [words[k] for k in np.flatnonzero(out < 0).tolist()]
        long = np.fromiter(map(len, new), np.int64, len(new)) > LONGEST
        order = np.argsort(long, kind="stable")
        new, kept = [new[k] for k in order.tolist()], len(new) - int(long.sum())
        at = np.empty(len(new), np.int64)
        at[order] = self.words + np.arange(len(new))
        out[out < 0] = at
        ids, size = self._of_words(new)
        border = int(size[:kept].sum())
        self.numbers.update(zip(new[:kept], range(self.words, self.words + kept)))
        self.word_bytes += (ENTRY + 16) * kept + sum(map(len, new[:kept])) + 2 * border
        self._append(ids[:border], size[:kept])
        self.kept = self.words, self.used
        self._append(ids[border:], size[kept:])
        return out

    def encode(self, texts: pa.Array) -> pa.Array:
        if not len(texts):
            return pa.array([], pa.binary())
        if self.word_bytes > TABLE_BYTES:
            self._empty()
        texts = pc.fill_null(texts, "")
        special = np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)).tolist()
        plain = pc.if_else(pc.match_substring(texts, "<|"), "", texts) if special else texts
        split = pc.ascii_split_whitespace(plain)
        words = split.flatten().dictionary_encode()
        lower = lowered(words.dictionary).dictionary_encode()
        end = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64))
        number = self._numbers(lower.dictionary.to_pylist())[lower.indices.to_numpy(zero_copy_only=False)][words.indices.to_numpy(zero_copy_only=False)]
        number = np.insert(number, end, 0)  # the end id after each text
        known = pa.Array.from_buffers(pa.binary(), self.words, [None, pa.py_buffer(self.offset[:self.words + 1]), pa.py_buffer(self.ids[:self.used])])
        ids = known.take(pa.array(number))
        offsets = np.frombuffer(ids.buffers()[1], np.int32)[np.concatenate([[0], end + np.arange(1, len(end) + 1)])]
        out = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), ids.buffers()[2]])
        self.words, self.used = self.kept
        if special:
            out = out.to_pylist()
            for k, x in zip(special, self._ids([texts[k].as_py() for k in special])):
                out[k] = x + np.array([END], "<u2").tobytes()
            out = pa.array(out, pa.binary())
        return out


def lowered(words: pa.Array) -> pa.Array:
    """Lower case where the tokenizer's own lower case can't differ: words of Latin-1 alone."""
    return pc.if_else(pc.match_substring_regex(words, "[^\\x{00}-\\x{ff}]"), words, pc.utf8_lower(words))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (binary) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for part in gathered(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), e.encode(part.column("text"))], ["doc_id", "ids"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, ids binary")


def id_counts(ids: DataFrame) -> dict[int, int]:
    """How often each id occurs: at most one row for each id of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for x in batch.column("ids"):
                total += np.bincount(np.frombuffer(x.as_buffer(), "<u2"), minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    return {r.id: r.n for r in map_arrow(ids.select("ids"), run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()}


def code_lengths(weights: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge; one symbol has length 1)."""
    n = len(weights)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError("more symbols than codes")
    order = np.argsort(weights, kind="stable")
    leaves = np.asarray(weights)[order].astype(np.float64)
    levels, merged = [], leaves
    for _ in range(limit):
        if levels:
            pairs = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
            both = np.concatenate([leaves, pairs])
            at = np.argsort(both, kind="stable")  # leaves before packages of the same weight
            merged, leaf = both[at], at < n
        else:
            leaf = np.ones(n, bool)
        levels.append(leaf)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(levels):
        own = int(leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical codes of ids, and the table that decodes them."""

    def __init__(self, lengths: dict[int, int]):
        ids = sorted(lengths, key=lambda i: (lengths[i], i))
        self.bits = max(lengths.values(), default=1)
        self.length, self.code = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.uint64)
        self.symbol, self.width = np.zeros(1 << self.bits, np.uint16), np.ones(1 << self.bits, np.int64)
        code = before = 0
        for i in ids:
            code <<= lengths[i] - before
            before = lengths[i]
            self.code[i], self.length[i] = code, before
            first = code << (self.bits - before)
            self.symbol[first:first + (1 << (self.bits - before))] = i
            self.width[first:first + (1 << (self.bits - before))] = before
            code += 1

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bits, first one highest, and the bit offset of every STEP-th id."""
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        n = self.length[ids]
        end = np.cumsum(n)
        pos = end - n
        word, shift = pos >> 6, 64 - (pos & 63) - n
        code = self.code[ids]
        inside = np.where(shift >= 0, code << np.maximum(shift, 0).astype(np.uint64), code >> np.maximum(-shift, 0).astype(np.uint64))
        out = np.zeros(int(word[-1]) + 2, np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[first]] = np.bitwise_or.reduceat(inside, first)
        over = np.flatnonzero(shift < 0)
        out[word[over] + 1] |= code[over] << (64 + shift[over]).astype(np.uint64)
        return out.astype(">u8").tobytes()[:(int(end[-1]) + 7) // 8], pos[::STEP].copy()

    def decode(self, data: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """The n ids of a block; all checkpoints advance together, one table look-up an id."""
        if not n:
            return np.zeros(0, np.uint16)
        raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint32)
        at = (raw[:-3] << np.uint32(24)) | (raw[1:-2] << np.uint32(16)) | (raw[2:-1] << np.uint32(8)) | raw[3:]
        pos, last = checkpoints.astype(np.int64), 8 * len(data)
        out = np.empty((STEP, len(pos)), np.uint16)
        mask = (1 << self.bits) - 1
        for k in range(STEP):
            look = (at[pos >> 3] >> (32 - self.bits - (pos & 7)).astype(np.uint32)) & np.uint32(mask)
            out[k] = self.symbol[look]
            pos = np.minimum(pos + self.width[look], last)
        return out.T.ravel()[:n]


BLOCKS = "shard int, block int, doc_ids array<long>, lengths array<long>, checkpoints array<long>, bits binary"


def write_ids(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Write ids as blocks in ascending doc_id order. Returns the written tables: blocks, and code lengths (id, bits)."""
    spark = ids.sparkSession
    counts = id_counts(ids)
    symbols = sorted(counts)
    lengths = dict(zip(symbols, code_lengths(np.array([counts[s] for s in symbols], np.int64)).tolist()))
    codes = keep(spark.createDataFrame(sorted(lengths.items()), "id int, bits int"))
    shared = spark.sparkContext.broadcast(lengths)  # at most the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, shard, number = Code(shared.value), TaskContext.get().partitionId(), 0
        docs: list = []
        parts: list[np.ndarray] = []
        held = 0

        def block() -> pa.RecordBatch:
            bits, checkpoints = code.encode(np.concatenate(parts))
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([docs], pa.list_(pa.int64())),
                 pa.array([[len(x) for x in parts]], pa.list_(pa.int64())), pa.array([checkpoints.tolist()], pa.list_(pa.int64())),
                 pa.array([bits], pa.binary())], ["shard", "block", "doc_ids", "lengths", "checkpoints", "bits"])

        for batch in batches:
            for doc_id, x in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                docs.append(doc_id)
                parts.append(np.frombuffer(x.as_py(), "<u2"))
                held += len(parts[-1])
                if held >= BLOCK:
                    yield block()
                    docs, parts, held, number = [], [], 0, number + 1
        if docs:
            yield block()

    shards = max(1, ceil(sum(counts.values()) / SHARD))
    order = ["doc_id", "tie", "row"]  # the last parts rows that are equal, so that no task gets them all
    rows = ids.withColumn("tie", F.xxhash64("ids")).withColumn("row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "ids")
    return keep(map_arrow(ordered, run, BLOCKS)), codes


def read_ids(blocks: DataFrame, codes: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit, binary) of every document, in the file's order of start.

    Blocks learn where they start while they are compressed; what is decoded isn't shuffled.
    """
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast({r.id: r.bits for r in codes.collect()})  # at most the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(shared.value)
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1)
                get = lambda c: row.column(c).flatten().to_numpy(zero_copy_only=False)
                n = get("lengths").astype(np.int64)
                got = code.decode(row.column("bits")[0].as_py(), get("checkpoints"), int(n.sum())).astype("<u4")
                end = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [row.column("doc_ids").flatten(), pa.array(row.column("first")[0].as_py() + end - n), pa.array(n),
                     pa.array([got[a:b].tobytes() for a, b in zip((end - n).tolist(), end.tolist())], pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    sizes = keep(blocks.select("shard", "block", size.alias("n")))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row a shard: a shard holds SHARD ids, so this is a small table even for a large corpus.
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n")).select("shard", before(Window.orderBy("shard")).alias("shard_start"))
    starts = keep(sizes.withColumn("block_start", before(Window.partitionBy("shard").orderBy("block"))).join(shards, "shard")
                  .select("shard", "block", (F.col("shard_start") + F.col("block_start")).cast("long").alias("first")))
    return map_arrow(blocks.join(starts, ["shard", "block"]).drop("shard", "block"), run, "doc_id long, start long, n_tokens long, ids binary")


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = keep(token_ids(table(spark, sf_dir, "documents"), default_tokenizer()))
    return read_ids(*write_ids(ids)).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
