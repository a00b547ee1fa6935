"""SentencePiece encoding and decoding by shared-prefix Viterbi.

The vocabulary's scores make it a unigram model: the ids of a text are the best-scoring pieces (of equals, those with the longest
last piece first). No piece crosses from a word to the next mark, so marked words (a run of marks and what follows) are
independent. The distinct marked words of a batch are sorted, which lays out their trie, and walked in that order depth first; a word keeps the forward scores of
the prefix that it shares with the one before. Characters without a piece become byte pieces at the price of an unknown one, so that decoding returns the text.

Words already seen stay in two tables of at most ``TABLE_BYTES`` each in a Python worker; long ones aren't kept. The pipeline's
stage empties them after each task, as other stages run in the same workers. Null and empty texts have no ids and decode to empty. The mark U+2581
in a text decodes to a space. Rows are independent of one another, other columns don't matter.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from adspark.llm.common import map_arrow, small_batches, table

MARK, UNKNOWN_PENALTY = "▁", 10.0
#: Bytes of the table of words, what Python needs for an entry, and the longest word kept (characters).
TABLE_BYTES, ENTRY, LONGEST = 128 << 20, 250, 64
WORD = re.compile(f"{MARK}+[^{MARK}]*")


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces with scores, byte pieces, and what ids decode to."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, tuple[float, int]] = {}
        self.byte: dict[int, int] = {}
        self.out: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.out.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.out.append(b"")
            else:
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"a piece that joins words: {piece!r}")
                self.score[piece] = (sp.get_score(i), i)
                self.out.append(piece.replace(MARK, " ").encode())
        if len(self.byte) < 256:
            raise ValueError("the vocabulary has no byte pieces")
        self.unknown = min(s for s, _ in self.score.values()) - UNKNOWN_PENALTY
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.known_bytes = 0
        #: By the last three characters of pieces, their lengths, longest first.
        self.lengths: dict[str, list[int]] = {}
        for piece in sorted(self.score, key=len, reverse=True):
            if len(piece) > 2 and len(piece) not in (known := self.lengths.setdefault(piece[-3:], [])):
                known.append(len(piece))

    def _extend(self, word: str, start: int, best: list[float], back: list[int]) -> None:
        """Forward scores of the prefixes of ``word`` longer than ``start``."""
        score, lengths = self.score, self.lengths
        del best[start + 1:], back[start + 1:]
        for j in range(start + 1, len(word) + 1):
            top, at = float("-inf"), -1
            for n in lengths.get(word[j - 3:j], ()) if j > 2 else ():
                if n <= j and (got := score.get(word[j - n:j])) is not None and best[j - n] + got[0] > top:
                    top, at = best[j - n] + got[0], j - n
            if j > 1 and (got := score.get(word[j - 2:j])) is not None and best[j - 2] + got[0] > top:
                top, at = best[j - 2] + got[0], j - 2
            got = score.get(word[j - 1])
            value = best[j - 1] + (self.unknown if got is None else got[0])
            if value > top:
                top, at = value, j - 1
            best.append(top)
            back.append(at)

    def _ids(self, word: str, back: list[int]) -> bytes:
        j, out = len(word), []
        while j > 0:
            i = back[j]
            got = self.score.get(word[i:j])
            if got:
                out.append(got[1])
            else:
                out += [self.byte[b] for b in reversed(word[i:j].encode())]
            j = i
        out.reverse()
        return pack(f"<{len(out)}I", *out)

    def learn(self, words: set[str]) -> None:
        """Ids of marked words, in the order of their trie."""
        best, back, before = [0.0], [-1], ""
        for word in sorted(words):
            shared, most = 1 if before else 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            self._extend(word, shared, best, back)
            self.known[word] = self._ids(word, back)
            before = word

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if self.known_bytes > TABLE_BYTES:  # the words in use stay, those of two tables ago go
            self.known, self.older, self.known_bytes = {}, self.known, 0
        new = set().union(*split) - self.known.keys() if split else set()
        again = new & self.older.keys()
        self.known.update((w, self.older[w]) for w in again)
        new -= again
        self.learn(new)
        get = self.known.__getitem__
        out = [b"".join(map(get, words)) for words in split]
        for word in new | again:
            if len(word) > LONGEST:  # whole paragraphs, where a script has no spaces
                del self.known[word]
            else:
                self.known_bytes += ENTRY + 2 * len(word) + len(self.known[word])
        return out

    def forget(self) -> None:
        """Empty the tables of words."""
        self.known, self.older, self.known_bytes = {}, {}, 0

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.out.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return text.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encoded(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``docs`` with token_ids, their number n_tokens, and text as it decodes from them; null texts become empty."""
    path = model or default_model()
    kept = [c for c in docs.columns if c.lower() not in ("token_ids", "n_tokens")]  # Spark compares names without case
    docs = docs.select(*kept)
    at = kept.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        try:
            for batch in batches:
                texts = [t.as_py() or "" for t in batch.column("text")]
                for k in range(0, max(1, len(texts)), 100):  # a bounded number of texts share a trie
                    part = batch.slice(k, 100)
                    ids = v.encode(texts[k:k + 100])
                    n = [len(x) // 4 for x in ids]
                    flat = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), flat)
                    field = batch.schema.field(at)
                    part = part.set_column(at, pa.field("text", field.type, True), pa.array([v.decode(x) for x in ids], field.type))
                    yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(n, pa.int64())], [*part.schema.names, "token_ids", "n_tokens"])
        finally:
            v.forget()

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("token_ids", ArrayType(IntegerType())), StructField("n_tokens", LongType())]))


def round_trips(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, text_sha256 (of the decoded text) and round_trip for each row of ``docs``."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column("text")]
            out = []
            for k in range(0, len(texts), 100):
                for text, ids in zip(texts[k:k + 100], v.encode(texts[k:k + 100])):
                    again = v.decode(ids)
                    out.append((len(ids) // 4, zlib.crc32(ids), hashlib.sha256(again.encode()).hexdigest(), again == text.replace(MARK, " ")))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[k] for r in out], t) for k, t in enumerate(kinds))],
                                             ["doc_id", "n_tokens", "ids_crc32", "text_sha256", "round_trip"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                     "doc_id long, n_tokens long, ids_crc32 long, text_sha256 string, round_trip boolean")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded(docs)
