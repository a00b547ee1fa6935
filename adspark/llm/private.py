"""Personal data by weak supervision.

Base spans are exact patterns with checks (Luhn, parts of an address, number of digits). Looser patterns propose more spans of the same
kinds: spelt-out addresses, numbers in other groupings, addresses of version six. On every proposed span five labelers vote for, against or not
at all: the base rule, a shape check, a gazetteer (endings of domains, card issuers, address ranges, calling codes: :mod:`adspark.llm.gazetteer`), cue words before the span, and its borders. Expectation
maximisation over all spans of all documents, counted by pattern of votes, estimates how reliable each labeler is for each kind without any
label; its posteriors train a logistic classifier on votes and shape, which decides on the spans that aren't base. Those are added where
they overlap no base span; base spans always stay.

What is collected are counts by pattern of votes and shape: a bounded number, whatever the input. Offsets are code points, ends exclusive. Null
texts count as empty. Rows that share a doc_id are independent. Other columns are ignored. Every scan is linear in the text.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from adspark.llm.common import map_arrow, small_batches, table
from adspark.llm.gazetteer import Gazetteer

KINDS = ("email", "ip", "card", "phone")
ACCEPT, ROUNDS = 0.9, 50
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOOSE = {
    "email": re.compile(r"(?<![\w.+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]{1,63}+){1,8}"),
    "ip": re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])"),
    "card": re.compile(r"(?<![0-9./])[0-9]{4}([./])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9./])"),
    "phone": re.compile(r"(?<![0-9.+/-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-]*[0-9])|(?<![0-9.+/-])00[1-9][0-9](?:[ -]?[0-9]){6,12}(?![0-9])"),
}
# Cue words in four languages.
CUES = {
    "email": {"mail", "email", "e-mail", "contact", "kontakt", "correo", "courriel", "write", "schreiben"},
    "ip": {"ip", "host", "server", "address", "adresse", "client", "from"},
    "card": {"card", "visa", "mastercard", "karte", "carte", "tarjeta", "credit", "payment"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "telefon", "anruf", "appel", "telefono", "llame"},
}
LISTS = Gazetteer()
GROUPED = re.compile(r"[0-9]{3}\)?[ .-]+[0-9]{3}[ .-][0-9]{4}$")
VOTERS = 5


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping: from each @, the run of local characters before it that isn't used yet, and the domain after it."""
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        before = len(LOCAL.match(text[max(free, at - 256):at][::-1])[0])
        if before == 256 and at - 256 > free:  # a long run: look at all of it
            before = len(LOCAL.match(text[free:at][::-1])[0])
        m = DOMAIN.match(text, at + 1) if before else None
        if m:
            found.append((at - before, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(free, at + 1))
    return found


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    out = {k: [] for k in KINDS}
    out["email"] = emails(text)
    for m in IP.finditer(text):
        if all(int(x) <= 255 if len(x) < 9 else int(x.lstrip("0")[:4] or 0) <= 255 and len(x.lstrip("0")) <= 3 for x in m[0].split(".")):
            out["ip"].append(m.span())
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = digits_of(m[0])
            if 13 <= len(d) <= 19 and luhn(d):
                out["card"].append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m[0])) <= 15:
                out["phone"].append(m.span())
    return out


def loose_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    out = {k: [] for k in KINDS}
    if "at)" in text or "at]" in text or "at}" in text:
        out["email"] = [m.span() for m in LOOSE["email"].finditer(text)]
    if ":" in text:
        out["ip"] = [m.span() for m in LOOSE["ip"].finditer(text)]
    for m in CARD.finditer(text):  # numbers of the right length that fail a check
        if 13 <= len(digits_of(m[0])) <= 19:
            out["card"].append(m.span())
    out["card"] += [m.span() for m in LOOSE["card"].finditer(text)]
    out["ip"] += [m.span() for m in IP.finditer(text)]
    out["phone"] = [m.span() for m in LOOSE["phone"].finditer(text)]
    return out


def votes(text: str, kind: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    """Of each labeler 1, -1 or 0."""
    s = text[start:end]
    d = digits_of(s)
    if kind == "email":
        ending = re.split(r"[.)\]} ]+", s)[-1].lower()
        shape = 1 if 2 <= len(ending) <= 12 and ending.isalpha() else -1
        known = LISTS.domain(ending)
    elif kind == "ip":
        parts = s.split(".") if "." in s else []
        shape = 1 if not parts or all(len(p) <= 3 and int(p) <= 255 for p in parts) else -1
        known = LISTS.address(s)
    elif kind == "card":
        shape = 1 if luhn(d) else -1
        known = LISTS.card(d)
    else:
        shape = 1 if 9 <= len(d) <= 15 else -1
        known = LISTS.phone(s, d) or (1 if GROUPED.search(s) else 0)
    cue = 1 if CUES[kind] & set(re.findall(r"[\w-]+", text[max(0, start - 40):start].lower())) else 0
    near = text[max(0, start - 1):start] + text[end:end + 1]
    border = -1 if any(c.isalnum() or c in "_/=&" for c in near) else 1
    return (1 if base else -1, shape, known, cue, border)


def shape_of(text: str, start: int, end: int) -> tuple[int, ...]:
    """Length in steps of four up to 10, separators up to 5, letters or not: coarse, so that patterns are few."""
    s = text[start:end]
    return min(10, len(s) // 4), min(5, sum(not c.isalnum() for c in s)), int(any(c.isalpha() for c in s))


def proposed(text: str) -> Iterator[tuple[str, int, int, bool, tuple[int, ...]]]:
    """Kind, start, end, whether base, and the pattern (votes and shape) of every proposed span."""
    base, loose = base_spans(text), loose_spans(text)
    for kind in KINDS:
        own = set(base[kind])
        for start, end in base[kind]:
            yield kind, start, end, True, votes(text, kind, start, end, True) + shape_of(text, start, end)
        for start, end in sorted(set(loose[kind]) - own):
            yield kind, start, end, False, votes(text, kind, start, end, False) + shape_of(text, start, end)


def _pattern_counts(docs: DataFrame) -> list[tuple[str, tuple[int, ...], int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen.update((kind, pattern) for kind, _, _, _, pattern in proposed(text.as_py() or ""))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in seen], pa.string()), pa.array([list(p) for _, p in seen], pa.list_(pa.int32())),
             pa.array(list(seen.values()), pa.int64())], ["kind", "pattern", "n"])

    rows = map_arrow(docs.select("text"), run, "kind string, pattern array<int>, n long").groupBy("kind", "pattern").agg(F.sum("n").alias("n"))
    return [(r.kind, tuple(r.pattern), r.n) for r in rows.orderBy("kind", "pattern").collect()]


def estimate(patterns: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Posteriors of patterns of votes by expectation-maximisation over tables of votes given the truth, weighted by counts."""
    p = np.where(patterns.sum(axis=1) > 0, 0.9, 0.1)
    for _ in range(ROUNDS):
        score = np.zeros((2, len(n)))
        for truth, mass in ((1, p * n), (0, (1 - p) * n)):
            score[truth] += np.log(mass.sum() + 1) - np.log(n.sum() + 2)
            for j in range(patterns.shape[1]):
                for v in (-1, 0, 1):
                    chosen = patterns[:, j] == v
                    score[truth][chosen] += np.log((mass[chosen].sum() + 0.5) / (mass.sum() + 1.5))
        p = 1 / (1 + np.exp(np.clip(score[0] - score[1], -500, 500)))
    return p


def _features(patterns: np.ndarray) -> np.ndarray:
    """Votes for and against, and the shape: intercept first."""
    v = patterns[:, :VOTERS]
    return np.column_stack([np.ones(len(v)), v > 0, v < 0, patterns[:, VOTERS:] / np.array([10.0, 5.0, 1.0])]).astype(float)


def train(counts: list[tuple[str, tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Coefficients of the span classifier for each kind."""
    model = {}
    for kind in KINDS:
        rows = [(p, n) for k, p, n in counts if k == kind]
        if not rows:
            continue
        patterns, n = np.array([p for p, _ in rows]), np.array([x for _, x in rows], float)
        y, x = estimate(patterns[:, :VOTERS], n), _features(patterns)
        beta = np.zeros(x.shape[1])
        for _ in range(30):  # Newton's method with a ridge penalty
            q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            beta += np.linalg.solve((x * (n * q * (1 - q))[:, None]).T @ x + np.eye(len(beta)), x.T @ (n * (y - q)) - beta)
        model[kind] = beta
    return model


def spans(text: str, model: dict[str, np.ndarray]) -> tuple[dict[str, list[tuple[int, int]]], dict[str, list[tuple[int, int]]]]:
    """Base spans and all spans, by kind."""
    base, extra = {k: [] for k in KINDS}, []
    for kind, start, end, is_base, pattern in proposed(text):
        if is_base:
            base[kind].append((start, end))
        elif kind in model and 1 / (1 + np.exp(-np.clip(_features(np.array([pattern]))[0] @ model[kind], -30, 30))) >= ACCEPT:
            extra.append((start, end, kind))
    found = {k: list(v) for k, v in base.items()}
    begins, ends = [], []  # what base spans cover, as ranges apart
    for a, b in sorted(x for v in base.values() for x in v):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            begins.append(a)
            ends.append(b)
    free = 0
    for start, end, kind in sorted(extra):
        k = bisect_left(begins, end) - 1  # the last range that begins before the end
        if start >= free and (k < 0 or ends[k] <= start):
            found[kind].append((start, end))
            free = end
    return base, {k: sorted(v) for k, v in found.items()}


def _joined(found: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in found[k])


def mask(text: str, found: dict[str, list[tuple[int, int]]]) -> str:
    """The text with a mark in place of each span; of overlapping spans the outer borders count."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, v in found.items() for a, b in v):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, base_sha256, spans and masked for each row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = train(_pattern_counts(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text"):
                t = text.as_py() or ""
                base, found = spans(t, model)
                out.append((*(len(base[k]) for k in KINDS), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(found), mask(t, found)))
            cols = [pa.array([r[k] for r in out], pa.int64() if k < 4 else pa.large_string() if k == 6 else pa.string()) for k in range(7)]
            cols[6] = cols[6].cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols],
                                             ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "masked"])

    return map_arrow(docs, run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, masked string")


def masked_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans of text replaced by marks and n_chars adjusted; all other columns and nulls stay."""
    model = train(_pattern_counts(docs))
    spark = docs.sparkSession
    at = docs.columns.index("text")
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            done = [t if t is None else mask(t, spans(t, model)[1]) for t in texts]
            yield batch.set_column(at, batch.schema.field(at), pa.array(done, batch.schema.field(at).type))

    small_batches(spark)
    out = docs.mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents")).drop("masked")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to marks of its kind."""
    return masked_texts(docs)
