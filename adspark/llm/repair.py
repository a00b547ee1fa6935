"""Cheapest repair of the turn structure of conversations, by a Viterbi search that runs in chunks at once.

The grammar of role initials is ``(s?(ua)+)?``: four states (start, after s, after u, after a). Costs run backwards, from the end of a conversation: the cost vector of a
place holds, for each state, the least cost of what follows. Rows are ordered by a range sort and cut into chunks. A conversation inside one chunk is
solved at once. Longer ones are solved by rank convergence: every chunk starts from a speculative vector at its end; in each fix-up pass those
whose successor now begins with another vector run again, beside their earlier run, only until both differ by a constant, from where on
the earlier run holds. When no chunk changes, each traces the least audit from each of the four states by its stitched
costs, the four outcomes are composed over the chunks, and each chunk writes what it does from the state it is in.

Edits: Keep costs 0, Rerole (to user or assistant) 1, Delete 2, Insert (an empty user or assistant turn) 5; a truncated row costs 5 more unless deleted;
blank and duplicate rows must be deleted. Of the cheapest audits the ASCII-least counts: at each place D, I, K, R in this order, if still cheapest.

Rows are ordered by conv_id, turn (null first), role, hash of the text. A null role or text counts as one space, so its row is blank or
of no known role. A null conv_id names one conversation. Repeated rows are duplicates. Other columns are ignored.
A digest over a conversation is serial: its chunks' texts, joined before, stream through one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adspark.llm.common import joined_sha256, keep, map_arrow, table

KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
START, S, U, A = range(4)
#: What a role initial leads to from each state, None where the grammar has no such step.
STEP = {"s": (S, None, None, None), "u": (U, U, None, U), "a": (None, None, A, None)}
NEXT = (U, U, A, U)  # the state after the user or assistant turn that the state asks for
ROLE = {U: "user", A: "assistant"}
FAR = 1 << 40
END = (0, 2 * INSERT, INSERT, 0)  # nothing left: start and after a are complete, the others insert
CHUNK_ROWS, CHUNK_BYTES = 1024, 1 << 16
BLANKS = "\\x20\\x09-\\x0D"

RowCode = tuple[str, bool, bool]  # role initial, must be deleted, truncated


def inserted(v: tuple) -> tuple:
    """The vector when turns may be inserted first."""
    v = list(v)
    for _ in range(2):
        v = [min(c, INSERT + v[NEXT[k]]) for k, c in enumerate(v)]
    return tuple(v)


def before(code: RowCode, v: tuple) -> tuple:
    """The cost vector before a row, from that after it."""
    initial, bad, cut = code
    out = []
    for k, rest in enumerate(v):
        least = DELETE + rest
        if not bad:
            more = CUT if cut else 0
            to = STEP.get(initial, (None,) * 4)[k]
            least = min(least, FAR if to is None else KEEP + more + v[to], REROLE + more + v[NEXT[k]])
        out.append(least)
    return inserted(tuple(out))


class Costs:
    """:func:`before` on vectors less their least entry; few such vectors exist, so each step is computed once."""

    def __init__(self):
        self.known: dict = {}

    def step(self, code: RowCode, v: tuple) -> tuple[tuple, int]:
        found = self.known.get((code, v))
        if found is None:
            out = before(code, v)
            low = min(out)
            found = self.known[code, v] = (tuple(c - low for c in out), low)
        return found

    def run(self, codes: list[RowCode], end: tuple) -> tuple[tuple, int]:
        """The vector before the first row, less its least entry, and that entry, for a vector ``end`` whose least entry is 0."""
        total = 0
        for code in reversed(codes):
            end, more = self.step(code, end)
            total += more
        return end, total

    def rerun(self, codes: list[RowCode], end: tuple, earlier: tuple) -> tuple[bool, tuple, int]:
        """As :meth:`run`, beside the run from ``earlier``: whether they met, and if so how much more the new one costs."""
        gap = 0
        for code in reversed(codes):
            if end == earlier:
                return True, end, gap
            end, a = self.step(code, end)
            earlier, b = self.step(code, earlier)
            gap += a - b
        return end == earlier, end, gap

    def trace(self, codes: list[RowCode], end: tuple, state: int, last: bool) -> tuple[str, list, int]:
        """Edits from ``state``: their initials, what stays (role or None for the row's own, number of the row or None), and the state at the end."""
        vectors = [end]
        for code in reversed(codes):
            v, _ = self.step(code, vectors[-1])
            vectors.append(v)
        vectors.reverse()
        audit, out, i = [], [], 0
        while i < len(codes) or last and state not in (START, A):
            if i == len(codes):
                state = NEXT[state]
                audit.append("I")
                out.append((ROLE[state], None))
                continue
            initial, bad, cut = codes[i]
            now, after, more = vectors[i], vectors[i + 1], CUT if cut else 0
            # the vectors lack a constant each; a deletion or insertion can't be compared without it
            constant = self.step(codes[i], after)[1]
            to = STEP.get(initial, (None,) * 4)[state]
            if now[state] + constant == DELETE + after[state]:
                audit.append("D")
                i += 1
            elif now[state] == INSERT + now[NEXT[state]]:
                state = NEXT[state]
                audit.append("I")
                out.append((ROLE[state], None))
            elif not bad and to is not None and now[state] + constant == more + after[to]:
                state = to
                audit.append("K")
                out.append((None, i))
                i += 1
            else:
                state = NEXT[state]
                audit.append("R")
                out.append((ROLE[state], i))
                i += 1
        return "".join(audit), out, state


def normal(v: tuple) -> tuple[tuple, int]:
    low = min(v)
    return tuple(c - low for c in v), low


def written(out: list, roles: list[str], texts: list[str]) -> str:
    return "\n".join((roles[i] if role is None else role) + ":" + ("" if i is None else texts[i]) for role, i in out)


def pair_is_illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


class Chunk:
    """Consecutive rows of a conversation: what they count by themselves, and what the neighbours need."""

    def __init__(self):
        self.turns, self.roles, self.texts, self.states, self.size = [], [], [], [], 0

    def add(self, turn, role: str, text: str, state: int) -> None:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.states.append(state)
        self.size += len(text) + len(role)

    def span(self) -> tuple:
        """First and last turn and the number of distinct turns, nulls apart, and the number of illegal pairs of neighbours."""
        turns = [t for t in self.turns if t is not None]
        first = [r[:1] for r in self.roles]
        return (turns[0] if turns else None, turns[-1] if turns else None, sum(a != b for a, b in zip(turns, [None, *turns])),
                sum(map(pair_is_illegal, first, first[1:])))


def codes_of(roles: list[str], states: list[int], repeated: list[bool]) -> tuple[list[RowCode], list[int]]:
    """The code of each row and the numbers of blank, duplicate and truncated rows; ``states`` are 1 for blank, 2 for truncated texts."""
    codes, counts = [], [0, 0, 0]
    for role, state, again in zip(roles, states, repeated):
        fault = 0 if state == 1 else 1 if again else 2 if state == 2 else None
        if fault is not None:
            counts[fault] += 1
        codes.append((role[:1] if role[:1] in STEP else "", fault in (0, 1), fault == 2))
    return codes, counts


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of ``conversations`` after the damage that the hash of conv_id and turn decides, copies by ``copy``."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fate = F.crc32(key) % 20
    text = F.coalesce(F.col("text").cast("string"), space)
    return (rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), fate.alias("fate"),
                        F.when(fate == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), space)).alias("role"),
                        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"))
            .where("fate <> 0")
            .withColumn("copy", F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .drop("fate"))


def text_state(text: Column) -> Column:
    """1 for a text of white space alone, 2 if its last other character ends no sentence, else 0."""
    return F.when(~text.rlike(f"[^{BLANKS}]"), 1).when(~text.rlike(f"[.!?][{BLANKS}]*\\z"), 2).otherwise(0)


PARTS = ("kind string, conv_id long, part int, chunk int, turns array<long>, roles array<string>, texts array<string>, states array<int>, "
         "first_turn long, last_turn long, distinct_turns long, illegal long, blank long, duplicate long, truncated long, cost long, audit string, repaired string")


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


SCHEMA = pa.schema([("kind", pa.string()), ("conv_id", pa.int64()), ("part", pa.int32()), ("chunk", pa.int32()), ("turns", pa.list_(pa.int64())),
                    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("states", pa.list_(pa.int32())),
                    *[(n, pa.int64()) for n in ("first_turn", "last_turn", "distinct_turns", "illegal", "blank", "duplicate", "truncated", "cost")],
                    ("audit", pa.string()), ("repaired", pa.string())])


def _solver(chunk_rows: int):
    """Ordered rows: whole conversations are solved, others (cut by a border of the range, or long) become rows of kind ``chunk``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs, part, number = Costs(), TaskContext.get().partitionId(), 0
        out, size = [], 0
        now, name, alone = Chunk(), None, False  # whether the chunk is its whole conversation; the first of a task may have begun earlier
        begun = False

        def close(whole: bool) -> dict:
            nonlocal number, size
            first, last, distinct, illegal = now.span()
            row = {"conv_id": name, "first_turn": first, "last_turn": last, "distinct_turns": distinct, "illegal": illegal}
            size += now.size + 40 * len(now.turns)
            if not whole:
                number += 1
                return row | {"kind": "chunk", "part": part, "chunk": number, "turns": now.turns, "roles": now.roles, "texts": now.texts, "states": now.states}
            seen: set = set()
            repeated = [(x in seen) or seen.add(x) is not None for x in zip(now.roles, now.texts)]
            codes, (blank, duplicate, truncated) = codes_of(now.roles, now.states, repeated)
            v, total = costs.run(codes, END)
            audit, kept, _ = costs.trace(codes, END, START, last=True)
            digest = hashlib.sha256(written(kept, now.roles, now.texts).encode()).hexdigest()
            return row | {"kind": "whole", "blank": blank, "duplicate": duplicate, "truncated": truncated, "cost": v[START] + total, "audit": audit, "repaired": digest}

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in ("conv_id", "turn", "role", "text", "state")]
            for conv, turn, role, text, state in zip(*columns):
                if begun and conv != name:
                    out.append(close(alone))
                    now, alone = Chunk(), True
                elif begun and (len(now.turns) >= chunk_rows or now.size >= CHUNK_BYTES):
                    out.append(close(False))
                    now, alone = Chunk(), False
                begun, name = True, conv
                now.add(turn, role, text, state)
            if size > 4 << 20:
                yield _batch(out, SCHEMA)
                out, size = [], 0
        if begun:
            out.append(close(False))  # the next task may go on with it
        if out:
            yield _batch(out, SCHEMA)

    return run


VECTORS = "conv_id long, chunk long, last boolean, codes array<string>, used array<long>, begin array<long>, cost long, told array<long>"


def _codes(packed: list[str]) -> list[RowCode]:
    return [(x[2:], x[0] == "1", x[1] == "1") for x in packed]


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A pass: chunks whose successor tells another beginning than they used (``told``) run again."""
    costs = Costs()
    for batch in batches:
        rows = batch.to_pylist()
        for x in rows:
            codes = _codes(x["codes"])
            if x["begin"] is None:
                used = END
                begin, cost = costs.run(codes, used)
            else:
                used = tuple(x["told"])
                met, end, gap = costs.rerun(codes, used, tuple(x["used"]))
                begin, cost = (tuple(x["begin"]) if met else end), x["cost"] + gap
            x |= {"used": list(used), "begin": list(begin), "cost": cost, "told": None}
        yield _batch(rows, batch.schema)


def converge(chunks: DataFrame) -> DataFrame:
    """conv_id, chunk, last, codes, used (the vector at the end), begin, cost (least entry before) of each chunk, stitched.

    Vectors are less their least entry, so chunks agree when the vectors that meet differ by constants.
    """
    empty = lambda kind: F.lit(None).cast(kind)
    wait = chunks.select("conv_id", "chunk", "last", "codes", empty("array<long>").alias("used"), empty("array<long>").alias("begin"),
                         empty("long").alias("cost"), empty("array<long>").alias("told"))
    now = keep(map_arrow(wait, _vectors, VECTORS))
    while True:
        after = now.select("conv_id", (F.col("chunk") - 1).alias("chunk"), F.col("begin").alias("next"))
        told = keep(now.drop("told").join(after.withColumnRenamed("conv_id", "c").withColumnRenamed("chunk", "k"),
                                          F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")), "left")
                    .withColumn("told", F.when(F.col("next") != F.col("used"), F.col("next"))).drop("c", "k", "next"))
        changed = told.where("told IS NOT NULL")
        if changed.isEmpty():
            return told.drop("told")
        now = keep(map_arrow(changed, _vectors, VECTORS).unionByName(told.where("told IS NULL")))


def _outcomes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state at the end of each chunk for each state at its beginning."""
    costs = Costs()
    for batch in batches:
        rows = [{"conv_id": x["conv_id"], "chunk": x["chunk"], "cost": x["cost"] + (x["begin"][START] if x["chunk"] == 1 else 0),
                 "ends": [costs.trace(_codes(x["codes"]), tuple(x["used"]), k, x["last"])[2] for k in range(4)]} for x in batch.to_pylist()]
        yield _batch(rows, pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("cost", pa.int64()), ("ends", pa.list_(pa.int64()))]))


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each chunk does from the state it is in."""
    costs = Costs()
    for batch in batches:
        for x in batch.to_pylist():
            audit, kept, _ = costs.trace(_codes(x["codes"]), tuple(x["used"]), x["state"], x["last"])
            yield _batch([{"conv_id": x["conv_id"], "chunk": x["chunk"], "audit": audit, "repaired": written(kept, x["roles"], x["texts"]) if kept else None}],
                         pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("audit", pa.string()), ("repaired", pa.string())]))


FOLDED = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("state", pa.int64()), ("total", pa.bool_()),
                    *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered chunks without texts: the state at each one's beginning, and a row with the sums of each conversation."""
    name, begun, sums = None, False, {}

    def total() -> dict:
        gaps = 0 if sums["low"] is None else sums["high"] - sums["low"] + 1 - sums["distinct"]
        return {"conv_id": name, "total": True, "gaps": gaps} | {k: sums[k] for k in ("blank", "duplicate", "truncated", "illegal", "cost")}

    for batch in batches:
        out = []
        for x in batch.to_pylist():
            if not begun or x["conv_id"] != name:
                if begun:
                    out.append(total())
                name, begun, state = x["conv_id"], True, START
                sums = {"low": None, "high": None, "distinct": 0, "initial": None} | dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
            for k in ("blank", "duplicate", "truncated", "illegal", "cost"):
                sums[k] += x[k]
            sums["illegal"] += sums["initial"] is not None and pair_is_illegal(sums["initial"], x["first_initial"])
            sums["initial"] = x["last_initial"]
            if x["first_turn"] is not None:
                sums["distinct"] += x["distinct_turns"] - (sums["high"] == x["first_turn"])
                sums["low"] = x["first_turn"] if sums["low"] is None else sums["low"]
                sums["high"] = x["last_turn"]
            out.append({"conv_id": name, "chunk": x["chunk"], "state": state, "total": False})
            state = x["ends"][state]
        yield _batch(out, FOLDED)
    if begun:
        yield _batch([total()], FOLDED)


def _same(a: DataFrame, b: DataFrame, *names: str) -> tuple[DataFrame, Column]:
    """``b`` with other names, and the condition that the columns ``names`` are equal, null being equal to null."""
    other = b
    for n in names:
        other = other.withColumnRenamed(n, f"_{n}")
    condition = F.lit(True)
    for n in names:
        condition = condition & F.col(n).eqNullSafe(F.col(f"_{n}"))
    return other, condition


def _long(chunks: DataFrame) -> DataFrame:
    """Conversations in several chunks: their sums, audit and digest."""
    numbered = keep(_numbered(chunks))
    rows = numbered.select("conv_id", "chunk", F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "x")).select(
        "conv_id", "chunk", "pos", F.sha2(F.concat(F.length("x.roles"), F.lit(":"), F.col("x.roles"), F.col("x.texts")), 256).alias("said"))
    first = rows.groupBy("conv_id", "said").agg(F.min(F.struct("chunk", "pos")).alias("at"))
    new = keep(first.groupBy("conv_id", F.col("at.chunk").alias("chunk")).agg(F.collect_list("at.pos").alias("new")))  # at most a chunk's rows
    other, same = _same(numbered, new, "conv_id", "chunk")
    coded = keep(map_arrow(numbered.drop("texts", "turns").join(other, same, "left").select(
        "conv_id", "chunk", "last", "roles", "states", F.coalesce("new", F.array().cast("array<int>")).alias("new"), "first_turn", "last_turn", "distinct_turns", "illegal"),
        _coded, "conv_id long, chunk long, last boolean, codes array<string>, first_turn long, last_turn long, distinct_turns long, illegal long, "
                "blank long, duplicate long, truncated long, first_initial string, last_initial string"))
    solved = keep(converge(coded))
    ends = map_arrow(solved, _outcomes, "conv_id long, chunk long, cost long, ends array<long>")
    other, same = _same(coded, ends, "conv_id", "chunk")
    facts = coded.drop("codes").join(other, same).drop("_conv_id", "_chunk")
    folded = keep(map_arrow(facts.repartition("conv_id").sortWithinPartitions("conv_id", "chunk"), _fold,
                            "conv_id long, chunk long, state long, total boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"))
    states = folded.where("NOT total").select("conv_id", "chunk", "state")
    other, same = _same(solved, states, "conv_id", "chunk")
    ready = keep(solved.select("conv_id", "chunk", "last", "codes", "used").join(other, same).drop("_conv_id", "_chunk"))
    other, same = _same(numbered, ready, "conv_id", "chunk")
    edits = keep(map_arrow(numbered.select("conv_id", "chunk", "roles", "texts").join(other, same).select(
        "conv_id", "chunk", "last", "codes", "used", "state", "roles", "texts"), _edits, "conv_id long, chunk long, audit string, repaired string"))
    digests = joined_sha256(edits, "conv_id", ["chunk"], "repaired", "\n").withColumnRenamed("sha256", "repaired_sha256")
    audits = edits.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    other, same = _same(audits, digests, "conv_id")
    both = audits.join(other, same).drop("_conv_id")
    other, same = _same(folded, both, "conv_id")
    return folded.where("total").drop("chunk", "state", "total").join(other, same).drop("_conv_id")


def _numbered(chunks: DataFrame) -> DataFrame:
    """Chunks numbered from 1 inside their conversation; ``last`` marks the last one."""
    spots = chunks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "chunk"))).alias("spots"))
    spots = spots.select(F.col("conv_id").alias("_conv_id"), F.size("spots").alias("n"), F.posexplode("spots").alias("k", "at"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("part") == F.col("at.part")) & (F.col("chunk") == F.col("at.chunk"))
    return chunks.join(spots, same).select(
        "conv_id", (F.col("k") + 1).cast("long").alias("chunk"), (F.col("k") + 1 == F.col("n")).alias("last"), "turns", "roles", "texts", "states",
        "first_turn", "last_turn", "distinct_turns", "illegal")


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes and counts of each chunk, from which of its rows say something for the first time in their conversation."""
    schema = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("last", pa.bool_()), ("codes", pa.list_(pa.string())),
                        *[(n, pa.int64()) for n in ("first_turn", "last_turn", "distinct_turns", "illegal", "blank", "duplicate", "truncated")],
                        ("first_initial", pa.string()), ("last_initial", pa.string())])
    for batch in batches:
        out = []
        for x in batch.to_pylist():
            new = set(x["new"])
            codes, (blank, duplicate, truncated) = codes_of(x["roles"], x["states"], [i not in new for i in range(len(x["roles"]))])
            out.append({k: x[k] for k in ("conv_id", "chunk", "last", "first_turn", "last_turn", "distinct_turns", "illegal")} | {
                "codes": [f"{int(bad)}{int(cut)}{initial}" for initial, bad, cut in codes], "blank": blank, "duplicate": duplicate, "truncated": truncated,
                "first_initial": x["roles"][0][:1], "last_initial": x["roles"][-1][:1]})
        yield _batch(out, schema)


RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repair(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of each conversation among ``rows`` (conv_id, turn, role, text without nulls but in conv_id and turn)."""
    ordered = (rows.withColumn("row", F.monotonically_increasing_id()).withColumn("state", text_state(F.col("text")))
               .select("conv_id", "turn", "role", "text", "state", F.sha2("text", 256).alias("said"), "row"))
    order = ["conv_id", "turn", "role", "said", "row"]
    parts = keep(map_arrow(ordered.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "state"), _solver(chunk_rows), PARTS))
    gaps = F.when(F.col("first_turn").isNull(), 0).otherwise(F.col("last_turn") - F.col("first_turn") + 1 - F.col("distinct_turns")).alias("gaps")
    whole = parts.where("kind = 'whole'").select("conv_id", gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("repaired").alias("repaired_sha256"))
    long = _long(parts.where("kind = 'chunk'"))
    return whole.unionByName(long)


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the table after the damage, repaired."""
    rows = table(spark, sf_dir, "conversations")
    found = repair(damaged(rows))
    every, same = _same(found, rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct(), "conv_id")
    zero = F.lit(0).cast("long")
    nothing = hashlib.sha256().hexdigest()
    filled = [F.coalesce(n, zero).alias(n) for n in RESULT[1:7]]
    return every.join(found, same, "left").select(F.col("_conv_id").alias("conv_id"), *filled, F.coalesce("audit", F.lit("")).alias("audit"),
                                                  F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


SQL = r"""
WITH RECURSIVE f AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
        string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
        lambda ch: [CAST(ord(ch) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295) % 20 AS fate FROM conversations),
d AS (SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role, text, copy FROM (
  SELECT conv_id, turn, role, fate, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE fate WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM f WHERE fate <> 0)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM d),
n AS (SELECT conv_id, turn, role, text, i, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS previous,
  CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
       WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
       WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault FROM o),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (i > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM n GROUP BY conv_id),
v AS (
  SELECT conv_id, n + 1 AS i, [{'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])}, {'c': 10, 'a': 'II', 't': ['user:', 'assistant:']},
                               {'c': 5, 'a': 'I', 't': ['assistant:']}, {'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])}] AS s FROM g
  UNION ALL
  SELECT conv_id, i, list_transform([1, 2, 3, 4], lambda k: list_min([w[k],
    {'c': w[[3, 3, 4, 3][k]].c + 5, 'a': 'I' || w[[3, 3, 4, 3][k]].a, 't': list_prepend([ 'user:', 'user:', 'assistant:', 'user:'][k], w[[3, 3, 4, 3][k]].t)}]))
  FROM (SELECT conv_id, i, list_transform([1, 2, 3, 4], lambda k: list_min([u[k],
    {'c': u[[3, 3, 4, 3][k]].c + 5, 'a': 'I' || u[[3, 3, 4, 3][k]].a, 't': list_prepend([ 'user:', 'user:', 'assistant:', 'user:'][k], u[[3, 3, 4, 3][k]].t)}])) AS w
  FROM (SELECT n.conv_id, n.i, list_transform([1, 2, 3, 4], lambda k: list_min([
      {'c': s[k].c + 2, 'a': 'D' || s[k].a, 't': s[k].t},
      CASE WHEN fault NOT IN ('blank', 'duplicate') THEN
        {'c': s[[3, 3, 4, 3][k]].c + 1 + cut, 'a': 'R' || s[[3, 3, 4, 3][k]].a,
         't': list_prepend([ 'user:', 'user:', 'assistant:', 'user:'][k] || text, s[[3, 3, 4, 3][k]].t)} END,
      CASE WHEN fault NOT IN ('blank', 'duplicate') AND steps[k] > 0 THEN
        {'c': s[steps[k]].c + cut, 'a': 'K' || s[steps[k]].a, 't': list_prepend(role || ':' || text, s[steps[k]].t)} END])) AS u
    FROM v JOIN (SELECT *, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS cut,
                   CASE initial WHEN 's' THEN [2, 0, 0, 0] WHEN 'u' THEN [3, 3, 0, 3] WHEN 'a' THEN [0, 0, 4, 0] ELSE [0, 0, 0, 0] END AS steps FROM n) AS n
      ON n.conv_id IS NOT DISTINCT FROM v.conv_id AND n.i = v.i - 1)))
SELECT e.conv_id AS conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
  CAST(coalesce(s[1].c, 0) AS BIGINT) AS cost, coalesce(s[1].a, '') AS audit, sha256(coalesce(array_to_string(s[1].t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS e LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN v ON v.conv_id IS NOT DISTINCT FROM e.conv_id AND v.i = 1
"""
