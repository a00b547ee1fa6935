"""Operators on conversations against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

from pyspark.sql import functions as F

from adspark.llm import chat, repair, trie

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\v\f\r"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def damage_brute(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(c, t, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return sorted(out, key=lambda x: (x[1] is not None, x[1] or 0, x[2], sha(x[3])))


def repair_brute(rows):
    """The columns after conv_id for the damaged rows of one conversation."""
    turns = {t for _, t, _, _ in rows if t is not None}
    counts, codes, seen = [0, 0, 0], [], set()
    for _, _, role, text in rows:
        last = text.rstrip(WHITE)[-1:]
        fault = 0 if not last else 1 if (role, text) in seen else 2 if last not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        codes.append((role[:1], fault in (0, 1), 5 * (fault == 2)))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    grammar = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    @lru_cache(maxsize=None)
    def best(i, state, fresh):
        """Least (cost, audit, repaired turns) of what follows; ``fresh`` insertions stand directly before."""
        options = []
        if i == len(codes) and state in ("", "a"):
            options.append((0, "", ()))
        asked = grammar.get((state, "u")) or grammar.get((state, "a"))
        if fresh < 3:
            c, a, r = best(i, asked, fresh + 1)
            options.append((c + 5, "I" + a, ((names[asked], None), *r)))
        if i < len(codes):
            initial, bad, cut = codes[i]
            c, a, r = best(i + 1, state, 0)
            options.append((c + 2, "D" + a, r))
            if not bad:
                if (state, initial) in grammar:
                    c, a, r = best(i + 1, grammar[state, initial], 0)
                    options.append((c + cut, "K" + a, ((None, i), *r)))
                c, a, r = best(i + 1, asked, 0)
                options.append((c + 1 + cut, "R" + a, ((names[asked], i), *r)))
        return min(options, key=lambda x: x[:2]) if options else (10**9, "", ())

    for i in range(len(codes), 0, -50):  # fill the table from the end, so that recursion stays shallow
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    cost, audit, kept = best(0, "", 0)
    text = "\n".join(f"{role or rows[i][2]}:{'' if i is None else rows[i][3]}" for role, i in kept)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *counts, illegal, cost, audit, sha(text))


def some_rows(seed, conversations, longest):
    r = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "U", "antic"]
    texts = ["Yes.", "No", "Well?", " ", "", None, "\t.\n", "a.b", "Ünd!", "x. ", "Yes.", "So be it.", *(f"Line {i}." for i in range(40))]
    rows = []
    for c in conversations:
        for k in range(r.randrange(1, longest)):
            rows.append((c, r.choice([k, k, k, k + 3, None, -k]), r.choice(roles[:5] if r.random() < .8 else roles), r.choice(texts)))
    r.shuffle(rows)
    return rows


def want_repairs(rows):
    every = {}
    for x in rows:
        every.setdefault(x[0], []).append(x)
    return sorted(((c, *repair_brute(damage_brute(x))) for c, x in every.items()), key=str)


def test_repair_of_short_conversations(spark, tmp_path):
    rows = some_rows(1, [*range(60), None, -5], 12)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = repair.op12_structure_repair(spark, str(tmp_path))
    assert got.columns == repair.RESULT
    assert sorted(map(tuple, got.collect()), key=str) == want_repairs(rows)


def test_repair_of_long_conversations_in_small_chunks(spark):
    rows = some_rows(2, [1, 2, None], 400) + some_rows(3, range(4, 20), 9)
    damaged = repair.damaged(spark.createDataFrame(rows, SCHEMA))
    want = [x for x in want_repairs(rows)]
    there = {x.conv_id for x in damaged.select("conv_id").distinct().collect()}
    for size in (1, 7, 64):
        got = sorted(map(tuple, repair.repair(damaged, size).collect()), key=str)
        assert got == [x for x in want if x[0] in there]


def test_repair_of_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair(repair.damaged(none)).collect() == []


def test_costs_that_do_not_converge_pass_on_from_chunk_to_chunk(spark):
    """A conversation of alternating roles whose parity only its end decides."""
    rows = [(1, k, "user" if k % 2 else "assistant", f"Line {k}.") for k in range(300)]
    got = repair.repair(spark.createDataFrame(rows, SCHEMA), 10).collect()
    assert [tuple(x) for x in got] == [(1, *repair_brute(rows))]


def rebuilt_brute(rows):
    """Rebuilt turns of each conversation."""
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, sha(f"{len(role or '')}:{role or ''}{text or ''}")[:32], role or "", text or ""))
    turns = {c: [x[3:] for x in sorted(xs)] for c, xs in own.items()}
    out = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = turns.get(base, [])[:h] + mine[h:]
    return out


def trie_brute(turns):
    members = {}
    for c, t in turns.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for p in sorted(members, key=len, reverse=True):
        kids.setdefault(p, 0)
        leaves[p] = leaves.get(p, 0) or 1
        saved[p] = saved.get(p, 0) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
        if p:
            up = p[:-1]
            kids[up] = kids.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[p]
            saved[up] = saved.get(up, 0) + saved[p]
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    sha(",".join(map(str, sorted(c for c in m if len(turns[c]) == len(p)))))) for p, m in members.items()), key=str)


def test_trie_of_rebuilt_conversations(spark, tmp_path):
    rows = some_rows(4, [*range(-130, 330, 3), 0, 100, 200, None, 10**12], 9)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = trie.op11_prefix_trie(spark, str(tmp_path))
    assert got.columns == trie.RESULT
    assert sorted(map(tuple, got.collect()), key=str) == trie_brute(rebuilt_brute(rows))


def some_turns(seed, n, longest, kinds):
    """Conversations of few kinds of turns: shared prefixes, copies, prefixes of others, none at all."""
    r = random.Random(seed)
    turns = {c: [("user", f"T{r.randrange(kinds)}" * 2) for _ in range(r.randrange(longest))] for c in r.sample(range(10 * n), n)}
    for c in r.sample(sorted(turns), n // 3):
        turns[c] = turns[r.choice(sorted(turns))][:r.randrange(longest)]
    return turns


def lists_of(spark, turns):
    rows = [(c, k, role, text) for c, t in turns.items() for k, (role, text) in enumerate(t)]
    lists = trie.sequences(spark.createDataFrame(rows, SCHEMA))
    none = [(c, b"", []) for c, t in turns.items() if not t]
    return lists.unionByName(spark.createDataFrame(none, lists.schema)) if none else lists


def test_trie_across_blocks_and_partitions(spark):
    merge, before = "spark.sql.adaptive.coalescePartitions.enabled", spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set(merge, "false")
    try:
        _tries_across_blocks(spark)
    finally:
        spark.conf.set(merge, before)


def _tries_across_blocks(spark):
    for seed, n, longest, kinds, block, fan in ((1, 300, 6, 2, 1, 2), (2, 300, 5, 3, 7, 3), (3, 60, 40, 1, 5, 64), (4, 200, 8, 40, 50, 2)):
        turns = some_turns(seed, n, longest, kinds)
        got = trie.prefix_trie(lists_of(spark, turns), block, fan)
        assert sorted(map(tuple, got.collect()), key=str) == trie_brute(turns), seed


def test_trie_of_copies_and_of_nothing(spark):
    same = {c: [("user", "Hi."), ("assistant", "Ho.")] for c in range(500)}
    got = trie.prefix_trie(lists_of(spark, same), 20, 2)
    assert sorted(map(tuple, got.collect()), key=str) == trie_brute(same)
    empty = trie.sequences(spark.createDataFrame([], SCHEMA))
    assert trie.prefix_trie(trie.rebuilt(empty)).collect() == []
    alone = {7: [("user", "x")] * 3000}
    assert sorted(map(tuple, trie.prefix_trie(lists_of(spark, alone)).collect()), key=str) == trie_brute_line(alone[7], 7)


def trie_brute_line(turns, c):
    return sorted(((c, d, c if d else None, 1, int(d < len(turns)), 1, 0, sha(str(c) if d == len(turns) else "")) for d in range(len(turns) + 1)), key=str)


MESSAGES = "message_id string, parent_id string, role string, text string, score double"


def branches_brute(messages, best):
    """(leaf's message_id, rank, turns) of the best branches of each tree; ids are distinct."""
    by = {m[0]: m for m in messages}
    parent = {m[0]: m[1] if m[1] in by else None for m in messages}
    for m in parent:  # of each cycle the first row becomes a root
        path, at = [], m
        while at is not None and at not in path:
            path.append(at)
            at = parent[at]
        if at is not None:
            cycle = path[path.index(at):]
            parent[min(cycle, key=[x[0] for x in messages].index)] = None
    leaves = [m for m in parent if m not in set(parent.values())]
    trees = {}
    for leaf in leaves:
        path, at = [], leaf
        while at is not None:
            path.append(at)
            at = parent[at]
        scores = [by[x][4] or 0.0 for x in path]
        trees.setdefault(path[-1], []).append((-sum(0.0 if s != s else s for s in scores), [x[0] for x in messages].index(leaf), path[::-1]))
    return sorted((p[-1], k + 1, [(by[x][2] or "", by[x][3] or "") for x in p]) for t in trees.values() for k, (_, _, p) in enumerate(sorted(t)[:best]))


def test_branches_of_reply_trees(spark):
    r = random.Random(7)
    odd = ["", None, "\\", "###", "####x", "</turn>", "</turn></turn>", "<\\/turn>", "#\\##", "a\n### user:\n", "end\\", ":\n", "Ü😀", chat.PROBE]
    rows = []
    for k in range(150):
        parent = None if r.random() < .1 else "gone" if r.random() < .05 else f"m{r.randrange(max(0, k - 6), k + 1) if k > 100 else r.randrange(k + 1)}"
        rows.append((f"m{k}", parent, r.choice(["user", "assistant", "", None, "a:\nb", "x</turn>", "###", "r\\"]), r.choice(odd) if r.random() < .6 else f"Text {k}.",
                     r.choice([None, float("nan"), 1.0, 0.5, 2.0, -1.0])))
    rows += [("c0", "c2", "user", "x", 1.0), ("c1", "c0", "user", "y", 1.0), ("c2", "c1", "user", "z", 1.0), ("t", "c1", "assistant", "w", 1.0)]
    for best in (1, 3):
        frame = spark.createDataFrame(rows, MESSAGES).coalesce(1).selectExpr("*", "1 AS node", "2 AS leaf", "3 AS depth", "4 AS head")
        got = chat.read_back(chat.format_trees(frame, best)).collect()
        assert sorted((x.leaf, x["rank"], [(t["role"], t["text"]) for t in x.turns]) for x in got) == branches_brute(rows, best)
        for x in got:
            assert len(x.loss_mask) == len(x.turns)
            for span, t in zip(x.loss_mask, x.turns):
                under = x.formatted[span["start"]:span["end"]]
                assert t["loss"] == (t["text"] if t["role"] == "assistant" else "") == re.sub(r"(?s)\\(.)", r"\1", under)
                assert x.formatted[span["turn"]:].startswith("### ")


def test_a_deep_branch_and_a_wide_tree(spark):
    rows = [(f"d{k}", f"d{k - 1}" if k else None, "user", str(k), 0.0) for k in range(300)]
    rows += [("w", None, "user", "root", 0.0), *((f"w{k}", "w", "assistant", str(k), float(k)) for k in range(2000))]
    got = {x.leaf: x for x in chat.read_back(chat.format_trees(spark.createDataFrame(rows, MESSAGES))).collect()}
    assert set(got) == {"d299", "w1999"}
    assert [t["text"] for t in got["d299"].turns] == [str(k) for k in range(300)]
    assert [t["text"] for t in got["w1999"].turns] == ["root", "1999"]


def test_messages_repeated_without_id_and_none(spark):
    rows = [("a", None, "user", "one", 0.0), ("a", None, "user", "one", 0.0), ("b", "a", "assistant", "two", 0.0), (None, "a", "user", "three", -1.0), (None, None, "user", "four", None)]
    got = chat.read_back(chat.format_trees(spark.createDataFrame(rows, MESSAGES), best=5)).collect()
    assert sorted([t["text"] for t in x.turns] for x in got) == [["four"], ["one"], ["one", "three"], ["one", "two"]]
    assert chat.format_trees(spark.createDataFrame([], MESSAGES)).collect() == []


def test_chat_formatting_reads_back_what_was_written(spark, tmp_path):
    rows = some_rows(5, [*range(30), None, -7], 9)
    rows = [x for x in {(c, t): (c, t, role, text) for c, t, role, text in rows}.values()]  # one row for each turn
    spark.createDataFrame(rows, SCHEMA).withColumn("k", F.lit(1)).write.parquet(f"{tmp_path}/conversations.parquet")
    every = {}
    for c, t, role, text in [*rows, (-7, 0, "user", chat.PROBE), (-7, 1, "assistant", chat.PROBE)]:
        every.setdefault(c, []).append((t is not None, t or 0, role is not None, role or "", text is not None, text or ""))
    want = []
    for c, xs in every.items():
        turns = [(x[3], x[5]) for x in sorted(xs)]
        loss = "".join(text for role, text in turns if role == "assistant")
        want.append((c, len(turns), sha("".join(f"{role}\n{text}\n" for role, text in turns)), len(loss), sha(loss)))
    got = chat.op13_chat_formatting(spark, str(tmp_path)).collect()
    assert sorted((tuple(x)[:5] for x in got), key=str) == sorted(want, key=str)
