"""The trie of conversation prefixes, built from sorted sequences of turns.

Every turn is a 128-bit digest of role and text, a conversation the sequence of its turns' digests. A range sort brings equal prefixes together. In a block of
sorted sequences, union-find takes the edges between neighbours in descending order of their longest common prefix: a merge at depth d makes
(or joins) the branching node at depth d, and the nodes between it and the tops of the merged components lie on unary chains.
Nodes that hold neither the block's first nor its last sequence are complete and written at once. The others form two spines, the contracted
forest of the block. Neighbouring forests merge along their common prefix, in the task while it streams its blocks, then in rounds over
groups of ``FAN`` partitions; what a merge encloses is complete. Only numbers travel in these rounds: the ids of conversations that end in a spine
are written aside in pieces and hashed as a stream.

Null roles and texts count as empty. Rows without conv_id belong to no conversation. Rows of equal turn (null first) stand in order of their
digest; repeated rows are turns of their own. Conversations with equal turns are members of the same nodes. No conversations: no nodes. Other
columns are ignored. The digests of one conversation (16 bytes a turn, and 8 for its length) must fit a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adspark.llm.common import joined_sha256, keep, map_arrow, table

WIDTH, FAN, BLOCK_ROWS, BLOCK_BYTES = 16, 16, 20_000, 32 << 20
NOTHING = hashlib.sha256().hexdigest()

#: kind node: a complete node, whose parent is known by conv_id or, if on a spine, by pid. Its own pid is given if it lay on a spine.
#: kind open: a node of a spine (side 0: of the first sequence, 1: of the last beyond their ``shared`` depth), with what is complete below it.
#: kind ends: a piece of the list of conversations that end at the spine's node pid.
FIELDS = [("kind", pa.string()), ("level", pa.int32()), ("part", pa.int32()), ("side", pa.int32()), ("shared", pa.int64()), ("pid", pa.binary()), ("conv_id", pa.int64()),
          ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("parent_pid", pa.binary()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
          ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("size", pa.int64()), ("ends", pa.string())]
ROWS = pa.schema(FIELDS)
DDL = ", ".join(f"{n} {({'int64': 'long', 'int32': 'int'}).get(str(t), t)}" for n, t in FIELDS)
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(rows: DataFrame) -> DataFrame:
    """conv_id, key (the digests of its turns, one after the other) and sizes (code points of each text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)
    turns = rows.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"),
                                                     F.struct(F.col("turn"), said.alias("said"), F.length(text).cast("long").alias("size")).alias("t"))
    lists = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return lists.select("conv_id", F.unhex(F.array_join("t.said", "")).alias("key"), F.col("t.size").alias("sizes"))


def rebuilt(lists: DataFrame) -> DataFrame:
    """Each conversation c after the first h turns of conversation c - c % 100, in place of its own first h; h is crc32(c) % 6."""
    block = lambda c: c - c % 100
    h = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    heads = lists.where(F.col("conv_id") % 100 == 0).select(
        F.col("conv_id").alias("base"), F.substring("key", 1, 5 * WIDTH).alias("head"), F.slice("sizes", 1, 5).alias("head_sizes"))
    most = F.lit(2**31 - 1)
    key = F.concat(F.coalesce(F.substring("head", F.lit(1), WIDTH * h), F.lit(b"")), F.substring("key", WIDTH * h + 1, most))
    sizes = F.concat(F.coalesce(F.slice("head_sizes", F.lit(1), h), F.array().cast("array<long>")), F.slice("sizes", h + 1, most))
    return lists.join(heads, block(F.col("conv_id")) == F.col("base"), "left").select("conv_id", key.alias("key"), sizes.alias("sizes"))


class Open:
    """A node of a spine: its members so far and the sums of its complete children."""

    __slots__ = ("depth", "pid", "low", "n", "kids", "leaves", "saved", "size")

    def __init__(self, depth: int, pid: bytes, low: int, n: int, kids: int, leaves: int, saved: int, size: int):
        self.depth, self.pid, self.low, self.n, self.kids, self.leaves, self.saved, self.size = depth, pid, low, n, kids, leaves, saved, size

    def complete(self, parent: Open | None, level: int, part: int) -> dict:
        """The finished row; the sums go to the parent."""
        leaves, saved = self.leaves if self.kids else 1, self.saved + (self.n - 1) * self.size
        if parent:
            parent.kids += 1
            parent.leaves += leaves
            parent.saved += saved
        return {"kind": "node", "level": level, "part": part, "pid": self.pid, "conv_id": self.low, "depth": self.depth, "parent_pid": parent and parent.pid,
                "n_convs": self.n, "n_children": self.kids, "n_leaves": leaves, "saved_tokens": saved}

    def row(self, part: int, side: int, shared: int) -> dict:
        return {"kind": "open", "part": part, "side": side, "shared": shared, "pid": self.pid, "conv_id": self.low, "depth": self.depth, "n_convs": self.n,
                "n_children": self.kids, "n_leaves": self.leaves, "saved_tokens": self.saved, "size": self.size}


class Forest:
    """The spines of a run of sorted sequences: nodes from the root to the first and to the last, equal objects up to depth ``shared``."""

    def __init__(self, left: list[Open], right: list[Open], shared: int):
        self.left, self.right, self.shared = left, right, shared

    def rows(self, part: int) -> list[dict]:
        return [x.row(part, 0, self.shared) for x in self.left] + [x.row(part, 1, self.shared) for x in self.right[self.shared + 1:]]

    def join(self, after: Forest, level: int, part: int) -> list[dict]:
        """Append the forest of the sequences that follow; returns the nodes that this completes."""
        a, b = self.right, after.left
        low, high = 0, min(len(a), len(b)) - 1  # the deepest equal node: of equal paths from the root
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if a[mid].pid == b[mid].pid else (low, mid - 1)
        done = []
        for path, end in ((a, max(low, self.shared)), (b, max(low, after.shared))):
            for k in range(len(path) - 1, end, -1):
                done.append(path[k].complete(path[k - 1], level, part))
        for k in range(low + 1):
            x, y = a[k], b[k]
            x.n, x.low, x.kids, x.leaves, x.saved = x.n + y.n, min(x.low, y.low), x.kids + y.kids, x.leaves + y.leaves, x.saved + y.saved
            if k <= after.shared:
                after.right[k] = x
        for k in range(low, max(self.shared, after.shared), -1):
            done.append(a[k].complete(a[k - 1], level, part))
        self.right, self.shared = after.right, min(self.shared, low, after.shared)
        return done

    def finish(self, level: int, part: int) -> list[dict]:
        done = [self.right[k].complete(self.right[k - 1], level, part) for k in range(len(self.right) - 1, self.shared, -1)]
        return done + [x.complete(self.left[k - 1] if k else None, level, part) for k, x in reversed([*enumerate(self.left)])]


def common(a: bytes, b: bytes) -> int:
    """Turns that two sequences have in common at their beginning."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid * WIDTH] == b[:mid * WIDTH] else (low, mid - 1)
    return low


class Block:
    """The trie of sorted distinct sequences, by union-find over their neighbours."""

    def __init__(self, keys: list[bytes], sizes: list[list[int]], ids: list[list[int]]):
        self.keys, self.sizes, self.ids = keys, sizes, ids
        self.depth, self.n, self.low, self.kids, self.leaves, self.saved, self.size, self.open, self.parent = ([] for _ in range(9))
        last = len(keys) - 1
        for i, key in enumerate(keys):  # node i is the end of sequence i
            d = len(key) // WIDTH
            self.make(d, len(ids[i]), ids[i][0], sizes[i][d - 1] if d else 0, i in (0, last))
        lcp = [common(a, b) for a, b in zip(keys, keys[1:])]
        self.shared = min(lcp, default=len(keys[0]) // WIDTH)
        above, top = list(range(last + 1)), list(range(last + 1))

        def find(i: int) -> int:
            while above[i] != i:
                above[i] = i = above[above[i]]
            return i

        for i in sorted(range(last), key=lambda i: -lcp[i]):
            a, b, d = find(i), find(i + 1), lcp[i]
            left = self.climb(top[a], d + 1, sizes[i])
            right = self.climb(top[b], d + 1, sizes[i + 1])
            if self.depth[left] > d:
                node = self.make(d, self.n[left], self.low[left], sizes[i][d - 1] if d else 0, self.open[left])
                self.attach(left, node)
            else:
                node = left
            self.n[node] += self.n[right]
            self.low[node] = min(self.low[node], self.low[right])
            self.open[node] |= self.open[right]
            self.attach(right, node)
            above[b], top[a] = a, node
        self.climb(top[find(0)], 0, sizes[0])

    def make(self, depth: int, n: int, low: int, size: int, is_open: bool) -> int:
        for column, value in zip((self.depth, self.n, self.low, self.kids, self.leaves, self.saved, self.size, self.open, self.parent),
                                 (depth, n, low, 0, 0, 0, size, is_open, -1)):
            column.append(value)
        return len(self.depth) - 1

    def attach(self, node: int, parent: int) -> None:
        self.parent[node] = parent
        if not self.open[node]:
            self.leaves[node] = self.leaves[node] if self.kids[node] else 1
            self.saved[node] += (self.n[node] - 1) * self.size[node]
            self.kids[parent] += 1
            self.leaves[parent] += self.leaves[node]
            self.saved[parent] += self.saved[node]

    def climb(self, node: int, depth: int, sizes: list[int]) -> int:
        """Nodes with one child each, up to ``depth``."""
        while self.depth[node] > depth:
            d = self.depth[node] - 1
            above = self.make(d, self.n[node], self.low[node], sizes[d - 1] if d else 0, self.open[node])
            self.attach(node, above)
            node = above
        return node

    def forest(self) -> tuple[Forest, dict[int, bytes]]:
        """The spines, and the pid of each open node."""
        pids, paths = {}, []
        for i in (0, len(self.keys) - 1):
            path, node = [], i
            while node >= 0:
                path.append(node)
                node = self.parent[node]
            pid = b""
            for d, node in enumerate(reversed(path)):
                pid = hashlib.blake2b(pid + self.keys[i][(d - 1) * WIDTH:d * WIDTH] if d else b"", digest_size=WIDTH).digest()
                pids[node] = pid
            paths.append(path[::-1])
        opened = {x: Open(self.depth[x], pids[x], self.low[x], self.n[x], self.kids[x], self.leaves[x], self.saved[x], self.size[x]) for x in pids}
        return Forest([opened[x] for x in paths[0]], [opened[x] for x in paths[1]], self.shared), pids

    def batch(self, pids: dict[int, bytes], part: int) -> pa.RecordBatch:
        """The complete nodes, and the ends at open ones."""
        done = [x for x, o in enumerate(self.open) if not o]
        take = lambda column: [column[x] for x in done]
        parents = take(self.parent)
        ends = [hashlib.sha256(",".join(map(str, self.ids[x])).encode()).hexdigest() if x < len(self.ids) else NOTHING for x in done]
        k = len(done)
        columns = {"kind": ["node"] * k, "level": [0] * k, "part": [part] * k, "conv_id": take(self.low), "depth": take(self.depth),
                   "parent_conv_id": [None if p in pids else self.low[p] for p in parents], "parent_pid": [pids.get(p) for p in parents],
                   "n_convs": take(self.n), "n_children": take(self.kids), "n_leaves": take(self.leaves), "saved_tokens": take(self.saved), "ends": ends}
        at = [x for x in pids if x < len(self.ids)]
        values = []
        for name, kind in FIELDS:
            own = columns.get(name, [None] * k)
            more = {"kind": ["ends"] * len(at), "part": [part] * len(at), "pid": [pids[x] for x in at], "conv_id": [self.ids[x][0] for x in at],
                    "ends": [",".join(map(str, self.ids[x])) for x in at]}.get(name, [None] * len(at))
            values.append(pa.array(own + more, kind))
        return pa.RecordBatch.from_arrays(values, schema=ROWS)


def _forests(block_rows: int):
    """Sorted conversations: complete nodes, ends at spines, and one contracted forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, forest = TaskContext.get().partitionId(), None
        keys, sizes, ids, rows, size = [], [], [], 0, 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal forest
            block = Block(keys, sizes, ids)
            own, pids = block.forest()
            yield block.batch(pids, part)
            if forest is None:
                forest = own
            else:
                yield pa.RecordBatch.from_pylist(forest.join(own, 0, part), ROWS)

        for batch in batches:
            for conv, key, lens in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "key", "sizes")]):
                if keys and key == keys[-1]:
                    ids[-1].append(conv)
                else:
                    keys.append(key)
                    sizes.append(lens)
                    ids.append([conv])
                    size += 2 * len(key)
                rows += 1
                if rows >= block_rows or size >= BLOCK_BYTES:
                    yield from close()
                    keys, sizes, ids, rows, size = [], [], [], 0, 0
        if keys:
            yield from close()
        if forest:
            yield pa.RecordBatch.from_pylist(forest.rows(part), ROWS)

    return run


def _merged(level: int, last: bool):
    """Forests by group, part, side and depth: one forest for each group, or (``last``) all their nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, group, spine, part, shared = None, None, ([], []), None, 0

        def end_part() -> list[dict]:
            nonlocal whole
            left, right = spine
            own = Forest(left, left[:shared + 1] + right, shared)
            if whole is None:
                whole = own
                return []
            return whole.join(own, level, group)

        def end_group() -> list[dict]:
            return whole.finish(level, group) if last else whole.rows(group)

        for batch in batches:
            out = []
            for x in batch.to_pylist():
                if part is not None and x["part"] != part:
                    out += end_part()
                    if x["group"] != group:
                        out += end_group()
                        whole = None
                    spine = ([], [])
                part, group, shared = x["part"], x["group"], x["shared"]
                spine[x["side"]].append(Open(x["depth"], x["pid"], x["conv_id"], x["n_convs"], x["n_children"], x["n_leaves"], x["saved_tokens"], x["size"]))
            yield pa.RecordBatch.from_pylist(out, ROWS)
        if part is not None:
            yield pa.RecordBatch.from_pylist(end_part() + end_group(), ROWS)

    return run


def prefix_trie(lists: DataFrame, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """The nodes of the trie of ``lists`` (conv_id, key and sizes as of :func:`sequences`, one row for each conversation), with :data:`RESULT` as columns."""
    ordered = lists.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    first = keep(map_arrow(ordered, _forests(block_rows), DDL))
    forests, complete = first.where("kind = 'open'"), first.where("kind = 'node'")
    parts, level = (forests.agg(F.max("part")).first()[0] or 0) + 1, 0
    while True:
        parts, level = -(-parts // fan), level + 1
        grouped = forests.withColumn("group", (F.col("part") / fan).cast("int")).repartition("group").sortWithinPartitions("group", "part", "side", "depth")
        now = keep(map_arrow(grouped, _merged(level, parts == 1), DDL))
        complete = complete.unionByName(now.where("kind = 'node'"))
        if parts == 1:
            break
        forests = now.where("kind = 'open'")
    on_spine = complete.where("pid IS NOT NULL")
    digests = joined_sha256(first.where("kind = 'ends'"), "pid", ["part", "conv_id"], "ends", ",").withColumnRenamed("pid", "at")
    sha = F.coalesce("sha256", F.lit(NOTHING)).alias("ends_sha256")
    spine = keep(on_spine.join(digests, F.col("pid") == F.col("at"), "left").withColumn("ends_sha256", sha))
    nodes = complete.where("pid IS NULL").withColumn("ends_sha256", F.col("ends")).unionByName(spine.select(*complete.columns, "ends_sha256"))
    # A spine's node may have children in every part: its id is dealt to the parts first, and met there.
    wanted = nodes.where("parent_pid IS NOT NULL").select("level", "part", "parent_pid").distinct()
    names = keep(wanted.join(spine.select(F.col("pid").alias("parent_pid"), F.col("conv_id").alias("name")), "parent_pid"))
    return (nodes.join(names, ["level", "part", "parent_pid"], "left")
            .withColumn("parent_conv_id", F.coalesce("name", "parent_conv_id")).select(*RESULT))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the rebuilt conversations of the whole table."""
    return prefix_trie(rebuilt(keep(sequences(table(spark, sf_dir, "conversations")))))


SQL = r"""
WITH t AS (SELECT conv_id, turn, length(coalesce(text, '')) AS size,
  left(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS said FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list(said ORDER BY turn NULLS FIRST, said, size) AS said, list(size ORDER BY turn NULLS FIRST, said, size) AS size,
  CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
        lambda ch: [CAST(ord(ch) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295) % 6 AS INTEGER) AS h FROM t GROUP BY conv_id),
r AS (SELECT l.conv_id AS conv_id, list_concat(coalesce(b.said, [])[1:l.h], l.said[l.h + 1:]) AS said, list_concat(coalesce(b.size, [])[1:l.h], l.size[l.h + 1:]) AS size
  FROM l LEFT JOIN l AS b ON b.conv_id = l.conv_id - l.conv_id % 100),
m AS (SELECT conv_id, d, said[1:d] AS said, coalesce(size[d], 0) AS size, len(said) = d AS ends
  FROM (SELECT *, unnest(generate_series(0, len(said))) AS d FROM r)),
n AS (SELECT said, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY said, d),
k AS (SELECT said[1:d - 1] AS said, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
e AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON n.said = k.said AND n.d = k.d),
u AS (SELECT said[1:a] AS said, a AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
  FROM (SELECT *, unnest(generate_series(0, d)) AS a FROM e) GROUP BY 1, 2)
SELECT e.conv_id AS conv_id, CAST(e.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(e.n_convs AS BIGINT) AS n_convs,
  CAST(e.n_children AS BIGINT) AS n_children, CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, e.ends_sha256 AS ends_sha256
FROM e JOIN u ON u.said = e.said AND u.d = e.d LEFT JOIN n AS p ON p.said = e.said[1:e.d - 1] AND p.d = e.d - 1
"""
