"""SimHash groups, repeated passages and contamination against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
import xxhash

from adspark.llm import contamination, simhash, substrings

DOCS = "doc_id long, text string, lang string, root string, rank string, row string, u string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", None, "y", "z") for i, t in rows], DOCS).repartition(3)


def corpus(seed, n=60):
    """Texts from few words, with copies, near copies, shared passages, empty texts, nulls and one long text."""
    r = random.Random(seed)
    word = lambda: r.choice(["the", "Of", "é!", "a" * 30, "x\x00y", "日本", " q"]) + str(r.randrange(400))
    texts = [" ".join(word() for _ in range(r.randrange(0, 260))) for _ in range(n)]
    passage = [word() for _ in range(90)]
    for k in range(0, n, 4):
        w = texts[k].split(" ")
        at = r.randrange(len(w) + 1)
        texts[k] = "\n".join(w[:at] + passage[r.randrange(30):50 + r.randrange(40)] + w[at:])
    copies = [texts[1], texts[1], texts[2] + " end", "  " + texts[3], "", "   ", None, None, "one", "one two", "one two"]
    loop = " ".join(["again and"] * 120)
    return list(enumerate(texts + copies + [loop, "start " + loop, " ".join(word() for _ in range(6000))])) + [(None, texts[1]), (1, "other"), (1, texts[1])]


def simhash_brute(rows):
    fps = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        s = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        fps.append(sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64)))
    return fps


def grouped(ids, fps):
    group = list(range(len(fps)))
    find = lambda x: x if group[x] == x else find(group[x])
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                group[find(a)] = find(b)
    low = {}
    for k, i in enumerate(ids):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return [low.get(find(k)) for k in range(len(fps))]


def test_simhash_groups(spark):
    rows = corpus(1)
    fps = simhash_brute(rows)
    want = sorted(zip([i for i, _ in rows], [f"{f:016x}" for f in fps], grouped([i for i, _ in rows], fps)), key=str)
    got = simhash.near_duplicates(frame(spark, rows))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == want


@pytest.mark.parametrize("bucket", [1, 4, 64])
def test_links_connect_what_hamming_distance_does(spark, bucket):
    r = random.Random(3)
    fps = set()
    for _ in range(12):
        x = r.getrandbits(64)
        for _ in range(20):  # chains of small steps, and strays
            x ^= (1 << r.randrange(64)) | (1 << r.randrange(64)) if r.random() < .8 else 1 << r.randrange(64) | 1 << r.randrange(64) | 1 << r.randrange(64)
            fps.add(x)
    fps = sorted(fps, key=simhash._signed)
    signed = [simhash._signed(f) for f in fps]
    edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), bucket)
    from adspark.llm.common import components
    root = {x.node: x.root for x in components(edges, "a", "b").collect()}
    want = grouped(signed, fps)
    for a in range(len(fps)):
        for b in range(a):
            assert (root.get(signed[a], signed[a]) == root.get(signed[b], signed[b])) == (want[a] == want[b])


def test_simhash_keeps_one_of_each_group(spark):
    rows = corpus(2)
    docs = frame(spark, rows)
    kept = simhash.stage(spark, docs, "")
    assert kept.columns == docs.columns
    fps = simhash_brute(rows)
    groups = {}  # a name for each group that no other has, though groups may share an id
    for (i, _), g in zip(rows, grouped(list(range(len(rows))), fps)):
        groups.setdefault(g, []).append(i)
    want = [min((i for i in ids if i is not None), default=None) for ids in groups.values()]
    assert sorted((x.doc_id for x in kept.collect()), key=str) == sorted(want, key=str)


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    """Also where the rows come from files, which number them, and names clash with those that operators use."""
    from adspark.llm import contamination, toxicity
    names = ["Row", "__digest", "n_words", "segments", "score", "fp", "hash", "of", "own_0", "file", "bad", "first"]
    docs = frame(spark, corpus(3)).selectExpr("doc_id", "text", *[f"{k} AS {n}" for k, n in enumerate(names)])
    spark.createDataFrame([(7, "again and " * 9)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(0, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for stage in (toxicity.stage, simhash.stage, contamination.stage):
        results = [stage(spark, d, str(tmp_path)) for d in (docs, spark.read.parquet(f"{tmp_path}/documents.parquet"))]
        assert all(x.columns == docs.columns for x in results)
        a, b = (sorted(map(tuple, x.collect()), key=str) for x in results)
        assert a == b and len(a) > 10 and all(x[2:] == tuple(range(len(names))) for x in a)


def test_simhash_stage_keeps_groups_whose_documents_share_an_id_or_have_none(spark):
    r = random.Random(5)
    a, b, c, d = (" ".join(f"w{r.randrange(10**6)}" for _ in range(60)) for _ in range(4))
    rows = [(0, b), (1, b), (1, a), (None, b), (None, c), (None, c), (None, d), (None, None), (None, ""), (7, c + " " + d), (7, d + " " + a)]
    kept = simhash.stage(spark, frame(spark, rows), "").collect()
    want = [(0, b), (1, a), (None, c), (None, d), (None, ""), (7, c + " " + d), (7, d + " " + a)]
    assert sorted(((x.doc_id, x.text or "") for x in kept), key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    none = frame(spark, rows=[])
    assert simhash.near_duplicates(none).collect() == []
    assert substrings.remove_repeats(none).collect() == []
    bench = spark.createDataFrame([], "item_id long, text string")
    assert contamination.contamination(spark, none, bench).collect() == []
    got = contamination.contamination(spark, frame(spark, [(1, "a b c"), (2, None)]), bench).collect()
    assert [tuple(x)[1:4] for x in sorted(got)] == [(3, 0, 0), (0, 0, 0)]


def repeats_brute(rows):
    rank = lambda i: substrings.LAST_ID if i is None else i
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    low = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - 49):
            key = tuple(w[k:k + 50])
            low[key] = min(low.get(key, rank(i)), rank(i))
    out = []
    for (i, _), w in zip(rows, words):
        gone = {p for k in range(len(w) - 49) if low[tuple(w[k:k + 50])] < rank(i) for p in range(k, k + 50)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


@pytest.mark.parametrize("seed", [1, 5, 6])
def test_repeats(spark, seed):
    rows = corpus(seed)
    got = substrings.remove_repeats(frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(repeats_brute(rows), key=str)


def test_passages_whose_words_only_collide_in_a_polynomial_hash_stay(spark):
    """Thue-Morse words: sums of any odd base's powers modulo 2**64 are equal for both."""
    bits = "".join("ab"[k.bit_count() & 1] for k in range(2048))
    other = bits.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"r{k}" for k in range(49))
    rows = [(0, f"{bits} {rest}"), (1, f"{other} {rest}"), (2, f"{other}\n{rest} x"), (3, " ".join(bits)), (4, " ".join(other)), (5, " ".join(other[:200]))]
    got = substrings.remove_repeats(frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(repeats_brute(rows), key=str)


def contamination_brute(rows, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = []
    for i, t in items:
        w = words(t)
        k = min(13, len(w))
        windows += [(i, w[a:a + k]) for a in range(len(w) - k + 1) if k]
    out = []
    for i, t in rows:
        w, hit, of = words(t), set(), set()
        for item, win in windows:
            for a in range(len(w) - len(win) + 1):
                if w[a:a + len(win)] == win:
                    hit |= set(range(a, a + len(win)))
                    of.add(item)
        of = sorted(str(x) for x in of if x is not None)
        out.append((i, len(w), len(hit), len(of), hashlib.sha256(",".join(of).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_contamination(spark):
    r = random.Random(4)
    word = lambda: r.choice(["Tom", "é", "日本", "b2"]) + str(r.randrange(6))
    items = [(k, " ".join(word() for _ in range(r.choice([1, 2, 3, 5, 13, 14, 40])))) for k in range(14)]
    items += [(20, items[0][1]), (20, items[3][1]), (None, items[4][1]), (21, None), (22, ""), (23, "--"), (9, "Zebra")]
    rows = [(k, "; ".join(word() for _ in range(r.randrange(80)))) for k in range(30)]
    rows += [(k + 100, rows[k][1] + "\n" + items[k % 14][1].upper().replace("É", "é") + " tail") for k in range(28)]
    rows += [(1, "same id " + items[5][1]), (None, items[6][1]), (300, None), (301, ""), (302, items[6][1] * 2), (303, " ".join([items[13][1]] * 50))]
    bench = spark.createDataFrame([(i, t, "c", "d") for i, t in items], "item_id long, text string, row string, window string")
    got = contamination.contamination(spark, frame(spark, rows), bench)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(contamination_brute(rows, items), key=str)
