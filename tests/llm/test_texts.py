"""Token files, SentencePiece, toxicity and personal data: round trips, libraries and brute force."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus_pipeline
from adspark.llm import contamination, huffman, private, sentences, simhash, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids string, start string"
ODD = [None, "", "   ", "a", "<|endoftext|> don't <|x", "it's WE'LL o'clock''s 'S", "é́x …, a≠b ≠ ≠", "İstanbul ΣΑΣ ﬁ ① x²", "日本語 text nb em",
       "_under_score--dash!!", "\x00\x01 tab\tnl\r\n", "👩‍👩‍👧 emoji", "word." * 50, "x" * 3000, "a" * 20 + "́" * 5, "Ａ１", "don’t 'tis 're", "▁mark ▁ ▁▁"]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None, "x", "y") for i, t in rows], DOCS).repartition(3)


def texts(seed, n=40):
    r = random.Random(seed)
    chars = "abcdeABC é߀日́'.,!?<|>-_123   \n\t▁"
    return ODD + ["".join(r.choice(chars) for _ in range(r.randrange(300))) for _ in range(n)] + [" ".join(r.choice(["the", "Then,", "them;"]) for _ in range(20_000))]


@pytest.mark.parametrize("bound", [1, 5000, 64 << 20])
def test_pieces_encode_as_whole_texts_do(monkeypatch, bound):
    t = Tokenizer.from_file(huffman.default_tokenizer())
    rows = [x or "" for seed in range(8) for x in texts(seed)]
    want = [np.array(e.ids + [huffman.END], "<u2").tobytes() for e in t.encode_batch(rows, add_special_tokens=False)]
    assert huffman.Encoder(huffman.default_tokenizer()).encode(pa.array(rows)).to_pylist() == want
    e = huffman.Encoder(huffman.default_tokenizer())
    monkeypatch.setattr(huffman, "TABLE_BYTES", bound)
    column = pa.array([None, *rows])
    for k in range(1, len(column), 7):  # batch by batch, with tables that hold little
        assert e.encode(column.slice(k, 7)).to_pylist() == want[k - 1:k + 6]
    assert e.encode(column.slice(0, 1)).to_pylist() == [np.array([huffman.END], "<u2").tobytes()]
    assert e.encode(column.slice(0, 0)).to_pylist() == []
    assert max(map(len, e.numbers), default=0) <= huffman.LONGEST and max(map(len, e.pieces), default=0) <= huffman.LONGEST


@pytest.mark.parametrize("limit", [7, 9, 40])
def test_code_lengths(limit):
    r = random.Random(limit)
    weights = np.array([r.randrange(1, 10 ** r.randrange(1, 9)) for _ in range(100)])
    lengths = huffman.code_lengths(weights, limit)
    assert lengths.max() <= limit and sum(2.0 ** -x for x in lengths) <= 1
    import heapq
    heap = [(int(w), k, 0) for k, w in enumerate(weights)]
    heapq.heapify(heap)
    best = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        best += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], 1000 + len(heap), 0))
    cost = int((lengths * weights).sum())
    assert cost == best if limit == 40 else cost >= best


def test_block_round_trip():
    r = np.random.default_rng(1)
    ids = (r.zipf(1.3, 70_000) % 5000).astype(np.uint16)
    symbols, n = np.unique(ids, return_counts=True)
    code = huffman.Code(dict(zip(symbols.tolist(), huffman.code_lengths(n).tolist())))
    for part in (ids, ids[:1], ids[:256], ids[:257], ids[:0]):
        bits, checkpoints = code.encode(part)
        assert (code.decode(bits, checkpoints, len(part)) == part).all()
        assert len(bits) * 8 < code.length[part].sum() + 8


@pytest.mark.parametrize("block", [50, 1 << 18])
def test_token_file(spark, monkeypatch, block):
    monkeypatch.setattr(huffman, "BLOCK", block)
    monkeypatch.setattr(huffman, "SHARD", 5000)
    rows = list(enumerate(texts(1))) + [(3, "same id"), (None, "no id"), (-5, "negative")]
    path = huffman.default_tokenizer()
    blocks, codes = huffman.write_ids(huffman.token_ids(frame(spark, rows), path))
    got = sorted(huffman.read_ids(blocks, codes).collect(), key=lambda x: x.start)
    t, at = Tokenizer.from_file(path), 0
    want = sorted((i if i is not None else -100, t.encode(x or "", add_special_tokens=False).ids + [1]) for i, x in rows)
    assert sorted((x.doc_id if x.doc_id is not None else -100, np.frombuffer(x.ids, "<u4").tolist()) for x in got) == want
    assert [x.doc_id for x in got] == sorted([i for i, _ in rows], key=lambda i: (i is not None, i))
    for x in got:
        assert (x.start, x.n_tokens) == (at, len(x.ids) // 4)
        at += x.n_tokens


def test_token_file_of_nothing(spark):
    blocks, codes = huffman.write_ids(huffman.token_ids(frame(spark, []), huffman.default_tokenizer()))
    assert huffman.read_ids(blocks, codes).collect() == []


def test_viterbi_finds_the_best_pieces():
    v = sentences.Vocabulary(sentences.default_model())
    r = random.Random(2)
    words = {sentences.MARK * r.choice([1, 1, 1, 2, 5]) + "".join(r.choice("theringaoé日x\n") for _ in range(r.randrange(12))) for _ in range(300)}
    v.learn(words)
    price = {i: s for s, i in v.score.values()}
    for w in words:
        best = [0.0] + [float("-inf")] * len(w)
        for j in range(1, len(w) + 1):
            best[j] = max([best[i] + v.score[w[i:j]][0] for i in range(j) if w[i:j] in v.score] + ([best[j - 1] + v.unknown] if w[j - 1] not in v.score else []))
        ids = np.frombuffer(v.known[w], "<u4").tolist()
        assert sum(price.get(i, 0.0) for i in ids) + sum(v.unknown for c in w if c not in v.score) == pytest.approx(best[-1])


def test_same_ids_as_the_library_with_a_unigram_model():
    raw = open(sentences.default_model(), "rb").read()
    assert raw.count(b"\x12\x06tok_v0\x18\x02 ") == 1  # model_type: BPE
    unigram = sentencepiece.SentencePieceProcessor(model_proto=raw.replace(b"\x12\x06tok_v0\x18\x02 ", b"\x12\x06tok_v0\x18\x01 "))
    r = random.Random(5)
    words = ["".join(r.choice("theringaosdl") for _ in range(r.randrange(1, 12))) for _ in range(500)]
    v = sentences.Vocabulary(sentences.default_model())
    assert [np.frombuffer(x, "<u4").tolist() for x in v.encode(words)] == [unigram.encode(w) for w in words]


def test_sentencepiece_round_trip(spark):
    rows = list(enumerate(texts(3))) + [(None, "no id"), (2, "same id")]
    lib = sentencepiece.SentencePieceProcessor(model_file=sentences.default_model())
    docs = frame(spark, rows).withColumnRenamed("ids", "token_ids")
    got = sentences.encoded(docs)
    assert got.columns == [c for c in docs.columns if c != "token_ids"] + ["token_ids", "n_tokens"]
    seen = [(x.doc_id, x.text) for x in got.collect()]
    assert sorted(seen, key=str) == sorted([(i, (t or "").replace("▁", " ")) for i, t in rows], key=str)
    for x in got.collect():
        assert x.n_tokens == len(x.token_ids) and lib.decode(list(x.token_ids)) == x.text
    assert all(x.round_trip for x in sentences.round_trips(frame(spark, rows)).collect())
    assert sentences.round_trips(frame(spark, [])).collect() == []


def test_segments_are_all_maximal():
    r = random.Random(1)

    def split(s, a, b):  # the definition: take the best segment, the shortest of equals, and go on at both sides
        best = max(((sum(s[i:j]), i - j, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
        if best[0] <= 0:
            return []
        return split(s, a, best[2]) + [(best[2], best[3], best[0])] + split(s, best[3], b)

    for _ in range(60):
        s = [r.choice([-3, -1, 2, 5, -2, 1]) + r.random() / 100 for _ in range(r.randrange(25))]
        got = toxicity.segments(np.array(s))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in split(s, 0, len(s))]
        assert [x for *_, x in got] == pytest.approx([x for *_, x in split(s, 0, len(s))])


def labelled(seed, n=600):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = r.random() < .2
        words = [f"w{r.randrange(300)}" for _ in range(r.randrange(20, 120))]
        for _ in range(r.randrange(2, 6) if toxic else 0):
            words.insert(r.randrange(len(words)), f"vile{r.randrange(40)}")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_of_held_out_documents(spark):
    rows, labels = labelled(1)
    extra = [(2000, None), (2001, ""), (None, "vile1 vile2 vile3"), (5, "same id")]
    frames = spark.createDataFrame([*labels, (None, 1), (3000, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(frame(spark, rows + extra), frames).collect()
    assert len(got) == len(rows) + len(extra)
    truth = dict(labels)
    assert all(x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in got)
    held = [x for x in got if x.held_out and x.doc_id in truth]
    assert sum(x.predicted == truth[x.doc_id] for x in held) >= 0.95 * len(held)
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.3) for x in got)
    changed = spark.createDataFrame([(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels], "doc_id long, toxic int")
    again = toxicity.toxicity(frame(spark, rows + extra), changed).collect()
    key = lambda x: (str(x.doc_id), x.n_words)
    assert [x.score for x in sorted(got, key=key)] == pytest.approx([x.score for x in sorted(again, key=key)])  # held-out labels teach nothing


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {(x.score, x.predicted) for x in toxicity.toxicity(frame(spark, [(1, "a"), (2, None)]), none).collect()} == {(0.0, 0)}
    assert toxicity.toxicity(frame(spark, []), none).collect() == []


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_brute(text):
    out = {k: [m for m in re.finditer(p, text)] for k, p in PATTERNS.items()}
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    keep = {"email": lambda m: True, "ip": lambda m: all(int(x) <= 255 for x in m[0].split(".")),
            "card": lambda m: 13 <= len(digits(m)) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits(m)))) % 10 == 0,
            "phone": lambda m: 9 <= len(digits(m)) <= 15}
    return {k: [m.span() for m in v if keep[k](m)] for k, v in out.items()}


def personal(seed, n=60):
    r = random.Random(seed)
    bits = ["a@b.co", "x@@y.z", "@", "a@b", "q.w%+-@d-e.f.g..", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "001.002.003.004", "4111 1111-1111 1111", "4111111111111112",
            "+1 (743) 555-3824", "+", "+12", "+1.2.3.4 5 6", "+4444 4444 4444 4444", "12", " ", "é", ". ", "a", "x@y.z@w.v", "call ", "555-123-4567", "me (at) home (dot) org", "\n", "0" * 30, "日"]
    return ["".join(r.choice(bits) + r.choice(["", " ", "-"]) for _ in range(r.randrange(40))) for _ in range(n)]


def test_base_spans():
    for seed in range(20):
        for text in [*personal(seed), *[x or "" for x in ODD]]:
            assert private.base_spans(text) == base_brute(text)
    assert private.base_spans("a" * 400_000 + "@ " + "1" * 200_000 + "." * 1000 + "+1" + " " * 100_000)["email"] == []


def test_personal_data(spark):
    rows = list(enumerate(personal(50, 200) + ODD)) + [(None, "a@b.co"), (1, "a@b.co 1.2.3.4")]
    docs = frame(spark, rows)
    got = private.personal_data(docs).collect()
    assert len(got) == len(rows)
    base = {(str(i), len(base_brute(t or "")["email"]), len(base_brute(t or "")["ip"])) for i, t in rows}
    assert {(str(x.doc_id), x.n_email, x.n_ip) for x in got} == base
    for x in got:
        t = next(t or "" for i, t in rows if i == x.doc_id and (t or "").count("@") >= x.n_email)
        spans = [s.rsplit(":", 2) for s in x.spans.split(",") if s]
        if x.doc_id not in (1, None):
            mine = [(k, int(a), int(b)) for k, a, b in spans]
            assert all((k, *s) in mine for k, v in base_brute(t).items() for s in v)
    masked = private.masked_texts(docs)
    assert masked.columns == docs.columns and masked.count() == len(rows)
    assert {x.text for x in masked.where("doc_id is null").collect()} == {"[EMAIL]"}
    assert all(x.n_chars == (None if x.text is None else len(x.text)) for x in masked.collect())
    assert private.personal_data(frame(spark, [])).collect() == []


def test_estimated_reliability_beats_a_bad_labeler():
    r = np.random.default_rng(1)
    truth = r.random(5000) < .3
    votes = np.stack([np.where(r.random(5000) < q, truth, ~truth) * 2 - 1 for q in (.95, .9, .9, .5, .5)], axis=1)
    patterns, at, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p = private.estimate(patterns, n.astype(float))[at.ravel()]
    assert ((p > .5) == truth).mean() > .94


def test_gazetteer():
    from adspark.llm.gazetteer import Gazetteer
    g = Gazetteer()
    assert [g.domain(x) for x in ("com", "de", "zzz")] == [1, 1, 0]
    assert [g.card(x) for x in ("4111111111111111", "378282246310005", "2720990000000000", "2721990000000000", "9999999999999999", "41111111111111")] == [1, 1, 1, -1, -1, -1]
    assert [g.address(x) for x in ("8.8.8.8", "10.1.2.3", "192.0.2.77", "239.1.1.1", "1.2.3.999", "2001:db8:0:0:0:0:0:1", "2a00:1:2:3:4:5:6:7", "fe80:0:0:0:0:0:0:1")] == [1, 0, -1, -1, -1, -1, 1, 0]
    assert [g.phone(x, "".join(filter(str.isdigit, x))) for x in ("+49 30 1234567", "0044 20 1234567", "+999 1234567", "+28 1234567", "555 123 4567")] == [1, 1, 1, -1, 0]


def test_extra_spans_beside_many_base_spans():
    """Against every pair, and in time that grows with the text."""
    import time
    r = random.Random(11)
    model = {k: np.array([30.0] + [0.0] * (2 * private.VOTERS + 3)) for k in private.KINDS}  # accepts all
    pieces = ["a@b.co", "1.2.3.4", "+1 555 123 4567", "4111 1111 1111 1111", "x (at) y.org", "(555) 123-4567", "1:2:3:4:5:6:7:8", "4111.1111.1111.1111", "word", "4111 1111 1111 1112"]
    for _ in range(30):
        text = " ".join(r.choice(pieces) for _ in range(40))
        base, found = private.spans(text, model)
        taken, free, want = [x for v in base.values() for x in v], 0, {k: list(v) for k, v in base.items()}
        for a, b, kind in sorted((a, b, k) for k, a, b, is_base, _ in private.proposed(text) if not is_base):
            if a >= free and not any(x < b and a < y for x, y in taken):
                want[kind].append((a, b))
                free = b
        assert found == {k: sorted(v) for k, v in want.items()}
    start = time.process_time()
    private.spans("a@b.co (555) 123-4567 " * 20_000, model)
    assert time.process_time() - start < 20


def test_pipeline_stages(spark, tmp_path):
    rows, labels = labelled(4, 300)
    rows += [(1000 + k, rows[k][1]) for k in range(40)] + [(1100, None), (1101, ""), (None, "some words"), (1102, "write to a@b.co " + rows[50][1])]
    bench = " ".join(f"bench{k}" for k in range(30))
    rows.append((1200, bench))
    docs = frame(spark, rows).drop("ids", "start")
    folder = str(tmp_path)
    docs.write.parquet(folder + "/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(folder + "/labels.parquet")
    spark.createDataFrame([(7, bench)], "item_id long, text string").write.parquet(folder + "/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "pii", "sentencepiece"]
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == [*docs.columns, "token_ids", "n_tokens"]
    got = {x.doc_id: x.text for x in out.collect()}
    toxic = {x.doc_id for x in toxicity.toxicity(docs, spark.read.parquet(folder + "/labels.parquet")).where("predicted = 1").collect()}
    from adspark.llm import simhash
    left = docs.where(~docs.doc_id.isin(list(toxic)) | docs.doc_id.isNull())
    groups = {x.component_id for x in simhash.near_duplicates(left).collect()}
    assert set(got) == groups - {1200}
    assert all(k < 1000 or k >= 1100 for k in got if k is not None)
    assert 1102 not in got or got[1102].startswith("write to [EMAIL] ")


def test_filters_judge_each_row_by_its_own_text(spark, tmp_path):
    rows, labels = labelled(6)
    vile, bench = " ".join(f"vile{k}" for k in range(30)), " ".join(f"bench{k}" for k in range(30))
    clean = [rows[k][1] for k, y in labels if not y][:3]
    folder = str(tmp_path)
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(folder + "/labels.parquet")
    spark.createDataFrame([(7, bench)], "item_id long, text string").write.parquet(folder + "/benchmark.parquet")
    extra = lambda bad: [(None, bad), (None, clean[0]), (None, None), (9000, bad), (9000, clean[1]), (9001, bad), (9002, clean[2]), (9002, clean[2])]
    want = [(None, clean[0]), (None, None), (9000, clean[1]), (9002, clean[2]), (9002, clean[2])]
    for stage, bad in ((toxicity.stage, vile), (contamination.stage, bench)):
        kept = stage(spark, frame(spark, rows + extra(bad)), folder).collect()
        assert sorted(((x.doc_id, x.text) for x in kept if x.doc_id is None or x.doc_id >= 9000), key=str) == sorted(want, key=str)


def test_stages_leave_little_in_their_workers(spark, monkeypatch):
    """Stages that share Python workers hold half a MB of text at once, and no words when a task has ended."""
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(400)), "text": ["word " * 1000] * 400})
    for module, made in ((toxicity, lambda: toxicity._segments(docs, np.zeros(toxicity.BUCKETS))), (simhash, lambda: simhash.fingerprints(docs))):
        monkeypatch.setattr(module, "map_arrow", lambda df, run, schema: run)
        rows = [len(part) for part in made()(iter([batch]))]
        assert sum(rows) == 400 and max(rows) * 5000 <= 1 << 19

    class Frame:
        columns, schema, sparkSession = docs.columns, docs.schema, spark
        select = lambda self, *names: self
        mapInArrow = lambda self, run, schema: run

    assert sum(map(len, sentences.encoded(Frame())(iter([batch])))) == 400
    v = sentences.vocabulary(sentences.default_model())
    assert not v.known and not v.older and not v.known_bytes
