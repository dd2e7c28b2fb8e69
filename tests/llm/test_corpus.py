"""Mixing, sharding, near duplicates, tokens and the pipeline against plain Python."""

import json
import random
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash

import corpus_pipeline
from rillflow.llm import decontamination, mixing, queries, sharding, simhash, tokens

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BPE = public_tokenizers.path("byte_bpe_50k.json")


def docs_of(spark, texts, sources=None, extra=False):
    rows = [(i, t, "en", (sources or ["s0", "s1", "s2"])[i % len(sources or [0, 1, 2])], len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    return df.selectExpr("*", "1 AS size", "2 AS shard", "'x' AS fp", "3 AS taken", "4 AS node", "5 AS src") if extra else df


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s] + 1e-9}
        if not over:
            return target | {s: level * weight[s] for s in free}
        target |= {s: 2.0 * sizes[s] for s in over}
        rest -= sum(2 * sizes[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("sources", [["s0"] * 6 + ["b", None, "é", "Z"], ["one"], ["a", "b", "c", "d", "e"]])
def test_mix(spark, sources):
    rng = random.Random(2)
    texts = [" ".join("w" for _ in range(rng.choice([0, 1, 5, 60, 400, 3000]))) for _ in range(400)] + [None, "", " \n"]
    docs = docs_of(spark, texts, sources, extra=True).unionByName(docs_of(spark, ["w w w w"] * 50, [sources[-1]], extra=True).selectExpr("77L AS doc_id", *[c for c in docs_of(spark, [""], extra=True).columns if c != "doc_id"]))
    mixed, planned = mixing.mix(docs)
    rows = mixed.collect()
    assert len(rows) == docs.count()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        assert 0 <= r.taken <= 2 * r.size
    want = brute_targets(sizes)
    for s in sizes:
        mine = [r for r in rows if r.source == s]
        assert {r.source_size for r in mine} == {sizes[s]} and abs(mine[0].target - want[s]) < 1e-6 * max(1, want[s])
        assert abs(sum(r.taken for r in mine) - want[s]) <= 0.02 * want[s] + 3 * max(1, -(-sizes[s] // 256))
    assert sorted(map(tuple, mixing.mix(docs)[0].collect()), key=str) == sorted(map(tuple, rows), key=str)
    slots = [r.slot for r in planned.select("slot").collect()]
    assert len(slots) == len(set(slots))


def test_mix_edges(spark):
    docs = docs_of(spark, [None, "", "one two three"], [None])
    got = sorted((r.doc_id, r.size, r.taken) for r in mixing.mix(docs)[0].collect())
    assert got[:2] == [(0, 0, 0), (1, 0, 0)] and 4 <= got[2][2] <= 6
    assert mixing.mix(docs.limit(0))[0].count() == 0 and mixing.mix(docs_of(spark, [None, ""]))[0].agg({"taken": "sum"}).first()[0] == 0
    ragged = [f"  {i}\n" + "w\t\n w " * 15 + "end\n" for i in range(300)]
    docs = docs_of(spark, ragged, extra=True)
    docs = docs.unionByName(docs.where("doc_id < 40")).unionByName(docs.where("doc_id < 5"))
    rows = mixing.mixed_rows(docs, share=1.37)
    parts = [(r.doc_id, r.text, r.n_chars) for r in rows.collect()]
    assert all(ragged[i].startswith(t) and n == len(t) and t for i, t, n in parts) and sum(ragged[i] != t for i, t, _ in parts) <= 3
    per, words = {}, lambda t: len(t.split())
    for i, t, _ in parts:
        per[i] = per.get(i, 0) + words(t)
    taken = {r.doc_id: r.t for r in mixing.mix(docs, share=1.37, row=mixing.F.xxhash64(*docs.columns))[0].groupBy("doc_id").agg(mixing.F.sum("taken").alias("t")).collect()}
    assert sum(per.values()) == sum(taken.values()) and mixing.mixed_rows(docs.limit(0)).count() == 0
    assert [r.x for r in spark.createDataFrame([(" a  b\tc\n",)], "t string").select(mixing.F.explode(mixing.F.array(*[mixing.first_words(mixing.F.col("t"), mixing.F.lit(n)) for n in range(4)])).alias("x")).collect()] == ["", " a", " a  b", " a  b\tc"]
    rows = mixing.mixed_rows(docs_of(spark, [f"{i} " + "w " * 30 for i in range(300)], extra=True))
    assert rows.columns == docs_of(spark, [""], extra=True).columns
    per = {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    assert max(per.values()) <= 2 and abs(rows.selectExpr("sum(size(split(trim(text), ' ')))").first()[0] - 1.5 * 300 * 31) < 300


def test_mix_pieces_not_broadcast(spark):
    """A few long documents make 25,000 pieces, of which Spark knows only the documents' size."""
    mixed = mixing.mix(docs_of(spark, ["w"] * 8).selectExpr("doc_id", "repeat('w ', 200000) AS text", "source"))[0]
    rows = mixed.collect()
    assert [r.size for r in rows] == [200_000] * 8 and all(0 < r.taken <= 400_000 for r in rows)
    assert abs(sum(r.taken for r in rows) - 1.5 * 8 * 200_000) <= 0.02 * 1.5 * 8 * 200_000
    assert set(re.findall(r"(\w+) \[src#\d+L?, block#\d+L?\], \[", mixed._jdf.queryExecution().sparkPlan().toString())) == {"SortMergeJoin"}


def test_shards(spark):
    rng = random.Random(4)
    texts = ["x" * rng.randrange(3000) + str(i) for i in range(1500)]
    texts += ["same small text"] * 40 + ["a big copy " * 50] * 2000 + [None, "", None]
    docs = docs_of(spark, texts, ["a", "b", "c", None], extra=True)
    rows = sharding.shard(docs).collect()
    total = [0] * 24
    for r in rows:
        text = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(text) + 8, zlib.crc32(text))
        total[r.shard] += r["size"]
    assert len(rows) == len(texts) and max(total) < 1.1 * min(total)
    for s in range(24):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in rows if texts[r.doc_id] == "same small text"}) == 1
    assert len({r.shard for r in rows if texts[r.doc_id] == "a big copy " * 50}) > 1  # no shard can hold them all
    assert sorted(map(tuple, sharding.shard(docs).collect())) == sorted(map(tuple, rows))
    assert sharding.shard(docs.limit(0)).count() == 0 and sharding.shard(docs.limit(1)).count() == 1
    assert sharding.shard(docs.select("doc_id", "text"), 5).agg({"shard": "max"}).first()[0] == 4


def test_equal_texts_stay_together(spark):
    """A group stays whole up to what a shard holds."""
    rng = random.Random(14)
    texts = ["x" * rng.randrange(900) + str(i) for i in range(3000)]
    room = sum(len(t) + 8 for t in texts) / 24
    copies = {f"copy {k} " * 20: int(room * k / 10 / (20 * len(f"copy {k} ") + 8)) for k in (4, 8, 9)}
    texts += [t for t, n in copies.items() for _ in range(n)]
    rows = sharding.shard(docs_of(spark, texts)).collect()
    total = [sum(r["size"] for r in rows if r.shard == s) for s in range(24)]
    assert max(total) < 1.05 * min(total)
    for t in copies:
        assert len({r.shard for r in rows if texts[r.doc_id] == t}) == 1


def test_sources_with_a_common_start(spark):
    """A dimension's values are told apart however they start: shards are runs of sources."""
    texts = [f"{i:05d} " * 20 for i in range(2400)]
    sources = [f"commoncrawl-2024-{i:03d}" for i in range(48)]
    rows = sharding.shard(docs_of(spark, texts, sources), 8).collect()
    per = {s: sorted({r.doc_id % 48 for r in rows if r.shard == s}) for s in range(8)}
    assert all(len(x) <= 8 and x == list(range(x[0], x[-1] + 1)) for x in per.values())


def brute_tree(items, room, first=0):
    """(item, shard) by exact weighted medians. items: (id, bytes, keys)."""
    n, half = len(room), len(room) // 2
    if n == 1 or not items:
        return [(i, first) for i, _, _ in items]
    bits = sharding.TIE_BITS
    spread = [(max(k[d] for _, _, k in items) >> bits) - (min(k[d] for _, _, k in items) >> bits) for d in range(len(items[0][2]))]
    d = spread.index(max(spread))
    goal, below, left = sum(b for _, b, _ in items) * sum(room[:half]) / sum(room), 0, []
    order = sorted({k[d] for _, _, k in items})
    for key in order:
        own = sum(b for _, b, k in items if k[d] == key)
        if below + own >= goal:
            if goal - below > below + own - goal:
                left.append(key)
            break
        below += own
        left.append(key)
    left = set(left)
    return brute_tree([x for x in items if x[2][d] in left], room[:half], first) + brute_tree([x for x in items if x[2][d] not in left], room[half:], first + half)


@pytest.mark.parametrize("room", [[1.0] * 24, [1.0, 0.2, 0.7, 1.0, 0.0, 0.5, 0.9], [1.0]])
def test_tree_against_brute_force(spark, room):
    rng = random.Random(len(room))
    bits = sharding.TIE_BITS
    items = [(i, rng.choice([8, 9, 50, 400, 3000]), (rng.randrange(1 << 20) << bits | rng.randrange(1 << bits), rng.choice([0, 5, 9, 1 << 19]) << bits | rng.randrange(1 << bits))) for i in range(900)]
    items += [(900 + i, 70, items[0][2]) for i in range(30)]
    df = spark.createDataFrame([(i, b, *k) for i, b, k in items], "i int, bytes long, a long, b long").repartition(3)
    got = {r.i: r.shard for r in sharding.tree(df, ["a", "b"], room, 0.0).collect()}
    assert got == dict(brute_tree(items, room))


def test_very_long_texts(spark):
    long = " ".join(f"w{i % 9973}" for i in range(600_000))
    texts = [long, "a short one of five words", long, long + " end", None]
    assert [simhash.fingerprint(t) for t in texts[:2]] == [brute_fingerprint_of_long(long), brute_fingerprint(texts[1])]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs_of(spark, texts)).collect()}
    assert got == {0: 0, 1: 1, 2: 0, 3: 0, 4: 4}
    rows = {r.doc_id: (r["size"], r.text_crc32) for r in sharding.shard(docs_of(spark, texts), 3).collect()}
    assert rows == {i: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in enumerate(texts)}


def brute_fingerprint_of_long(text):
    ws, ones = text.encode().split(), np.zeros(64, np.int64)
    for i in range(len(ws) - 3):
        h = xxhash.xxh64_intdigest(b" ".join(ws[i : i + 4]), 42)
        ones += np.array(list(f"{h:064b}"[::-1]), np.int64)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(ws) - 3)


def test_large_groups_are_placed():
    group = lambda n, h: type("G", (), {"bytes": n, "h": h, "text_crc32": 0})
    placed, left = sharding.place_large([group(50, 1), group(100, 2), group(60, 3), group(101, 4)], 2, 100.0)
    assert placed == [(None, 50), (0, 1), (1, 1), (None, 101)] and left == [0.0, 40.0]


def brute_fingerprint(text):
    ws = (text or "").encode()
    ws = bytes(b + 32 if 65 <= b <= 90 else b for b in ws).split()
    grams = [b" ".join(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))] if ws else []
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, distance=4):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def test_simhash(spark):
    rng = random.Random(6)
    base = [" ".join(rng.choice("alpha beta gamma delta Eps zeta eta theta iota kappa".split()) + str(rng.randrange(50)) for _ in range(rng.randrange(3, 200))) for _ in range(60)]
    texts = [None, "", " \t", "one", "One", "two words", "ßa b c d e"] + base
    for t in base[:40]:
        w = t.split()
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = rng.choice(["x", "y", w[0]])
            texts.append(" ".join(w))
    texts += texts[5:9]
    assert [simhash.fingerprint(t) for t in texts] == [brute_fingerprint(t) for t in texts]
    got = simhash.near_duplicates(docs_of(spark, texts, extra=True)).collect()
    comp = brute_components([brute_fingerprint(t) for t in texts])
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(comp)) and len(set(comp)) < len(comp)
    assert simhash.near_duplicates(docs_of(spark, texts).limit(0)).count() == 0


@pytest.mark.parametrize("group", [16_384, 20])
def test_simhash_links(spark, group):
    rng = random.Random(8)
    fps = []
    for _ in range(25):
        fps.append(rng.getrandbits(64))
        for _ in range(rng.randrange(12)):  # chains and clouds around a centre
            fps.append(rng.choice(fps[-3:]) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 7))))
    centre = rng.getrandbits(64)
    fps += [centre ^ sum(1 << b for b in rng.sample(range(64), 3)) for _ in range(150)]
    fps = sorted(set(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), len(fps), group=group)
    found = {r.node: r.component for r in simhash.components(edges).collect()}
    comp = brute_components(fps)
    assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 4 for r in edges.collect())
    mine = [found.get(x, x) for x in signed]
    pairs = {(c, m) for c, m in zip(comp, mine, strict=True)}
    assert len(pairs) == len({c for c, _ in pairs}) == len({m for _, m in pairs})
    for n in (10, 10**6, 10**9, 10**11):  # every pair in reach meets in some table
        masks = simhash.tables(n)
        for _ in range(50):
            d = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(d & m == 0 for m in masks)


@pytest.fixture
def small_broadcasts(spark):
    """Spark refuses to broadcast more than 512 KB; what it estimates to be below 10 MB it tries to."""
    spark.conf.set("spark.sql.maxBroadcastTableSize", "512k")
    yield
    spark.conf.unset("spark.sql.maxBroadcastTableSize")


def test_simhash_keys_not_broadcast(spark, small_broadcasts):
    """8,000 fingerprints make 120,000 keys, of which Spark knows only the size before they were exploded."""
    near = spark.range(4000).selectExpr("inline(array(struct(xxhash64(id) AS fp), struct(xxhash64(id) ^ 5 AS fp)))")
    fps = simhash.staged(near, "fps")
    edges = simhash.links(fps, 20_000).collect()
    assert {(r.a ^ r.b) for r in edges} == {5} and len(edges) == 4000


TEXTS = ["", "a", " a", "the rain. The\nsea, and  two\t\tblanks ", "<|endoftext|>x <|endoftext|>", "é" * 50, "a\u00a0 b\u2028 c", "\x00 a\x00", "don't we'll, 12.5% of", "x" * 5000, "word " * 3000, " " * 300, "\n \n a"]


def test_tokens(spark, monkeypatch):
    tok = tokens.tokenizer(BPE)
    rng = random.Random(9)
    pieces = ["the", " ", "  ", "\n", " \n", "a", "é", "<|endoftext|>", "12", "'s", "!!", "\t", "\x1c", "\x85", "😀", "abc,", "def.", "x.\n", "y,."]
    texts = TEXTS + ["".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(300)]
    ids = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    for t, want in zip(texts, ids, strict=True):
        assert np.concatenate(list(tokens.resynchronised(tok, t, 16, 4))).tolist() == want
    own = tokens.Memo(BPE, len, 0)
    monkeypatch.setattr(tokens, "CHUNK", 24)
    monkeypatch.setattr(tokens, "OVERLAP", 7)
    assert own.spliced(pa.array(texts, pa.large_string())).tolist() == list(map(len, ids))
    monkeypatch.undo()
    big = " ".join(rng.choice(pieces) + "word" for _ in range(20000)) + "z" * 40000
    texts += [big, None, texts[3]]
    ids += [tok.encode(big, add_special_tokens=False).ids, [], ids[3]]
    docs = docs_of(spark, texts, extra=True).repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(docs, BPE).collect()}
    assert got == {i: (len((t or "").encode()), len(w), len(w) > 1024) for i, (t, w) in enumerate(zip(texts, ids, strict=True))}
    folder, manifest = tokens.write_tokens(docs, BPE, 2, parts=3)
    rows = sorted(tokens.read_tokens(spark, folder, manifest).collect())
    start = 0
    for r, w in zip(rows, ids, strict=True):
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(w) + 1, zlib.crc32(struct.pack(f"<{len(w) + 1}I", *w, 2)))
        start += len(w) + 1
    folder, manifest = tokens.write_tokens(docs.limit(0), BPE, 2, parts=3)
    assert tokens.read_tokens(spark, folder, manifest).count() == 0 and tokens.count_tokens(docs.limit(0), BPE).count() == 0
    nulls = spark.createDataFrame([(None, "a"), (-5, "b"), (-5, "b")], "doc_id long, text string")
    folder, manifest = tokens.write_tokens(nulls, BPE, 2, parts=2)
    assert [(r.doc_id, r.start, r.n_tokens) for r in tokens.read_tokens(spark, folder, manifest).orderBy("start").collect()] == [(None, 0, 2), (-5, 2, 2), (-5, 4, 2)]


def test_other_vocabularies(spark, tmp_path):
    """A file whose rules aren't the proven ones goes through the library whole, in counting and in writing."""
    assert tokens.proven(BPE)
    file = json.loads(open(BPE, encoding="utf-8").read())
    changes = {"lower": {"normalizer": {"type": "Lowercase"}}, "prefix": {"pre_tokenizer": file["pre_tokenizer"] | {"add_prefix_space": True}}, "special": {"added_tokens": [file["added_tokens"][0] | {"lstrip": True, "rstrip": True}]}, "none": {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False, "trim_offsets": True}}}
    texts = [*TEXTS, "The Rain, the SEA. " * 300, "a <|endoftext|> b", None]
    docs = docs_of(spark, texts)
    for name, change in changes.items():
        path = str(tmp_path / f"{name}.json")
        (tmp_path / f"{name}.json").write_text(json.dumps(file | change), encoding="utf-8")
        assert not tokens.proven(path)
        want = [len(e) for e in tokens.tokenizer(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
        assert [r.n_tokens for r in tokens.count_tokens(docs, path).orderBy("doc_id").collect()] == want
        folder, manifest = tokens.write_tokens(docs, path, 2, parts=2)
        assert [r.n_tokens - 1 for r in tokens.read_tokens(spark, folder, manifest).orderBy("doc_id").collect()] == want
    word = public_tokenizers.path("word_bpe_49k.json")
    assert not tokens.proven(word)
    want = [len(e) for e in tokens.tokenizer(word).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [r.n_tokens for r in tokens.count_tokens(docs, word).orderBy("doc_id").collect()] == want


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    for name in list(stages)[:-1]:
        assert stages[name](spark, docs, sf).columns == docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in stages["near_duplicates"](spark, docs, sf).collect()}
    ids = sorted(texts)
    comp = brute_components([brute_fingerprint(texts[i]) for i in ids])
    assert kept == {ids[c] for c in comp}
    clean = {r.doc_id for r in stages["decontaminated"](spark, docs, sf).collect()}
    hits = {r.doc_id: r.n_hit for r in decontamination.decontaminate(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert clean == {i for i, n in hits.items() if n == 0} and any(hits.values())
    good = {r.doc_id for r in stages["quality"](spark, docs, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert sum(i in good for i, q in labels.items() if q == 1) >= 0.98 * sum(q == 1 for q in labels.values())
    out = queries.pipeline(spark, sf)
    last = {r.doc_id for r in out.collect()}
    assert last and last <= good and set(out.columns) == {"doc_id", "size", "text_crc32", "shard", "slot"}


def test_pipeline_edges(spark):
    rows = [(1, "same text of a few words", "en", "a", 3), (1, "same text of a few words", "en", "a", 3), (None, "same text of a few words", None, None, None), (None, "another text that stands alone here", None, None, None), (2, None, "en", "b", 0), (3, "", "en", "b", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    assert sorted((str(r.doc_id), str(r.text)) for r in stage(spark, docs, "").collect()) == [("1", "same text of a few words"), ("2", "None"), ("None", "another text that stands alone here")]
    assert stage(spark, docs.limit(0), "").count() == 0
    sf = "/root/testdata/sf0.001"
    clashing = docs.selectExpr("*", "7 AS score", "8 AS n_hit", "9 AS shard", "'p' AS predicted", "'g' AS `group`", "1 AS n_words")
    for name, f in corpus_pipeline.STAGES[:-1]:
        out = f(spark, clashing, sf)
        assert out.columns == clashing.columns and {(r.score, r.n_hit, r.predicted) for r in out.collect()} <= {(7, 8, "p")}, name


def test_pipeline_of_nothing(spark, tmp_path):
    """Empty tables go through every stage and the whole run."""
    sf = "/root/testdata/sf0.001"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, f in corpus_pipeline.STAGES:
        out = f(spark, docs, str(tmp_path))
        assert out.count() == 0 and (name == "sharded" or out.columns == docs.columns), name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    few = spark.createDataFrame([(1, None, None, None, None), (None, "", "en", "a", 0), (2, "x " * 900, None, "b", 1800)], DOCS)
    for name, f in corpus_pipeline.STAGES:
        out = f(spark, few, str(tmp_path))
        assert out.count() == {"quality": 3, "near_duplicates": 2, "decontaminated": 3, "mixed": 2, "sharded": 3}[name], name


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("pages", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    mine = queries.QUERIES[name](spark, sf)
    theirs = con.sql(f"SELECT {', '.join(mine.columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, mine.collect()), key=str) == sorted(theirs, key=str)
