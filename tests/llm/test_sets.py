"""SetSketch near duplicates and phrases against plain Python."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from rillflow.llm import collocations, setsketch


def brute_sets(texts, percent=85):
    sets = []
    for t in texts:
        ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
        sets.append({tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set())
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = i, j
                while root[x] != x:
                    x = root[x]
                while root[y] != y:
                    y = root[y]
                root[max(x, y)] = min(x, y)
    out = []
    for i, s in enumerate(sets):
        x = i
        while root[x] != x:
            x = root[x]
        out.append((len(s), x, x == i))
    return out


def near_texts(rng):
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n\t", "a b", "A  b", "a b c d e", "A b\nc d e"]
    for size in (6, 40, 120, 300):
        for _ in range(6):
            base = [rng.choice(words) for _ in range(size)]
            for edits in (0, 0, 1, 2, 3, size // 40, size // 25):
                copy = list(base)
                for _ in range(edits):
                    copy[rng.randrange(size)] = rng.choice(words)
                texts.append(" ".join(copy))
    chain = [rng.choice(words) for _ in range(200)]  # neighbours link, the ends don't
    for step in range(12):
        chain = chain[:-4] + [f"new{step}-{i}" for i in range(4)] if step else chain
        chain = chain[4:] + chain[:4]
        texts.append(" ".join(chain))
    texts.append(" ".join(rng.choice(words) for _ in range(30_000)))
    return texts


@pytest.mark.parametrize("group", [4096, 3])
def test_near_duplicates(spark, monkeypatch, group):
    """All links, also where keys are compared chunk by chunk."""
    monkeypatch.setattr(setsketch.links, "__defaults__", (group,))
    texts = near_texts(random.Random(5))
    df = spark.createDataFrame([(i, t, "x", 1, b"") for i, t in enumerate(texts)], "doc_id long, text string, node string, hi int, regs binary").repartition(3)
    rows = setsketch.near_duplicates(df, ["node", "doc_id"]).collect()
    want = brute_sets(texts)
    assert len(rows) == len(texts) and any(not k for *_, k in want)
    for r in rows:
        assert (r.n_shingles, r.component_id, r.kept) == want[r.doc_id], r.doc_id
        assert r.node == "x"


def test_ids(spark):
    """Repeated rows, one id for two texts, null ids, and an empty table."""
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(5, long), (5, long), (3, long), (None, long), (9, "x y"), (9, long + " end"), (None, "alone here"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, setsketch.near_duplicates(df).collect()), key=str)
    want = [(5, 46, 3, False)] * 2 + [(3, 46, 3, True), (None, 46, 3, False), (9, 1, 9, True), (9, 47, 3, False), (None, 1, None, True), (None, 0, None, True)]
    assert got == sorted(want, key=str)
    assert setsketch.near_duplicates(df.limit(0)).collect() == []


def test_registers():
    """Registers merge, are equal about as often as sets overlap, and the likelihood keeps what is similar enough."""
    rng, m = np.random.default_rng(1), 170
    x = np.unique(rng.integers(0, 1 << 63, 3000).astype(np.uint64))
    assert (setsketch.merged(setsketch.registers(x[:1000], m), setsketch.registers(x[900:], m)) == setsketch.registers(x, m)).all()
    assert (setsketch.registers(x[:1], m) > 0).all() and setsketch.bands(80) > setsketch.bands(85)
    one, other = setsketch.registers(x[:1000], m), setsketch.registers(x[81:1081], m)  # 919 of 1081: 0.85
    assert abs((one == other).mean() - setsketch.equal_share(0.5, 0.85)) < 0.1
    both = np.stack([other, setsketch.registers(x[1500:2500], m)])
    assert setsketch.likely(one, both, 1000, np.array([1000, 1000]), 0.85).tolist() == [True, False]


def brute_phrases(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if c.isascii() else c for c in text or "")):
            ws = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(ws)
            for m in (1, 2, 3):
                counts[lang].update(tuple(ws[i : i + m]) for i in range(len(ws) - m + 1))
    out = set()
    for lang, f in counts.items():
        longer = defaultdict(int)
        for g, n in f.items():
            if len(g) == 3 and n >= least:
                for h in (g[:2], g[1:]):
                    longer[h] = max(longer[h], n)
        found = []
        for g, a in f.items():
            if len(g) > 1 and a >= least and not (len(g) == 2 and g in longer and 100 * longer[g] >= 50 * a):
                score, k = min((10**6 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out |= {(lang, i + 1, p.decode(), -a, l_, r, totals[lang], -s) for i, (s, a, p, l_, r) in enumerate(sorted(found)[:top])}
    return out


@pytest.mark.parametrize(("crowded", "least", "top"), [(1 << 14, 3, 2000), (1, 2, 7)])
def test_phrases(spark, monkeypatch, crowded, least, top):
    rng = random.Random(6)
    words = ["the", "The", "of", "a", "a", "né", "É", "x\x00y", "b-b", "b-b", "long" * 40, "\x0b", "z.", "q,", "e\n", "f\tg", "h  i", "j k"]
    rows = [(rng.choice(["en", "de", None, "und", ""]), " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 40, 300])))) for _ in range(120)]
    rows += [("en", None), ("en", ""), ("de", " . \t"), ("xx", "only once"), ("en", "a a a a a a"), ("en", "a" * 100_000), (None, "new york city " * 50)] + [("fr", "tout à fait")] * 4
    df = spark.createDataFrame([(*r, 1, "w", 2) for r in rows], "lang string, text string, n int, word string, code int").repartition(3)
    got = {tuple(r) for r in collocations.phrases(df, least, top).collect()}
    assert got == brute_phrases(rows, least, top)


def test_no_phrases(spark):
    df = spark.createDataFrame([("en", "a b c"), (None, None)], "lang string, text string")
    assert collocations.phrases(df).collect() == [] and collocations.phrases(df.limit(0)).collect() == []


def test_tiles(monkeypatch):
    """Crowded tiles and sorted coordinates give the same counts, whatever is handed over on the way."""
    rng = np.random.default_rng(2)
    first, second = (rng.zipf(1.3, 200_000) % 50_000 for _ in range(2))
    want = Counter(zip(first.tolist(), second.tolist(), strict=True))
    for crowded, held in ((1 << 14, 1 << 21), (100, 5000), (1 << 40, 3000)):
        monkeypatch.setattr(collocations, "CROWDED", crowded)
        monkeypatch.setattr(collocations, "COORDINATES", held)
        tiles, got = collocations.Tiles(), Counter()
        batches = [b for i in range(0, len(first), 20_000) for b in tiles.add(first[i : i + 20_000], second[i : i + 20_000])] + list(tiles.finish())
        for b in batches:
            for code, n in zip(b.column("code").to_pylist(), b.column("n").to_pylist(), strict=True):
                got[code >> 31, code & ((1 << 31) - 1)] += n
        assert got == want


def test_tasks_hold_little():
    """What splitting and counting take beside the texts stays bounded, and counts leave in small batches."""
    rng = np.random.default_rng(5)
    text = " ".join(f"w{i}" for i in rng.integers(0, 1 << 40, 1 << 18).tolist())
    batch = pa.record_batch({"lang": ["en"] * 4, "text": pa.array([text[i : i + (1 << 20)] for i in range(0, 1 << 22, 1 << 20)], pa.string())})
    seen, sizes = Counter(), []
    tracemalloc.start()
    tiles = collocations.Tiles()
    for number, *_ in collocations.coded(batch):
        seen["words"] += len(number)
    split = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    for _ in range(16):
        sizes += [b.num_rows for b in tiles.add(rng.integers(0, 1 << 20, 1 << 18), rng.integers(0, 1 << 20, 1 << 18))]
    sizes += [b.num_rows for b in tiles.finish()]
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen["words"] > 250_000 and sum(sizes) >= 4_000_000
    assert max(sizes) <= 1 << 16 and split < 64 << 20 and held < 96 << 20, (max(sizes), split >> 20, held >> 20)
