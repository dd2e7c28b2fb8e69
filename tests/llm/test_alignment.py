"""Alignment of two tokenizers against the libraries and plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rillflow.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "a ", "\n", "a  b   c", "<s> </s> <0x41> <unk>", "▁a", "a▁b", "x<|endoftext|> y", "\0 a\0", "   x  ", "日本語 テキスト 🙂", "\t a\r\n b ", "é" * 300, " . , ;", "it's 12345,67 (ok).\n\nNew", "  b c"]


def brute(texts):
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    left, right = alignment.byte_level(A).written.to_pylist(), alignment.piece_level(B).written.to_pylist()
    rows, links, held = [], [], Counter()
    for text in texts:
        ids, links_here, groups = ([], []), Counter(), []
        if text:
            ids = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            spelled = [b"".join(w[i] for i in x) for x, w in zip(ids, (left, right), strict=True)]
            if any(s != (" " + text).encode() for s in spelled):
                ids = [], []
        ends = [np.cumsum([len(w[i]) for i in x]).tolist() for x, w in zip(ids, (left, right), strict=True)]
        i = j = 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            x, y = i, j
            while i < len(ids[0]) and ends[0][i] <= e:
                i += 1
            while j < len(ids[1]) and ends[1][j] <= e:
                j += 1
            groups.append(",".join(map(str, ids[0][x:i])) + "|" + ",".join(map(str, ids[1][y:j])))
            for p in range(x, i):
                for q in range(y, j):
                    if max(ends[0][p] - len(left[ids[0][p]]), ends[1][q] - len(right[ids[1][q]])) < min(ends[0][p], ends[1][q]):
                        links_here[ids[0][p], ids[1][q]] += 1
        held.update(links_here.keys())
        links.append(links_here)
        rows.append([len(ids[0]), len(ids[1]), len(groups), sum(links_here.values()), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""])
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    return [(*r[:4], sum(n for k, n in x.items() if held[k] == best[k[0]]), sum(n * held[k] for k, n in x.items()), r[4]) for r, x in zip(rows, links, strict=True)]


@pytest.mark.parametrize(("part", "kept", "longest"), [(1 << 20, 400_000, 64), (300, 20, 4)])
def test_aligned(monkeypatch, part, kept, longest):
    """Every value, with texts in one part and in many, and units that are kept and let go."""
    monkeypatch.setattr(alignment, "KEPT", kept)
    monkeypatch.setattr(alignment, "LONGEST", longest)
    rng = random.Random(4)
    words = ["the", "of", "naïve", "straße", "x1", "12,5", "(a)", "co-op", "üß", "end.\nNew", "tab\there"]
    texts = ODD + [" ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 900]))) for _ in range(40)] + ["twice here"] * 2
    want = brute(texts)
    monkeypatch.setattr(alignment, "PART", part)
    units, got, links = alignment.Units(A, B), {}, {}
    import pyarrow as pa

    for done, linked in alignment.documents_of(pa.array(texts, pa.large_string()).fill_null(""), units, True):
        for i, (row, *four, sha) in enumerate(done):
            got[row] = (*four, sha)
            mine = linked.filter(pa.compute.equal(linked.column("doc"), i))
            links[row] = dict(zip(mine.column("code").to_pylist(), mine.column("n").to_pylist(), strict=True))
    for i, w in enumerate(want):
        assert got.get(i, (0, 0, 0, 0, "")) == (*w[:4], w[6]), texts[i]
        assert sum(links.get(i, {}).values()) == w[3]


def test_documents(spark):
    """Through Spark: corpus-wide counts, repeated rows, clashing names, and an empty table."""
    texts = ODD + ["one two two", "two one", "one, two!"] * 3
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in enumerate(texts)], "doc_id int, text string, n long, code string, best int")
    rows = alignment.align_documents(df.repartition(5), A, B, ["doc_id", "n", "code", "best"]).collect()
    want = brute(texts)
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == want[r.doc_id], texts[r.doc_id]
        assert (r.n, r.code, r.best) == (1, "x", 2)
    twice = alignment.align_documents(df.unionByName(df), A, B).collect()
    assert Counter(r.doc_id for r in twice) == Counter({i: 2 for i in range(len(texts))})
    assert {r.doc_id: r.count_sum for r in twice} == {r.doc_id: 2 * r.count_sum for r in rows}
    assert alignment.align_documents(df.limit(0), A, B).collect() == []


def test_read_once(spark):
    """Every text is read, and so encoded and aligned, once."""
    read = spark.sparkContext.accumulator(0)

    def noted(row):
        read.add(1)
        return row

    df = spark.createDataFrame(spark.sparkContext.parallelize(list(enumerate(ODD)), 3).map(noted), "doc_id int, text string", verifySchema=False)
    assert len(alignment.align_documents(df, A, B).collect()) == len(ODD)
    assert read.value == len(ODD)


@pytest.mark.parametrize("links", [1, 3, 1 << 20])
def test_written_links(monkeypatch, links):
    """Arrays come back from their bytes, from slices of a batch too, and rows without any are empty."""
    import pyarrow as pa

    monkeypatch.setattr(alignment, "LINKS", links)
    values = [np.arange(k, dtype="<i8") + (1 << 40) for k in (2, 5, 1)]
    batch = pa.record_batch({"codes": alignment.binaries(values, [1, 2, 5], 7).cast(pa.binary()), "row": list(range(7))})
    got = {}
    for few in [y for x in (batch.slice(0, 2), batch.slice(2)) for y in alignment.bounded(x)]:
        flat, ends = alignment.numbers(few.column("codes"))
        got |= {row: flat[x:z].tolist() for row, x, z in zip(few.column("row").to_pylist(), ends, ends[1:], strict=False)}
    assert got == {i: [] for i in range(7)} | {1: values[0].tolist(), 2: values[1].tolist(), 5: values[2].tolist()}


def test_cuttable():
    assert alignment.cuttable(B)
