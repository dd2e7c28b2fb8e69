"""Phrases of two and three words, by direct-address tiling.

Words get ids in the order of their frequency, so that common words have small ids. Neighbouring ids are counted in
tiles of TILE x TILE cells: crowded tiles by dense bincounts, all other pairs as sorted coordinates with counts. Pairs
that are frequent enough are ranked again and get ids of their own; such a pair with the word behind it is a pair again,
and counted alike. A phrase that is frequent has only frequent parts, so nothing is lost on the way.

Tasks find ids in sorted files that they map into memory. Partial counts are added up by Spark; scores, containment and
ranks are joins and windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm import sorted_files
from rillflow.llm.common import staged
from rillflow.llm.tokens import pieces
from rillflow.operators.shared import in_order

LEAST, TOP, SHARE, NO_LANG = 10, 2000, 50, "und"
#: Sides of a tile; entries of one slice that make a tile dense; dense tiles that a task holds (4 MB each).
TILE, CROWDED, TILES = 1024, 1 << 14, 32
#: Coordinates that a task holds before it hands their counts over; words likewise; rows that leave a task at a time.
COORDINATES, WORDS, LEAVE = 1 << 20, 1 << 19, 1 << 16
#: Bytes of text that a task splits at a time (one text at least).
SPLIT = 1 << 20
#: Deals of a language's phrases, each of which keeps its own first ones.
DEALS = 64
_BITS = 31
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BLANK, _CUT = np.zeros(256, bool), np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_CUT[[*b".,;:!?\n\x0b\x0c\r"]] = True


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of the texts in order, lower-cased, with each one's text and piece (numbers that grow). All
    delimiters are ASCII, so bytes are looked at instead of characters."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    if data is None or ends[0] == ends[-1]:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    heads = ends[:-1] - ends[0]
    cut = _CUT[raw]
    inside = ~(cut | _BLANK[raw])
    fresh = np.zeros(len(raw) + 1, bool)  # a text starts here
    fresh[heads] = True
    before = np.concatenate([[False], inside])
    after = np.concatenate([inside, [False]])
    starts = np.flatnonzero(after & (~before | fresh))
    stops = np.flatnonzero(before & (~after | fresh))
    if not len(starts):
        return pa.array([], pa.large_string()), starts, starts
    bounds = np.stack([starts, stops], 1).ravel()  # words and the gaps between them take turns
    laid = pa.LargeStringArray.from_buffers(2 * len(starts) - 1, pa.py_buffer(bounds), pa.py_buffer(_LOWER[raw]))
    words = laid.take(pa.array(np.arange(0, 2 * len(starts) - 1, 2)))
    piece = np.cumsum(cut | fresh[:-1], dtype=np.int32)[starts]  # an array has fewer than 2^31 bytes
    return words, np.searchsorted(heads, starts, "right") - 1, piece


def coded(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[str], list[str]]]:
    """Slice by slice: each word occurrence's number among the slice's distinct (lang, word), its piece, and these."""
    at = 0
    for texts in pieces(batch.column("text"), chars=SPLIT):
        langs = batch.column("lang").slice(at, len(texts)).dictionary_encode()
        at += len(texts)
        words, text, piece = split(texts)
        if not len(words):
            continue
        coded_words = words.dictionary_encode()
        key = langs.indices.to_numpy()[text].astype(np.int64) * len(coded_words.dictionary) + coded_words.indices.to_numpy()
        cells = len(langs.dictionary) * len(coded_words.dictionary)
        if cells <= 1 << 23:
            used = np.zeros(cells, bool)
            used[key] = True
            distinct = np.flatnonzero(used)
            number = (np.cumsum(used) - 1)[key]
        else:
            distinct, number = np.unique(key, return_inverse=True)
        lang, word = np.divmod(distinct, len(coded_words.dictionary))
        yield number, piece, *(x.dictionary.take(pa.array(at)).to_numpy(zero_copy_only=False).tolist() for x, at in ((langs, lang), (coded_words, word)))


def of_langs(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), "text").where("text <> ''")


def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n) of every word; the row of a null word has the number of all of a language's words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, waiting = [], 0

        def summed() -> pa.Table:
            return pa.concat_tables(kept).group_by(["lang", "word"], use_threads=False).aggregate([("n", "sum")]).select(["lang", "word", "n_sum"]).rename_columns(["lang", "word", "n"]).combine_chunks()

        for batch in batches:
            for number, _, langs, words in coded(batch):
                n = np.bincount(number, minlength=len(words))
                one = pa.table({"lang": pa.array(langs, pa.large_string()), "word": pa.array(words, pa.large_string()), "n": n})
                total = one.group_by("lang", use_threads=False).aggregate([("n", "sum")])
                kept += [one, pa.table({"lang": total.column("lang"), "word": pa.nulls(len(total), pa.large_string()), "n": total.column("n_sum")})]
                waiting += len(one)
                if waiting > WORDS:
                    kept = [summed()]
                    waiting = len(kept[0])
                    if waiting > WORDS // 2:
                        yield from kept[0].to_batches(max_chunksize=LEAVE)
                        kept, waiting = [], 0
        if kept:
            yield from summed().to_batches(max_chunksize=LEAVE)

    return rows.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Lexicon(sorted_files.SortedFiles):
    """Ids of (lang, word) by digest; the stored strings confirm."""

    def ids(self, langs: list[str], words: list[str]) -> np.ndarray:
        import xxhash

        entries = [f"{len(x)}:{x}{w}" for x, w in zip(langs, words, strict=True)]
        digests = np.array([xxhash.xxh64_intdigest(e, 42) for e in entries], np.uint64).view(np.int64)
        order = np.argsort(digests)
        ordered, want = digests[order], pa.array(entries, pa.large_string()).take(pa.array(order))
        out = np.full(len(order), -1, np.int64)
        for table, keys, x, z in self.shards(ordered):
            at = np.searchsorted(keys, ordered[x:z])
            open_ = np.flatnonzero(at < len(keys))
            while len(open_):  # once, but for words that share a digest
                open_ = open_[keys[at[open_]] == ordered[x + open_]]
                places = pa.array(at[open_])
                same = pc.equal(table.column("entry").take(places), want.take(pa.array(x + open_))).to_numpy()
                out[x + open_[same]] = table.column("id").take(places).to_numpy()[same]
                open_ = open_[~same]
                at[open_] += 1
                open_ = open_[at[open_] < len(keys)]
        back = np.empty(len(order), np.int64)
        back[order] = out
        return back


def leaving(code: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(code, n) in batches of at most LEAVE rows: what a task hands over stands in memory several times on its way."""
    for i in range(0, len(code), LEAVE):
        yield pa.RecordBatch.from_arrays([pa.array(code[i : i + LEAVE]), pa.array(n[i : i + LEAVE])], names=["code", "n"])


class Tiles:
    """Counts pairs of ids: dense tiles, and sorted coordinates for the rest."""

    def __init__(self):
        self.dense: dict[int, np.ndarray] = {}
        self.codes, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.new: list[np.ndarray] = []
        self.waiting = 0

    def add(self, first: np.ndarray, second: np.ndarray) -> Iterator[pa.RecordBatch]:
        tile = (first // TILE << _BITS) | second // TILE
        which, back, entries = np.unique(tile, return_inverse=True, return_counts=True)
        rest = np.ones(len(first), bool)
        for k, (t, n) in enumerate(zip(which.tolist(), entries.tolist(), strict=True)):
            if t not in self.dense and (n < CROWDED or len(self.dense) >= TILES):
                continue
            own = back == k
            rest &= ~own
            cells = np.bincount(first[own] % TILE * TILE + second[own] % TILE, minlength=TILE * TILE).astype(np.int32)
            self.dense[t] = self.dense[t] + cells if t in self.dense else cells
            if self.dense[t].max() > 1 << 30:
                yield from self._of(t)
        self.new.append((first[rest] << _BITS) | second[rest])
        self.waiting += len(self.new[-1])
        if self.waiting > COORDINATES:
            self._sort()
            if len(self.codes) > COORDINATES // 2:
                yield from self._hand_over()

    def _of(self, t: int) -> Iterator[pa.RecordBatch]:
        cells = self.dense.pop(t)
        at = np.flatnonzero(cells)
        row, column = np.divmod(at, TILE)
        code = (((t >> _BITS) * TILE + row) << _BITS) | ((t & ((1 << _BITS) - 1)) * TILE + column)
        yield from leaving(code, cells[at].astype(np.int64))

    def _sort(self) -> None:
        new, n = np.unique(np.concatenate(self.new) if self.new else np.zeros(0, np.int64), return_counts=True)
        codes, n = np.concatenate([self.codes, new]), np.concatenate([self.counts, n])
        order = np.argsort(codes, kind="stable")
        codes, n = codes[order], n[order]
        heads = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
        self.codes, self.counts = codes[heads], np.add.reduceat(n, heads) if len(heads) else n
        self.new, self.waiting = [], len(self.codes)

    def _hand_over(self) -> Iterator[pa.RecordBatch]:
        codes, counts = self.codes, self.counts
        self.codes, self.counts, self.waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        yield from leaving(codes, counts)

    def finish(self) -> Iterator[pa.RecordBatch]:
        for t in list(self.dense):
            yield from self._of(t)
        self._sort()
        yield from self._hand_over()


def pair_counts(rows: DataFrame, lexicon, pairs=None) -> DataFrame:
    """(code, n) of neighbouring frequent words of a piece, where a code is the two ids; with the frequent pairs' files,
    of such a pair and the word behind it, if that word also ends a frequent pair with the word before it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ranked, tiles = Lexicon(lexicon, "digest"), sorted_files.SortedFiles(pairs, "code") if pairs else None, Tiles()
        for batch in batches:
            for number, piece, langs, strings in coded(batch):
                ids = words.ids(langs, strings)[number]
                at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0) & (piece[:-1] == piece[1:]))
                first, second = ids[at], ids[at + 1]
                if ranked:
                    pair = np.full(len(ids), -1, np.int64)  # of the word and the next one
                    pair[at] = ranked.numbers((first << _BITS) | second, "id")
                    at = np.flatnonzero((pair[:-2] >= 0) & (pair[1:-1] >= 0))
                    first, second = pair[at], ids[at + 2]
                if len(at):
                    yield from tiles.add(first, second)
        yield from tiles.finish()

    return rows.mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def ranked(counts: DataFrame, ties: list[str], name: str) -> tuple[DataFrame, int]:
    """counts with an id for each row, the most frequent first, and their number."""
    rows = staged(in_order(counts.withColumn("rare", -F.col("n")), ["rare", *ties], "id", {}).drop("rare"), name)
    n = rows.count()
    if n >= 1 << _BITS:
        raise ValueError(f"{n} {name}: ids have {_BITS} bits")
    return rows, n


def phrases(documents: DataFrame, least: int = LEAST, top: int = TOP, share: int = SHARE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases of two or three words.

    a is how often the phrase stands within pieces (between marks and line ends), at least `least` times; l and r are the
    frequencies of the two parts of its lowest-scoring cut, n counts all words of the language, and the score is
    1000000 a a / (l r), rounded down, in exact decimals. Phrases whose words lie in a longer one that is at least
    `share` % as frequent are left out. Ties go by frequency, then by the phrase's bytes. A null lang is `und`; null,
    empty and blank texts have no words. Repeated rows count each; texts of any length are read whole, and a text is the
    least that one task splits at a time. An empty table gives an empty result; other columns aren't read.
    """
    rows = of_langs(documents)
    counted = staged(word_counts(rows).where(f"n >= {least} OR word IS NULL"), "words")
    totals = counted.where("word IS NULL").select("lang", F.col("n").alias("total"))
    words, n_words = ranked(counted.where("word IS NOT NULL"), ["lang", "word"], "word-ranks")
    entry = F.concat(F.length("lang").cast("string"), F.lit(":"), "lang", "word")
    lexicon = sorted_files.write(words.select(F.xxhash64(entry).alias("digest"), F.col("id").cast("int").alias("id"), entry.alias("entry")), "digest", n_words, "lexicon")

    pairs, n_pairs = ranked(staged(pair_counts(rows, lexicon).where(f"n >= {least}"), "pairs"), ["code"], "pair-ranks")
    files = sorted_files.write(pairs.select("code", F.col("id").cast("int").alias("id")), "code", n_pairs, "pair-ids")
    triples = staged(pair_counts(rows, lexicon, files).where(f"n >= {least}"), "triples")

    left, right = (lambda c: F.shiftright(c, _BITS)), (lambda c: F.col(c).bitwiseAND(F.lit((1 << _BITS) - 1)))
    word = lambda k: words.select(F.col("id").alias(f"w{k}"), F.col("word").alias(f"word{k}"), F.col("n").alias(f"n{k}"), *([F.col("lang")] if k == 1 else []))
    two = pairs.select("code", F.col("n").alias("a"), left("code").alias("w1"), right("code").alias("w2")).join(word(1), "w1").join(word(2), "w2")
    head = pairs.select(F.col("id").alias("pair"), F.col("code").alias("code12"), F.col("n").alias("n12"))
    three = triples.select(left("code").alias("pair"), right("code").alias("w3"), F.col("n").alias("a")).join(head, "pair")
    three = three.withColumns({"w1": left("code12"), "w2": right("code12")}).withColumn("code23", F.shiftleft("w2", _BITS).bitwiseOR(F.col("w3")))
    three = staged(three.join(pairs.select(F.col("code").alias("code23"), F.col("n").alias("n23")), "code23"), "three")
    longer = staged(three.select(F.explode(F.array("code12", "code23")).alias("code"), "a").groupBy("code").agg(F.max("a").alias("longer")), "longer")
    two = two.join(longer, "code", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))

    floors = lambda l_, r_: F.expr(f"(CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(16,0)) * CAST(a AS DECIMAL(16,0))) div (CAST({l_} AS DECIMAL(16,0)) * CAST({r_} AS DECIMAL(16,0)))")
    cut = lambda k, l_, r_: F.struct(floors(l_, r_).alias("score"), F.lit(k).alias("k"), F.col(l_).alias("l"), F.col(r_).alias("r"))
    two = two.select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", cut(1, "n1", "n2").alias("c"))
    three = three.join(word(1), "w1").join(word(2), "w2").join(word(3), "w3")
    three = three.select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", F.least(cut(1, "n1", "n23"), cut(2, "n12", "n3")).alias("c"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    deal = F.pmod(F.xxhash64("phrase"), F.lit(DEALS))
    found = two.unionByName(three).select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    # A language's phrases are dealt first; each deal's first ones meet in a window of at most DEALS * top rows.
    some = found.withColumn("_n", F.row_number().over(Window.partitionBy("lang", deal).orderBy(*order))).where(F.col("_n") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
