"""Token counts and token files with a public byte-level BPE vocabulary.

Texts are cut only where the cut can't change a token: before a space that follows a non-space. The byte-level
splitting pattern lets no token hold a space after a non-space, and it looks only ahead, so tokens left of such a place
depend on the left part alone and tokens right of it on the right part alone. That is proven for one kind of file only:
`proven` reads the file's settings, and texts of any other vocabulary go through the library whole.

Counting encodes every text by overlapping chunks that are spliced at such places (resynchronisation).
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import mounted, new_path, staged

#: Characters in a chunk (a common text has one to a few), and in the overlap of neighbouring chunks at first.
CHUNK, OVERLAP = 2048, 128
#: Atoms in each of a worker's two generations (at most some 600 bytes each, 200 commonly), and the longest atom kept.
MEMO, LONGEST = 700_000, 64

#: Texts with a NUL, or with a blank before a space, are cut by a slower search.
_ODD = "\\x00|[\\t\\n\\x0b\\x0c\\r \\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}] "
#: Further places where the pattern surely ends a token: between a letter or digit and a comma or full stop, and around
#: a line end between a non-blank and a letter.
_ENDS = (("([A-Za-z0-9\xc0-\xd6\xd8-\xf6\xf8-\xff])([,.])", "\\1\0\\2"), ("([!-~\xa1-\xff])\n([A-Za-z])", "\\1\0\n\0\\2"))
_PLACES = re.compile(r"(?<=\S)(?= )")
#: Letters and digits that the splitting pattern surely takes as such.
_WORD = re.compile("[ ]?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
_PLAIN = frozenset("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZäöüßáéíóúñàèùâêîôûëïçÄÖÜÉÈÊÇÑÁÍÓÚ")


def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_padding()
    tok.no_truncation()
    return tok


@lru_cache
def proven(path: str) -> bool:
    """Whether the file has the rules that the cuts are proven for: byte-level BPE with its standard splitting pattern,
    no normalizer, merges without dropout, affixes or whole-word shortcuts, and special strings that take no white space
    along and hold no place where texts are cut."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    split, model = file.get("pre_tokenizer") or {}, file.get("model") or {}
    plain = file.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("add_prefix_space") is False and split.get("use_regex", True)
    merges = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    letters = merges and set(byte_characters().values()) <= model["vocab"].keys()
    added = file.get("added_tokens") or []
    strings = [t["content"] for t in added]
    bare = not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    uncut = all(len(u) == 1 and atoms(u[0]) == u for u in units(pa.array(strings, pa.large_string())).to_pylist())
    return bool(plain and letters and bare and uncut)


def units(texts: pa.Array) -> pa.Array:
    """Each text cut at every proven place, as a list; joined, the units are the text."""
    odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
    marked = pc.replace_substring(texts, " ", "\0 ")
    for pattern, marks in _ENDS:
        marked = pc.replace_substring_regex(marked, pattern, marks)
    cut = pc.split_pattern(marked, "\0")
    if not odd.any():
        return cut
    slow = pa.array([_PLACES.split(t) for t in texts.filter(pa.array(odd)).to_pylist()], cut.type)
    order = np.empty(len(texts), np.int64)
    order[np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])] = np.arange(len(texts))
    return pa.concat_arrays([cut.filter(pa.array(~odd)), slow]).take(pa.array(order))


def pieces(texts: pa.Array, rows: int = 8192, chars: int = 1 << 23) -> Iterator[pa.Array]:
    """The array in slices of bounded rows and bytes (but of one row at least); nulls become empty texts."""
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        limit = (ends[at - 1] if at else 0) + chars
        upto = max(at + 1, min(at + rows, int(np.searchsorted(ends, limit, "right"))))
        yield texts.slice(at, upto - at)
        at = upto


def atoms(unit: str) -> list[str]:
    """A unit cut further where the pattern surely ends a token: around a line end between non-blanks, and between a
    letter or digit and the full stops and commas that end a line of the unit."""
    lines = unit.split("\n")
    if len(lines) > 1 and unit.removeprefix(" ").split() != unit.removeprefix(" ").split("\n"):
        return [unit]
    out = []
    for i, line in enumerate(lines):
        if i:
            out.append("\n")
        stem = line.rstrip(",.")
        out += [stem, line[len(stem) :]] if stem != line and stem and stem[-1] in _PLAIN else [line]
    return out


def byte_characters() -> dict[int, str]:
    """The character by which a byte-level vocabulary writes each byte: visible ones of Latin-1 by themselves, the
    others by those from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Memo:
    """Encodes texts unit by unit through the library, each distinct atom once as long as it is kept.

    A word of letters (with a space before it or not) is one piece of the splitting pattern, so the library's merges
    are applied to it directly; other atoms go through the whole tokenizer. When a generation is full, it becomes the
    old one; an old unit that comes again moves to the new generation.
    """

    def __init__(self, path: str, value, nothing):
        self.tok, self.value, self.nothing, self.proven = tokenizer(path), value, nothing, proven(path)
        self.merge, self.characters = self.tok.model.tokenize, byte_characters()
        self.kept, self.old = {"": nothing}, {}

    def encode(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The values of all texts' units in order, and where each text's units start (and the last one's end). A text
        of a file without proven cuts is one unit."""
        kind = pa.int64() if self.nothing == 0 else pa.large_binary()
        if not self.proven:
            return pa.array([self.value(e.ids) for e in self.tok.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)], kind), np.arange(len(texts) + 1)
        return self.coded(units(texts), kind)

    def coded(self, cut: pa.Array, kind: pa.DataType) -> tuple[pa.Array, np.ndarray]:
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))])
        coded = cut.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        own = self.learn(distinct)
        kept = self.kept
        values = pa.array([kept[u] if u in kept else own[u] for u in distinct] if own else list(map(kept.__getitem__, distinct)), kind)
        return values.take(coded.indices), bounds

    def learn(self, distinct: list[str]) -> dict:
        """The values of the units that aren't kept: those of several atoms, and long ones. The others are kept."""
        if len(self.kept) > MEMO:
            self.old, self.kept = self.kept, {"": self.nothing}
        kept, old, value = self.kept, self.old, self.value
        compound, asked = [], []
        for u in set(distinct).difference(kept):
            if (v := old.get(u)) is not None:
                kept[u] = v
            elif "\n" in u:
                compound.append((u, atoms(u)))
            elif u[-1] in ",." and (stem := u.rstrip(",.")) and stem[-1] in _PLAIN:
                compound.append((u, [stem, u[len(stem) :]]))
            else:
                asked.append(u)
        if compound:
            asked = list(set(asked).union(*(some for _, some in compound)).difference(kept))
            if old:
                kept.update((a, old[a]) for a in asked if a in old)
                asked = [a for a in asked if a not in kept]
        word, merge, characters, rest = _WORD.fullmatch, self.merge, self.characters, []
        space = characters[ord(" ")]
        for a in asked:
            if word(a):
                written = (space + a[1:] if a[0] == " " else a) if a.isascii() else a.encode().decode("latin-1").translate(characters)
                kept[a] = value([t.id for t in merge(written)])
            else:
                rest.append(a)
        rest.sort()
        for few in _groups(rest):
            kept.update(zip(few, [value(e.ids) for e in self.tok.encode_batch_fast(few, add_special_tokens=False)], strict=True))
        if self.nothing == 0:
            own = {u: sum([kept[a] for a in some]) for u, some in compound if len(some) > 1}
        else:
            own = {u: self.nothing.join([kept[a] for a in some]) for u, some in compound if len(some) > 1}
        return own | {a: kept.pop(a) for a in asked if len(a) > LONGEST}

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        values, bounds = self.encode(texts)
        upto = np.concatenate([[0], np.cumsum(values.to_numpy())])
        return upto[bounds[1:]] - upto[bounds[:-1]]

    def spliced(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text, from overlapping chunks of CHUNK characters.

        Neighbouring chunks are encoded apart and spliced at the last place of their overlap where both have a boundary
        and the cut is proven. Where there is none, the text goes through `resynchronised`, which widens the overlap. A
        text within one chunk has nothing to splice.
        """
        long = np.flatnonzero(pc.greater(pc.utf8_length(texts), CHUNK).to_numpy(zero_copy_only=False)) if self.proven else []
        if not len(long):
            return self.counts(texts)
        step, whole = CHUNK - OVERLAP, [texts[i].as_py() for i in long.tolist()]
        starts = [range(0, len(t) - OVERLAP, step) for t in whole]
        chunks = pa.array([t[a : a + CHUNK] for t, s in zip(whole, starts, strict=True) for a in s], pa.large_string())
        own = np.ones(len(texts), bool)
        own[long] = False
        # Texts of one chunk and the chunks of the others, in one call.
        cut = units(pa.concat_arrays([texts.filter(pa.array(own)), chunks]))
        values, bounds = self.coded(cut, pa.int64())
        upto = np.concatenate([[0], np.cumsum(values.to_numpy())])
        chars = np.concatenate([[0], np.cumsum(pc.utf8_length(cut.flatten()).to_numpy())])
        n, k = np.zeros(len(texts), np.int64), int(own.sum())
        n[own] = upto[bounds[1 : k + 1]] - upto[bounds[:k]]
        for i, text, some in zip(long.tolist(), whole, starts, strict=True):
            last = None  # the places and counts of the chunk before: where its units end, and its ids up to there
            done = 0
            for a in some:
                b, z = bounds[k], bounds[k + 1]
                ends, ids = chars[b + 1 : z + 1] - chars[b] + a, upto[b + 1 : z + 1] - upto[b]
                k += 1
                if last is None:
                    first = 0
                elif done >= 0:
                    e, c = last
                    common = np.intersect1d(e[e > a], ends[ends < e[-1]])
                    place = next((p for p in common[::-1].tolist() if text[p] == " " and not text[p - 1].isspace()), None)
                    if place is None:
                        done = -1
                        continue
                    done += int(c[np.searchsorted(e, place)]) - first
                    first = int(ids[np.searchsorted(ends, place)])
                last = ends, ids
            n[i] = done + int(last[1][-1]) - first if done >= 0 else sum(len(x) for x in resynchronised(self.tok, text))
        return n

    def ids(self, texts: pa.Array) -> list[memoryview]:
        """The bytes of each text's ids."""
        values, bounds = self.encode(texts)
        _, offsets, data = values.buffers()
        at = np.frombuffer(offsets, np.int64, len(values) + 1, values.offset * 8)[bounds].tolist()
        view = memoryview(data) if data is not None else memoryview(b"")
        return [view[a:z] for a, z in zip(at, at[1:], strict=False)]


_memos: dict[tuple, Memo] = {}


def memo(path: str, what: str) -> Memo:
    """This worker's memo: what a unit is worth is its number of ids (count) or the ids in 16 or 32 bits (<u2, <u4)."""
    code = "H" if what == "<u2" else "I"
    if (path, what) not in _memos:
        _memos[path, what] = Memo(path, len, 0) if what == "count" else Memo(path, lambda ids: array(code, ids).tobytes(), b"")
    return _memos[path, what]


def _groups(items: list[str], chars: int = 1 << 20) -> Iterator[list[str]]:
    group, size = [], 0
    for x in items:
        group.append(x)
        size += len(x)
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def resynchronised(tok, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[np.ndarray]:
    """The ids of one text, piece by piece, from overlapping chunks.

    A chunk and the next one, which starts `overlap` characters before the first one's end, are spliced at a character
    position where both have a token boundary and which is a proven place. The place must lie inside the overlap, past
    the new chunk's start. Where there is none, the overlap doubles; where it has reached back to the first chunk's
    start, the first chunk grows instead. So at most a stretch without any proven place is encoded in one call.
    """

    def encode(at: int, end: int):
        e = tok.encode(text[at:end], add_special_tokens=False)
        off = np.array(e.offsets, np.int64).reshape(-1, 2) + at
        return np.array(e.ids, np.int64), off[:, 0], off[:, 1]

    at, size = 0, chunk
    end = min(len(text), size)
    ids, starts, ends = encode(at, end)
    while end < len(text):
        back, place = overlap, None
        while place is None and back < end - at:
            begin = end - back
            upto = min(len(text), begin + max(chunk, 2 * back))
            new = encode(begin, upto)
            # Both encodings must show the boundary: a token of the old ends there and one of the new starts there.
            common = np.intersect1d(ends[(ends > begin) & (ends < end)], new[1])
            place = next((p for p in common[::-1].tolist() if text[p] == " " and not text[p - 1].isspace()), None)
            back *= 2
        if place is None:
            size *= 2
            end = min(len(text), at + size)
            ids, starts, ends = encode(at, end)
            continue
        yield ids[: int(np.searchsorted(ends, place, "right"))]
        first = int(np.searchsorted(new[1], place, "left"))
        ids, starts, ends = new[0][first:], new[1][first:], new[2][first:]
        at, end, size = place, upto, chunk
    yield ids


def count_tokens(documents: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document.

    A null text counts as empty, an empty text has 0 tokens. Special strings inside a text become their special id, as
    the library does by default. Texts of any length are counted chunk by chunk, repeated rows one by one; an empty
    table gives an empty result. Rows stay where they are; other columns aren't read.
    """
    key = documents.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = memo(path, "count")
        for batch in batches:
            at = 0
            for texts in pieces(batch.column("text")):
                n = own.spliced(texts)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(texts)), pc.binary_length(texts).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit, pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
                at += len(texts)

    return documents.select("doc_id", "text").mapInArrow(count, f"doc_id {key}, n_bytes long, n_tokens long, over_limit boolean")


def write_tokens(documents: DataFrame, path: str, end_id: int = 2, parts: int | None = None) -> tuple[str, list[tuple[int, int, int]]]:
    """Writes every text's ids and end_id as flat files in ascending doc_id order; returns the folder and the manifest.

    Part p has ids-p.bin (unsigned 16-bit little-endian ids, or 32-bit for larger vocabularies), offsets-p.bin (64-bit:
    the start of each document in the part, then the part's length) and docs-p.bin (64-bit doc_ids). The manifest has
    (part, documents, ids) for each part; bases are their prefix sums. A null text counts as empty; null doc_ids come
    first, written as the smallest 64-bit number; documents of one doc_id follow in order of their text's hash. Files
    appear by rename: a part that is written again, after a lost executor, is the same part.
    """
    spark = documents.sparkSession
    folder = new_path(spark, "tokens")
    root = mounted(folder)
    os.makedirs(root, exist_ok=True)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    ordered = rows.repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h")
    kind = id_type(path, end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part, temp = context.partitionId(), f"{root}/tmp-{context.partitionId()}-{context.taskAttemptId()}"
        own = memo(path, kind)
        tail, width, at, n = np.array([end_id], kind).tobytes(), np.dtype(kind).itemsize, 0, 0
        with open(f"{temp}-ids", "wb") as ids, open(f"{temp}-offsets", "wb") as offsets, open(f"{temp}-docs", "wb") as docs:
            for batch in batches:
                docs.write(batch.column("doc_id").to_numpy().astype("<i8").tobytes())
                for texts in pieces(batch.column("text")):
                    data = own.ids(texts)
                    sizes = np.array([len(x) // width + 1 for x in data], "<i8")
                    offsets.write((at + np.cumsum(sizes) - sizes).astype("<i8").tobytes())
                    ids.writelines(x for pair in zip(data, repeat(tail), strict=False) for x in pair)
                    at, n = at + int(sizes.sum()), n + len(data)
            offsets.write(np.array([at], "<i8").tobytes())
        for name in ("docs", "offsets", "ids"):
            os.replace(f"{temp}-{name}", f"{root}/{name}-{part:05d}.bin")
        yield pa.RecordBatch.from_pydict({"part": [part], "documents": [n], "ids": [at]})

    manifest = staged(ordered.mapInArrow(write, "part long, documents long, ids long"), "manifest")
    return folder, sorted(tuple(r) for r in manifest.collect())  # one row per part


def id_type(path: str, end_id: int) -> str:
    return "<u2" if max(tokenizer(path).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def read_tokens(spark, folder: str, manifest: list[tuple[int, int, int]], kind: str = "<u2") -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the memory-mapped files: one task per part."""
    root = mounted(folder)
    bases = np.concatenate([[0], np.cumsum([m[2] for m in manifest])]).tolist()
    filled = [(m[0], b) for m, b in zip(manifest, bases, strict=False) if m[1]]
    if not filled:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column("id").to_pylist():
                part, base = filled[i]
                ids = np.memmap(f"{root}/ids-{part:05d}.bin", kind, "r")
                offsets, docs = (np.memmap(f"{root}/{x}-{part:05d}.bin", "<i8", "r") for x in ("offsets", "docs"))
                for k in range(0, len(docs), 8192):
                    at = offsets[k : k + 8193]
                    few, size = np.array(docs[k : k + 8192]), np.diff(at)
                    crc = [zlib.crc32(ids[a : a + s].astype("<u4").tobytes()) for a, s in zip(at.tolist(), size.tolist(), strict=False)]
                    yield pa.RecordBatch.from_arrays([pa.array(few, pa.int64(), mask=few == -(2**63)), pa.array(at[: len(few)] + base, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return spark.range(0, len(filled), 1, len(filled)).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
