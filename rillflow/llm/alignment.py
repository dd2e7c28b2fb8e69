"""Alignment of two tokenizers over the bytes of a text, on Arrow arrays.

A batch of texts becomes two list arrays of ids, which are flattened with their parents' indices. Segmented cumulative
sums of the tokens' lengths give their ends; an Acero join on (document, end) lines both up. Filled backwards, its rows
are the links: each stretch between two neighbouring ends lies in one token of either side, and each overlapping pair has
one such stretch. Where both end, a group ends. Each document's links are written beside its sums, so texts are encoded and
aligned once; Arrow's group_by then counts in how many documents a pair of ids is linked, Spark adds up these partial
counts, and the written links are looked up in them.

Both sides encode a text unit by unit (cut as in `tokens`) and keep what common units give, if
the vocabularies allow it: `tokens.proven` says so for the first, `cuttable` for the second.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import mounted, new_path, staged
from rillflow.llm.tokens import _WORD as WORD
from rillflow.llm.tokens import LONGEST, byte_characters, pieces, proven, tokenizer, units

#: Characters that are aligned at a time; longer texts are aligned in several parts.
PART = 1 << 19
#: Units that a worker keeps, about (some 200 bytes each).
KEPT = 400_000
#: Pairs of ids that a task counts before it hands them over, and in a file of counts.
PAIRS = 1 << 21
#: Links that a task reads at a time.
LINKS = 1 << 20
_CROSSED = re.compile("[A-Za-z0-9\xc0-\xd6\xd8-\xf6\xf8-\xff][,.]")
#: A space that follows a non-blank: both sides may be cut there.
_PLACE = re.compile(r"(?<=\S)(?= )")


@lru_cache
def pieces_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache
def cuttable(path: str) -> bool:
    """Whether a text may be cut where `tokens.units` cuts it: the text is taken as it is, and no piece holds a space after
    another character, a comma or full stop after a letter or digit, or a line end beside anything."""
    from sentencepiece import sentencepiece_model_pb2

    model, file = pieces_model(path), sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        file.ParseFromString(f.read())
    spec = file.normalizer_spec
    plain = not spec.precompiled_charsmap and spec.add_dummy_prefix and not spec.remove_extra_whitespaces and spec.escape_whitespaces
    normal = [p.piece for p in file.pieces if p.type == 1]
    inside = any("▁" in p.lstrip("▁") or ("\n" in p and len(p) > 1) or _CROSSED.search(p) for p in normal)
    own = all(p.type in (1, 2, 3, 6) for p in file.pieces)  # normal, unknown, control and byte pieces only
    return bool(plain and own and not inside and not file.trainer_spec.treat_whitespace_as_suffix and file.trainer_spec.model_type == 2 and model.piece_to_id("▁") > 0)


#: The numbers of a document; the last two need the counts of the whole corpus.
SUMS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


@dataclass
class Side:
    """A vocabulary: its ids' bytes and their lengths, by id, and the encoder of texts that start with a space."""

    written: pa.Array
    lengths: pa.Array
    encode: Callable[[list[str]], list[list[int]]]


def side_of(written: list[bytes], encode: Callable[[list[str]], list[list[int]]]) -> Side:
    return Side(pa.array(written, pa.large_binary()), pa.array([len(w) for w in written], pa.int64()), encode)


@lru_cache
def byte_level(path: str) -> Side:
    """The first side: a byte-level vocabulary; special strings in a text are plain text. Where units are known to be
    pieces of the splitting pattern, words of letters go to its merges directly."""
    tok = tokenizer(path)
    tok.encode_special_tokens = True
    letters, cut = byte_characters(), proven(path)
    space, merge = letters[ord(" ")], tok.model.tokenize

    def encode(texts: list[str]) -> list[list[int]]:
        out: list = [None] * len(texts)
        rest = []
        for i, t in enumerate(texts):
            if cut and WORD.fullmatch(t):
                out[i] = [x.id for x in merge((space + t[1:] if t[0] == " " else t) if t.isascii() else t.encode().decode("latin-1").translate(letters))]
            else:
                rest.append(i)
        for i, e in zip(rest, tok.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = e.ids
        return out

    bytes_of_letter = {c: x for x, c in letters.items()}
    written = [tok.id_to_token(i) or "" for i in range(tok.get_vocab_size())]
    return side_of([bytes(bytes_of_letter[c] for c in w) if all(c in bytes_of_letter for c in w) else w.encode() for w in written], encode)


@lru_cache
def piece_level(path: str) -> Side:
    """The second side: a sentencepiece vocabulary; byte pieces stand for their byte. The model adds the space that a text
    starts with; one that is nothing else would vanish, and is its own piece. A unit without a space is encoded behind a
    line end, which stays apart in a cuttable vocabulary, and the ids of both go."""
    model = pieces_model(path)
    space, before = [model.piece_to_id("▁")], len(model.encode("\n"))

    def encode(texts: list[str]) -> list[list[int]]:
        ids = model.encode([t[1:] if t[:1] == " " else "\n" + t for t in texts], num_threads=1)
        return [space if t == " " else x if t[:1] == " " else x[before:] for t, x in zip(texts, ids, strict=True)]

    written = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))]
    return side_of(written, encode)


class Units:
    """Both sides' ids of texts, unit by unit; each distinct unit is encoded once as long as it is kept.

    Ids of all kept units lie in one array per side; a text's ids are gathered from there. When there are too many units,
    all are let go.
    """

    def __init__(self, path_a: str, path_b: str):
        self.sides = byte_level(path_a), piece_level(path_b)
        self.whole = not (proven(path_a) and cuttable(path_b))
        self.forget()

    def forget(self) -> None:
        self.kept: dict[str, int] = {}
        self.flat = [np.zeros(0, np.int32)] * 2
        self.ends = [np.zeros(1, np.int64)] * 2

    def cut(self, texts: pa.Array) -> pa.Array:
        if self.whole:
            return pa.LargeListArray.from_arrays(pa.array(np.arange(len(texts) + 1)), texts)
        return units(texts)

    def ids(self, texts: pa.Array) -> tuple[pa.LargeListArray, pa.LargeListArray]:
        cut = self.cut(texts)
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))])
        coded = cut.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.kept) > KEPT:
            self.forget()
        place = np.fromiter(map(self.kept.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(place < 0)
        flat, ends = list(self.flat), list(self.ends)
        if len(new):
            asked = [distinct[i] for i in new.tolist()]
            place[new] = np.arange(len(new)) + len(ends[0]) - 1
            for s, side in enumerate(self.sides):
                ids = [x for i in range(0, len(asked), 4096) for x in side.encode(asked[i : i + 4096])]
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                flat[s] = np.concatenate([flat[s], np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))])
                ends[s] = np.concatenate([ends[s], ends[s][-1] + np.cumsum(sizes)])
            if max(map(len, asked)) <= LONGEST:
                self.kept.update(zip(asked, place[new].tolist(), strict=True))
                self.flat, self.ends = flat, ends
            else:  # long units aren't kept: the arrays of this call go, and short ones are learnt again
                short = [u for u in asked if len(u) <= LONGEST]
                self._learn(short, [dict(zip(asked, place[new].tolist(), strict=True))[u] for u in short], flat, ends)
        at = place[coded.indices.to_numpy()]
        out = []
        for f, e in zip(flat, ends, strict=True):
            sizes = np.diff(e)[at]
            upto = np.concatenate([[0], np.cumsum(sizes)])
            ids = f[np.arange(upto[-1]) + np.repeat(e[at] - upto[:-1], sizes)]
            out.append(pa.LargeListArray.from_arrays(pa.array(upto[bounds]), pa.array(ids)))
        return out[0], out[1]

    def _learn(self, units: list[str], at: list[int], flat: list[np.ndarray], ends: list[np.ndarray]) -> None:
        self.kept.update(zip(units, range(len(self.ends[0]) - 1, len(self.ends[0]) - 1 + len(units)), strict=True))
        for s in (0, 1):
            own = [flat[s][ends[s][i] : ends[s][i + 1]] for i in at]
            self.flat[s] = np.concatenate([self.flat[s], *own])
            self.ends[s] = np.concatenate([self.ends[s], self.ends[s][-1] + np.cumsum([len(x) for x in own], dtype=np.int64)])


@lru_cache(maxsize=2)
def units_of(path_a: str, path_b: str) -> Units:
    """This worker's units."""
    return Units(path_a, path_b)


@lru_cache
def decimals(n_a: int, n_b: int) -> pa.Array:
    """Every id in decimal with what may follow it: ids of the first side with `,` and `|`, of the second with `,`, `;`
    and nothing."""
    return pa.array([b"%d%s" % (i, x) for n, marks in ((n_a, (b",", b"|")), (n_b, (b",", b";", b""))) for x in marks for i in range(n)], pa.large_binary())


def parts(text: str, whole: bool) -> list[str]:
    """A text, with its leading space, in parts of about PART characters, cut where both sides allow it."""
    out, at = [], 0
    while not whole and len(text) - at > PART:
        place = _PLACE.search(text, at + PART)
        if place is None:
            break
        out.append(text[at : place.start()])
        at = place.start()
    return [*out, text[at:]]


def slices(texts: pa.Array, whole: bool) -> Iterator[tuple[list[int], list[str], list[bool]]]:
    """Rows, parts of their texts, and whether a part is its text's last; PART characters at a time, or one part."""
    rows, some, last, size = [], [], [], 0
    for i, t in enumerate(texts):
        t = t.as_py()
        if not t:
            continue
        own = parts(" " + t, whole)
        for k, p in enumerate(own):
            if rows and size + len(p) > PART:
                yield rows, some, last
                rows, some, last, size = [], [], [], 0
            rows.append(i)
            some.append(p)
            last.append(k + 1 == len(own))
            size += len(p)
    if rows:
        yield rows, some, last


def bytes_of(side: Side, ids: pa.Array) -> np.ndarray:
    laid = side.written.take(ids)
    _, offsets, data = laid.buffers()
    ends = np.frombuffer(offsets, np.int64, len(laid) + 1, laid.offset * 8)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)


def token_ends(side: Side, ids: pa.LargeListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parent of each token, its end within the parent (a segmented cumulative sum), and the parents' lengths."""
    parent = pc.list_parent_indices(ids).to_numpy()
    upto = pc.cumulative_sum(side.lengths.take(ids.flatten())).to_numpy()
    heads = np.concatenate([[0], upto])[ids.offsets.to_numpy()]
    return parent, upto - heads[parent], np.diff(heads)


def true_parts(texts: pa.Array, a: Side, b: Side, ids_a: pa.LargeListArray, ids_b: pa.LargeListArray) -> np.ndarray:
    """Which texts both sides' tokens spell."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    want, ok = np.frombuffer(data, np.uint8), np.ones(len(texts), bool)
    for side, ids in ((a, ids_a), (b, ids_b)):
        got, sizes = bytes_of(side, ids.flatten()), token_ends(side, ids)[2]
        if np.array_equal(sizes, np.diff(ends)) and np.array_equal(got, want[ends[0] : ends[-1]]):
            continue
        at = np.concatenate([[0], np.cumsum(sizes)])
        ok &= [np.array_equal(got[at[i] : at[i + 1]], want[ends[i] : ends[i + 1]]) for i in range(len(texts))]
    return ok


@dataclass
class Aligned:
    """One slice: per part the tokens, groups and links, and the text of its groups; links as (part, code)."""

    ok: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    said: list[memoryview] | None
    part: np.ndarray
    code: np.ndarray


def align(texts: list[str], last: list[bool], own: Units, say: bool) -> Aligned:
    """Aligns texts that start with a space, or parts of texts. Parts that a side doesn't spell count nothing."""
    spaced, (a, b) = pa.array(texts, pa.large_string()), own.sides
    ids_a, ids_b = own.ids(spaced)
    ok = true_parts(spaced, a, b, ids_a, ids_b)
    if not ok.all():  # they keep their place as empty lists
        ids_a, ids_b = (pc.if_else(pa.array(ok), x, pa.scalar([], x.type)) for x in (ids_a, ids_b))
        ids_a, ids_b = (pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(pc.list_value_length(x).to_numpy())])), x.flatten()) for x in (ids_a, ids_b))
    tables = []
    for side, ids, name in ((a, ids_a, "a"), (b, ids_b, "b")):
        parent, end, _ = token_ends(side, ids)
        tables.append(pa.table({"part": parent, "end": end, name: np.arange(len(parent))}))
    n = len(texts)
    n_a, n_b = (pc.list_value_length(x).to_numpy() for x in (ids_a, ids_b))
    met = tables[0].join(tables[1], ["part", "end"], join_type="full outer", use_threads=False).combine_chunks()
    base = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    part = met.column("part").to_numpy()
    met = met.take(pa.array(np.argsort(base[part] + met.column("end").to_numpy())))
    part, in_a, in_b = met.column("part").to_numpy(), *(pc.is_valid(met.column(c)).to_numpy() for c in "ab")
    both = in_a & in_b
    of_a, of_b = (pc.fill_null_backward(met.column(c)).to_numpy() for c in "ab")
    flat_a, flat_b = ids_a.flatten().to_numpy(), ids_b.flatten().to_numpy()
    code = flat_a[of_a].astype(np.int64) * len(b.written) + flat_b[of_b] if len(part) else np.zeros(0, np.int64)
    said = None
    if say:
        group = np.cumsum(both) - both  # of each row; rows of a side's tokens come in their order
        group_a, group_b, ends_a, ends_b = group[in_a], group[in_b], both[in_a], both[in_b]
        before_a, before_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=int(both.sum())))]) for g in (group_a, group_b))
        final = np.zeros(len(flat_b), bool)
        final[np.cumsum(n_b)[(n_b > 0) & np.array(last)] - 1] = True
        size_a, size_b = len(a.written), len(b.written)
        at = np.empty(len(flat_a) + len(flat_b), np.int64)
        at[np.arange(len(flat_a)) + before_b[group_a]] = flat_a + np.where(ends_a, size_a, 0)
        at[np.arange(len(flat_b)) + before_a[group_b + 1]] = 2 * size_a + flat_b + np.where(final, 2 * size_b, np.where(ends_b, size_b, 0))
        laid = decimals(size_a, size_b).take(pa.array(at))
        _, offsets, data = laid.buffers()
        places = np.frombuffer(offsets, np.int64, len(laid) + 1, laid.offset * 8)[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()
        view = memoryview(data) if data is not None else memoryview(b"")
        said = [view[x:z] for x, z in zip(places, places[1:], strict=False)]
    count = lambda at: np.bincount(at, minlength=n)
    return Aligned(ok, n_a, n_b, count(part[both]), count(part), said, part, code)


def documents_of(texts: pa.Array, by: Units, say: bool) -> Iterator[tuple[list[tuple], pa.Table]]:
    """For the texts with tokens, some at a time: (row, n_a, n_b, n_groups, n_links, sha256), and the table (doc, code, n)
    of their links, where doc counts these documents and n how often one holds the link.

    A text of several parts ends in the slice of its last part; what its earlier parts gave waits for that.
    """
    held: list | None = None  # [row, ok, four sums, sha256, links (code, n) so far]
    for rows, some, last in slices(texts, by.whole):
        found = align(some, last, by, say)
        pa.default_memory_pool().release_unused()
        sums = np.stack([found.n_a, found.n_b, found.n_groups, found.n_links], 1)
        linked = pa.table({"doc": found.part, "code": found.code}).group_by(["doc", "code"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["doc", "code", "n"])
        if held is None and all(last) and found.ok.all():
            done = [(r, *s, hashlib.sha256(t).hexdigest()) for r, s, t in zip(rows, sums.tolist(), found.said or [b""] * len(rows), strict=True)]
            yield done, linked
            continue
        done, tables = [], []
        doc, edges = linked.column("doc").to_numpy(), np.arange(len(rows) + 1)
        order = np.argsort(doc, kind="stable")
        linked, edges = linked.take(pa.array(order)), np.searchsorted(doc[order], edges)
        for k, (row, end) in enumerate(zip(rows, last, strict=True)):
            if held is None:
                held = [row, True, np.zeros(4, np.int64), hashlib.sha256(), None]
            held[1] = held[1] and bool(found.ok[k])
            held[2] = held[2] + sums[k]
            if say:
                held[3].update(found.said[k])
            own = linked.slice(edges[k], edges[k + 1] - edges[k]).select(["code", "n"])
            if held[4] is not None:
                own = pa.concat_tables([held[4], own]).group_by("code", use_threads=False).aggregate([("n", "sum")]).rename_columns(["code", "n"])
            held[4] = own
            if end:
                if held[1]:
                    tables.append(own.add_column(0, "doc", pa.array(np.full(len(own), len(done)), pa.int64())))
                    done.append((held[0], *held[2].tolist(), held[3].hexdigest()))
                held = None
        if done:
            yield done, pa.concat_tables(tables)


def binaries(values: list[np.ndarray], rows: list[int], n: int) -> pa.Array:
    """The bytes of each array at its row, of n rows; rows ascend, the others are empty."""
    sizes = np.zeros(n, np.int64)
    sizes[rows] = [x.nbytes for x in values]
    data = np.concatenate(values) if values else np.zeros(0, np.uint8)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)])), pa.py_buffer(data)])


def numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """What `binaries` wrote: all 64-bit numbers in order, and where each row's start (and the last one's end)."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    own = data[int(ends[0]) : int(ends[-1])] if data is not None else b""
    return np.frombuffer(own, "<i8"), (ends - ends[0]) // 8


def bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of documents with at most LINKS links, but of one row at least."""
    ends, at = np.cumsum(pc.binary_length(batch.column("codes")).to_numpy(zero_copy_only=False).astype(np.int64) // 8), 0
    while at < len(ends):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + LINKS, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def aligned(documents: DataFrame, path_a: str, path_b: str, columns: list[str]) -> DataFrame:
    """Written: the columns as c0, c1 and so on, each document's sums and sha256, and its distinct links as 64-bit
    numbers: codes, and how often it holds each."""
    kinds = [documents.schema[c].dataType.simpleString() for c in columns]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = units_of(path_a, path_b)
        for batch in batches:
            at = 0
            for texts in pieces(batch.column("text"), chars=1 << 22):
                out, said, rows, codes, times = np.zeros((len(texts), 4), np.int64), [""] * len(texts), [], [], []
                for done, linked in documents_of(texts, by, say=True):
                    doc, code, n = (linked.column(c).to_numpy() for c in ("doc", "code", "n"))
                    order = np.argsort(doc, kind="stable")
                    edges = np.searchsorted(doc[order], np.arange(len(done) + 1)).tolist()
                    code, n = code[order].astype("<i8"), n[order].astype("<i8")
                    for (row, *four, sha), x, z in zip(done, edges, edges[1:], strict=False):
                        out[row], said[row] = four, sha
                        rows.append(row)
                        codes.append(code[x:z])
                        times.append(n[x:z])
                own = [batch.column(c).slice(at, len(texts)) for c in columns]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(out[:, i]) for i in range(4)), pa.array(said), *(binaries(x, rows, len(texts)).cast(pa.binary()) for x in (codes, times))], names=[*(f"c{i}" for i in range(len(own))), *SUMS[:4], "groups_sha256", "codes", "times"])
                at += len(texts)

    schema = "".join(f"c{i} {k}, " for i, k in enumerate(kinds)) + ", ".join(f"{x} long" for x in SUMS[:4]) + ", groups_sha256 string, codes binary, times binary"
    return staged(documents.select(*dict.fromkeys([*columns, "text"])).mapInArrow(apply, schema), "aligned")


def pair_counts(found: DataFrame, size: int) -> DataFrame:
    """(code, n, best): in how many of the aligned documents each pair of ids is linked, and whether no pair of its first
    id has more. A code is the first id times the size of the second vocabulary, plus the second id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, waiting = [], 0

        def summed() -> pa.Table:
            return pa.concat_tables(kept).group_by("code", use_threads=False).aggregate([("n", "sum")]).rename_columns(["code", "n"]).combine_chunks()

        for batch in batches:
            for few in bounded(batch):
                linked = pa.table({"code": numbers(few.column("codes"))[0]})
                kept.append(linked.group_by("code", use_threads=False).aggregate([([], "count_all")]).rename_columns(["code", "n"]))
                waiting += len(kept[-1])
                if waiting > PAIRS:
                    kept = [summed()]
                    waiting = len(kept[0])
                    if waiting > PAIRS // 2:
                        yield from kept[0].to_batches()
                        kept, waiting = [], 0
        if kept:
            yield from summed().to_batches()

    counts = found.select("codes").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = staged(counts.withColumn("a", F.floor(F.col("code") / size)), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return staged(counts.join(most, "a").select("code", "n", (F.col("n") == F.col("most")).alias("best")), "pair-ranks")


def write_counts(counts: DataFrame) -> tuple[str, list[tuple[int, str, int]]]:
    """Writes the counts as sorted arrays in flat files, and returns the folder and (first code, file, pairs) of each.

    There are at most as many pairs as the vocabularies have, whatever the corpus; readers map the files into memory.
    """
    folder = new_path(counts.sparkSession, "pair-files")
    root = mounted(folder)
    os.makedirs(root, exist_ok=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows = [b for b in batches if b.num_rows]
        if rows:
            table, name = pa.Table.from_batches(rows), f"pairs-{TaskContext.get().taskAttemptId()}"
            with open(f"{root}/{name}", "wb") as out:
                for column, kind in (("code", "<i8"), ("n", "<i8"), ("best", np.uint8)):
                    out.write(table.column(column).to_numpy().astype(kind).tobytes())
            yield pa.RecordBatch.from_pydict({"first": [table.column("code")[0].as_py()], "file": [name], "pairs": [len(table)]})

    ordered = counts.repartitionByRange(counts.count() // PAIRS + 1, "code").sortWithinPartitions("code")
    files = staged(ordered.select("code", "n", "best").mapInArrow(write, "first long, file string, pairs long"), "pair-manifest")
    return folder, sorted(tuple(r) for r in files.collect())  # one row per file


class Counts:
    """The counts of pairs, mapped into memory."""

    def __init__(self, folder: str, files: list[tuple[int, str, int]]):
        self.first, self.files = np.array([f[0] for f in files], np.int64), []
        for _, name, n in files:
            data = np.memmap(f"{mounted(folder)}/{name}", np.uint8, "r")
            self.files.append((data[: 8 * n].view("<i8"), data[8 * n : 16 * n].view("<i8"), data[16 * n :]))

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count of each code, and whether it is a best one; every code is in the files."""
        distinct, back = np.unique(codes, return_inverse=True)
        cuts = [0, *np.searchsorted(distinct, self.first[1:]).tolist(), len(distinct)]
        n, best = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
        for (keys, counts, flags), x, z in zip(self.files, cuts, cuts[1:], strict=False):
            if z > x:
                at = np.searchsorted(keys, distinct[x:z])
                n[x:z], best[x:z] = counts[at], flags[at]
        return n[back], best[back]


def align_documents(documents: DataFrame, path_a: str, path_b: str, columns: list[str] = ("doc_id",)) -> DataFrame:
    """The columns of every document with n_a, n_b, n_groups, n_links, n_best, count_sum (long) and groups_sha256.

    Null and empty texts, and texts that a vocabulary can't spell (the sentencepiece one writes U+2581 as a space), have
    zeros and ''. Repeated rows count each as a document. Texts of any length are aligned part by part (those of
    vocabularies that no cut is proven for, whole). An empty table gives an empty result; other columns aren't read.
    """
    columns = list(dict.fromkeys(columns))
    found = aligned(documents, path_a, path_b, columns)
    folder, files = write_counts(pair_counts(found, len(piece_level(path_b).written)))
    own = [f"c{i}" for i in range(len(columns))]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(folder, files)
        for batch in batches:
            for few in bounded(batch):
                (code, edges), (times, _) = (numbers(few.column(c)) for c in ("codes", "times"))
                n, best = counts.of(code)
                sums = [pa.array(np.diff(np.concatenate([[0], np.cumsum(times * x)])[edges])) for x in (best, n)]
                yield pa.RecordBatch.from_arrays([*(few.column(c) for c in [*own, *SUMS[:4]]), *sums, few.column("groups_sha256")], names=[*columns, *SUMS, "groups_sha256"])

    schema = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in columns)
    return found.mapInArrow(apply, f"{schema}, {', '.join(f'{x} long' for x in SUMS)}, groups_sha256 string")
