"""Quality classifier: a byte-level convolutional network, written and trained in numpy.

Each text's UTF-8 bytes are cut into overlapping chunks that cover the whole text. Learned filters slide over the
embedded bytes of a chunk and are max-pooled over its positions; the pooled vectors of all chunks are combined (maximum,
mean and minimum over chunks) and a small dense layer turns them into one probability.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import mounted, new_path

#: Fitting uses so many labelled rows at most, half of each class, chosen by a hash of doc_id; scoring has no bound.
TRAIN_ROWS = 3000
CHUNK, OVERLAP = 1024, 128
WIDTH, STEP, EMBED, FILTERS, HIDDEN = 12, 4, 8, 32, 16
EPOCHS, BATCH, RATE, SEED = 10, 32, 4e-3, 7
#: Chunks that one convolution handles at a time: bounds the memory of a text of any length.
GROUP = 128


@dataclass
class Network:
    embed: np.ndarray
    filters: np.ndarray
    filter_bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def new(cls, rng: np.random.Generator) -> Network:
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        embed = normal(256, EMBED, scale=0.5)
        embed[0] = 0
        return cls(embed, normal(WIDTH * EMBED, FILTERS, scale=0.15), np.zeros(FILTERS, np.float32), normal(3 * FILTERS, HIDDEN, scale=0.12), np.zeros(HIDDEN, np.float32), normal(HIDDEN, 1, scale=0.25), np.zeros(1, np.float32))

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        """[chunks, positions, WIDTH * EMBED] of byte chunks, without a copy."""
        e = self.embed[chunks]
        n = (CHUNK - WIDTH) // STEP + 1
        a, b, c = e.strides
        return np.lib.stride_tricks.as_strided(e, (len(chunks), n, WIDTH * EMBED), (a, STEP * b, c))

    def pool(self, chunks: np.ndarray) -> np.ndarray:
        """[chunks, FILTERS]: each filter's largest response in a chunk."""
        out = [np.zeros((0, FILTERS), np.float32)]
        for i in range(0, len(chunks), GROUP):
            w = np.ascontiguousarray(self.windows(chunks[i : i + GROUP]))
            out.append(np.maximum((w.reshape(-1, WIDTH * EMBED) @ self.filters).reshape(*w.shape[:2], FILTERS).max(1) + self.filter_bias, 0))
        return np.concatenate(out)

    def combine(self, docs: np.ndarray) -> np.ndarray:
        h = np.maximum(docs @ self.hidden + self.hidden_bias, 0)
        return 1 / (1 + np.exp(-np.clip((h @ self.out + self.out_bias)[:, 0].astype(np.float64), -30, 30)))


def n_chunks(size: int) -> int:
    return max(1, -(-(size - OVERLAP) // (CHUNK - OVERLAP)))


def cut(data, first: int = 0, end: int | None = None) -> np.ndarray:
    """[chunks, CHUNK] overlapping chunks of a buffer, from number `first` to before `end`; all of them cover all bytes.
    The last one is zero-padded; an empty text has one chunk of zeros."""
    step = CHUNK - OVERLAP
    end = n_chunks(len(data)) if end is None else end
    out = np.zeros((end - first, CHUNK), np.uint8)
    for i in range(first, end):
        piece = data[i * step : i * step + CHUNK]
        out[i - first, : len(piece)] = np.frombuffer(piece, np.uint8)
    return out


def packed(counts: list[int], size: int = GROUP) -> Iterator[list[tuple[int, int, int]]]:
    """(text, first chunk, end) spans over all chunks of all texts in order, in lists of at most `size` chunks."""
    spans, room = [], size
    for i, n in enumerate(counts):
        at = 0
        while at < n:
            take = min(room, n - at)
            spans.append((i, at, at + take))
            at, room = at + take, room - take
            if not room:
                yield spans
                spans, room = [], size
    if spans:
        yield spans


def merged(pooled: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """[docs, 3 * FILTERS] of chunk vectors: maximum, mean and minimum over each document's chunks."""
    return np.concatenate([np.maximum.reduceat(pooled, starts), np.add.reduceat(pooled, starts) / counts[:, None], np.minimum.reduceat(pooled, starts)], 1)


def gradients(net: Network, texts: list, y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross entropy of the texts' scores and y, by each of the network's arrays. GROUP chunks are held at a
    time, and for the others their pooled vectors."""
    counts = np.array([n_chunks(len(t)) for t in texts])
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    groups = list(packed(counts.tolist()))
    held = lambda spans: np.concatenate([cut(texts[i], a, z) for i, a, z in spans])
    args, pools = [], []
    for spans in groups:
        w = np.ascontiguousarray(net.windows(held(spans)))
        r = (w.reshape(-1, WIDTH * EMBED) @ net.filters).reshape(*w.shape[:2], FILTERS)
        args.append(r.argmax(1))
        pools.append(np.maximum(np.take_along_axis(r, args[-1][:, None], 1)[:, 0] + net.filter_bias, 0))
    pooled = np.concatenate(pools)
    docs = merged(pooled, starts, counts)
    h = np.maximum(docs @ net.hidden + net.hidden_bias, 0)
    p = 1 / (1 + np.exp(-np.clip((h @ net.out + net.out_bias)[:, 0], -30, 30)))
    g = ((p - y) / len(y)).astype(np.float32)[:, None]
    grads = {"out": h.T @ g, "out_bias": g.sum(0)}
    gh = (g @ net.out.T) * (h > 0)
    grads |= {"hidden": docs.T @ gh, "hidden_bias": gh.sum(0)}
    gd, owner = gh @ net.hidden.T, np.repeat(np.arange(len(texts)), counts)
    top, mid, low = np.split(gd[owner], 3, 1)
    hi, _, lo = np.split(docs[owner], 3, 1)
    largest, least = (e / np.add.reduceat(e, starts)[owner] for e in ((pooled == hi).astype(np.float32), (pooled == lo).astype(np.float32)))  # ties share
    gp = (top * largest + mid / counts[owner][:, None] + low * least) * (pooled > 0)
    grads["filter_bias"] = gp.sum(0)
    grads["filters"], grads["embed"], at = np.zeros_like(net.filters), np.zeros_like(net.embed), 0
    for spans, arg in zip(groups, args, strict=True):
        chunks, g = held(spans), gp[at : at + len(arg)]
        at += len(arg)
        places = (arg[:, :, None] * STEP + np.arange(WIDTH)).reshape(len(arg), -1)
        seen = np.take_along_axis(chunks, places, 1)
        best = net.embed[seen].reshape(len(arg), FILTERS, WIDTH * EMBED)
        grads["filters"] += np.einsum("cf,cfw->wf", g, best, optimize=True)
        ge = (g[:, :, None] * net.filters.T[None]).reshape(-1, EMBED)
        grads["embed"] += np.stack([np.bincount(seen.ravel(), ge[:, j], 256) for j in range(EMBED)], 1).astype(np.float32)
    grads["embed"][0] = 0
    return grads


def fit(texts: list, labels: np.ndarray) -> Network:
    """Adam on the cross entropy, over all chunks of each text (bytes or a mapped stretch of a file); of a batch, GROUP
    chunks at a time are held, and for the others their pooled vectors. The same rows in the same order give the same network; without both classes the
    network stays as initialised, with a bias that gives the one class (or, without rows, 0.5)."""
    rng = np.random.default_rng(SEED)
    net = Network.new(rng)
    if len(set(labels.tolist())) < 2:
        net.out[:] = 0
        net.out_bias[:] = 0 if not len(labels) else (3 if labels[0] else -3)
        return net
    names = [f.name for f in fields(Network)]
    moments = {n: [np.zeros_like(getattr(net, n)), np.zeros_like(getattr(net, n))] for n in names}
    step, rounds = 0, max(EPOCHS, -(-400 * BATCH // len(texts)))
    for epoch in range(min(rounds, 40)):
        order = rng.permutation(len(texts))
        for k in range(0, len(order), BATCH):
            pick = order[k : k + BATCH]
            grads = gradients(net, [texts[i] for i in pick], labels[pick].astype(np.float32))
            step += 1
            rate = RATE * min(1, step / 20) * (1 - 0.8 * epoch / max(1, min(rounds, 40)))
            for n in names:
                m, v = moments[n]
                m += 0.1 * (grads[n] - m)
                v += 0.01 * (grads[n] ** 2 - v)
                getattr(net, n)[...] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return net


def scores(net: Network, texts: list[bytes]) -> np.ndarray:
    """The score of each text; GROUP chunks are laid out at a time, whatever a text's length."""
    counts = [n_chunks(len(t)) for t in texts]
    if not counts:
        return np.zeros(0)
    pooled = np.concatenate([net.pool(np.concatenate([cut(texts[i], a, z) for i, a, z in spans])) for spans in packed(counts)])
    return net.combine(merged(pooled, np.concatenate([[0], np.cumsum(counts)[:-1]]), np.array(counts)))


def held_out(doc_id):
    """Whether crc32 of doc_id as text leaves 0 by 5; false for a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Network:
    """Fits on labelled rows that aren't held out: at most `rows` of them, half of each class, with their whole texts.

    A doc_id with several labels takes the lowest, one with several documents the one of smallest text hash; null
    labels and ids are left out, a null text counts as empty. Only the chosen ids are sent to the scan of documents
    (their number is bounded by `rows`). Their texts are written to the shared folder and mapped into memory.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picks = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows // 2) for q in (0, 1)]
    chosen = picks[0].unionByName(picks[1])
    text = F.coalesce("text", F.lit(""))
    sample = documents.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h")).join(F.broadcast(chosen), "doc_id")
    sample = sample.groupBy("doc_id", "quality").agg(F.min_by("text", "h").alias("text")).sortWithinPartitions("doc_id")
    root = mounted(new_path(documents.sparkSession, "training-texts"))
    os.makedirs(root, exist_ok=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part, at = context.partitionId(), 0
        name, temp = f"{root}/{part:05d}.bin", f"{root}/{part:05d}.{context.taskAttemptId()}"
        places = []
        with open(temp, "wb") as out:
            for batch in batches:
                sizes = [out.write(t.encode()) for t in batch.column("text").to_pylist()]
                ends = at + np.cumsum(sizes, dtype=np.int64)
                places.append((batch.column("doc_id"), batch.column("quality"), ends - np.array(sizes, np.int64), ends))
                at = int(ends[-1]) if sizes else at
        os.replace(temp, name)
        for ids, quality, starts, ends in places:
            yield pa.RecordBatch.from_arrays([ids, quality.cast(pa.int32()), pa.array([part] * len(ids), pa.int32()), pa.array(starts), pa.array(ends)], names=["doc_id", "quality", "part", "start", "end"])

    found = sorted(sample.mapInArrow(write, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, quality int, part int, start long, end long").collect())
    files = {p: np.memmap(f"{root}/{p:05d}.bin", np.uint8, "r") for p in {r.part for r in found if r.end > r.start}}
    nothing = np.zeros(0, np.uint8)
    return fit([files[r.part][r.start : r.end] if r.end > r.start and r.part in files else nothing for r in found], np.array([r.quality for r in found], int))


def score(documents: DataFrame, net: Network, columns: list[str] | None = None, threshold: float = 0.3, prefix: str = "") -> DataFrame:
    """The columns (all, unless listed) of every document with score and predicted (after the prefix), from its whole text.

    A null text counts as empty; an empty text is scored as one chunk of zeros. Rows stay where they are: no shuffle.
    A text of any length is handled GROUP chunks at a time; repeated rows are scored one by one, an empty table gives
    an empty result. Columns named as a result are replaced.
    """
    made = [f"{prefix}score", f"{prefix}predicted"]
    columns = [c for c in columns or documents.columns if c.lower() not in made]
    rows = documents.select(*dict.fromkeys([*columns, "text"]))
    params = [getattr(net, f.name) for f in fields(Network)]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(*params)
        for whole in batches:
            for at in range(0, max(1, whole.num_rows), 512):
                batch = whole.slice(at, 512)
                p = scores(net, [(t.as_py() or "").encode() for t in batch.column("text")])
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32), pa.int32())], names=[*columns, *made])

    schema = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in columns)
    return rows.mapInArrow(apply, f"{schema}, `{made[0]}` double, `{made[1]}` int")
