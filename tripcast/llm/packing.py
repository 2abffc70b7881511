"""Mixture-controlled packing by deficit round-robin over source queues.

Every document's tokens (its ids and one separator) queue up behind those of its
source.  A window of ``window`` tokens takes from each queue what the target
proportions entitle it to: a queue's deficit grows by its share of the window, it
pays whole tokens, and what rounding leaves goes to the largest deficits.  Deficits
carry over from window to window.

Windows are laid in blocks of ``BLOCK_WINDOWS``.  At a block's start each queue has
paid the whole part of its entitlement, in closed form, and the rest is the deficit
that it carries in; so every block is laid by itself, on any machine, and a task
that holds a part of a queue finds the windows of its documents without seeing the
others.  No text and no ids are shuffled: only token totals per partition and queue
are.  With the default targets (each source's own share of all tokens) all queues
end together; with other targets an empty queue's share goes to the rest.

Documents are cut wherever a window ends.  Only a block's last sequence can be
short: less than one in ``BLOCK_WINDOWS`` sequences has padding.

Each distinct source has a queue and a target of its own, so the vector of totals that
each task gets has one entry per source.  Queues are ordered by their sources' hash
(modulo ``QUEUES``), then by name.

Defined cases: a null text has its separator only; a null source is a queue of its
own; a null id is kept; repeated rows are packed each; an empty table gives an empty
table; other columns are not read.
"""
from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import Numbers, chunks, text_of, written

WINDOW, BLOCK_WINDOWS, QUEUES, SEPARATOR = 1024, 1024, 65_536, 0
#: what the laid blocks that a task keeps weigh at most, beside the last one
LAID_BYTES = 256 << 20
CACHE_CHUNKS = 200_000
# Fixed value: the split pattern of byte-level BPE tokenizers with this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# In texts of these characters only, a token never goes on over a space that stands between
# others: they are cut there.  Texts with more kinds of white space are encoded as a whole.
_CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_OTHER = re.compile("[^\n -~¡-¬®-ɏ]")
_START = "\x00"  # marks a chunk that has no space before it


class Encoder:
    """Ids of whole texts; each distinct chunk between spaces is encoded once.

    The tokenizer's own merge ranks run in a faster encoder for plain chunks; whatever
    else a text holds goes to the tokenizer itself.
    """

    def __init__(self, path: str):
        self.path, self.whole = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        signs = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        added = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(signs[c] for c in token): i for token, i in vocab.items() if token not in added}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        made = [vocab[a + b] for a, b in pairs]
        pre = spec.get("pre_tokenizer") or {}
        # only where ids rise with the merges do ids serve as ranks
        self.fast = made == sorted(made) and spec.get("normalizer") is None and pre.get("type") == "ByteLevel" \
            and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        if self.fast:
            import tiktoken
            self.bpe = tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.begins = np.zeros(max(ranks.values()) + 1, bool)  # ids of tokens that begin with a space
            self.begins[[i for token, i in ranks.items() if token[:1] == b" "]] = True
        self.forget()

    def forget(self) -> None:
        self.number = Numbers()
        self.store, self.used = np.zeros(1 << 16, np.int32), 0
        self.at, self.len = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def _encode_whole(self, text: str) -> np.ndarray:
        if self.whole is None:
            from tokenizers import Tokenizer
            self.whole = Tokenizer.from_file(self.path)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.int32)

    def _learn(self, known: int) -> None:
        new = list(islice(self.number, known, None))
        # words after a space, without more white space: encoded in one go, each begins at a token with a space
        spaced = np.fromiter((c[:1] != _START and " " not in c and "\n" not in c for c in new), bool, len(new))
        ids = self.bpe.encode_to_numpy("".join([" " + c for c, s in zip(new, spaced) if s]), disallowed_special=())
        alone = [self.bpe.encode_ordinary(c[1:] if c[:1] == _START else " " + c) for c, s in zip(new, spaced) if not s]
        size = np.zeros(len(new), np.int64)
        size[spaced] = np.diff(np.flatnonzero(self.begins[ids]), append=len(ids))
        size[~spaced] = list(map(len, alone))
        flat = np.empty(int(size.sum()), np.int32)
        own = np.repeat(spaced, size)
        flat[own], flat[~own] = ids, np.fromiter(chain.from_iterable(alone), np.int32)
        total = self.used + len(flat)
        if total > len(self.store):
            self.store = np.concatenate([self.store[:self.used], np.zeros(2 * total - self.used, np.int32)])
        if known + len(new) > len(self.at):
            grow = np.zeros(2 * (known + len(new)) - len(self.at), np.int64)
            self.at, self.len = np.concatenate([self.at, grow]), np.concatenate([self.len, grow])
        self.store[self.used:total] = flat
        self.at[known:known + len(new)] = self.used + np.cumsum(size) - size
        self.len[known:known + len(new)] = size
        self.used = total

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.number) > CACHE_CHUNKS:
            self.forget()
        plain = [self.fast and not _OTHER.search(t) and "<|" not in t for t in texts]
        number, known = self.number, len(self.number)
        index, counts = [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if not plain[i] or not t:
                continue
            if "  " in t or t[0] == " " or t[-1] == " ":  # runs of spaces belong to what follows
                own = [c[1:] if c[0] == " " and len(c) > 1 else _START + c for c in _CHUNK.findall(t)]
            else:
                own = t.split(" ")
                own[0] = _START + own[0]
            index.extend(map(number.__getitem__, own))
            counts[i] = len(own)
        if len(number) > known:
            self._learn(known)
        index = np.array(index, np.int64)
        size = self.len[index]
        ends = np.concatenate([[0], np.cumsum(size)])
        flat = self.store[np.repeat(self.at[index] - ends[:-1], size) + np.arange(ends[-1])]
        bounds = ends[np.concatenate([[0], np.cumsum(counts)])]
        return [flat[bounds[i]:bounds[i + 1]] if plain[i] else self._encode_whole(t) for i, t in enumerate(texts)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ---------------------------------------------------------------------------
# the schedule
# ---------------------------------------------------------------------------
class Schedule:
    """Where each token of each queue lies, as a function of the queues' totals and targets."""

    def __init__(self, queues: np.ndarray, totals: np.ndarray, weights: np.ndarray | None = None,
                 window: int = WINDOW, block_windows: int = BLOCK_WINDOWS):
        self.queues, self.totals = queues, totals.astype(np.int64)
        self.row = {int(q): i for i, q in enumerate(queues)}
        self.weights = [int(w) for w in (totals if weights is None else weights)]
        if any(w < 1 for w in self.weights):
            raise ValueError("target weights are whole numbers from 1 on")
        self.window, self.block = window, window * block_windows
        self.stride = block_windows + len(queues) // window + 2  # sequences a block can have
        self.n_blocks = max(1, -(-int(self.totals.sum()) // self.block))
        # virtual time t: queue s has paid min(total, weight * t); by time of running empty
        full = sorted((Fraction(int(t), w), i) for i, (t, w) in enumerate(zip(self.totals, self.weights)) if w)
        self.phases, paid, at, rate = [], Fraction(0), Fraction(0), sum(self.weights)
        for t, i in full:
            if t > at:
                self.phases.append((paid, at, rate))
                paid, at = paid + (t - at) * rate, t
            rate -= self.weights[i]
        self.rough = [tuple(map(float, p)) for p in self.phases]
        self.zero = np.zeros(len(self.totals), np.int64)
        self.edges: dict[int, np.ndarray] = {}
        self.laid: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _time(self, paid: int) -> Fraction:
        """When all queues together have paid this many tokens."""
        k = max(i for i, p in enumerate(self.phases) if p[0] <= paid)
        base, at, rate = self.phases[k]
        return at + (paid - base) / rate

    def boundary(self, block: int) -> np.ndarray:
        """Tokens that each queue has paid before this block (whole parts of the entitlements)."""
        if block <= 0:
            return self.zero
        if block >= self.n_blocks:
            return self.totals
        if block not in self.edges:
            if len(self.edges) > 1024:
                self.edges.clear()
            t = self._time(block * self.block)
            self.edges[block] = np.array([min(int(n), w * t.numerator // t.denominator)
                                          for n, w in zip(self.totals, self.weights)], np.int64)
        return self.edges[block]

    def block_of(self, row: int, at: int) -> int:
        """The block that holds token ``at`` of a queue: a guess, then the exact boundaries."""
        t = at / self.weights[row]
        paid, start, rate = self.rough[bisect_right(self.rough, t, key=lambda p: p[1]) - 1]
        guess = min(self.n_blocks - 1, max(0, int((paid + (t - start) * rate) / self.block)))
        while guess + 1 < self.n_blocks and self.boundary(guess + 1)[row] <= at:
            guess += 1
        while guess and self.boundary(guess)[row] > at:
            guess -= 1
        return guess

    def lay(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """(paid, offset): tokens each queue has paid before each window of the block (and at
        its end), and where its tokens begin in the window."""
        if block in self.laid:
            return self.laid[block]
        start, end = self.boundary(block), self.boundary(block + 1)
        left = end - start
        windows = max(1, -(-int(left.sum()) // self.window))
        taken = np.zeros((windows, len(left)), np.int64)
        t = self._time(block * self.block) if block else Fraction(0)
        share = np.array([float(w) for w in self.weights])
        # the deficit carried in: the part of each entitlement that was not paid
        deficit = np.array([float(w * t - int(s)) if s < n else 0.0
                            for w, s, n in zip(self.weights, start, self.totals)])
        # while no queue can run empty, a window is a few vector operations
        each = share / share.sum() * self.window
        safe = min(windows - 1, int((left // (np.floor(each) + 3)).min())) if (left > 0).all() else 0
        i = 0
        for i in range(safe):
            deficit += each
            take = np.maximum(np.floor(deficit), 0.0)
            over = int(self.window - take.sum())
            if over < 0 or over > len(take):
                deficit -= each
                break
            if over:
                take[np.argsort(take - deficit, kind="stable")[:over]] += 1
            deficit -= take
            taken[i] = take
        else:
            i = safe
        left = left - taken[:i].sum(axis=0)
        for i in range(i, windows):
            room = min(self.window, int(left.sum()))
            active = np.where(left > 0, share, 0.0)
            deficit = np.where(left > 0, deficit + active / active.sum() * self.window, 0.0)
            take = np.clip(np.floor(deficit).astype(np.int64), 0, left)
            over = int(take.sum()) - room
            if over > 0:  # carried deficits ask for more than a window: the smallest claims wait
                order = np.argsort(deficit - take, kind="stable")
                for j in order:
                    give = min(over, int(take[j]))
                    take[j] -= give
                    over -= give
                    if not over:
                        break
            while over < 0:  # what rounding leaves goes round the largest deficits
                open_ = np.flatnonzero(left > take)
                order = open_[np.argsort(-(deficit - take)[open_], kind="stable")][:-over]
                each = max(1, -over // len(open_)) if len(order) == len(open_) else 1
                more = np.minimum(each, left[order] - take[order])
                take[order] += more
                over += int(more.sum())
            deficit -= take
            left = left - take
            taken[i] = take
        paid = start + np.vstack([np.zeros((1, len(left)), np.int64), np.cumsum(taken, axis=0)])
        offset = np.cumsum(taken, axis=1) - taken
        if len(self.laid) > 64 or len(self.laid) * 2 * paid.nbytes > LAID_BYTES:
            self.laid.clear()
        self.laid[block] = paid, offset
        return paid, offset

    def pieces(self, queue: int, at: int, n: int) -> np.ndarray:
        """(start, length, sequence, offset) of the n tokens of a queue from ``at`` on, as rows."""
        row, out, done = self.row[queue], [], 0
        block = self.block_of(row, at)
        while done < n:
            paid, offset = self.lay(block)
            mine = paid[:, row]
            first = int(mine.searchsorted(at + done, side="right")) - 1
            last = int(mine.searchsorted(at + n, side="left"))  # the window after the last one
            last = min(last, len(mine) - 1)
            edges = mine[first:last + 1]
            begin = np.maximum(edges[:-1], at + done)
            length = np.minimum(edges[1:], at + n) - begin
            full = np.flatnonzero(length > 0)
            window = full + first
            out.append(np.column_stack([begin[full] - at, length[full], block * self.stride + window,
                                        offset[window, row] + begin[full] - edges[full]]))
            done += int(length[full].sum())
            block += 1
        return out[0] if len(out) == 1 else np.concatenate(out)


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------
def tokenised(docs: DataFrame, path: str, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, part, before, n, ids): tokens of each document and those of its source before it in its part."""
    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("t"),
                       docs[source_col].cast("string").alias("source"))
    kind = dict(rows.dtypes)["id"]

    def tokens_of(enc, part, seen, batches):
        for batch in batches:
            texts, sources = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for a, b in chunks(texts, 2_000_000):
                before, size, blobs = [], [], []
                for ids, q in zip(enc.encode(texts[a:b]), sources[a:b]):
                    n = len(ids) + 1
                    before.append(seen.get(q, 0))
                    seen[q] = before[-1] + n
                    size.append(n)
                    blobs.append(np.append(ids, SEPARATOR).astype("<u2" if not len(ids) or ids.max() < 65536 else "<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a),
                     pa.array(np.full(b - a, part, np.int32)), pa.array(before, pa.int64()),
                     pa.array(size, pa.int64()), pa.array(blobs, pa.binary())],
                    names=["id", "source", "part", "before", "n", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seen = encoder(path), TaskContext.get().partitionId(), {}
        try:
            yield from tokens_of(enc, part, seen, batches)
        finally:
            enc.forget()  # workers outlive the task, and what they hold stays through later stages

    return rows.mapInArrow(run, f"id {kind}, source string, part int, before long, n long, ids binary")


def pack(docs: DataFrame, path: str, targets: dict[str, int] | None = None, window: int = WINDOW,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``targets`` gives whole-number weights by source; sources without one (and all
    sources when it is None) weigh as many as their tokens.
    """
    spark = docs.sparkSession
    tokens = written(tokenised(docs, path, id_col, text_col, source_col), "tokens")
    # per partition and source: small beside the tokens; written to give Spark its true size for the join
    per_part = written(tokens.groupBy("source", "part").agg(F.sum("n").alias("n")), "queue-totals")
    # one row per source, a null source last
    order = F.when(F.col("source").isNull(), F.lit(QUEUES)).otherwise(F.pmod(F.xxhash64("source"), F.lit(QUEUES)))
    totals = per_part.groupBy("source").agg(F.sum("n").alias("n")).orderBy(order, "source").toArrow()
    sources, sums = totals.column("source").to_pylist(), totals.column("n").to_numpy()
    weights = np.array([(targets or {}).get(s, int(n)) for s, n in zip(sources, sums)], np.int64)
    shared = spark.sparkContext.broadcast((sources, sums, weights))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = written(per_part.select(F.col("source").alias("s"), F.col("part").alias("p"),
                                   F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "queue-bases")
    rows = tokens.join(base, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))).select(
        "id", "source", (F.col("base") + F.col("before")).alias("at"), "n", "ids")
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sources, sums, weights = shared.value
        queue_of = {s: q for q, s in enumerate(sources)}
        schedule = Schedule(np.arange(len(sources)), sums, weights, window=window)
        for batch in batches:
            source, at, n, blobs = (batch.column(i).to_pylist() for i in range(1, 5))
            out, counts, crcs = [np.zeros((0, 4), np.int64)], [], []
            for i in range(len(n)):
                blob = blobs[i]
                ids = np.frombuffer(blob, "<u2" if len(blob) == 2 * n[i] else "<u4").astype("<u4").tobytes()
                own = schedule.pieces(queue_of[source[i]], at[i], n[i])
                out.append(own)
                counts.append(len(own))
                crcs += [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(own[:, 0].tolist(), (own[:, 0] + own[:, 1]).tolist())]
            cols = np.concatenate(out)
            row = np.repeat(np.arange(len(n)), counts)
            rows_ = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows_), pa.array(cols[:, 0]), pa.array(cols[:, 1]), pa.array(crcs, pa.int64()),
                 batch.column(3).take(rows_), pa.array(cols[:, 2]), pa.array(cols[:, 3])],
                names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    out = rows.mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                               "sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
