"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The text is cut into words at white-space marks (no piece of the model crosses
one), and each distinct word is encoded once per batch.  All words lie in one flat
numpy symbol array.  A round looks up the rank of every adjacent pair, takes the
minimum per word, merges its leftmost occurrences in all words at once and
compacts the array; words without a pair leave it.  Characters outside the model
become byte pieces.  Results equal the library's for BPE models with identity
normalisation; other models are refused.

A word's further occurrences of its minimum pair are merged in the same round
unless the merged piece could take part in a better pair (known per piece from
the model); then only the leftmost is.

Defined cases: a null text counts as empty; an empty text has only the begin and
end ids; very long words are merged in place, never cut; repeated rows are
encoded each; an empty table gives an empty table; other columns are not read.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Numbers, chunks, text_of

MARK = "▁"
UNKNOWN_SURFACE = " ⁇ "
_INF = np.int32(2**31 - 1)
CACHE_WORDS = 300_000


class BpeModel:
    """The merge table of a SentencePiece BPE model and its word cache."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec, kinds = proto.normalizer_spec, pb.ModelProto.SentencePiece
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        if (proto.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces
                or not spec.add_dummy_prefix or not spec.escape_whitespaces
                or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces)
                or any(MARK in p.lstrip(MARK) for p in normal)):
            raise ValueError("only BPE models with identity normalisation and a dummy prefix are supported")
        self.size = len(proto.pieces)
        self.bos, self.eos, self.unk = proto.trainer_spec.bos_id, proto.trainer_spec.eos_id, proto.trainer_spec.unk_id
        self.bytes_ = np.full(256, self.unk, np.int64)
        for i, p in enumerate(proto.pieces):
            if p.type == kinds.BYTE:
                self.bytes_[int(p.piece[3:5], 16)] = i
        self.byte_fallback = proto.trainer_spec.byte_fallback
        order = np.unique(np.array([-p.score for p in proto.pieces]), return_inverse=True)[1]
        # symbol of each code point: its piece, else a number beyond the pieces
        self.first = np.arange(0x110000, dtype=np.int32) + np.int32(self.size)
        for p, i in normal.items():
            if len(p) == 1:
                self.first[ord(p)] = i
        self.first[ord(" ")] = self.first[ord(MARK)]
        # every way to make a piece from two parts that can stand next to each other
        pairs = {}
        part = lambda s: normal.get(s) if len(s) > 1 or s in normal else self.size + ord(s)
        late = np.zeros(self.size, bool)
        for p, i in normal.items():
            for cut in range(1, len(p)):
                a, b = part(p[:cut]), part(p[cut:])
                if a is None or b is None:
                    continue
                pairs[(a << 32) | b] = (int(order[i]), i)
                for x, s in ((a, p[:cut]), (b, p[cut:])):
                    if len(s) > 1 and order[i] <= order[x]:
                        late[x] = True
        self.keys = np.array(sorted(pairs), np.int64)
        self.rank = np.array([pairs[k][0] for k in self.keys.tolist()], np.int32)
        self.made = np.array([pairs[k][1] for k in self.keys.tolist()], np.int32)
        self.late = late  # pieces that may join a better pair than the one that made them
        breaks = not any("\n" in p and len(p) > 1 for p in normal)
        self.words = re.compile(r" *[^ \n]+| +|\n" if breaks else r" *[^ ]+| +")
        # decoding: bytes of each piece
        surface = []
        for i, p in enumerate(proto.pieces):
            if p.type == kinds.BYTE:
                surface.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == kinds.CONTROL:
                surface.append(b"")
            elif p.type == kinds.UNKNOWN:
                surface.append(UNKNOWN_SURFACE.encode())
            else:
                surface.append(p.piece.replace(MARK, " ").encode())
        self.surface = surface
        self.is_byte = np.array([p.type == kinds.BYTE for p in proto.pieces])
        self.is_control = np.array([p.type == kinds.CONTROL for p in proto.pieces])
        self.out_len = np.fromiter(map(len, surface), np.int64, self.size)
        self.out_at = np.concatenate([[0], np.cumsum(self.out_len)[:-1]])
        self.out = np.frombuffer(b"".join(surface), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.cache = Numbers()
        self.store = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.at, self.len = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    # -- encoding ------------------------------------------------------------
    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.rank[at], _INF), self.made[at]

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of each word after all merges: flat ids and bounds (len(words) + 1)."""
        base = self.size
        sym = self.first[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        done_sym, done_word = [], []
        rank = np.full(len(sym), _INF, np.int32)
        made = np.zeros(len(sym), np.int32)
        if len(sym) > 1:
            same = np.flatnonzero(word[1:] == word[:-1])
            rank[same], made[same] = self._ranks(sym[same], sym[same + 1])
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(starts, len(sym)))
            least = np.minimum.reduceat(rank, starts)
            open_ = least < _INF
            if not open_.all():  # finished words leave the array
                keep = np.repeat(open_, size)
                done_sym.append(sym[~keep])
                done_word.append(word[~keep])
                sym, word, rank, made = sym[keep], word[keep], rank[keep], made[keep]
                least, size = least[open_], size[open_]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, size))
            new_run = np.concatenate([[True], np.diff(hit) != 1])
            run_first = np.maximum.accumulate(np.where(new_run, np.arange(len(hit)), 0))
            leftmost = np.concatenate([[True], word[hit[1:]] != word[hit[:-1]]])
            even = (np.arange(len(hit)) - run_first) % 2 == 0
            chosen = hit[leftmost | (even & ~self.late[made[hit]])]
            sym[chosen] = made[chosen]
            stay = np.ones(len(sym), bool)
            stay[chosen + 1] = False
            fresh = np.zeros(len(sym), bool)
            fresh[chosen] = True
            sym, word, rank, made, fresh = sym[stay], word[stay], rank[stay], made[stay], fresh[stay]
            fresh[:-1] |= fresh[1:]
            touch = np.flatnonzero(fresh)
            rank[touch] = _INF
            touch = touch[touch < len(sym) - 1]
            touch = touch[word[touch] == word[touch + 1]]
            rank[touch], made[touch] = self._ranks(sym[touch], sym[touch + 1])
        sym = np.concatenate(done_sym) if done_sym else np.zeros(0, np.int32)
        word = np.concatenate(done_word) if done_word else np.zeros(0, np.int32)
        order = np.argsort(word, kind="stable")
        sym, word = sym[order], word[order]
        outside = np.flatnonzero(sym >= base)
        if len(outside):  # byte fallback
            parts, last = [], 0
            extra = np.ones(len(sym), np.int64)
            for i in outside.tolist():
                code = chr(int(sym[i]) - base).encode("utf-8", "surrogatepass")
                ids = self.bytes_[np.frombuffer(code, np.uint8)] if self.byte_fallback else np.array([self.unk])
                parts += [sym[last:i], ids]
                extra[i], last = len(ids), i + 1
            parts.append(sym[last:])
            sym, word = np.concatenate(parts), np.repeat(word, extra)
        return sym, np.searchsorted(word, np.arange(len(words) + 1))

    def _learn(self, n: int) -> None:
        """Encode the words numbered n and later."""
        words = list(islice(self.cache, n, None))
        ids, bounds = self.merge_words(words)
        total = self.used + len(ids)
        if total > len(self.store):
            self.store = np.concatenate([self.store[:self.used], np.zeros(2 * total - self.used, np.int32)])
        if n + len(words) > len(self.at):
            grow = np.zeros(2 * (n + len(words)) - len(self.at), np.int64)
            self.at, self.len = np.concatenate([self.at, grow]), np.concatenate([self.len, grow])
        self.store[self.used:total] = ids
        self.at[n:n + len(words)] = self.used + bounds[:-1]
        self.len[n:n + len(words)] = np.diff(bounds)
        self.used = total

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts with begin and end ids: flat ids and bounds (len(texts) + 1)."""
        if len(self.cache) > CACHE_WORDS:
            self.forget()
        find, words, counts = self.words.findall, [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                own = find(" " + t.replace(MARK, " "))
                counts[i] = len(own)
                words += own
        known, number = len(self.cache), self.cache
        index = np.array([number[w] for w in words], np.int64)
        if len(number) > known:
            self._learn(known)
        size = self.len[index]
        ends = np.concatenate([[0], np.cumsum(size)])
        body = self.store[np.repeat(self.at[index] - ends[:-1], size) + np.arange(ends[-1])]
        text_end = ends[np.concatenate([[0], np.cumsum(counts)])]
        n = len(texts)
        bounds = text_end + 2 * np.arange(n + 1)
        out = np.empty(bounds[-1], np.int32)
        marks = np.zeros(bounds[-1], bool)
        out[bounds[:-1]], out[bounds[1:] - 1] = self.bos, self.eos
        marks[bounds[:-1]], marks[bounds[1:] - 1] = True, True
        out[~marks] = body
        return out, bounds

    # -- decoding ------------------------------------------------------------
    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """UTF-8 of each sequence of ids."""
        size = self.out_len[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        flat = self.out[np.repeat(self.out_at[ids] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            own = flat[ends[a]:ends[b]]
            body = ids[a:b][~self.is_control[ids[a:b]]]
            lead = len(body) > 0 and not self.is_byte[body[0]] and body[0] != self.unk and own[:1] == b" "
            try:
                own.decode()
                odd = self.is_control[ids[a + 1:b - 1]].any()
            except UnicodeDecodeError:
                odd = True
            if odd:  # ids that no text gives: each odd byte piece becomes U+FFFD
                own = self._mended(ids[a:b])
            out.append(own[1:] if lead else own)
        return out

    def _mended(self, ids: np.ndarray) -> bytes:
        out, run = [], b""
        for i in [*ids.tolist(), None]:
            if i is not None and self.is_byte[i]:
                run += self.surface[i]
                continue
            at = 0
            while at < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(run[at:at + n].decode().encode())
                        at += n
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�".encode())
                    at += 1
            run = b""
            if i is not None:
                out.append(self.surface[i])
        return b"".join(out)


_MODELS: dict[str, BpeModel] = {}


def model(path: str) -> BpeModel:
    """The model of this worker process."""
    if path not in _MODELS:
        _MODELS[path] = BpeModel(path)
    return _MODELS[path]


def encode_column(path: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            raw = [t or "" for t in texts]
            for a, b in chunks(raw, 2_000_000):
                ids, bounds = bpe.encode(raw[a:b])
                decoded = bpe.decode(ids, bounds)
                counts = pa.array(np.diff(bounds))
                keys = batch.column(0).slice(a, b - a)
                if digests:
                    wide = ids.astype("<u4")
                    one = [hashlib.sha256(wide[x:y]).hexdigest() for x, y in zip(bounds[:-1], bounds[1:])]
                    two = [hashlib.sha256(d).hexdigest() for d in decoded]
                    yield pa.RecordBatch.from_arrays([keys, counts, pa.array(one, pa.string()),
                                                      pa.array(two, pa.string())],
                                                     names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                    yield pa.RecordBatch.from_arrays([keys, counts, lists, pa.array([d.decode() for d in decoded])],
                                                     names=["id", "n_tokens", "ids", "decoded"])
    return run


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  digests: bool = False) -> DataFrame:
    """id, n_tokens, ids and decoded text of each row; with ``digests`` their SHA-256 instead."""
    rows = docs.select(docs[id_col].alias(id_col), text_of(docs, text_col).alias("__t"))
    kind = dict(rows.dtypes)[id_col]
    tail = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    out = rows.mapInArrow(encode_column(path, digests), f"id {kind}, n_tokens long, {tail}")
    return out.withColumnRenamed("id", id_col)
