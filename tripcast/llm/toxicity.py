"""Toxicity scores by class-conditional Kneser-Ney models.

Words are runs of letters and digits in lower case.  Two character models of
order ``ORDER`` (contexts stop at the word's start) count the n-grams of toxic and
of ordinary training texts; both back off to one shared model, whose lower orders
are continuation counts (in how many different contexts an n-gram ends) pooled
over the classes.  So a rare expression gets its probability from its parts, and
forms of a known stem count even if never seen.  All counts cover every labelled
training row and are aggregated in Spark.

A text is compared by the difference of its log-likelihoods under the two models,
normalised by length: over all words as it is, and over all words counting of each
only what exceeds 1 and 2 nats (at most 6), so that a few toxic words stand out of
the noise of a long text.  A logistic curve on these and the length gives the score.
It is fitted by crossing two halves: a bounded sample of the training rows, each
scored by a model that counted the other half only.

Where an n-gram was seen in neither class the shared backoff cancels, so that a
log-likelihood ratio needs the seen n-grams and their contexts only.  Both stay
tables keyed by the n-gram itself and grow with the corpus.  The words of all documents
are counted first, those of the training rows also by class and half; each distinct word
is then cut once, for the n-gram counts and for its own ratio.  For the latter words lie
in blocks: a block asks for each of its n-grams once, gets the ratios by a join, and sums
them to one ratio per word.  The three models (of either half, of all) are columns.
The most frequent words, up to ``DICTIONARY_BYTES``, are broadcast with their ratios;
the words of a document that are not among them come out as (row, word, count) and
are joined to the table of words.  So what is broadcast is bounded, and no n-gram
or word takes another one's ratio.

Defined cases: a null or wordless text has features 0 and the score of the
curve's lower end; labels that are null are ignored; a document labelled several
times counts with each label; without training rows of both classes every score
is 0; repeated rows are scored each; an empty table gives an empty table.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import chunks, discard, text_of, written

ORDER = 5
DISCOUNT = 0.75
#: the models built side by side: of either half of the training rows, and of all
HALVES, ALL = 2, 2
#: the curve is fitted on this many rows at most, those of the smallest id hashes
CURVE_ROWS = 20_000
THRESHOLD = 0.3
CACHE_WORDS = 400_000
#: what the broadcast words weigh at most, at WORD_BYTES each besides their text
DICTIONARY_BYTES, WORD_BYTES = 32 << 20, 64
_WORDS = re.compile("[0-9a-zµ-\U0010ffff]+")
_BEGIN, _END = "\x01", "\x02"
# the hash of n-grams into slots; the model does not use it (tests hold it against Python's)
SLOTS, _BASE, _PRIME = 1 << 22, 1_000_003, (1 << 31) - 1


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def fold(id_column: Column) -> Column:
    """crc32 of the id as text."""
    return F.crc32(id_column.cast("string").cast("binary"))


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.pmod(fold(id_column), F.lit(4)) == 2, F.lit(False))


# ---------------------------------------------------------------------------
# counts and model
# ---------------------------------------------------------------------------
#: counts by half and class of the training rows: ordinary and toxic, first and second half
SLOT_COUNTS = ["co0", "ct0", "co1", "ct1"]
MODELS = range(ALL + 1)
RATIOS = [f"r{m}" for m in MODELS]
BLOCK_WORDS = 100_000
#: n-grams that a task holds with their counts before it passes them on
CACHE_GRAMS = 100_000


def grams_of(word: str) -> list[str]:
    s = _BEGIN + word + _END
    return [s[max(0, i - ORDER + 1):i + 1] for i in range(1, len(s))]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of a partition's texts with their count by slot (-1: any row; else by half and class)."""
    seen: dict[int, Counter] = {}

    def flush():
        for slot, own in seen.items():
            words = list(own)
            for a, b in chunks(words):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[a:b], pa.string()), pa.array([slot] * (b - a), pa.int32()),
                     pa.array([own[w] for w in words[a:b]], pa.int64())], names=["w", "slot", "n"])
        seen.clear()

    for batch in batches:
        for text, slot in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen.setdefault(slot, Counter()).update(words_of(text))
        if sum(map(len, seen.values())) > CACHE_WORDS:
            yield from flush()
    yield from flush()


def word_counts(texts: DataFrame) -> DataFrame:
    """(w, n, co0, ct0, co1, ct1) from rows (text, slot): counts over all rows, and over those of each slot."""
    parts = texts.select("text", F.col("slot").cast("int")).mapInArrow(_count_words, "w string, slot int, n long")
    own = lambda slot: F.sum(F.when(F.col("slot") == slot, F.col("n")).otherwise(0))
    return parts.groupBy("w").agg(own(-1).alias("n"), *[own(i).alias(c) for i, c in enumerate(SLOT_COUNTS)])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-grams of a partition's words (w, counts by slot) with their counts."""
    out: dict[str, np.ndarray] = {}

    def flush():
        keys = list(out)
        for a in range(0, len(keys), 50_000):
            part = keys[a:a + 50_000]
            sums = np.stack([out[k] for k in part], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *[pa.array(c) for c in sums]],
                                             names=["g", *SLOT_COUNTS])
        out.clear()

    for batch in batches:
        counts = np.stack([batch.column(c).to_numpy() for c in SLOT_COUNTS], axis=1)
        for w, own in zip(batch.column("w").to_pylist(), counts):
            for g in grams_of(w):
                if g in out:
                    out[g] += own
                else:
                    out[g] = own.copy()
        if len(out) > CACHE_GRAMS:
            yield from flush()
    yield from flush()


def grams_of_words(words: DataFrame) -> DataFrame:
    """(g, co0, ct0, co1, ct1) of the n-grams of words with such counts."""
    some = words.where(" + ".join(SLOT_COUNTS) + " > 0").select("w", *SLOT_COUNTS)
    parts = some.mapInArrow(_count_grams, "g string, " + ", ".join(f"{c} long" for c in SLOT_COUNTS))
    return parts.groupBy("g").agg(*[F.sum(c).alias(c) for c in SLOT_COUNTS])


def gram_counts(rows: DataFrame) -> DataFrame:
    """(g, co0, ct0, co1, ct1) from rows (text, toxic 0/1, half 0/1)."""
    return grams_of_words(word_counts(rows.select("text", (F.col("half") * 2 + F.col("toxic")).alias("slot"))))


def _model_counts(m: int) -> tuple[Column, Column]:
    """Toxic and ordinary count of model m: a half's model counts the other half."""
    if m == ALL:
        return F.col("ct0") + F.col("ct1"), F.col("co0") + F.col("co1")
    return F.col(f"ct{1 - m}"), F.col(f"co{1 - m}")


def _head(g: Column) -> Column:
    return F.substring(g, F.lit(1), F.length(g) - 1)


def shared_model(counts: DataFrame, temporary: list) -> DataFrame:
    """Pooled Kneser-Ney model (s, p0, p1, p2) of the n-grams of length 1 .. ORDER - 1.

    ``temporary`` gets the tables that the result reads.
    """
    level = counts.select("g", *[(t + o).alias(f"n{m}") for m in MODELS for t, o in [_model_counts(m)]])
    levels = []
    for k in range(ORDER - 1, 0, -1):
        # n-grams of full length lose their first character; shorter ones start a word and stay
        short = F.when(F.length("g") == k + 1, F.substring(F.col("g"), 2, k)).otherwise(F.col("g")).alias("g")
        level = written(level.select(short, *[f"n{m}" for m in MODELS]).groupBy("g").agg(
            *[F.count_if(F.col(f"n{m}") > 0).alias(f"n{m}") for m in MODELS]), "toxicity-level")
        levels.append(level)
    below, out = None, None
    # the n-grams of one context differ in their last character only
    over = Window.partitionBy("h")
    for k, level in enumerate(reversed(levels), start=1):
        rows = level.where(F.length("g") == k).withColumn("h", _head(F.col("g")))
        rows = rows.select("g", *[f"n{m}" for m in MODELS], *[x for m in MODELS for x in (
            F.sum(f"n{m}").over(over).alias(f"total{m}"), F.count_if(F.col(f"n{m}") > 0).over(over).alias(f"types{m}"))])
        if below is None:
            b = [1.0 / (F.col(f"types{m}") + 1) for m in MODELS]
        else:
            rows = rows.withColumn("s", F.substring(F.col("g"), 2, k)).join(below, "s", "left")
            b = [F.coalesce(f"p{m}", F.lit(1e-9)) for m in MODELS]
        p = [F.when(F.col(f"n{m}") > 0, (F.greatest(F.col(f"n{m}") - DISCOUNT, F.lit(0.0)) + DISCOUNT
                                         * F.col(f"types{m}") * low) / F.col(f"total{m}")) for m, low in zip(MODELS, b)]
        below = written(rows.select(F.col("g").alias("s"), *[x.alias(f"p{m}") for m, x in zip(MODELS, p)]),
                        "toxicity-backoff")
        temporary.append(below)
        out = below if out is None else out.unionByName(below)
    discard(*levels)
    return out


def ratio_tables(counts: DataFrame, temporary: list) -> tuple[DataFrame, DataFrame]:
    """Log-likelihood ratios toxic : ordinary under each model, as columns r0, r1, r2: of seen
    n-grams (g), and of contexts (g) before unseen ones; null where a model has not seen them."""
    backoff = shared_model(counts, temporary)
    sums, prob, weight = [], [], []
    over = Window.partitionBy("h")
    for m in MODELS:
        t, o = _model_counts(m)
        sums.append({f"tt{m}": F.sum(t), f"to{m}": F.sum(o), f"kt{m}": F.count_if(t > 0), f"ko{m}": F.count_if(o > 0)})
        b = F.coalesce(f"p{m}", F.lit(1e-9))

        def part(c, total, kinds, b=b):
            own = (F.greatest(c - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col(kinds) * b) / F.col(total)
            return F.when(F.col(total) > 0, own).otherwise(b)

        before = lambda total, kinds: F.when(F.col(total) > 0, DISCOUNT * F.col(kinds) / F.col(total)).otherwise(1.0)
        prob.append(F.when(t + o > 0, F.log(part(t, f"tt{m}", f"kt{m}") / part(o, f"to{m}", f"ko{m}"))).alias(f"r{m}"))
        weight.append(F.when(F.col(f"tt{m}") + F.col(f"to{m}") > 0, F.log(
            before(f"tt{m}", f"kt{m}") / before(f"to{m}", f"ko{m}"))).alias(f"r{m}"))
    flat = {k: v for own in sums for k, v in own.items()}
    lower = F.when(F.length("g") == ORDER, F.substring(F.col("g"), 2, ORDER)).otherwise(F.col("g"))
    rows = counts.withColumns({"h": _head(F.col("g")), "s": lower})
    rows = rows.select("*", *[v.over(over).alias(k) for k, v in flat.items()]).join(backoff, "s", "left")
    heads = counts.groupBy(_head(F.col("g")).alias("g")).agg(*[v.alias(k) for k, v in flat.items()])
    return rows.select("g", *prob), heads.select("g", *weight)


def ratios(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tables of ``ratio_tables`` as rows (m, g, llr)."""
    def long(t):
        each = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(f"r{m}").alias("llr")) for m in MODELS]))
        return t.select("g", each.alias("x")).select("x.m", "g", "x.llr").where("llr is not null")
    seen, contexts = ratio_tables(written(counts, "toxicity-counts"), [])
    return long(seen), long(contexts)


def _slot(g: Column) -> Column:
    """The slot of an n-gram of at most ORDER characters (the same as in ``slots_of``)."""
    h = F.lit(0).cast("long")
    for i in range(1, ORDER + 1):
        c = F.ascii(F.substring(g, i, 1)).cast("long")
        h = F.when(F.length(g) >= i, F.pmod(h * _BASE + c + 1, F.lit(_PRIME))).otherwise(h)
    return F.pmod(h, F.lit(SLOTS)).cast("int")


# ---------------------------------------------------------------------------
# one ratio per distinct word
# ---------------------------------------------------------------------------
_BLOCKS = "block long, kind int, t string, n long"


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of words (w, n): each of a block's n-grams once (kind 0), and its words (kind 1)."""
    task, number, words, counts, grams = TaskContext.get().partitionId(), 0, [], [], set()

    def emit():
        block = (task << 32) + number
        for kind, texts, n in ((0, list(grams), None), (1, words, counts)):
            for a in range(0, len(texts), 50_000):
                own = texts[a:a + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(own), pa.int64()), pa.array([kind] * len(own), pa.int32()),
                     pa.array(own, pa.string()), pa.array(n[a:a + 50_000] if n else [None] * len(own), pa.int64())],
                    names=["block", "kind", "t", "n"])

    for batch in batches:
        for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words.append(w)
            counts.append(n)
            grams.update(grams_of(w))
            if len(words) >= BLOCK_WORDS:
                yield from emit()
                number, words, counts, grams = number + 1, [], [], set()
    yield from emit()


def _sum_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w, n, r0, r1, r2) of blocks sorted by kind: n-grams with their ratios, then words."""
    block, number, table = None, {}, np.zeros((1, len(RATIOS)))  # row 0: an n-gram without ratio
    for batch in batches:
        if not batch.num_rows:
            continue
        blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
        edges = np.flatnonzero((blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows]):
            if blocks[a] != block:
                block, number, table = blocks[a], {}, np.zeros((1, len(RATIOS)))
            texts = batch.column("t").slice(a, b - a).to_pylist()
            if kinds[a] == 0:
                number.update(zip(texts, range(len(table), len(table) + b - a)))
                table = np.concatenate([table, np.stack([batch.column(r).slice(a, b - a).fill_null(0.0).to_numpy(
                    zero_copy_only=False) for r in RATIOS], axis=1)])
                continue
            own = [[number.get(g, 0) for g in grams_of(t)] for t in texts]
            sizes = np.array([len(o) for o in own])
            values = table[np.array([i for o in own for i in o])]
            sums = np.add.reduceat(values, np.cumsum(sizes) - sizes, axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), batch.column("n").slice(a, b - a), *[pa.array(c) for c in sums.T]],
                names=["w", "n", *RATIOS])


def word_ratios(words: DataFrame, seen: DataFrame, contexts: DataFrame, temporary: list) -> DataFrame:
    """(w, n, r0, r1, r2): each word's log-likelihood ratio under each model, from words (w, n).

    An n-gram has the ratio of ``ratio_tables``'s first table, one not seen that of its context
    in the second, and 0 if that was not seen either.
    """
    blocks = written(words.select("w", "n").mapInArrow(_block_words, _BLOCKS), "toxicity-blocks")
    temporary.append(blocks)
    as_ = lambda t, key, to: t.select(F.col("g").alias(key), *[F.col(r).alias(f"{to}{r}") for r in RATIOS])
    grams = (blocks.where("kind = 0").withColumn("h", _head(F.col("t")))
             .join(as_(seen, "t", "s"), "t", "left").join(as_(contexts, "h", "c"), "h", "left")
             .select("block", "kind", "t", "n", *[F.coalesce(f"s{r}", f"c{r}").alias(r) for r in RATIOS])
             .where(" or ".join(f"{r} <> 0" for r in RATIOS)))
    own = blocks.where("kind = 1").withColumns({r: F.lit(None).cast("double") for r in RATIOS})
    parts = max(1, int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (grams.unionByName(own).repartition(parts, "block").sortWithinPartitions("block", "kind")
            .mapInArrow(_sum_words, "w string, n long, " + ", ".join(f"{r} double" for r in RATIOS)))


def _dictionary_floor(words: DataFrame, most: int) -> int:
    """The least count class such that its words and all more frequent ones weigh ``most`` bytes at most."""
    weights = words.groupBy("class").agg(F.sum(F.octet_length("w") + WORD_BYTES).alias("bytes")).collect()
    total, floor = 0, 1 << 30
    for r in sorted(weights, key=lambda r: -r["class"]):
        total += r["bytes"]
        if total > most:
            break
        floor = r["class"]
    return floor


class WordModel:
    """Ratios of all distinct words: a broadcast dictionary of frequent ones and a table of the others."""

    def __init__(self, texts: DataFrame, training: DataFrame, most: int = DICTIONARY_BYTES):
        """``texts`` (text) to score, ``training`` (text, toxic 0/1, half 0/1) to learn from."""
        rows = texts.select("text", F.lit(-1).alias("slot")).unionByName(
            training.select("text", (F.col("half") * 2 + F.col("toxic")).alias("slot")))
        words = written(word_counts(rows), "toxicity-words")
        counts = written(grams_of_words(words), "toxicity-counts")
        temporary = [words, counts]
        found = word_ratios(words.where("n > 0"), *ratio_tables(counts, temporary), temporary)
        # eight classes of counts per power of two
        table = written(found.withColumn("class", F.floor(F.log2("n") * 8).cast("int")), "toxicity-ratios")
        discard(*temporary)
        floor = _dictionary_floor(table, most)
        frequent = table.where(F.col("class") >= floor).select("w", *RATIOS).toArrow()
        ratio = np.stack([frequent.column(r).to_numpy() for r in RATIOS])
        self.shared = texts.sparkSession.sparkContext.broadcast((frequent.column("w").to_pylist(), ratio))
        others = table.where(F.col("class") < floor).select("w", *RATIOS)
        self.others = None if others.isEmpty() else others


class Scorer:
    """Sums over the dictionary words of texts, and the words of each text that are not in it."""

    def __init__(self, words: list[str], ratio: np.ndarray):
        self.number = {w: i for i, w in enumerate(words)}
        self.ratio = ratio

    def sums(self, texts: list[str], models: np.ndarray) -> tuple[np.ndarray, list[Counter]]:
        """Per text: ratios summed, their excess over 1 and over 2 nats summed, words; and the other words."""
        get, index, others = self.number.get, [], []
        counts, known = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            own = words_of(t)
            numbers = [n for n in map(get, own) if n is not None]
            counts[i], known[i] = len(own), len(numbers)
            index += numbers
            others.append(Counter(w for w in own if w not in self.number) if len(numbers) < len(own) else Counter())
        out = np.zeros((len(texts), 4))
        out[:, 3] = counts
        if index:
            value = self.ratio[np.repeat(models, known), np.array(index, np.int64)]
            has = known > 0
            starts = (np.cumsum(known) - known)[has]
            out[has, 0] = np.add.reduceat(value, starts)
            for k, least in ((1, 1.0), (2, 2.0)):
                out[has, k] = np.add.reduceat(np.clip(value - least, 0.0, 6.0), starts)
        return out, others


def curve_inputs(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x[:, 0], np.log(x[:, 1] + 0.02), np.log(x[:, 2] + 0.01), np.log1p(x[:, 3])])


def curve_column(curve: dict | None) -> Column:
    """The score from the columns FEATURES."""
    if curve is None:
        return F.lit(0.0)
    x = [F.col("mean_ratio"), F.log(F.col("over_1") + 0.02), F.log(F.col("over_2") + 0.01), F.log1p("words")]
    z = F.lit(curve["w"][0])
    for value, mean, scale, w in zip(x, curve["mean"], curve["scale"], curve["w"][1:]):
        z = z + (value - mean) / scale * w
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> dict[str, list[float]] | None:
    """Logistic regression on standardised features by Newton steps; None without both classes."""
    if not len(y) or y.min() == y.max():
        return None
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    penalty = ridge * np.eye(len(w)) * np.r_[0.0, np.ones(len(w) - 1)] * len(y) ** 0.5
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-8 * np.eye(len(w)),
                               z.T @ (y - p) - penalty @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return {"mean": mean.tolist(), "scale": scale.tolist(), "w": w.tolist()}


FEATURES = ["mean_ratio", "over_1", "over_2", "words"]
SUMS = FEATURES[:3]


def _with_features(rows: DataFrame, model: WordModel, id_col: str) -> DataFrame:
    """id and features of rows (id, m, text), each under its model m."""
    kind, shared = dict(rows.dtypes)[id_col], model.shared
    other = pa.list_(pa.struct([("w", pa.string()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # made for the task and gone with it: a worker process lives on into other jobs
        scorer = Scorer(*shared.value)
        for batch in batches:
            texts, m = batch.column(2).to_pylist(), batch.column(1).to_numpy()
            for a, b in chunks(texts):
                x, others = scorer.sums(texts[a:b], m[a:b])
                others = [[{"w": w, "n": n} for w, n in c.items()] for c in others]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                     *[pa.array(x[:, i]) for i in range(4)], pa.array(others, other)],
                    names=["id", "m", *FEATURES, "others"])

    out = rows.select(id_col, "m", "text").mapInArrow(
        run, f"id {kind}, m int, " + ", ".join(f"{c} double" for c in FEATURES) + ", others array<struct<w:string,n:long>>")
    if model.others is not None:
        out = written(out.withColumn("__row", F.monotonically_increasing_id()), "toxicity-sums")
        single = out.select("__row", "m", F.explode("others").alias("o")).select("__row", "m", "o.w", "o.n")
        ratio = F.get(F.array(*RATIOS), F.col("m"))
        over = lambda least: F.least(F.greatest(F.col("r") - least, F.lit(0.0)), F.lit(6.0))
        added = (single.join(model.others, "w").withColumn("r", ratio).groupBy("__row").agg(
            *[F.sum(F.col("n") * c).alias(f"__{s}") for s, c in zip(SUMS, (F.col("r"), over(1.0), over(2.0)))]))
        out = out.join(added, "__row", "left").withColumns(
            {s: F.col(s) + F.coalesce(f"__{s}", F.lit(0.0)) for s in SUMS})
    out = out.select(F.col("id").alias(id_col), *[F.when(F.col("words") > 0, F.col(s) / F.col("words")).otherwise(0.0).alias(s)
                                                 for s in SUMS], "words")
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          curve_rows: int = CURVE_ROWS, dictionary_bytes: int = DICTIONARY_BYTES) -> tuple[WordModel, dict | None]:
    """Ratios of the documents' words, and curve, from the labelled rows that are not held out."""
    own = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
    marks = labels.select(labels["doc_id"], labels["toxic"].cast("int").alias("toxic")).where("toxic in (0, 1)")
    hash_ = fold(F.col("doc_id"))
    half = F.pmod(F.floor(hash_ / 4), F.lit(HALVES)).cast("int").alias("half")
    marks = marks.where(~held_out(F.col("doc_id"))).select("doc_id", "toxic", half)
    usable = own.where(~held_out(F.col("doc_id"))).join(marks.hint("merge"), "doc_id")
    model = WordModel(own, usable, dictionary_bytes)
    sample = marks.orderBy(hash_, "doc_id", "toxic").limit(curve_rows)
    # at most curve_rows small rows
    fit = own.join(F.broadcast(sample), "doc_id").select(F.struct("doc_id", "toxic").alias("__key"),
                                                         F.col("half").alias("m"), "text")
    got = _with_features(fit, model, "__key").toArrow()
    x = np.column_stack([got.column(c).to_numpy() for c in FEATURES])
    y = [k["toxic"] for k in got.column("__key").to_pylist()]
    return model, fit_curve(curve_inputs(x), np.array(y, np.float64))


def _scored(rows: DataFrame, model: WordModel, curve: dict | None, id_col: str) -> DataFrame:
    """id, features and score of rows (id, text)."""
    out = _with_features(rows.withColumn("m", F.lit(ALL)), model, id_col)
    return out.withColumn("score", curve_column(curve))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD, dictionary_bytes: int = DICTIONARY_BYTES) -> DataFrame:
    """id, held_out, score, predicted and the length-normalised ratios of each document."""
    model, curve = train(docs, labels, id_col, text_col, dictionary_bytes=dictionary_bytes)
    rows = docs.select(docs[id_col].alias(id_col), text_of(docs, text_col).alias("text"))
    out = _scored(rows, model, curve, id_col).withColumn("held_out", held_out(F.col(id_col)))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int")).select(
        id_col, "held_out", "score", "predicted", *FEATURES)


def keep_ordinary(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD, dictionary_bytes: int = DICTIONARY_BYTES) -> DataFrame:
    """The rows that score below the threshold, with all their columns.

    The score depends on the text alone, so the toxic texts' SHA-256 tells which rows go.
    """
    model, curve = train(docs, labels, id_col, text_col, dictionary_bytes=dictionary_bytes)
    digest = F.sha2(text_of(docs, text_col), 256)
    rows = docs.select(digest.alias("__digest"), text_of(docs, text_col).alias("text"))
    toxic = _scored(rows, model, curve, "__digest").where(F.col("score") >= threshold).select("__digest").distinct()
    toxic = written(toxic, "toxicity-toxic")
    model.shared.destroy()
    return docs.join(toxic, digest == toxic["__digest"], "left_anti")
