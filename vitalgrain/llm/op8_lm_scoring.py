"""Language-model scores by prediction by partial matching (PPM) over bytes.

A text is lower-cased (A-Z), cut into words, and written as its words with one space between them
and a line feed as its end. The model is the trie of all contexts of up to ORDER bytes in the
training texts. With a context's total T and its D distinct symbols, a symbol seen c times there has
the probability (2c - 1) / 2T, and the escape to the next shorter context D / 2T; symbols already
refused by a longer context are excluded from the shorter ones, and below the empty context all
bytes not excluded are equally likely. A text's score is the sum of log10 over its bytes and end.

Training counts cover every training text. They are summed up in each task, which hands on what it
holds whenever that is too much, and then shuffled by n-gram and by word, so what moves grows with the
input, and no count is dropped. What the longest contexts know of their MAX_GRAMS most frequent symbols is broadcast. All other n-grams of a text are
looked up by an exact join: they and all counts are dealt by the last SUFFIX bytes of the context, so
that all contexts of that length or more are whole in one task; the counts of the shorter ones are
summed over all n-grams and broadcast. The unigram base needs the count of any word: the HEAD_WORDS
most frequent ones of up to HEAD_BYTES bytes are broadcast, and all others of a text are looked up by an exact join too.

Defined cases: null and empty texts are the end alone; with nothing to learn from all bytes are
equally likely and every count is 0; null ids count as the empty text in the fold; repeated rows
are scored (and learned from) each; an empty table stays empty; other columns are not carried.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import attach_groups, materialise, slices, text_or_empty, word_units
from .op5_language import fold

ORDER = 5
#: N-grams that are broadcast; any number of others is joined.
MAX_GRAMS = 4_000_000
#: Bytes of a context by which counts are dealt. Shorter contexts have at most 256 ** SUFFIX n-grams, far fewer in texts.
SUFFIX = 3
HEAD_WORDS, HEAD_BYTES = 400_000, 64
#: The end of a text; no word holds it.
END = "\n"


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray, pa.Array]:
    """Where each text's words begin, the words, and the texts as their words with one space between."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    lists = pc.ascii_split_whitespace(trimmed)
    starts, units = word_units(trimmed)
    joined = pc.binary_join(lists, " ")
    if pc.any(pc.equal(pc.binary_length(trimmed), 0)).as_py():  # splitting nothing gives one empty word
        sizes = np.diff(starts)
        none = pc.equal(pc.binary_length(trimmed), 0).to_numpy(zero_copy_only=False)
        keep = np.repeat(~none, sizes)
        starts = np.concatenate([[0], np.cumsum(np.where(none, 0, sizes))])
        units = units.take(pa.array(np.flatnonzero(keep)))
    return starts.astype(np.int64), units, joined


def _grams(joined: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each symbol with the `order` bytes before it, text by text, and where each text's begin."""
    stream = pc.binary_join_element_wise(pa.scalar(END * order), joined, pa.scalar(END), "")
    ends = np.cumsum(pc.binary_length(stream).to_numpy(zero_copy_only=False).astype(np.int64))
    if not len(ends):
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    begin = np.concatenate([[0], ends[:-1]])
    first = np.frombuffer(stream.buffers()[1], np.int32, len(stream) + 1, 4 * stream.offset)[0]
    raw = np.frombuffer(stream.buffers()[2], np.uint8, int(ends[-1]), int(first))
    code = np.zeros(len(raw) - order, np.uint64)
    for j in range(order + 1):
        code = code << np.uint64(8) | raw[j : len(raw) - order + j]
    keep = np.ones(len(code), bool)
    for d in begin[1:].tolist():  # code i predicts byte i + order; the padding of later texts is not predicted
        keep[d - order : d] = False
    return code[keep], np.concatenate([[0], np.cumsum(ends - begin - order)])


_COUNTS = pa.schema([("word", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])


#: Bytes of text whose words, and whose n-grams, are handled at once; n-grams take some 40 bytes of memory each.
WORD_SLICE, GRAM_SLICE = 6 << 20, 2 << 20
_ROWS = 200_000
#: Counts of n-grams that a task holds; it hands them on, to be summed up after the shuffle, where half of them are distinct.
HELD_GRAMS = 4_000_000


class _Sums:
    """Counts of n-grams, of which no more than a bounded number is held."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)
        if self.size >= HELD_GRAMS:
            self._merge()
            if self.size >= HELD_GRAMS // 2:
                yield from self.rows()

    def _merge(self) -> None:
        if len(self.keys) > 1:
            keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
            by = np.argsort(keys)
            keys, counts = keys[by], counts[by]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            self.keys, self.counts, self.size = [keys[first]], [np.add.reduceat(counts, first)], len(first)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """All that is held; nothing is after that."""
        if self.size:
            self._merge()
            (keys,), (counts,) = self.keys, self.counts
            self.__init__()
            for i in range(0, len(keys), _ROWS):
                some = keys[i : i + _ROWS].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.string()), pa.array(some), pa.array(counts[i : i + _ROWS], pa.int64())], schema=_COUNTS)


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _LAST.clear()  # a worker may still hold the model of an earlier run
        sums = _Sums()
        for batch in batches:
            for part in slices(batch.column(0), WORD_SLICE):
                _, units, _ = _words(part)
                n = np.bincount(units.indices.to_numpy(zero_copy_only=False), minlength=len(units.dictionary))
                words, n = units.dictionary.filter(pa.array(n > 0)), n[n > 0]
                words, n = pa.concat_arrays([words, pa.array([END])]), np.append(n, len(part))
                for i in range(0, len(words), _ROWS):
                    some = words.slice(i, _ROWS)
                    yield pa.RecordBatch.from_arrays([some, pa.nulls(len(some), pa.int64()), pa.array(n[i : i + _ROWS], pa.int64())], schema=_COUNTS)
                del units, words
                for piece in slices(part, GRAM_SLICE):
                    yield from sums.add(*np.unique(_grams(_words(piece)[2], order)[0], return_counts=True))
        yield from sums.rows()

    return run


class Table:
    """Open addressing over 64-bit keys, looked up a whole array at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 1.6))))
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.used = np.zeros(1 << self.bits, bool)
        self.values = np.zeros(1 << self.bits, values.dtype)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            at = slot[left]
            free = left[~self.used[at]]
            _, one = np.unique(slot[free], return_index=True)
            put = free[one]
            self.keys[slot[put]], self.values[slot[put]], self.used[slot[put]] = keys[put], values[put], True
            stay = np.ones(len(keys), bool)
            stay[put] = False
            left = left[stay[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray, absent: float) -> np.ndarray:
        slot = self._slot(keys)
        hit = self.used[slot] & (self.keys[slot] == keys)
        out = np.where(hit, self.values[slot], absent)
        left = np.flatnonzero(~hit & self.used[slot])
        while len(left):
            at = slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            hit = self.used[at] & (self.keys[at] == keys[left])
            out[left[hit]] = self.values[at[hit]]
            left = left[~hit & self.used[at]]
        return out


class Ppm:
    """The trie as sorted arrays, a level for each context length, and the log10 of what its longest contexts know.

    Contexts shorter than SUFFIX are summed from `low`, if it is given, and else from the n-grams.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int = ORDER, low: tuple[np.ndarray, np.ndarray] | None = None):
        self.order = order
        order_ = np.argsort(grams)
        codes, counts = grams[order_].astype(np.uint64), counts[order_].astype(np.int64)
        self.levels = [(codes, counts)]
        for k in range(order - 1, -1, -1):
            longer, n = (codes, counts) if low is None or k >= SUFFIX else low
            shorter, of = np.unique(longer & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
            self.levels.append((shorter, np.bincount(of, n, len(shorter)).astype(np.int64)))
        _, context = np.unique(codes >> np.uint64(8), return_inverse=True)
        total = np.bincount(context, counts) if len(codes) else np.empty(0)
        self.known = Table(codes, np.log10((2 * counts - 1) / (2 * total[context])) if len(codes) else np.empty(0))
        self.other: dict[int, float] = {}

    def _escaped(self, code: int) -> float:
        """log10 of a symbol that its longest context has not seen."""
        symbol, out, excluded = code & 255, 0.0, np.zeros(256, bool)
        for k, (codes, counts) in zip(range(self.order, -1, -1), self.levels):
            context = (code & ((1 << 8 * (k + 1)) - 1)) >> 8 << 8
            lo, hi = np.searchsorted(codes, np.array([context, context + 256], np.uint64)) if context + 256 < 1 << 64 else (0, 0)
            symbols, c = (codes[lo:hi] & np.uint64(255)).astype(np.int64), counts[lo:hi]
            free = ~excluded[symbols]
            symbols, c = symbols[free], c[free]
            if not len(c):
                continue
            total = 2 * int(c.sum())
            here = np.flatnonzero(symbols == symbol)
            if len(here):
                return out + float(np.log10((2 * int(c[here[0]]) - 1) / total))
            out += float(np.log10(len(c) / total))
            excluded[symbols] = True
        return out - float(np.log10(256 - int(excluded.sum())))

    def logs(self, codes: np.ndarray) -> np.ndarray:
        out = self.known.get(codes, np.nan)
        left = np.flatnonzero(np.isnan(out))
        if len(left):
            new, of = np.unique(codes[left], return_inverse=True)
            if len(self.other) > 1_000_000:
                self.other.clear()
            values = []
            for x in new.tolist():
                if x not in self.other:
                    self.other[x] = self._escaped(x)
                values.append(self.other[x])
            out[left] = np.array(values)[of]
        return out


class Scorer:
    """Scores of texts with the log10 of the frequent n-grams and the counts of the frequent words."""

    def __init__(self, grams: np.ndarray, logs: np.ndarray, order: int, words: np.ndarray, checks: np.ndarray, word_counts: np.ndarray, ends: int):
        self.known, self.order, self.ends = Table(grams, logs), order, ends
        self.slot = Table(words, np.arange(len(words), dtype=np.int64))
        # one more row, for words that are not in the head
        self.checks, self.counts = np.append(checks, 0), np.append(word_counts, 0)

    def head(self, words: list[str]) -> np.ndarray:
        """Counts of words, 0 for those outside the head; two hashes must agree."""
        keys = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
        checks = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
        at = self.slot.get(keys, -1).astype(np.int64)
        return np.where((at >= 0) & (self.checks[at] == checks), self.counts[at], 0)

    def score(self, texts: pa.Array) -> dict[str, pa.Array]:
        starts, units, joined = _words(texts)
        index = units.indices.to_numpy(zero_copy_only=False)
        count = self.head(units.dictionary.to_pylist())[index] if len(index) else np.empty(0, np.int64)
        upto = np.concatenate([[0.0], np.cumsum(np.log10(count + 1))])
        known = np.concatenate([[0], np.cumsum(count > 0)])
        tail = count == 0
        tail_upto = np.concatenate([[0], np.cumsum(tail)])
        codes, at = _grams(joined, self.order)
        logs = self.known.get(codes, np.nan)
        rare = np.isnan(logs)
        rare_upto = np.concatenate([[0], np.cumsum(rare)])
        logs = np.concatenate([[0.0], np.cumsum(np.where(rare, 0.0, logs))])
        end = self.ends
        return {
            "n_tokens": pa.array(np.diff(starts) + 1, pa.int64()),
            "head_known": pa.array(np.diff(known[starts]) + (end > 0), pa.int64()),
            "head_log": pa.array(np.diff(upto[starts]) + np.log10(end + 1), pa.float64()),
            "score": pa.array(np.diff(logs[at]), pa.float64()),
            "tail": self._once(np.repeat(np.arange(len(starts) - 1), np.diff(tail_upto[starts])), index[tail], units.dictionary, len(starts) - 1),
            "rare": pa.ListArray.from_arrays(pa.array(rare_upto[at], pa.int32()), pa.array(codes[rare].astype(np.int64))),
        }


    @staticmethod
    def _once(row: np.ndarray, index: np.ndarray, words: pa.Array, n: int) -> pa.ListArray:
        """Each text's distinct words, and how often it has them."""
        width = max(1, len(words))
        both, times = np.unique(row * width + index, return_counts=True)
        ends = np.searchsorted(both // width, np.arange(n + 1))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([words.take(pa.array(both % width)), pa.array(times, pa.int64())], ["word", "times"]))


_TAIL = pa.list_(pa.struct([("word", pa.string()), ("times", pa.int64())]))
_SCORED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("head_known", pa.int64()), ("head_log", pa.float64()), ("score", pa.float64()), ("tail", _TAIL), ("rare", pa.list_(pa.int64()))])


_SOLVED = pa.schema([("code", pa.int64()), ("times", pa.int64()), ("log", pa.float64())])
#: Counts and asked n-grams that are handled at once, and as many more as their last suffix has.
SOLVE_ROWS = 300_000


def _solve(order: int, low):
    """Rows (suffix, gram, n, times) sorted by suffix, n a count in training, times that of an asked n-gram: log10 of the asked ones."""

    def solved(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, grams, n, times = rows
        asked = times > 0
        if asked.any():
            ppm = Ppm(grams[~asked].astype(np.uint64), n[~asked], order, low.value)
            logs = ppm.logs(grams[asked].astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(grams[asked]), pa.array(times[asked]), pa.array(logs)], schema=_SOLVED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            parts.append(np.stack([c.to_numpy() for c in batch.columns]))
            size += batch.num_rows
            if size >= SOLVE_ROWS and parts[0][0, 0] != parts[-1][0, -1]:
                rows = np.concatenate(parts, axis=1)
                whole = int(np.searchsorted(rows[0], rows[0, -1]))
                yield from solved(rows[:, :whole])
                parts, size = [rows[:, whole:]], rows.shape[1] - whole
        if size:
            yield from solved(np.concatenate(parts, axis=1))

    return run


def _rare_logs(asked: DataFrame, grams: DataFrame, order: int) -> DataFrame:
    """(code, times, log) of the distinct n-grams asked for, by the counts of all n-grams."""
    width = min(SUFFIX, order)

    def last(column: Column) -> Column:
        return column.bitwiseAND(F.lit((1 << 8 * width) - 1))

    short = grams.groupBy(last(F.col("gram")).alias("gram")).agg(F.sum("n").alias("n")).toArrow()
    low = asked.sparkSession.sparkContext.broadcast((short.column("gram").to_numpy().astype(np.uint64), short.column("n").to_numpy()))
    none = F.lit(0).cast("long")
    rows = grams.select("gram", "n", none.alias("times")).unionByName(asked.select(F.col("code").alias("gram"), none.alias("n"), "times"))
    rows = rows.select(last(F.shiftright("gram", 8)).alias("suffix"), "gram", "n", "times").repartition("suffix").sortWithinPartitions("suffix")
    return materialise(rows.mapInArrow(_solve(order, low), "code long, times long, log double"), "rare")


def _threshold(counts: DataFrame, most: int) -> int:
    """The least count that at most `most` rows have or exceed."""
    rows = 0
    least = 1
    for r in counts.groupBy("n").agg(F.count("*").alias("rows")).orderBy(F.desc("n")).toLocalIterator():
        rows += r["rows"]
        if rows > most:
            least = r["n"] + 1
            break
    return least


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 7, held_out: int = 2, order: int = ORDER, max_grams: int = MAX_GRAMS, head_words: int = HEAD_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each document."""
    if not 1 <= order <= 6:
        raise ValueError("order must be 1 to 6")
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), (fold(doc_id, folds) == held_out).alias("held_out"), text_or_empty(text).alias("text"))
    partial = rows.where("not held_out").select("text").mapInArrow(_count(order), "word string, gram long, n long")
    counts = materialise(partial.groupBy("word", "gram").agg(F.sum("n").alias("n")), "counts")
    words = counts.where("word is not null").select("word", "n")
    grams = counts.where("gram is not null").select("gram", "n")
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("distinct"), F.coalesce(F.max(F.when(F.col("word") == END, F.col("n"))), F.lit(0)).alias("ends")).first()
    short = F.octet_length("word") <= HEAD_BYTES  # others may be whole documents
    least_word, least_gram = _threshold(words.where(short), head_words), _threshold(grams, max_grams)
    in_head = short & (F.col("n") >= least_word)

    total = F.sum("n").over(Window.partitionBy(F.shiftright("gram", 8)))  # of a context, 256 rows at most
    shares = grams.select("gram", "n", F.log10((2 * F.col("n") - 1) / (2 * total)).alias("log"))

    # at most head_words and max_grams rows
    head = words.where(in_head).toArrow().combine_chunks()
    trie = shares.where(F.col("n") >= least_gram).select("gram", "log").toArrow().combine_chunks()
    names = head.column("word").to_pylist()
    name = uuid.uuid4().hex
    model = spark.sparkContext.broadcast(
        (
            trie.column("gram").to_numpy().astype(np.uint64), trie.column("log").to_numpy(), order,
            np.array([xxhash.xxh3_64_intdigest(w) for w in names], np.uint64),
            np.array([xxhash.xxh64_intdigest(w) for w in names], np.uint64),
            head.column("n").to_numpy(),
            totals["ends"],
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(name, model)
        for batch in batches:
            at = 0
            for part in slices(batch.column(3), GRAM_SLICE):
                own = batch.slice(at, len(part))
                at += len(part)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), own.column(2), *scorer.score(part).values()], schema=_SCORED)

    scored = materialise(rows.mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, head_known long, head_log double, score double, tail array<struct<word:string,times:long>>, rare array<long>"), "scored")
    rare = scored.select("row", F.explode("rare").alias("code"))
    logs = _rare_logs(rare.groupBy("code").agg(F.count("*").alias("times")), grams, order)
    asked = logs.agg(F.sum("times")).first()[0] or 1
    rare = attach_groups(rare, logs, "code", "times", asked, written=True).groupBy("row").agg(F.sum("log").alias("rare_log"))
    tail = scored.select("row", F.inline("tail"))
    texts = tail.groupBy("word").agg(F.count("*").alias("texts"))
    # also the words that training lacks: one of them may be in a third of all texts
    found = materialise(texts.join(words.where(~in_head), "word", "left"), "tail-words")
    uses = found.agg(F.sum("texts")).first()[0] or 1
    rest = attach_groups(tail, found, "word", "texts", uses, written=True).where("n is not null")
    rest = rest.groupBy("row").agg(F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("log"))
    total = F.lit(float(np.log10(totals["tokens"] + totals["distinct"] + 1)))
    return scored.drop("tail", "rare").join(rest, "row", "left").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(totals["tokens"]).cast("long").alias("train_tokens"),
        (F.col("head_log") + F.coalesce("log", F.lit(0.0)) - F.col("n_tokens") * total).alias("base_score"),
        (F.col("score") + F.coalesce("rare_log", F.lit(0.0))).alias("score"),
    )


_LAST: dict[str, Scorer] = {}


def _scorer(name: str, model) -> Scorer:
    """Built once in each worker process; only the last model is kept, and not its broadcast arrays."""
    if name not in _LAST:
        _LAST.clear()
        _LAST[name] = Scorer(*model.value)
        model.__dict__.pop("_value", None)
    return _LAST[name]


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
