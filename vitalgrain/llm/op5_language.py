"""Language identification by words first, with character n-grams behind them.

A known word gives its log frequency in each language, which is its share of all words seen in that
language plus 0.2 of one occurrence among the most words seen in any; an unseen word falls back to its n-grams of
four characters, and if none of them is known to those of three, two and one. Each word's
scores are turned into log shares over the languages, and the shares add up over the whole text.

The classifier is fitted on a sample bounded by SAMPLE_ROWS rows a language (expected number; rows
are taken by a hash of the id, all of them where a language has fewer). Prediction covers every
row and whole texts.

Defined cases: a text that is null or has no letter is `und` with score 0, and so is any text when
nothing could be learned; rows whose lang is null or blank are never learned from; null ids count
as the empty text in the fold; ties go to the language that sorts first; repeated rows get the
same answer; an empty table stays empty; all other columns of `with_language` pass unchanged.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, slices, word_units

#: Documents a language from which the classifier learns.
SAMPLE_ROWS = 600
LONGEST_GRAM = 4
#: A word seen fewer times in the sample counts as unseen; its n-grams don't.
LEAST_COUNT = 2
UNKNOWN = "und"
#: Below this score a text is taken for none of the languages.
MIN_SCORE = 0.2
#: So is a text whose share of words known as words, and two standard deviations at most, is below this part of what its language has.
#: The deviation is that of a text's distinct words: one word repeated is no sign of another language.
MIN_KNOWN = 0.6

_WORD = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def distinct_words(text: str) -> int:
    """The words that say something new about a text's language; 1 at least."""
    return max(1, len(set(words_of(text))))


def grams_of(word: str, n: int) -> list[str]:
    marked = f"^{word}$" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and n-grams by language, summed up within the task."""
    seen: dict[str, Counter] = defaultdict(Counter)
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen[lang].update(words_of(text))
    for lang, words in seen.items():
        grams: Counter = Counter()
        for word, n in words.items():
            for size in range(1, LONGEST_GRAM + 1):
                for g in grams_of(word, size):
                    grams[size, g] += n
        rows = [(lang, 0, w, n) for w, n in words.items()] + [(lang, size, g, n) for (size, g), n in grams.items()]
        for i in range(0, len(rows), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 50_000]), (pa.string(), pa.int32(), pa.string(), pa.int64()))], names=["lang", "size", "item", "n"])


class Model:
    """Log shares of each known word and n-gram over the languages, in their sorted order."""

    def __init__(self, counts: list[tuple[str, int, str, int]], least_count: int = LEAST_COUNT):
        self.langs = sorted({lang for lang, *_ in counts})
        at = {lang: i for i, lang in enumerate(self.langs)}
        total: dict[int, list[int]] = defaultdict(lambda: [0] * len(self.langs))
        seen: dict[tuple[int, str], list[int]] = defaultdict(lambda: [0] * len(self.langs))
        for lang, size, item, n in counts:
            seen[size, item][at[lang]] += n
            total[size][at[lang]] += n
        # a word has one 2-gram more than 1-grams; words that would be unseen but for one text's use don't count
        words = [max(two - one, known, 1) for two, one, known in zip(total[2], total[1], total[0])]
        often = [0] * len(self.langs)
        for (size, _), ns in seen.items():
            if not size:
                often = [x + (n if n > least_count else 0) for x, n in zip(often, ns)]
        #: The share of its words that a text of each language should have among the known ones.
        self.expected = [x / n for x, n in zip(often, words)]
        self.shares: list[dict[str, tuple[float, ...]]] = [{} for _ in range(LONGEST_GRAM + 1)]
        for (size, item), ns in seen.items():
            # what a language lacks is as rare there as in any other, however much of it was seen
            logs = [math.log(n / max(t, 1) + 0.2 / max(total[size])) for n, t in zip(ns, total[size])]
            self.shares[size][item] = _shares(logs)

    def word(self, word: str) -> tuple[float, ...] | None:
        known = self.shares[0].get(word)
        if known is not None:
            return known
        for size in range(LONGEST_GRAM, 0, -1):
            table = self.shares[size]
            found = [table[g] for g in grams_of(word, size) if g in table]
            if found:
                return _shares([sum(c) for c in zip(*found)])
        return None

    def unit(self, unit: str) -> list[float]:
        """Sums over the words of a unit without white space: log shares, then shares, then the words known as words, then the words."""
        n = len(self.langs)
        out = [0.0] * (2 * n + 2)
        for word in words_of(unit):
            out[-1] += 1
            out[-2] += word in self.shares[0]
            for i, x in enumerate(self.word(word) or ()):
                out[i] += x
                out[n + i] += math.exp(x)
        return out


def _shares(logs: list[float]) -> tuple[float, ...]:
    top = max(logs)
    whole = top + math.log(sum(math.exp(x - top) for x in logs))
    return tuple(max(x - whole, -12.0) for x in logs)


#: Bytes of text whose distinct units are scored together.
SLICE_BYTES = 6 << 20


class Predictor:
    """Predicts many texts at once: each distinct unit of a slice is scored once, and nothing is kept."""

    def __init__(self, model: Model):
        self.model = model

    def _sums(self, texts: pa.Array) -> np.ndarray:
        """The unit sums of each text."""
        starts, units = word_units(texts)
        width = 2 * len(self.model.langs) + 2
        table = np.empty((width, len(units.dictionary)), np.float32)
        for i, unit in enumerate(units.dictionary.to_pylist()):
            table[:, i] = self.model.unit(unit)
        index = units.indices.to_numpy(zero_copy_only=False)
        out = np.empty((len(texts), width))
        for i, row in enumerate(table):
            upto = np.concatenate([[0.0], np.cumsum(row[index], dtype=np.float64)])
            out[:, i] = upto[starts[1:]] - upto[starts[:-1]]
        return out

    def __call__(self, texts: pa.Array) -> list[tuple[str, float]]:
        """The language of each text, and the mean share that it has of the text's words."""
        return [(lang, score) for lang, score, _ in self.found(texts)]

    def found(self, texts: pa.Array) -> list[tuple[str, float, bool]]:
        """The same, and whether the language is recognised."""
        langs, n = self.model.langs, len(self.model.langs)
        if not n:
            return [(UNKNOWN, 0.0, False)] * len(texts)
        expected = MIN_KNOWN * np.array(self.model.expected)
        out = []
        for part in slices(pc.fill_null(texts, ""), SLICE_BYTES):
            sums = self._sums(part)
            best = sums[:, :n].argmax(axis=1)
            words = np.rint(sums[:, -1])
            share = np.minimum(1.0, np.maximum(0.0, sums[np.arange(len(best)), n + best] / np.maximum(words, 1)))
            some = np.maximum(words, 1)
            known, sure = sums[:, -2] / some, share >= MIN_SCORE
            for i in np.flatnonzero(sure & (known + 1 / np.sqrt(some) < expected[best])).tolist():
                sure[i] = known[i] + 1 / math.sqrt(distinct_words(part[i].as_py())) >= expected[best[i]]
            out += [(langs[b], float(s), k) if w else (UNKNOWN, 0.0, False) for b, s, k, w in zip(best.tolist(), share.tolist(), sure.tolist(), words.tolist())]
        return out


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def fit(rows: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id", sample_rows: int = SAMPLE_ROWS, least_count: int = LEAST_COUNT) -> Model:
    """Learns from a bounded sample of the rows that have a language and a text; words seen less than `least_count` times there stay unseen."""
    known = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(doc_id).alias("id")).where("lang is not null and trim(lang) != ''")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([])
    share = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample_rows / n))))
    # ids may be null or repeat, so the text decides too
    place = F.pmod(F.xxhash64("id", "text", F.lit("sample")), F.lit(1 << 52)).cast("double")
    drawn = known.where(place < share[F.col("lang")] * float(1 << 52)).where("text is not null").select("lang", "text")
    counts = drawn.mapInArrow(_learn, "lang string, size int, item string, n long").groupBy("lang", "size", "item").agg(F.sum("n").alias("n")).where((F.col("n") >= least_count) | (F.col("size") > 0))
    return Model([tuple(r) for r in counts.collect()], least_count)


def language(model: Model, spark: SparkSession, text: str | Column = "text") -> Column:
    """struct(lang_pred, score, recognised) of a text."""
    shared = spark.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("recognised", pa.bool_())])
    @F.arrow_udf("lang_pred string, score double, recognised boolean")
    def predicted(texts: pa.Array) -> pa.Array:
        columns = zip(*Predictor(shared.value).found(texts)) if len(texts) else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], fields=list(kind))

    return predicted(F.col(text) if isinstance(text, str) else text)


def with_language(docs: DataFrame, train: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds lang_pred and score; learns from `train`, or else from the documents outside fold 1 of 3."""
    model = fit(train if train is not None else docs.where(fold(doc_id, 3) != 1), doc_id=doc_id, text=text)
    found = scratch("language", docs.columns)
    named = {"lang_pred": F.col(f"{found}.lang_pred"), "score": F.col(f"{found}.score")}
    return docs.withColumn(found, language(model, docs.sparkSession, text)).withColumns(named).drop(found)


def identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows whose language is recognised, unchanged: not `und`, a score of MIN_SCORE at least, and enough words that are known.

    Learns from all rows that have a language; where none has, every text with a letter passes.
    """
    found = scratch("language", docs.columns)
    model = fit(docs, doc_id=doc_id, text=text)
    if not model.langs:
        return docs.where(F.col(text).rlike(r"\p{L}"))
    named = docs.withColumn(found, language(model, docs.sparkSession, text))
    return named.where(F.col(f"{found}.recognised")).drop(found)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return with_language(docs).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
