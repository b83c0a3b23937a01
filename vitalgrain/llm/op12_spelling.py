"""Spelling variants by a positional q-gram inverted index with a count filter, merged by heaps.

Words are counted first. Two words are near if they differ by one inserted, deleted or replaced
character. Candidates come from an inverted index: a posting list for each padded 2-gram, position and
length. One edit spoils at most two 2-grams, so a near word of the same length r shares r - 1 of the
query's r + 1 grams at the same positions, and one of length r + 1 shares r of them, moved by one at
most. So a near word is in one of any three lists of its own length, and in the lists of one of any
two grams of the next: the shortest of these are merged by a heap, the rest are probed by bisection,
and what stays below the bound is not looked at. Candidates are verified.

The index is cut into groups that one task can hold. A group has one least length m; its queries are
words of m characters, and its index those of m and m + 1. Beyond GROUP_CHARS it is split: of what the
group's words don't share yet, the shorter one's r characters, one edit leaves the first or the last
ceil((r - 1) / 2) equal, so each word goes to the group of its beginning and to that of its end, and a
pair that meets in both counts in the first alone. Groups of one word end. With one character left a
group is never split, and holds at most A + A * A words for an alphabet of A characters (90: some
8,000). Only the characters that a group does not share are indexed. Of near words, counts and the best
one leave a task, not pairs.

Words: maximal runs [A-Za-zÀ-ÿ]+, A-Z lower-cased. Where `typos` divides the CRC-32 h of
`<doc_id>:<run>`, the character at h % length is dropped (0: never). Words shorter than `shortest`, and
those with fewer than `least` occurrences, are left out.

Defined cases: null texts have no words; a null id counts as an empty one; repeated rows count as often
as they are there; of near words with equal counts the smallest in code-point order is the form; an empty
table gives no rows; other columns are not read. `root` ends, as counts grow tenfold with each form.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach_groups, materialise, text_or_empty

SHORTEST, LEAST, TIMES, TYPOS = 7, 2, 10, 31
#: Characters of a group's words, unless one character alone is left.
GROUP_CHARS = 1 << 15
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST, typos: int = TYPOS) -> DataFrame:
    """word and n, its occurrences."""
    # a run can lose one character, none can win one, so shorter runs are never taken out of the text
    runs = F.regexp_extract_all(F.translate(text_or_empty(text), _UPPER, _LOWER), F.lit(f"[a-zÀ-ÿ]{{{shortest},}}"), F.lit(0))
    out = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("word"))
    if typos:
        h = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        out = out.select("word", h.alias("h"))
        at = (F.col("h") % F.length("word")).cast("int")
        shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        out = out.select(F.when(F.col("h") % typos == 0, shorter).otherwise(F.col("word")).alias("word")).where(F.length("word") >= shortest)
    return out.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def one_edit(s: str, t: str) -> bool:
    """Whether s becomes t, which is as long or one longer, by one edit exactly."""
    if s == t:
        return False
    i, n = 0, len(s)
    while i < n and s[i] == t[i]:
        i += 1
    return s[i + 1 :] == t[i + 1 :] if len(t) == n else s[i:] == t[i + 1 :]


class GramIndex:
    """Posting lists of the words' 2-grams by position and length; words are numbered in their order."""

    def __init__(self, rests: list[str], short: int):
        self.rests, self.short = rests, short
        self.lists: dict[tuple[str, int, bool], list[int]] = {}
        for at, rest in enumerate(rests):
            longer = len(rest) > short
            for p, gram in enumerate(_grams(rest)):
                self.lists.setdefault((gram, p, longer), []).append(at)

    def near(self, at: int) -> Iterator[int]:
        """The words that are one edit away from a short word: later ones of its length, all longer ones."""
        grams = _grams(self.rests[at])
        get = self.lists.get
        same = [(get((g, p, False), _NONE),) for p, g in enumerate(grams)]
        longer = [(get((g, p, True), _NONE), get((g, p + 1, True), _NONE)) for p, g in enumerate(grams)]
        # of r + 1 grams, r - 1 must be shared with a word of r characters, r with one of r + 1
        for lists, bound, first in ((same, len(grams) - 2, at + 1), (longer, len(grams) - 1, 0)):
            for other in _at_least(lists, bound, first) if bound > 0 else range(first, self.count_short()):
                if one_edit(self.rests[at], self.rests[other]):
                    yield other

    def count_short(self) -> int:
        return bisect_left(self.rests, True, key=lambda r: len(r) > self.short)


_NONE: list[int] = []


def _grams(rest: str) -> list[str]:
    padded = f"\0{rest}\0"
    return [padded[i : i + 2] for i in range(len(padded) - 1)]


def _at_least(lists: list[tuple[list[int], ...]], bound: int, first: int) -> Iterator[int]:
    """Numbers from `first` on that are in `bound` of the entries, each of which is one list or two."""
    lists = sorted(lists, key=lambda entry: sum(map(len, entry)))
    merged = len(lists) - bound + 1
    for number, hits in groupby(heapq.merge(*(part for entry in lists[:merged] for part in entry))):
        if number < first:
            continue
        count = sum(1 for _ in hits) if merged else 0
        # probing ends as soon as the entries left can't reach the bound
        for i in range(merged, len(lists)):
            if count + len(lists) - i < bound:
                break
            count += any(_holds(part, number) for part in lists[i])
        if count >= bound:
            yield number


def _holds(numbers: list[int], number: int) -> bool:
    at = bisect_left(numbers, number)
    return at < len(numbers) and numbers[at] == number


_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _near_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups follow each other in the rows; each word with near ones in its group gives their number and the best."""
    key, group = None, []

    def compared() -> Iterator[pa.RecordBatch]:
        if len(group) < 2:
            return
        _, m, a, b, cap = group[0][:5]
        group.sort(key=lambda r: (len(r[5]), r[5]))
        index = GramIndex([r[5][a : len(r[5]) - b] for r in group], m - a - b)
        found: dict[int, list] = {}

        def note(at: int, other: int) -> None:
            word, n = group[other][5:7]
            mine = found.setdefault(at, [0, 0, ""])
            mine[0] += 1
            if n > mine[1] or n == mine[1] and word < mine[2]:
                mine[1], mine[2] = n, word

        for at in range(index.count_short()):
            for other in index.near(at):
                # a pair whose beginnings are equal as far as `cap` meets in another group too
                if cap < 0 or group[at][5][a:cap] != group[other][5][a:cap]:
                    note(at, other)
                    note(other, at)
        if found:
            rows = [(group[at][5], *mine) for at, mine in found.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _NEAR.types)], schema=_NEAR)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != key:
                yield from compared()
                key, group = row[0], []
            group.append(row)
    yield from compared()


def _group_key(m: Column, a: Column, b: Column, cap: Column) -> Column:
    return F.xxhash64(m, a, b, cap, F.substring("word", F.lit(1), a), F.substring("word", F.length("word") - b + 1, b))


_STATE = ["key", "m", "a", "b", "cap", "word", "n"]


def _split(state: DataFrame) -> DataFrame:
    """Each word of a group in the group of its beginning and in that of its end."""
    half = F.ceil((F.col("m") - F.col("a") - F.col("b") - 1) / 2).cast("int")
    a, b, cap = F.col("a"), F.col("b"), F.col("cap")
    ahead = F.struct((a + half).alias("a"), b.alias("b"), cap.alias("cap"))
    # the first such step binds: later beginnings are longer
    behind = F.struct(a.alias("a"), (b + half).alias("b"), F.when(cap < 0, a + half).otherwise(F.least(cap, a + half)).alias("cap"))
    out = state.select("m", "word", "n", F.explode(F.array(ahead, behind)).alias("to")).select("m", "to.*", "word", "n")
    return out.withColumn("key", _group_key(*(F.col(c) for c in ("m", "a", "b", "cap")))).select(_STATE)


def near_counts(vocabulary: DataFrame, shortest: int = SHORTEST, group_chars: int = GROUP_CHARS) -> DataFrame:
    """word, n_near, and best and best_n, the near word with the largest n: words with near ones only. `vocabulary` is a written table."""
    length = F.length("word")
    zero = F.lit(0)
    lengths = F.array_distinct(F.array(length, F.greatest(length - 1, F.lit(shortest))))
    state = vocabulary.select("word", "n", F.explode(lengths).alias("m")).select("m", zero.alias("a"), zero.alias("b"), F.lit(-1).alias("cap"), "word", "n")
    state = state.withColumn("key", F.xxhash64("m")).select(_STATE)
    done = None
    while True:
        state = materialise(state, "words")
        sizes = state.groupBy("key").agg(F.count("*").alias("size"), F.sum(length).alias("chars"), F.max(F.col("m") - F.col("a") - F.col("b")).alias("rest"), F.min(length - F.col("m")).alias("short"))
        # without a word of the least length a group has no query
        sizes = materialise(sizes.where("size > 1 and short = 0"), "sizes")
        split = sizes.where((F.col("chars") > group_chars) & (F.col("rest") > 1))
        kept = materialise(attach_groups(state, sizes, "key", "size", max(1, state.count()), written=True).where("size is not null"), "groups")
        large = (F.col("chars") > group_chars) & (F.col("rest") > 1)
        ready = kept.where(~large).select(_STATE)
        done = ready if done is None else done.unionByName(ready)
        if split.isEmpty():
            break
        state = _split(kept.where(large))
    rows = done.repartition("key").sortWithinPartitions("key")
    found = rows.mapInArrow(_near_words, "word string, n_near long, best_n long, best string")
    # descending count, then the smaller word
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("rank"), "best")).alias("best")).select("word", "n_near", F.col("best.best").alias("best"), (-F.col("best.rank")).alias("best_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, each jump twice as far as the one before."""
    jumps = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = materialise(jumps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        jumps = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            return jumps


def variants(vocabulary: DataFrame, times: int = TIMES, shortest: int = SHORTEST, group_chars: int = GROUP_CHARS) -> DataFrame:
    """word, n, n_near, form, form_n, root of each word of a table of words and counts."""
    vocabulary = materialise(vocabulary, "vocabulary")
    near = near_counts(vocabulary, shortest, group_chars)
    accepted = F.col("best_n") >= times * F.col("n")
    rows = vocabulary.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(accepted, F.col("best")).alias("form"), F.when(accepted, F.col("best_n")).alias("form_n"))
    rows = materialise(rows, "forms")
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(words(spark.read.parquet(f"{sf_dir}/documents.parquet")))


# the CRC-32 by its table; words are near if they are equal without the character at one place, or one is the other without a character
ORACLE = r"""
with recursive tab as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
runs as (
  select coalesce(cast(doc_id as varchar), '') || ':' as head, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) as run from documents),
coded as (select run, list_transform(regexp_extract_all(hex(encode(head || run)), '..'), lambda x: cast('0x' || x as bigint)) as b from runs where length(run) >= 7),
hashed as (select run, xor(list_reduce(list_prepend(4294967295::bigint, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) as h from coded, tab),
edited as (select case when h % 31 = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word from hashed),
words as (select word, count(*) as n from edited where length(word) >= 7 group by word having count(*) >= 2),
cut as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
near as (
  select a.word, b.word as other, b.n as other_n from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, b.word, b.n from cut a join words b on a.rest = b.word
  union select b.word, a.word, a.n from cut a join words b on a.rest = b.word),
best as (select word, count(*) as n_near, first(other order by other_n desc, other) as best, max(other_n) as best_n from near group by word),
forms as (select word, n, coalesce(n_near, 0)::bigint as n_near, case when best_n >= 10 * n then best end as form, case when best_n >= 10 * n then best_n end as form_n from words left join best using (word)),
chain as (
  select word, word as place, 0 as depth from forms
  union all select chain.word, forms.form, depth + 1 from chain join forms on chain.place = forms.word where forms.form is not null),
roots as (select word, last(place order by depth) as root from chain group by word)
select word, n, n_near, form, form_n, root from forms join roots using (word)
"""
