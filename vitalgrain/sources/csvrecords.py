"""Records of CSV files whose quoted fields hold line breaks, read by several tasks.

A line's effect on the reader is a function of one bit: whether a quoted field is open before it, and
after it. The first pass composes these functions over each file range, for both starts. A prefix
combination over the ranges, one row each, then tells every range how it starts. The second pass cuts
each range into records; a record that goes on into further ranges leaves its pieces, which are put
together by the range where it began.

The grammar: a quote opens a field only as its first character, and closes it at a quote that is not
doubled; what follows up to the comma belongs to the field as it stands. Line breaks (LF, CRLF, CR)
outside of quotes end a record, within them they are kept as they are. Records that are empty or of
white space alone are skipped, and so is the first record of each file, the header.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A quoted field up to its closing quote, and its inside alone.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_QUOTED = rf'"{_INSIDE}"'
#: A whole field: quoted, with what follows the closing quote, or plain.
_FIELD = rf'{_QUOTED}[^,]*+|[^",][^,]*+|'
#: Lines that the JVM's own reader splits in the same way: each quoted field ends at a comma or the end.
_PLAIN = rf'(?:(?:{_QUOTED}|[^",][^,]*+|),)*+(?:{_QUOTED}|[^",][^,]*+|)'

#: Lines after which a quoted field is open: whole fields, and one that is not closed.
_opens = re.compile(rf'(?:(?:{_FIELD}),)*+"{_INSIDE}').fullmatch
#: What closes an open field, and the rest of that field.
_closes = re.compile(rf'{_INSIDE}"[^,]*+').match
_field = re.compile(rf"({_FIELD})(?:,|\Z)")
_unquoted = re.compile(rf'"({_INSIDE})"(.*)', re.DOTALL).fullmatch


#: A byte order mark, which may stand before the header.
_MARK = "\ufeff"


def plain_line() -> Column:
    """Whether the JVM's reader splits the text line `value` by the grammar above."""
    return ~F.col("value").contains('"') | F.col("value").rlike(f"^{_PLAIN}$")


def count_fields(text: str) -> Column:
    """The number of fields of a closed record in a text column."""
    return F.size(F.regexp_extract_all(F.concat(F.lit(","), F.col(text)), F.lit(f",({_FIELD})"), F.lit(1)))


def fields_of(record: str) -> list[str]:
    """The fields of a closed record."""
    if '"' not in record:
        return record.split(",")
    out, at = [], 0
    while True:
        found = _field.match(record, at)
        field, at = found[1], found.end()
        if field.startswith('"'):
            inside, rest = _unquoted(field).groups()
            field = inside.replace('""', '"') + rest
        out.append(field)
        if found[0] == found[1]:  # no comma follows
            return out


def is_open_after(line: str, is_open: bool) -> bool:
    if '"' not in line:
        return is_open
    if not is_open:
        return _opens(line) is not None
    end = _closes(line)
    if not end:
        return True
    # a comma follows, or nothing
    return end.end() < len(line) and _opens(line[end.end() + 1 :]) is not None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines by LF alone, as CR may belong to a field, with the file and where its range begins."""
    return spark.read.option("lineSep", "\n").text(path).select("value", "_metadata.file_path", F.col("_metadata.file_block_start"))


def _parts(line: str) -> list[tuple[str, str]]:
    """A line cut at the carriage returns in it: (text, the break that follows)."""
    if "\r" not in line:
        return [(line, "\n")]
    *heads, last = line.split("\r")
    return [*((h, "\r") for h in heads), (last, "\n")]


@dataclass
class Range:
    """A file range: its records, whether a quoted field is open at its beginning and its end, and the range where that record began."""

    path: str
    start: int
    records: int
    before: bool
    after: bool
    origin: int


class _Scan:
    """What a range does to a reader that comes with an open field or without one."""

    def __init__(self, is_open: bool):
        self.is_open, self.records, self.unbroken = is_open, 0, is_open

    def line(self, text: str) -> None:
        was, self.is_open = self.is_open, is_open_after(text, self.is_open)
        if not was and text.strip(" \t"):
            self.records += 1
        if not (was and self.is_open):
            self.unbroken = False


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, start) of each range, and for both starts the end, the records that begin and whether one record fills it."""
    ranges: dict[tuple[str, int], tuple[_Scan, _Scan]] = {}
    for batch in batches:
        for value, path, start in zip(*(batch.column(i).to_pylist() for i in range(3))):
            both = ranges.get((path, start))
            if both is None:
                both = ranges[path, start] = _Scan(False), _Scan(True)
                value = value.lstrip(_MARK) if start == 0 else value
            for text, _ in _parts(value):
                for scan in both:
                    scan.line(text)
    if ranges:
        columns = [[k[0] for k in ranges], [k[1] for k in ranges], *([getattr(s[i], n) for s in ranges.values()] for i in range(2) for n in ("is_open", "records", "unbroken"))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["path", "start", "end0", "records0", "unbroken0", "end1", "records1", "unbroken1"])


def ranges_of(spark: SparkSession, path: str) -> list[Range]:
    """All ranges in the order of paths and places; one row a range comes to the driver. ValueError if a file ends within quotes."""
    kinds = "end# boolean, records# long, unbroken# boolean"
    found = _lines(spark, path).mapInArrow(_ends, f"path string, start long, {kinds.replace('#', '0')}, {kinds.replace('#', '1')}").collect()
    out: list[Range] = []
    for r in sorted(found, key=lambda r: (r["path"], r["start"])):
        last = out[-1] if out and out[-1].path == r["path"] else None
        if out and last is None and out[-1].after:
            break
        way = int(last is not None and last.after)
        # the record that is open at the end began before if it fills the whole range
        origin = last.origin if way and r[f"unbroken{way}"] else r["start"]
        out.append(Range(r["path"], r["start"], r[f"records{way}"] - (r["start"] == 0), bool(way), r[f"end{way}"], origin))
    if out and out[-1].after:
        raise ValueError(f"a quoted field is not closed in {out[-1].path}")
    return out


_PIECE = "path string, start long, seq long, text string, fields array<string>, part long"
_PIECE_ARROW = pa.schema([("path", pa.string()), ("start", pa.int64()), ("seq", pa.int64()), ("text", pa.string()), ("fields", pa.list_(pa.string())), ("part", pa.int64())])


class _Cutter:
    """Cuts a range into records: whole ones as fields, pieces of others as text with the place of the range as `part`.

    A record's `start` and `seq` say in which range it begins and at which place there.
    """

    def __init__(self, path: str, start: int, origin: int | None):
        self.path, self.start, self.origin = path, start, origin
        self.is_open = origin is not None
        # the header has the place -1
        self.seq, self.held = -1 if start == 0 else 0, []

    def line(self, value: str) -> Iterator[tuple]:
        for text, end in _parts(value):
            self.is_open = is_open_after(text, self.is_open)
            self.held.append(text)
            if self.is_open:
                self.held.append(end)
                continue
            record, self.held = "".join(self.held), []
            if self.origin is not None:
                yield self.path, self.origin, None, record, None, self.start
                self.origin = None
            elif record.strip(" \t"):
                if self.seq >= 0:
                    yield self.path, self.start, self.seq, None, fields_of(record), None
                self.seq += 1

    def end(self) -> Iterator[tuple]:
        if self.held:
            first = self.origin is None
            yield self.path, self.start if first else self.origin, self.seq if first else None, "".join(self.held), None, self.start


def _cut(origins: dict[tuple[str, int], int]):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Cutter | None = None
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PIECE_ARROW.types)], schema=_PIECE_ARROW)
            rows.clear()
            return batch

        for batch in batches:
            for value, path, start in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if now is None or (path, start) != (now.path, now.start):
                    if now is not None:
                        rows.extend(now.end())
                    now = _Cutter(path, start, origins.get((path, start)))
                    value = value.lstrip(_MARK) if start == 0 else value
                rows.extend(now.line(value))
            if rows:
                yield out()
        if now is not None:
            rows.extend(now.end())
        if rows:
            yield out()

    return cut


def records(spark: SparkSession, path: str, ranges: list[Range]) -> DataFrame:
    """path, start, seq, fields: the records of all files, headers left out; `seq` counts the records that begin in a range.

    The records of one range are the work of one task. Pieces of those that cross into other ranges, at
    most two a range, come from a second look at the ranges that begin or end within quotes.
    """
    cut = _cut({(r.path, r.start): before.origin for before, r in zip(ranges, ranges[1:]) if r.before})
    whole = _lines(spark, path).mapInArrow(cut, _PIECE).where("part is null").select("path", "start", "seq", "fields")
    across = [(r.path, r.start) for r in ranges if r.before or r.after]
    if not across:
        return whole
    some = F.broadcast(spark.createDataFrame(across, "file_path string, file_block_start long"))
    lines = _lines(spark, path).join(some, ["file_path", "file_block_start"], "left_semi")
    parts = lines.select("value", "file_path", "file_block_start").mapInArrow(cut, _PIECE).where("part is not null")
    pieces = F.array_sort(F.collect_list(F.struct("part", "text")))  # those of one record
    joined = parts.groupBy("path", "start").agg(F.max("seq").alias("seq"), pieces.alias("pieces")).where("seq >= 0")
    texts = joined.select("path", "start", "seq", F.array_join("pieces.text", "").alias("text"))
    return whole.unionByName(texts.mapInArrow(_parsed, "path string, start long, seq long, fields array<string>"))


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fields = pa.array([fields_of(t) for t in batch.column(3).to_pylist()], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], fields], names=["path", "start", "seq", "fields"])


def head_of(spark: SparkSession, path: str, most: int) -> list[list[str]]:
    """The fields of the first records, the header being the first, within `most` lines. ValueError if the header takes more."""
    out: list[list[str]] = []
    held, is_open = [], False
    for at, r in enumerate(spark.read.option("lineSep", "\n").text(path).limit(most).collect()):
        for text, end in _parts(r[0] if at else r[0].lstrip(_MARK)):
            is_open = is_open_after(text, is_open)
            held += [text, end]
            if not is_open:
                record, held = "".join(held[:-1]), []
                if record.strip(" \t"):
                    out.append(fields_of(record))
    if is_open and not out:
        raise ValueError(f"the header of {path} has more than {most} lines, or a quoted field that is not closed")
    return out
