"""Spark data source `xlog`: lines of growing text files with their byte offsets, in batch and as a stream.

Options: path (files, folders or globs, comma-separated; braces are expanded), splitBytes, offsets (JSON of file to the
start of its last loaded line; that line is passed over), strict ("false" ignores shrunken files).
For streams: maxBytesPerTrigger, dealt fairly over files; quietSeconds, for which a file must not have changed before it is read, and
maxWaitSeconds, after which it is read all the same; truncated ("raise", "anew" or "skip") for files that shrank or got another
first line; offsetLog, a folder for the places of streams in files (else each offset is a JSON of all files); generation ("true" adds a column of that name, by which a file that was begun anew is told from what it was).
A last line without its end is held back. Missing files are skipped; an offset beyond a file's end is an error.
Paths are of a shared file system, or addresses in a store that Arrow's file systems know.
"""

from __future__ import annotations

import fnmatch
import glob
import hashlib
import json
import os
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from loamline.sources.offsetlog import OffsetLog
from loamline.sources.paths import local, opened, remote

SCHEMA = "file string, offset bigint, line string"
SPLIT, BATCH = 32 << 20, 1 << 20
#: Ranges above which short ones share tasks, and the bytes that opening a file counts for.
TASKS, OPEN = 1000, 64 << 10


def expand_braces(pattern: str) -> list[str]:
    """`{a,b}{1,}` to its alternatives, nested and empty ones included; commas outside braces part patterns."""
    m = re.search(r"\{([^{}]*)\}", pattern)
    if not m:
        return [p.strip() for p in pattern.split(",") if p.strip()]
    out = [x for choice in m[1].split(",") for x in expand_braces(pattern[: m.start()] + choice.replace(",", "\0") + pattern[m.end() :])]
    return list(dict.fromkeys(out))


def listed(pattern: str) -> dict[str, int]:
    """Files by path, with their sizes."""
    out: dict[str, int] = {}
    for one in expand_braces(pattern):
        out |= _listed_remote(one) if remote(one) else _listed_local(local(one))
    return {k: v for k, v in sorted(out.items()) if not hidden(k.rsplit("/", 1)[-1])}


def hidden(name: str) -> bool:
    """Whether a file or folder isn't for readers, as those that Spark writes to before it gives files their names."""
    return name.startswith((".", "_"))


def shown(file: str, pattern: str) -> bool:
    """Whether no part of a found path is hidden but those that the pattern names."""
    named = pattern.split("/")
    return not any(hidden(x) and not hidden(named[k] if k < len(named) else "") for k, x in enumerate(file.split("/")))


def _listed_local(path: str) -> dict[str, int]:
    found = [p for p in glob.glob(path) if shown(p, path)] if re.search(r"[*?\[]", path) else [path]
    out, folders = {}, []
    for p in found:
        if os.path.isfile(p):
            out[p] = os.path.getsize(p)
        else:
            folders.append(p)
    while folders:
        try:
            entries = list(os.scandir(folders.pop()))
        except OSError:  # gone, or no folder
            continue
        for e in entries:
            if hidden(e.name):
                continue
            if e.is_dir():
                folders += [] if e.is_symlink() else [e.path]
                continue
            try:
                out[e.path] = e.stat().st_size
            except FileNotFoundError:  # gone since it was listed
                pass
    return out


def _listed_remote(path: str) -> dict[str, int]:
    from pyarrow import fs

    top = re.sub(r"/[^/]*[*?\[].*", "", path)
    system, inner = fs.FileSystem.from_uri(top)
    prefix = top.removesuffix(inner)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        return {prefix + info.path: info.size}
    infos = system.get_file_info(fs.FileSelector(inner, allow_not_found=True, recursive=True))
    files = {prefix + i.path: i.size for i in infos if i.type == fs.FileType.File and shown(prefix + i.path, path)}
    return {k: v for k, v in files.items() if top == path or fnmatch.fnmatchcase(k, path) and k.count("/") == path.count("/")}


@dataclass
class Range(InputPartition):
    """The lines that start in [start, end); resume: the line at start was loaded before."""

    file: str
    start: int
    end: int
    size: int
    resume: bool = False
    generation: str | None = None

    def __hash__(self):
        return hash((self.file, self.start))


@dataclass(eq=False)
class Ranges(InputPartition):
    """Short ranges that one task reads one after another."""

    ranges: list[Range]


def dealt(ranges: list[Range], split: int) -> list[Range | Ranges]:
    """Ranges for tasks: each its own, or where there are very many, neighbours together up to a split."""
    if len(ranges) <= TASKS:
        return list(ranges)
    size = min(split, sum(r.end - r.start + OPEN for r in ranges) // TASKS)
    out, held = [], 0
    for r in ranges:
        if not out or held >= size:
            out.append(Ranges([]))
            held = 0
        out[-1].ranges.append(r)
        held += r.end - r.start + OPEN
    return out


def read_part(part: Range | Ranges) -> Iterator[pa.RecordBatch]:
    for one in part.ranges if isinstance(part, Ranges) else [part]:
        if one.file:
            yield from read_range(one)


def read_range(part: Range) -> Iterator[pa.RecordBatch]:
    try:
        stream = opened(part.file)
    except FileNotFoundError:
        return
    with stream:
        at = part.start
        if part.resume or at > 0:
            # to the next line's start: one line on, or none if a line ends just before
            at = at if part.resume else at - 1
            at = _line_end(stream, at, part.size)
        rows: list[list] = [[], []]
        held = 0
        while at < part.end:
            stream.seek(at)
            block = stream.read(min(BATCH, part.size - at))
            cut = block.rfind(b"\n") + 1
            if not cut:  # a line longer than a block, or one without its end
                end = _line_end(stream, at, part.size)
                stream.seek(at)
                block = stream.read(end - at)
                cut = block.rfind(b"\n") + 1
                if not cut:
                    break
            for raw in block[: cut - 1].split(b"\n"):
                if at < part.end and raw.strip():
                    rows[0].append(at)
                    rows[1].append(raw.decode("utf-8", "replace"))
                at += len(raw) + 1
                held += len(raw)
            if held >= BATCH:
                yield _batch(part, rows)
                rows, held = [[], []], 0
        if rows[0]:
            yield _batch(part, rows)


def _line_end(stream, at: int, size: int) -> int:
    """The byte after the first line end at or after `at`."""
    while at < size:
        stream.seek(at)
        block = stream.read(min(65536, size - at))
        k = block.find(b"\n")
        if k >= 0:
            return at + k + 1
        at += len(block)
    return size


def _batch(part: Range, rows: list[list]) -> pa.RecordBatch:
    n = len(rows[0])
    columns = {"file": pa.array([part.file] * n, pa.string()), "offset": pa.array(rows[0], pa.int64()), "line": pa.array(rows[1], pa.string())}
    if part.generation is not None:
        columns["generation"] = pa.array([part.generation] * n, pa.string())
    return pa.RecordBatch.from_pydict(columns)


def _ranges(file: str, start: int, size: int, split: int, resume: bool) -> list[Range]:
    cuts = [start, *range(start + split, size, split), size]
    return [Range(file, a, z, size, resume and a == start) for a, z in zip(cuts, cuts[1:], strict=False) if z > a]


class XlogReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("splitbytes", SPLIT))
        self.offsets = json.loads(options.get("offsets", "{}"))
        self.strict = options.get("strict", "true") != "false"

    def partitions(self) -> list[Range]:
        out = []
        for file, size in listed(self.path).items():
            start = self.offsets.get(file)
            if start is not None and start > size:
                if self.strict:
                    raise ValueError(f"{file} has shrunk: its offset {start} lies beyond {size} bytes")
                continue
            out += _ranges(file, start or 0, size, self.split, start is not None)
        return dealt(out, self.split) or [Range("", 0, 0, 0)]

    def read(self, partition: Range | Ranges) -> Iterator[pa.RecordBatch]:
        return read_part(partition)


def first_line(file: str, most: int = 1 << 16) -> str:
    """A mark of a file's first line, or of its first `most` bytes; empty while that line has no end."""
    try:
        with opened(file) as stream:
            head = stream.read(most)
    except FileNotFoundError:
        return ""
    cut = head.find(b"\n")
    if cut < 0 and len(head) < most:
        return ""
    return hashlib.blake2b(head[: cut if cut >= 0 else most], digest_size=6).hexdigest()


class XlogStreamReader(DataSourceStreamReader):
    """Offsets are JSON of file to the byte after its last whole line that was read, and its generation: the mark of its first line, with
    a number where it was begun anew with the same one. NEXT names the file that was last read, after which the next batch begins.
    A file that goes away keeps its offset. With a log of offsets they are PLACE and the id of a place in it; a stream that began without
    one goes on with it.
    """

    NEXT, PLACE = "", "//place"

    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("splitbytes", SPLIT))
        self.limit = int(options.get("maxbytespertrigger", 0))
        self.quiet, self.longest = float(options.get("quietseconds", 0)), float(options.get("maxwaitseconds", 60))
        self.truncated = options.get("truncated", "raise")
        if self.truncated not in ("raise", "anew", "skip"):
            raise ValueError(f"truncated is raise, anew or skip, not {self.truncated}")
        self.named = options.get("generation", "false") == "true"
        self.log = OffsetLog(options["offsetlog"]) if options.get("offsetlog") else None
        self.last: dict = {}
        self.at = ""  # the place of `last`
        self.seen: dict[str, tuple[int, float, float]] = {}  # size, when it changed, when the first of what waits came
        self.heads: dict[str, tuple[int, str]] = {}  # size when the first line was read, and its mark

    def initialOffset(self) -> dict:
        return {}

    def _generation(self, file: str, size: int, end: int, known: str) -> str:
        """The file's generation now, `known` if it only grew. The first line is read again when the file has changed."""
        held = self.heads.get(file)
        if held is None or held[0] != size:
            held = self.heads[file] = (size, first_line(file) if size else "")
        if not known or held[1] == known.split("+")[0] and size >= end:
            return known or held[1]
        return held[1] if held[1] != known.split("+")[0] else f"{held[1]}+{int((known.split('+') + ['0'])[1]) + 1}"

    def _waits(self, file: str, size: int, now: float) -> bool:
        """Whether a file with news has changed too lately to be read."""
        if not self.quiet:
            return False
        before = self.seen.get(file)
        changed = now if before is None or before[0] != size else before[1]
        first = now if before is None else before[2]
        self.seen[file] = size, changed, first
        return now - changed < self.quiet and now - first < self.longest

    def latestOffset(self) -> dict:
        out, now, news = dict(self.last), time.monotonic(), {}
        for file, size in listed(self.path).items():
            end, known = out.get(file, (0, ""))
            generation = self._generation(file, size, end, known) if size != end or file not in self.heads else known
            if generation != known and known:
                if self.truncated == "raise":
                    raise ValueError(f"{file} has shrunk or begun anew: {end} bytes of it were read, {size} are there")
                if self.truncated == "skip":
                    continue
                end = 0
            if size > end and not self._waits(file, size, now):
                news[file] = end, size, generation
        begun = {file: end for file, (end, _, _) in news.items()}
        self._take(out, news)
        if self.log:
            changes = {file: [end, *out[file]] for file, end in begun.items() if file in out and out[file] != self.last.get(file)}
            if changes:
                self.at = self.log.put(self.at, changes, {k: v for k, v in out.items() if k != self.NEXT}, out.get(self.NEXT, ""))
        self.last = out
        return {self.PLACE: self.at} if self.at else out

    def _take(self, out: dict, news: dict[str, tuple[int, int, str]]) -> None:
        """Puts the new ends of files into out: in turns, from the file after the last one read, an equal share of what is left of
        the limit for each, until it is used up. A limit is overstepped by the rest of one line at most."""
        names = sorted(news)
        at = next((k for k, n in enumerate(names) if n > out.get(self.NEXT, "")), 0)
        waiting, room = names[at:] + names[:at], self.limit or None
        while waiting and (room is None or room > 0):
            share, left = None if room is None else max(1, room // len(waiting)), []
            for file in waiting:
                if room is not None and room <= 0:
                    break
                start, size, generation = news[file]
                end = whole_lines_end(file, start, size, None if share is None else min(share, room))
                if end > start:
                    out[file], out[self.NEXT] = [end, generation], file
                    news[file] = end, size, generation
                    self.seen.pop(file, None)
                    room = None if room is None else room - (end - start)
                    if end < size and room is not None:
                        left.append(file)
            waiting = left
        if out.get(self.NEXT) and not self.limit:
            out.pop(self.NEXT)

    def _state(self, offset: dict) -> dict:
        """All files at an offset, whichever way it is told."""
        if self.PLACE not in offset:
            return dict(offset)
        if self.log is None:
            raise ValueError("the offsets of this stream are places in a log: option offsetLog is missing")
        if offset[self.PLACE] == self.at:
            return self.last
        files, next_ = self.log.state(offset[self.PLACE])
        return files | ({self.NEXT: next_} if next_ else {})

    def _changes(self, start: dict, end: dict) -> dict[str, list]:
        """What lies between two offsets: file to first byte, byte after the last, and generation."""
        found = None
        if self.PLACE in end and self.log and (not start or self.PLACE in start):
            found = self.log.between(start.get(self.PLACE, ""), end[self.PLACE])
        if found is None:
            before, after = self._state(start), self._state(end)
            found = {}
            for file, (to, generation) in ((f, x) for f, x in after.items() if f != self.NEXT):
                begun, known = before.get(file, (0, generation))
                found[file] = [begun if known == generation else 0, to, generation]
        return found

    def partitions(self, start: dict, end: dict) -> list[Range | Ranges]:
        """Spark also asks for start == end, to tell a reader that begins anew where the stream is."""
        changes = {} if start == end else self._changes(start, end)
        self.last, self.at = self._state(end), end.get(self.PLACE, "")
        out = []
        for file, (begun, to, generation) in sorted(changes.items()):
            out += [Range(file, a.start, a.end, to, generation=generation if self.named else None) for a in _ranges(file, begun, to, self.split, False)]
        return dealt(out, self.split) or [Range("", 0, 0, 0)]

    def read(self, partition: Range | Ranges) -> Iterator[pa.RecordBatch]:
        return read_part(partition)

    def commit(self, end: dict) -> None:
        if self.log:
            self.log.trimmed()


def whole_lines_end(file: str, start: int, size: int, room: int | None) -> int:
    """The end of the last whole line in [start, size), or of the first lines that fill `room` bytes."""
    with opened(file) as stream:
        if room is not None and start + room < size:
            return _line_end_or(stream, start + room - 1, size, start)
        at = size
        while at > start:
            low = max(start, at - 65536)
            stream.seek(low)
            k = stream.read(at - low).rfind(b"\n")
            if k >= 0:
                return low + k + 1
            at = low
    return start


def _line_end_or(stream, at: int, size: int, other: int) -> int:
    while at < size:
        stream.seek(at)
        block = stream.read(min(65536, size - at))
        k = block.find(b"\n")
        if k >= 0:
            return at + k + 1
        at += len(block)
    return other


class XlogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "xlog"

    def schema(self) -> str:
        named = {k.lower(): v for k, v in self.options.items()}.get("generation", "false") == "true"
        return SCHEMA + ", generation string" * named

    def reader(self, schema: StructType) -> XlogReader:
        return XlogReader({k.lower(): v for k, v in self.options.items()})

    def streamReader(self, schema: StructType) -> XlogStreamReader:
        return XlogStreamReader({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(XlogSource)


def scan(spark: SparkSession, path: str, **options):
    register(spark)
    return spark.read.format("xlog").options(path=path, **options).load()


def tail(spark: SparkSession, path: str, **options):
    register(spark)
    return spark.readStream.format("xlog").options(path=path, **options).load()
