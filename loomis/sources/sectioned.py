"""A data source for sectioned task files, batch and stream:

    spark.dataSource.register(SectionedFiles)
    spark.read.format("sectioned").load(path)
    spark.readStream.format("sectioned").load(path)

One row per file and category: (file, category, offset, section); section is
the text behind the category's first heading, up to the next heading of any
kind, null where the file lacks the heading.  Files are cut while they are read,
each once and front to back, so a task holds one section and not a whole file;
small files share a partition up to ``partitionBytes``, a larger file has one of
its own.  Rows need no shuffle: which heading is the first is known to the one
reader of a file.

The stream takes every file once.  Its offset is the latest time of change it
has seen and the files taken within ``lateSeconds`` before that; a file that
appears later than that after its own time of change is passed over.  A file
must be complete when it appears (written elsewhere and renamed, as Spark's own
file source asks for).

Paths are those that pyarrow's file systems open (local or mounted folders, s3,
gs); ``tasks.read_sectioned_tasks`` reads any other path through Spark.  Hidden
files (leading "_" or ".") are passed over.  Defined cases: an empty file lacks
all headings; bytes that are not UTF-8 are replaced; an empty folder gives no
rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from loomis.schemas import SECTION_COLONS, SECTION_HEADINGS

SCHEMA = "file string, category string, offset bigint, section string"
PARTITION_BYTES = 64 << 20
CHUNK = 1 << 20
SCHEMES = ("", "file", "s3", "gs")
_HEADING = re.compile(("(" + "|".join(h for _, h in SECTION_HEADINGS) + ")(?:" + "|".join(SECTION_COLONS.strip("[]")) + ")")
                      .encode())
_CATEGORY = {h.encode(): c for c, h in SECTION_HEADINGS}
# A heading that a chunk cuts begins at most this many bytes before its end.
_LONGEST = max(len(h.encode()) for _, h in SECTION_HEADINGS) + 4


def readable(path: str) -> bool:
    """Whether the data source can open the path."""
    scheme = path.split(":", 1)[0] if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) else ""
    return scheme.lower() in SCHEMES


def _open(path: str):
    from pyarrow import fs
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        if path.startswith("file:"):
            return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def list_files(path: str) -> list[tuple[int, str, int]]:
    """(time of change in ns, path, bytes) of the files under a path, sorted."""
    from pyarrow import fs
    system, root = _open(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root, recursive=True))
    out = []
    for f in found:
        inner = f.path[len(root):] if f.path != root else ""
        hidden = any(p[:1] in ("_", ".") for p in inner.split("/") if p)
        if f.type == fs.FileType.File and not hidden:
            out.append((f.mtime_ns or 0, f.path, f.size or 0))
    return sorted(out)


def cut_sections(chunks: Iterator[bytes]) -> Iterator[tuple[str, int, bytes]]:
    """(category, offset of the heading, section) of each category's first
    heading, from the chunks of one file.  Holds one section at a time; of a
    repeated heading's section only what is needed to find its end."""
    seen: set[str] = set()
    held, at = b"", 0               # bytes not yet decided on, and their place in the file
    now: tuple[str, int] | None = None
    parts: list[bytes] = []
    for chunk in chunks:
        held += chunk
        done, keep = 0, len(held) - _LONGEST
        for m in _HEADING.finditer(held):
            # Decide on a heading near the end once more bytes are there.
            if m.end() > len(held) - _LONGEST:
                keep = min(keep, m.start())
                break
            if now:
                yield (*now, b"".join([*parts, held[done:m.start()]]))
            category = _CATEGORY[m[1]]
            now, parts, done = (None if category in seen else (category, at + m.start())), [], m.end()
            seen.add(category)
        keep = max(done, keep)
        if now:
            parts.append(held[done:keep])
        at, held = at + keep, held[keep:]
    done = 0
    for m in _HEADING.finditer(held):
        if now:
            yield (*now, b"".join([*parts, held[done:m.start()]]))
        category = _CATEGORY[m[1]]
        now, parts, done = (None if category in seen else (category, at + m.start())), [], m.end()
        seen.add(category)
    if now:
        yield (*now, b"".join([*parts, held[done:]]))


def read_file(path: str, root: str, chunk: int = CHUNK) -> Iterator[tuple]:
    system, _ = _open(root)

    def chunks():
        with system.open_input_stream(path) as f:
            while block := f.read(chunk):
                yield block
    found = set()
    for category, offset, section in cut_sections(chunks()):
        found.add(category)
        yield path, category, offset, section.decode("utf-8", "replace")
    for category, _ in SECTION_HEADINGS:
        if category not in found:
            yield path, category, None, None


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


def packed(files: list[tuple[int, str, int]], limit: int) -> list[Files]:
    """Files dealt to partitions of about ``limit`` bytes (a file counts for 64
    KB at least, as opening it costs)."""
    out: list[list[str]] = []
    size = 0
    for _, path, n in files:
        n = max(n, 1 << 16)
        if not out or size + n > limit:
            out.append([])
            size = 0
        out[-1].append(path)
        size += n
    return [Files(x) for x in out]


class SectionReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.limit = int(options.get("partitionBytes", PARTITION_BYTES))

    def partitions(self):
        return packed(list_files(self.path), self.limit) or [Files([])]

    def read(self, partition):
        for path in partition.paths:
            yield from read_file(path, self.path)


class SectionStreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.limit = int(options.get("partitionBytes", PARTITION_BYTES))
        self.late = int(float(options.get("lateSeconds", 3600)) * 1e9)

    def initialOffset(self):
        return {"time": -1, "taken": {}}

    def latestOffset(self):
        files = list_files(self.path)
        time = files[-1][0] if files else -1
        return {"time": time, "taken": {p: True for t, p, _ in files if t > time - self.late}}

    def partitions(self, start, end):
        def new(t, p):
            after = start["time"] < 0 or (t > start["time"] - self.late and p not in start["taken"])
            return after and (t <= end["time"] - self.late or p in end["taken"])
        return packed([f for f in list_files(self.path) if new(f[0], f[1])], self.limit) or [Files([])]

    def read(self, partition):
        for path in partition.paths:
            yield from read_file(path, self.path)

    def commit(self, end):
        pass


class SectionedFiles(DataSource):
    """Sectioned task files as a Spark data source."""

    @classmethod
    def name(cls):
        return "sectioned"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return SectionReader(self.options)

    def streamReader(self, schema):
        return SectionStreamReader(self.options)


def sections(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    """Sections of the files under ``path``, by the data source."""
    spark.dataSource.register(SectionedFiles)
    reader = (spark.readStream if stream else spark.read).format("sectioned")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


__all__ = ["SectionedFiles", "sections", "readable", "cut_sections"]
