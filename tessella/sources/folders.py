"""Folders of captured answers and of documents as data sources whose filters choose the files to read."""

from __future__ import annotations

import json
import posixpath
import urllib.parse
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, StringEndsWith, StringStartsWith
from pyspark.sql.pandas.types import to_arrow_schema

from .documents import decoded

# --- files -------------------------------------------------------------------


def opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:/") else (pyarrow.fs.LocalFileSystem(), path)


@dataclass
class Files(InputPartition):
    """Some files of a folder, which one task reads."""

    paths: tuple[str, ...]


def _holds(f: Filter, value: str | None) -> bool:
    if isinstance(f, EqualTo | EqualNullSafe):
        return value == f.value
    if isinstance(f, In):
        return value in f.value
    return value is not None and (value.startswith(f.value) if isinstance(f, StringStartsWith) else value.endswith(f.value))


class FolderReader(DataSourceReader):
    """Reads a folder's files in parts of bounded size. Filters on what a file's path says (``keys``)
    are applied to paths, so that no other file is opened.

    Options: ``path``; ``recursive`` (true); ``maxBytes`` and ``maxFiles`` of a task. Folders
    that are absent have no rows.

    Spark keeps what is pushed for a loaded table, not for its place in a plan: a plan that reads a
    folder twice under different filters has to load it twice.
    """

    endings: tuple[str, ...] = ()

    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.schema = options["path"], schema
        self.recursive = str(options.get("recursive", "true")).lower() == "true"
        self.most_bytes, self.most_files = int(options.get("maxBytes", 32 << 20)), int(options.get("maxFiles", 1000))
        self.pushed: list[Filter] = []

    def keys(self, file: str) -> dict[str, str | None]:
        """What the path below the folder says, by column."""
        raise NotImplementedError

    def rows(self, file: str, raw: bytes) -> Iterable[dict]:
        raise NotImplementedError

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        own = self.keys("")
        for f in filters:
            name = f.attribute[0] if isinstance(f, EqualTo | EqualNullSafe | In | StringStartsWith | StringEndsWith) and len(f.attribute) == 1 else None
            if name in own:
                self.pushed.append(f)
            yield f  # Spark tests it again: scans that differ in pushed filters alone would count as equal, and be read once

    def chosen(self, name: str) -> set[str] | None:
        """The values that filters by equality leave for a key, or None for any."""
        found = None
        for f in self.pushed:
            if f.attribute == (name,) and isinstance(f, EqualTo | EqualNullSafe | In):
                now = {v for v in (f.value if isinstance(f, In) else (f.value,)) if v is not None}
                found = now if found is None else found & now
        return found

    def candidates(self, fs: pyarrow.fs.FileSystem, root: str) -> Iterator[pyarrow.fs.FileInfo]:
        """Files below ``root`` that may be wanted: all of them, unless a source knows better."""
        yield from fs.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True, recursive=self.recursive))

    def partitions(self) -> Sequence[InputPartition]:
        fs, root = opened(self.path)
        out, held, size = [], [], 0
        for info in sorted(self.candidates(fs, root), key=lambda i: i.path):
            if info.type != pyarrow.fs.FileType.File or not info.path.endswith(self.endings):
                continue
            keys = self.keys(posixpath.relpath(info.path, root))
            if not all(_holds(f, keys[f.attribute[0]]) for f in self.pushed):
                continue
            if held and (size + info.size > self.most_bytes or len(held) >= self.most_files):
                out.append(Files(tuple(held)))
                held, size = [], 0
            held.append(info.path)
            size += info.size
        return [*out, Files(tuple(held))] if held or not out else out

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, root = opened(self.path)
        schema, held = to_arrow_schema(self.schema), []
        for path in partition.paths:
            with fs.open_input_stream(path) as f:
                raw = f.read()
            for row in self.rows(posixpath.relpath(path, root), raw):
                held.append(row)
                if len(held) >= 1000:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)
                    held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)


# --- captured answers ----------------------------------------------------------

# Where a service's answer has its records; others are one record each.
RECORDS = {"taxa": "records", "children": "records", "occurrences": "records", "search": "search"}
ANSWER = "service string, subject string, pos int, record string, _file string, _error string"


class AnswersReader(FolderReader):
    """A row for each record of ``service/subject.json`` (the subject percent-encoded), in the answer's
    order; an answer that can't be decoded is a row with ``_error``. Option ``first``: so many records
    of an answer at most, as services give them when asked for a first one; option ``service``: of it alone."""

    endings = (".json",)

    def __init__(self, options: dict, schema: T.StructType):
        super().__init__(options, schema)
        self.first = int(options.get("first", 0)) or None
        self.service = options.get("service")

    def keys(self, file: str) -> dict[str, str | None]:
        service, _, name = file.rpartition("/")
        return {"service": service, "subject": urllib.parse.unquote(name.removesuffix(".json")), "_file": file}

    def candidates(self, fs, root):
        services, subjects = self.chosen("service"), self.chosen("subject")
        if self.service is not None:
            services = {self.service} if services is None else services & {self.service}
        if services is None:
            folders = [i.path for i in fs.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True)) if i.type == pyarrow.fs.FileType.Directory]
        else:
            folders = [posixpath.join(root, s) for s in services]
        for folder in folders:
            if subjects is None:
                yield from fs.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True))
            else:  # no listing at all
                yield from fs.get_file_info([posixpath.join(folder, answer_name(s)) for s in subjects])

    def rows(self, file: str, raw: bytes) -> Iterator[dict]:
        row = self.keys(file) | {"pos": None, "record": None, "_error": None}
        try:
            answer = json.loads(raw)
            service = row["service"]
            if service == "entities":
                answer = (answer.get("entities") or {}).get(row["subject"])
                found = [] if answer is None else [answer]
            else:
                found = (answer.get(RECORDS[service]) or [] if isinstance(answer, dict) else []) if service in RECORDS else [answer]
            for pos, record in enumerate(found[: self.first]):
                yield row | {"pos": pos, "record": json.dumps(record, ensure_ascii=False)}
        except (ValueError, AttributeError) as e:
            yield row | {"_error": f"{type(e).__name__}: {e}"}


class CapturedAnswers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "captured_answers"

    def schema(self) -> str:
        return ANSWER

    def reader(self, schema: T.StructType) -> AnswersReader:
        return AnswersReader(self.options, schema)


def answer_name(subject: str) -> str:
    return urllib.parse.quote(subject, safe="") + ".json"


# --- documents -------------------------------------------------------------------


class DocumentsReader(FolderReader):
    """A row for each .yml or .yaml file; see ``documents.decode_documents`` for the columns."""

    endings = (".yml", ".yaml")

    def keys(self, file: str) -> dict[str, str | None]:
        folder, _, name = file.rpartition("/")
        return {"_file": file, "_stem": name.removesuffix(".yml").removesuffix(".yaml"), "_folder": posixpath.basename(folder or self.path.rstrip("/"))}

    def rows(self, file: str, raw: bytes) -> Iterator[dict]:
        fields = T.StructType([f for f in self.schema.fields if f.name not in ("_extra", "_file", "_stem", "_folder", "_error")])
        fitted, extra, error = decoded(raw.decode("utf-8", "replace"), fields)
        yield (fitted or dict.fromkeys(fields.names)) | self.keys(file) | {"_extra": extra, "_error": error}


class DocumentFolder(DataSource):
    """Needs the columns of the documents as the reader's schema, with those of ``documents.ADDED``."""

    @classmethod
    def name(cls) -> str:
        return "document_folder"

    def reader(self, schema: T.StructType) -> DocumentsReader:
        return DocumentsReader(self.options, schema)


# --- on Spark --------------------------------------------------------------------


def register(spark: SparkSession) -> None:
    """Make the formats known, and let Spark hand them filters."""
    for source in (CapturedAnswers, DocumentFolder):
        spark.dataSource.register(source)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def answers(spark: SparkSession, folder: str, **options) -> DataFrame:
    """The captured answers of a folder, loaded anew with each call."""
    register(spark)
    return spark.read.format("captured_answers").options(**options).load(folder)


def save_answers(df: DataFrame, folder: str) -> None:
    """Keep answers (``service, subject, body``) as files, written by the tasks that have them. A file
    appears whole or not at all, and a task that runs again writes the same."""

    def save(rows: Iterable) -> None:
        fs, root = opened(folder)
        for r in rows:
            place = posixpath.join(root, r.service)
            fs.create_dir(place, recursive=True)
            write_whole(fs, posixpath.join(place, answer_name(r.subject)), (r.body or "").encode())

    df.select("service", "subject", "body").foreachPartition(save)


def write_whole(fs: pyarrow.fs.FileSystem, path: str, raw: bytes) -> None:
    """Write beside the file, then move: readers see the old file or the new one."""
    import uuid

    beside = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(beside) as f:
        f.write(raw)
    fs.move(beside, path)
