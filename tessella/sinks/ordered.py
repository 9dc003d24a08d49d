"""One ordered document from many tasks: a data source that writes parts, and places what stands between them on commit."""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..sources.folders import opened

COPIED = 8 << 20  # bytes that a copying task holds


@dataclass(frozen=True)
class Section:
    """What stands before, after and between a section's records, and in the place of an empty one."""

    before: str = ""
    after: str = ""
    between: str = ""
    empty: str = ""


@dataclass(frozen=True)
class Layout:
    """A document: header, sections by number with a joint between any two, footer. ``form`` renders a
    record's JSON: ``json`` as an indented member named by its key, ``item`` as an indented value,
    ``yaml`` as an indented entry of block style; ``text`` leaves the value as it is."""

    sections: tuple[Section, ...] = (Section(),)
    header: str = ""
    footer: str = ""
    joint: str = ""
    form: str = "text"
    indent: int = 4

    def passed(self, a: int | None, b: int | None) -> str:
        """The text from after a record of section a (None: the header) to before one of section b (None: the footer)."""
        if a is not None and a == b:
            return self.sections[a].between
        parts = [] if a is None else [self.sections[a].after]
        for k in range(0 if a is None else a + 1, len(self.sections) if b is None else b):
            parts += [self.joint] * (k > 0) + [self.sections[k].empty]
        if b is not None:
            parts += [self.joint] * (b > 0) + [self.sections[b].before]
        return (self.header if a is None else "") + "".join(parts) + (self.footer if b is None else "")

    def rendered(self, key: str | None, value: str) -> str:
        if self.form == "text":
            return value
        data = plain(json.loads(value))
        pad = " " * self.indent
        if self.form == "yaml":
            return "".join(pad + line for line in yaml_text({key: data}).splitlines(keepends=True))
        text = json.dumps(data, indent=2, ensure_ascii=False).replace("\n", "\n" + pad)
        return f"{pad}{json.dumps(key, ensure_ascii=False)}: {text}" if self.form == "json" else f"{pad}{text}"


def plain(x):
    """Without null members, and with whole numbers as such."""
    if isinstance(x, dict):
        return {k: plain(v) for k, v in x.items() if v is not None}
    if isinstance(x, list):
        return [plain(v) for v in x]
    return int(x) if isinstance(x, float) and x.is_integer() else x


def yaml_text(data) -> str:
    """Block style without references or folded lines."""
    import yaml

    class Dumper(yaml.SafeDumper):
        def ignore_aliases(self, _):
            return True

    return yaml.dump(data, Dumper=Dumper, width=float("inf"), sort_keys=False, allow_unicode=True)


# --- the writer ----------------------------------------------------------------


@dataclass
class Part(WriterCommitMessage):
    """A task's file, empty if it had no rows, and the sections it begins and ends in."""

    task: int
    file: str
    rows: int = 0
    first: int | None = None
    last: int | None = None


@dataclass
class OrderedWriter(DataSourceArrowWriter):
    """Writes rows ``section, key, value``, sorted over all tasks in their order, as the files of one document.

    Tasks write to a folder of this write alone. The commit names their files by place, adds small ones
    for what stands between, and deletes that folder; so a task that failed, or ran twice, leaves nothing,
    nor does a write that failed as a whole, and an old document stays until then.
    """

    path: str
    overwrite: bool
    layout: Layout
    batch: str = field(default_factory=lambda: uuid.uuid4().hex)

    def _folder(self) -> tuple[pyarrow.fs.FileSystem, str, str]:
        fs, root = opened(self.path)
        return fs, root, f"{root.rstrip('/')}-{self.batch}.parts"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        fs, _, folder = self._folder()
        task = TaskContext.get()
        part = Part(task.partitionId(), posixpath.join(folder, f"{task.partitionId()}-{task.taskAttemptId()}"))
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(part.file) as out:
            for batch in iterator:
                for section, key, value in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("section", "key", "value")), strict=True):
                    if value is None:
                        raise ValueError(f"no value for {key}")
                    if part.rows:
                        if section < part.last:
                            raise ValueError("sections are out of order")
                        out.write(self.layout.passed(part.last, section).encode())
                    else:
                        part.first = section
                    out.write(self.layout.rendered(key, value).encode())
                    part.last, part.rows = section, part.rows + 1
        return part

    def commit(self, messages: list[Part | None]) -> None:
        fs, root, folder = self._folder()
        fs.create_dir(folder, recursive=True)
        wanted, last, k = [], None, 0
        for part in sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.task):
            if last is not None and part.first < last:
                self.abort(messages)
                raise ValueError("sections are out of order")
            wanted += [(self.layout.passed(last, part.first), None), (None, part.file)]
            last = part.last
        wanted.append((self.layout.passed(last, None), None))
        done = f"{folder}.whole"
        fs.create_dir(done, recursive=True)
        for text, file in wanted:
            name = posixpath.join(done, f"part-{k:08}")
            if file is not None:
                fs.move(file, name)
            elif text:
                with fs.open_output_stream(name) as f:
                    f.write(text.encode())
            k += 1
        if fs.get_file_info(root).type != pyarrow.fs.FileType.NotFound:
            fs.delete_dir(root)
        fs.move(done, root)
        fs.delete_dir(folder)

    def abort(self, messages: list[Part | None]) -> None:
        fs, _, folder = self._folder()
        if fs.get_file_info(folder).type != pyarrow.fs.FileType.NotFound:
            fs.delete_dir(folder)


class OrderedDocument(DataSource):
    """Options: ``path``, and ``layout``, a ``Layout`` as JSON."""

    @classmethod
    def name(cls) -> str:
        return "ordered_document"

    def schema(self) -> str:
        return "section int, key string, value string"

    def writer(self, schema: T.StructType, overwrite: bool) -> OrderedWriter:
        path = self.options["path"]
        fs, root = opened(path)
        if not overwrite and fs.get_file_info(root).type != pyarrow.fs.FileType.NotFound:
            raise FileExistsError(f"{path} exists: use mode overwrite")
        given = json.loads(self.options["layout"])
        return OrderedWriter(path, overwrite, Layout(**given | {"sections": tuple(Section(**s) for s in given["sections"])}))


# --- on Spark --------------------------------------------------------------------


def write_document(rows: DataFrame, path: str, layout: Layout, order: Sequence[str | Column] = ("section", "key"), *, mode: str = "overwrite") -> None:
    """Write ``section, key, value`` as one document, in order, from ranges of rows: a folder of files whose
    text in order of their names is the document (``assemble`` makes one file of it).

    No row passes the driver, and no task gets more than its range.
    """
    spark = rows.sparkSession
    spark.dataSource.register(OrderedDocument)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranges.select(F.col("section").cast("int").alias("section"), F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")).write.format("ordered_document").mode(mode).option("path", path).option("layout", json.dumps(asdict(layout))).save()


def document_files(path: str) -> list[str]:
    fs, root = opened(path)
    return sorted(i.path for i in fs.get_file_info(pyarrow.fs.FileSelector(root)))


def assemble(spark: SparkSession, path: str, file: str) -> None:
    """One file of a written document, copied in order by a task; it appears whole or not at all."""

    def copy(_) -> None:
        fs, target = opened(file)
        beside = f"{target}.{uuid.uuid4().hex}.part"
        with fs.open_output_stream(beside) as out:
            for name in document_files(path):
                with opened(path)[0].open_input_stream(name) as f:
                    while piece := f.read(COPIED):
                        out.write(piece)
        fs.move(beside, target)

    spark.range(1).coalesce(1).foreachPartition(copy)
