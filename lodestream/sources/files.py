"""A sink of named files and a source of recorded responses, as Python data sources; whole files from several places."""

from __future__ import annotations

import re
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage


def _open(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://?", path):
        return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def _delete(files, folder: str, tries: int = 50) -> None:
    """A folder that may be gone already, or in which another task still writes or deletes."""
    from pyarrow import fs

    for n in range(tries):
        try:
            return files.delete_dir(folder)
        except OSError:
            if files.get_file_info(folder).type == fs.FileType.NotFound:
                return None
            if n + 1 == tries:
                raise
            time.sleep(0.1)


_PART = re.compile(r"part-\d{5,}-of-\d{5,}")


def _part(name: str, folders: int) -> str:
    """The folder of a file among so many; none for files that lie side by side."""
    return f"part-{zlib.crc32(name.encode()) % folders:05d}-of-{folders:05d}" if folders else ""


def _listed(files, folder: str) -> list:
    """The files of a folder, without the sink's own."""
    from pyarrow import fs

    return [x for x in files.get_file_info(fs.FileSelector(folder)) if x.type == fs.FileType.File and not x.base_name.startswith("_")]


def _parts(files, folder: str) -> list[str]:
    from pyarrow import fs

    return sorted(x.path for x in files.get_file_info(fs.FileSelector(folder)) if x.type == fs.FileType.Directory and _PART.fullmatch(x.base_name))


@dataclass
class Staged(WriterCommitMessage):
    folder: str
    parts: list[str]


class FileWriter(DataSourceWriter):
    """Each task writes into a folder of its own below the target; the files move to their names only when all tasks are done, or with `folders` the folders of their parts do. A job that fails, and each attempt of a task that does, leaves nothing: the driver makes the folder of the tasks' folders, and a task that still runs when it has been deleted can't bring it back."""

    def __init__(self, path: str, overwrite: bool, folders: int = 0):
        self.path, self.overwrite, self.folders, self.staging = path.rstrip("/"), overwrite, folders, f"_staging-{uuid.uuid4().hex}"
        files, base = _open(self.path)
        if not overwrite and self._there(files, f"{base}/_SUCCESS"):
            with files.open_input_stream(f"{base}/_SUCCESS") as x:
                before = int(x.read() or b"0")
            if before != folders:
                raise ValueError(f"the folder has its files in {before} parts, not {folders}")
        files.create_dir(f"{base}/{self.staging}", recursive=True)

    @staticmethod
    def _there(files, path: str) -> bool:
        from pyarrow import fs

        return files.get_file_info(path).type != fs.FileType.NotFound

    def write(self, iterator) -> Staged:
        files, base = _open(self.path)
        task = TaskContext.get()
        folder, seen, parts = f"{base}/{self.staging}/{task.partitionId()}-{task.taskAttemptId()}", set(), set()
        files.create_dir(folder, recursive=False)
        try:
            for row in iterator:
                if not row.name or "/" in row.name or row.name.startswith(("_", ".")) or row.name in seen:
                    raise ValueError(f"a file needs a name of its own, without slashes: {row.name!r}")
                seen.add(row.name)
                part = _part(row.name, self.folders)
                if part and part not in parts:
                    files.create_dir(f"{folder}/{part}", recursive=False)
                parts.add(part)
                with files.open_output_stream(f"{folder}/{part}/{row.name}" if part else f"{folder}/{row.name}") as out:
                    out.write(bytes(row.content or b""))
        except BaseException:
            _delete(files, folder)
            raise
        return Staged(folder, sorted(parts))

    def commit(self, messages: list[Staged]) -> None:
        files, base = _open(self.path)
        done = {m.folder: m.parts for m in messages if m is not None}
        whole, moved = {}, []
        for part in sorted({p for parts in done.values() for p in parts}):
            staged = [f"{folder}/{part}".rstrip("/") for folder, parts in sorted(done.items()) if part in parts]
            if part and len(staged) == 1 and (self.overwrite or not self._there(files, f"{base}/{part}")):
                whole[part] = staged[0]
            else:
                moved += [(part, x) for folder in staged for x in _listed(files, folder)]
        again = {x.base_name for _, x in moved}
        if len(again) < len(moved):
            self.abort(messages)
            raise ValueError("two rows have one file's name")
        if self.overwrite:
            for x in _listed(files, base):
                if self.folders or x.base_name not in again:
                    files.delete_file(x.path)
            for folder in _parts(files, base):
                files.delete_dir(folder)
        for part, folder in whole.items():
            files.move(folder, f"{base}/{part}")
        for part in sorted({part for part, _ in moved if part}):
            files.create_dir(f"{base}/{part}")
        for part, x in moved:
            files.move(x.path, f"{base}/{part}/{x.base_name}" if part else f"{base}/{x.base_name}")
        files.delete_dir(f"{base}/{self.staging}")
        with files.open_output_stream(f"{base}/_SUCCESS") as out:
            out.write(str(self.folders or "").encode())

    def abort(self, messages: list[Staged | None]) -> None:
        files, base = _open(self.path)
        _delete(files, f"{base}/{self.staging}")


@dataclass
class Part(InputPartition):
    """A folder's files; some of them where names are given."""

    folder: str
    names: list[str] | None


class FileReader(DataSourceReader):
    """A task for each folder of the sink, which lists it itself, and for each thousand files that lie side by side."""

    def __init__(self, path: str, batch: int = 8 << 20):
        self.path, self.batch = path.rstrip("/"), batch

    @staticmethod
    def _names(files, folder: str) -> list[str]:
        return sorted(x.base_name for x in _listed(files, folder) if not x.base_name.startswith("."))

    def partitions(self) -> list[Part]:
        files, base = _open(self.path)
        flat = self._names(files, base)
        out = [Part(folder, None) for folder in _parts(files, base)]
        out += [Part(base, flat[lo : lo + 1000]) for lo in range(0, len(flat), 1000)]
        return out or [Part(base, [])]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        files, _ = _open(self.path)
        names = partition.names if partition.names is not None else self._names(files, partition.folder)
        held, contents, size = [], [], 0
        for name in names:
            with files.open_input_stream(f"{partition.folder}/{name}") as x:
                contents.append(x.read())
            held.append(name)
            size += len(contents[-1])
            if size >= self.batch or len(held) == 1000:
                yield self._batch(held, contents)
                held, contents, size = [], [], 0
        if held:
            yield self._batch(held, contents)

    @staticmethod
    def _batch(names: list[str], contents: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["name", "content"])


class Files(DataSource):
    """`df.write.format("files").save(folder)`: rows (name string, content binary), a file each; `spark.read.format("files").load(folder)` gives them back. Option `folders`: files lie in so many folders by the checksum of their names, and a folder moves as a whole where the file system can do so; the driver then never has a list of files."""

    @classmethod
    def name(cls) -> str:
        return "files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        if [f.name for f in schema.fields] != ["name", "content"]:
            raise ValueError("the sink takes the columns name and content")
        return FileWriter(self.options["path"], overwrite, int(self.options.get("folders", "0")))

    def reader(self, schema) -> FileReader:
        if [f.name for f in schema.fields] != ["name", "content"]:
            raise ValueError("the files have the columns name and content")
        return FileReader(self.options["path"])


def save_files(rows: DataFrame, folder: str, mode: str = "append", folders: int = 0) -> None:
    """rows: (name, content binary). With folders, a task for each of them."""
    rows.sparkSession.dataSource.register(Files)
    rows = rows.select("name", "content")
    if folders:
        rows = rows.repartitionById(folders, F.coalesce(F.pmod(F.crc32(F.encode("name", "UTF-8")), F.lit(folders)), F.lit(0)).cast("int"))
    rows.write.format("files").option("folders", folders).mode(mode).save(folder)


def load_files(spark: SparkSession, folder: str) -> DataFrame:
    """(name, content binary) of each file that save_files has written."""
    spark.dataSource.register(Files)
    return spark.read.format("files").load(folder)


# --- recorded responses


@dataclass
class Groups(InputPartition):
    """Row groups of one file."""

    path: str
    groups: list[int]


_KINDS = {"url": pa.string(), "method": pa.string(), "http_status": pa.int32(), "body": pa.string()}


class ResponseReader(DataSourceReader):
    """Takes equality, membership and prefix of the URL into the scan: they choose row groups by their statistics when the scan is planned, and rows in the tasks."""

    def __init__(self, options: dict, schema):
        self.path, self.columns = options["path"], [f.name for f in schema.fields]
        self.names = {c: options.get(c, c) for c in _KINDS}
        self.groups = int(options.get("groups", "1"))
        self.wanted: list[tuple[str, object]] = []

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            of_url = getattr(f, "attribute", None) == ("url",)
            if of_url and isinstance(f, EqualTo):
                self.wanted.append(("in", [f.value]))
            elif of_url and isinstance(f, In):
                self.wanted.append(("in", list(f.value)))
            elif of_url and isinstance(f, StringStartsWith):
                self.wanted.append(("starts", f.value))
            elif of_url and isinstance(f, IsNotNull):
                self.wanted.append(("there", None))
            else:
                yield f

    def _filter(self):
        import pyarrow.compute as pc

        url, out = pc.field(self.names["url"]), None
        for kind, value in self.wanted:
            if kind == "in":
                one = url.isin(value)
            elif kind == "starts":  # the range of the prefix is for the statistics
                one = pc.starts_with(url, value)
                if value and ord(value[-1]) < 0xD7FF:
                    one = (url >= value) & (url < value[:-1] + chr(ord(value[-1]) + 1)) & one
            else:
                one = url.is_valid()
            out = one if out is None else out & one
        return out

    def _fragments(self):
        import pyarrow.dataset as ds

        files, path = _open(self.path)
        return ds.dataset(path, filesystem=files, format="parquet").get_fragments(filter=self._filter())

    def partitions(self) -> list[Groups]:
        out = []
        for fragment in self._fragments():
            ids = [g.id for part in fragment.split_by_row_group(filter=self._filter()) for g in part.row_groups]
            out += [Groups(fragment.path, ids[lo : lo + self.groups]) for lo in range(0, len(ids), self.groups)]
        return out or [Groups("", [])]

    def read(self, partition: Groups) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        if not partition.groups:
            return
        files, _ = _open(self.path)
        fragment = ds.ParquetFileFormat().make_fragment(partition.path, filesystem=files, row_groups=partition.groups)
        there = set(fragment.physical_schema.names)
        needed = [self.names[c] for c in self.columns if self.names[c] in there]
        for batch in fragment.scanner(columns=needed or [self.names["url"]], filter=self._filter(), batch_size=1024).to_batches():
            columns = []
            for c in self.columns:
                fixed = {"method": "GET", "http_status": 200}.get(c)
                columns.append(batch.column(self.names[c]).cast(_KINDS[c]) if self.names[c] in there else pa.array([fixed] * len(batch), _KINDS[c]))
            yield pa.RecordBatch.from_arrays(columns, self.columns)


class Responses(DataSource):
    """`spark.read.format("responses")`: recorded answers in Parquet files. Options: path; url, method, http_status, body: their columns' names where they differ (an absent method is GET, an absent status 200); groups: row groups of a task. A schema of fewer columns reads no others."""

    @classmethod
    def name(cls) -> str:
        return "responses"

    def schema(self) -> str:
        return "url string, method string, http_status int, body string"

    def reader(self, schema) -> ResponseReader:
        return ResponseReader(self.options, schema)


def responses(spark: SparkSession, path: str, schema: str | None = None, **columns: str) -> DataFrame:
    """Recorded responses as a table; filters on url reach the scan."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Responses)
    reader = spark.read.format("responses").options(path=path, **columns)
    return (reader.schema(schema) if schema else reader).load()


def fetched(items: DataFrame, answers: DataFrame, method: str = "GET") -> DataFrame:
    """Items with http_status and body of their URL's answer; without one, `error` says so, and so it does for a status of 400 or more. The answers of one method only; of several for a URL the least status, then the least body."""
    one = answers.where(F.col("method") == method).groupBy("url").agg(F.min(F.struct("http_status", "body")).alias("a"))
    out = items.join(one, "url", "left").select(*items.columns, "a.http_status", "a.body")
    error = F.when(F.col("http_status").isNull(), "no answer").when(F.col("http_status") >= 400, F.concat(F.lit("HTTP "), F.col("http_status").cast("string")))
    return out.withColumn("error", error)


# --- whole files from several places


def first_files(spark: SparkSession, folder: str, places: dict[str, list[str]], missing: dict[str, str] | None = None) -> DataFrame:
    """(name, place, content): of each name the first of its places, relative to the folder, at which there is a file; else a null place and what `missing` says, or an empty text. One scan of whole files, which reads only those listed."""
    listed = [(name, place, i) for name, of_name in places.items() for i, place in enumerate(of_name)]
    wanted = spark.createDataFrame(listed, "name string, place string, i int")
    default = spark.createDataFrame([(name, (missing or {}).get(name, "")) for name in places], "name string, other string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    inner = F.regexp_extract("path", rf"{re.escape(folder.rstrip('/').rpartition('/')[2])}/(.*)$", 1)
    found = files.where(inner.isin(sorted({p for _, p, _ in listed}))).select(inner.alias("place"), F.decode("content", "UTF-8").alias("content"))
    first = wanted.join(found, "place").groupBy("name").agg(F.min(F.struct("i", "place", "content")).alias("f"))
    return default.join(first, "name", "left").select("name", "f.place", F.coalesce("f.content", "other").alias("content"))


def cv_files(spark: SparkSession, folder: str, names: list[str], inner_first: tuple[str, ...] = (), missing: dict[str, str] | None = None) -> DataFrame:
    """Documents of a CV: each in the folder itself or in its part `cv`, in this order; those of inner_first the other way round."""
    return first_files(spark, folder, {n: [f"cv/{n}", n] if n in inner_first else [n, f"cv/{n}"] for n in names}, missing)


