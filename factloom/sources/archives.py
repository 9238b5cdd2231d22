"""Archives of tagged documents: members of ZIP files as a data source, validation, a sink, and create-only storage of raw files.

A partition is several small archives, whose directories its task reads, or a run of members of a large one. Of a large archive the
central directory is read while partitions are planned, piece by piece, and what is planned is where a run's piece of it lies: many
tasks read such an archive, each from its own ranges of bytes. No row holds more than a member, and no member's name is in a plan.
What can't be read is a row with an error: an archive without a directory, a member whose bytes don't give its checksum.
"""

from __future__ import annotations

import hashlib
import io
import struct
import sys
import zipfile
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as stores
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.exprs import document_key, stable_rank
from ..schemas import MAX_BYTES
from . import tables

MEMBERS = "source_key string, place long, member_name string, byte_count long, content binary, error string"
PARTITION_BYTES = 16_000_000
BATCH_BYTES = 4_000_000
DIRECTORIES = 16  # read at a time while partitions are planned
TASKS_PER_CORE = 4  # at least, as long as there are archives enough
LOCAL_HEADER = 30  # fixed value: bytes of a member's own header before its name
#: The end of a directory (its last record, with that of large archives before it) and a member's record in it.
END, END64, ENTRY, ENTRY_MARK = "<4s4H2LH", "<4sQ2H2L4Q", 46, b"PK\x01\x02"
END_BYTES, END64_BYTES, LOCATOR64_BYTES, MOST_COMMENT = 22, 56, 20, 65_535
PIECE = 1 << 20  # bytes of a directory that are read at a time


UNREADABLE = (zipfile.BadZipFile, NotImplementedError, ValueError, OSError)  # what an archive without a good directory raises


def _open(path: str):
    """(file system, path there) of a URI or a local path."""
    store, inner = stores.FileSystem.from_uri(path if ":/" in path else f"file://{path}")
    return store, inner


def _listed(path: str, name: str | None) -> list[tuple[str, int]]:
    """(path with its scheme, size) of the ZIP files at a path: one file, or those of a folder."""
    store, inner = _open(path)
    info = store.get_file_info(inner)
    found = [info] if info.type == stores.FileType.File else store.get_file_info(stores.FileSelector(inner, recursive=True))
    scheme = path.partition(":/")[0] + "://" if ":/" in path else "file://"
    zips = [f for f in found if f.type == stores.FileType.File and f.base_name.endswith(".zip") and name in (None, f.base_name)]
    return sorted((scheme + f.path, f.size) for f in zips)


@dataclass
class Part:
    """A whole archive, or a piece of its directory: begin and end there, the place of its first member, and how far the archive lies
    from the beginning of its file."""

    path: str
    key: str
    begin: int | None = None
    end: int = 0
    place: int = 0
    shift: int = 0
    error: str | None = None

    def members(self) -> list[tuple]:
        """(place, name, offset, compressed size, size, checksum, method, flags) of each member but folders, in the order of their bytes."""
        if self.begin is None:
            return directory(self.path)
        store, inner = _open(self.path)
        with store.open_input_file(inner) as f:
            f.seek(self.begin)
            return _entries(io.BytesIO(_alone(f.read(self.end - self.begin))), self.place, self.shift)


@dataclass
class Run(InputPartition):
    parts: list[Part]


def _entries(f, place: int = 0, shift: int = 0) -> list[tuple]:
    with zipfile.ZipFile(f) as z:
        entries = [(i, m.filename, m.header_offset + shift, m.compress_size, m.file_size, m.CRC, m.compress_type, m.flag_bits) for i, m in enumerate(z.infolist(), place) if not m.is_dir()]
    return sorted(entries, key=lambda m: m[2])


def _alone(records: bytes) -> bytes:
    """A piece of a directory as the directory of an archive without bytes of its own."""
    end = struct.pack(END, b"PK\x05\x06", 0, 0, 0, 0, len(records), 0, 0)
    return records + end


def directory(path: str) -> list[tuple]:
    """What the central directory says of each member but folders, in the order of their bytes."""
    store, inner = _open(path)
    with store.open_input_file(inner) as f:
        return _entries(f)


def _directory_place(f) -> tuple[int, int, int]:
    """Where the central directory begins and ends, and how far the archive lies from the beginning of its file."""
    size = f.size()
    f.seek(max(0, size - END_BYTES - MOST_COMMENT))
    tail = f.read()
    last = tail.rfind(b"PK\x05\x06", 0, len(tail) - END_BYTES + 4)
    if last < 0:
        raise zipfile.BadZipFile("File is not a zip file")
    _, _, _, _, _, length, offset, _ = struct.unpack_from(END, tail, last)
    end = size - len(tail) + last
    if end >= LOCATOR64_BYTES + END64_BYTES:
        f.seek(end - LOCATOR64_BYTES - END64_BYTES)
        large, locator = f.read(END64_BYTES), f.read(4)
        if locator == b"PK\x06\x07" and large[:4] == b"PK\x06\x06":
            length, offset = struct.unpack(END64, large)[-2:]
            end -= LOCATOR64_BYTES + END64_BYTES
    if end - length < 0 or end - length - offset < 0:
        raise zipfile.BadZipFile("Bad offset for central directory")
    return end - length, end, end - length - offset


def _pieces(path: str, key: str, most: int) -> Iterator[Part]:
    """The parts of a large archive: runs of records of its directory whose members have about `most` compressed bytes."""
    store, inner = _open(path)
    with store.open_input_file(inner) as f:
        begin, end, shift = _directory_place(f)
        at, held, place, first, data, to, piece = begin, 0, 0, 0, b"", 0, b""
        f.seek(begin)
        while at < end:
            if len(data) - to < ENTRY or len(data) - to < ENTRY + sum(struct.unpack_from("<3H", data, to + 28)):
                more = f.read(min(PIECE, end - at - (len(data) - to)))
                if not more:
                    raise zipfile.BadZipFile("Truncated central directory")
                piece += data[:to]
                data, to = data[to:] + more, 0
                continue
            if data[to : to + 4] != ENTRY_MARK:
                raise zipfile.BadZipFile("Bad magic number for central directory")
            compressed = struct.unpack_from("<L", data, to + 20)[0]
            if place > first and held + compressed > most:
                piece += data[:to]
                _entries(io.BytesIO(_alone(piece)))  # what can't be read is the whole archive's error
                yield Part(path, key, begin, at, first, shift)
                data, to, piece, begin, first, held = data[to:], 0, b"", at, place, 0
            record = ENTRY + sum(struct.unpack_from("<3H", data, to + 28))
            to, at, place, held = to + record, at + record, place + 1, held + compressed
        _entries(io.BytesIO(_alone(piece + data[:to])))
        yield Part(path, key, begin, at, first, shift)


def parts(path: str, size: int, most: int, limit: int) -> list[Part]:
    key = path.rpartition("/")[2]
    if size > limit:
        return [Part(path, key, error="Truncated: larger than the limit")]
    if size <= most:
        return [Part(path, key)]
    try:
        return list(_pieces(path, key, most))
    except UNREADABLE as e:
        return [Part(path, key, error=str(e) or type(e).__name__)]


def read_member(f, member: tuple) -> tuple[bytes | None, str | None]:
    """(content, error) of one member, from its own range of bytes."""
    _, name, offset, compressed, size, crc, method, flags = member
    if flags & 1 or method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        return None, f"Unsupported: {name}"
    try:
        f.seek(offset)
        name_bytes, extra_bytes = struct.unpack("<HH", f.read(LOCAL_HEADER)[26:30])
        f.seek(offset + LOCAL_HEADER + name_bytes + extra_bytes)
        data = f.read(compressed)
        if method == zipfile.ZIP_DEFLATED:
            data = zlib.decompressobj(-15).decompress(data, size + 1)
    except (struct.error, zlib.error, OSError) as e:
        return None, f"Truncated: {name}: {e}"
    return (data, None) if len(data) == size and zlib.crc32(data) == crc else (None, f"Truncated: {name}")


class ZipReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.name = options.get("sourcekey")
        self.content = options.get("content", "true").lower() == "true"
        self.most, self.limit = int(options.get("partitionbytes", PARTITION_BYTES)), int(options.get("maxbytes", MAX_BYTES))
        self.least = int(options.get("partitions", 1))

    def partitions(self) -> list[Run]:
        files = _listed(self.path, self.name)
        # Small archives share a partition, as long as there are partitions enough.
        share = min(self.most, sum(size for _, size in files) // self.least)
        out, held = [], self.most
        with ThreadPoolExecutor(DIRECTORIES) as pool:
            for (_, size), found in zip(files, pool.map(lambda f: parts(*f, self.most, self.limit), files), strict=True):
                if len(found) > 1 or held + size > share:
                    out += [Run([p]) for p in found]
                    held = size if len(found) == 1 else self.most
                else:
                    out[-1].parts += found
                    held += size
        return out or [Run([])]

    def read(self, run: Run) -> Iterator[pa.RecordBatch]:
        for part in run.parts:
            try:
                if part.error is not None:
                    raise ValueError(part.error)
                members = part.members()
            except UNREADABLE as e:
                yield _batch([(part.key, None, None, None, None, str(e) or type(e).__name__)])
                continue
            if self.content:
                yield from self.contents(part, members)
            elif members:
                yield _batch([(part.key, m[0], m[1], m[4], None, None) for m in members])

    def contents(self, part: Part, members: list[tuple]) -> Iterator[pa.RecordBatch]:
        store, inner = _open(part.path)
        rows, held = [], 0
        with store.open_input_file(inner) as f:
            for m in members:
                data, error = read_member(f, m)
                rows.append((part.key, m[0], m[1], m[4], data, error))
                held += len(data or b"")
                if held >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"source_key": pa.string(), "place": pa.int64(), "member_name": pa.string(), "byte_count": pa.int64(), "content": pa.binary(), "error": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))


class ZipMembers(DataSource):
    """spark.read.format("zipmembers").load(path): options sourceKey (one archive), content (false: names alone), partitionBytes, partitions (at least), maxBytes."""

    @classmethod
    def name(cls) -> str:
        return "zipmembers"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> ZipReader:
        return ZipReader({k.lower(): v for k, v in self.options.items()})


def members(spark: SparkSession, path: str, source_key: str | None = None, with_content: bool = True, partition_bytes: int = PARTITION_BYTES, max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row a member, folders left out; an archive or a member that can't be read is a row with an error.

    `place` is the member's place in the archive's directory.
    """
    spark.dataSource.register(ZipMembers)
    r = spark.read.format("zipmembers").option("content", str(with_content).lower()).option("partitionBytes", partition_bytes).option("maxBytes", max_bytes)
    r = r.option("partitions", TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    return (r if source_key is None else r.option("sourceKey", source_key)).load(path)


def validated(spark: SparkSession, path: str, source_key: str | None = None, max_bytes: int = MAX_BYTES, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """source_key, members (count, null if the archive can't be read), error: the first that can't be read, if any; the checksums of
    all members are tested, run by run."""
    m = members(spark, path, source_key, partition_bytes=partition_bytes, max_bytes=max_bytes)
    first = F.min_by("error", F.when(F.col("error").isNotNull(), F.coalesce("place", F.lit(-1))))
    return m.groupBy("source_key").agg(F.nullif(F.count("place"), F.lit(0)).alias("members"), first.alias("error"))


def write_archives(rows: DataFrame, path: str) -> DataFrame:
    """Writes (source_key, member_name, content) as ZIP files under a path that all executors share, each in the task that its key is
    dealt to, member by member in the order of their names; source_key and members of what was written, when it is read."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        store, inner = _open(path)
        store.create_dir(inner, recursive=True)
        key = aside = z = raw = None
        done: list[tuple[str, int]] = []

        def close() -> None:
            done.append((key, len(z.infolist())))
            z.close()
            raw.close()
            store.move(aside, f"{inner}/{key}")  # a task that is run again writes the same members

        for batch in batches:
            for k, name, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if z is not None:
                        close()
                    key, aside = k, f"{inner}/{k}.{uuid.uuid4().hex}"
                    raw = store.open_output_stream(aside)
                    z = zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED)
                z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), data, zipfile.ZIP_DEFLATED)
        if z is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())], names=["source_key", "members"])

    dealt = rows.select("source_key", "member_name", "content").repartition("source_key").sortWithinPartitions("source_key", "member_name")
    return dealt.mapInArrow(write, "source_key string, members long")


def select_members(names: DataFrame, cap: int) -> DataFrame:
    """Of the members of one archive: the first `cap` documents by the rank of their id, which only grow with the cap,
    and the first `cap` names that are no document's, by name."""
    k = document_key(F.col("member_name"))
    keyed = names.select("*", *[c.alias(n) for n, c in k.items()])
    known = keyed.where("document_id is not null").orderBy(stable_rank(F.col("document_id")), "member_name").limit(cap)
    unknown = keyed.where("document_id is null").orderBy("member_name").limit(cap)
    return known.unionByName(unknown)


def store_once(spark: SparkSession, root: str, source_key: str, local: str) -> tuple[bool, str]:
    """Create-only copy of a fetched file into the raw store: (written, sha256 of what is there). An existing one is never replaced.

    The bytes go to a place of their own first; the source's manifest then names the place, if no other fetch was there before.
    """
    digest = hashlib.sha256()
    with open(local, "rb") as f:
        while part := f.read(1 << 20):
            digest.update(part)
    there = tables.manifest(spark, root, "raw", source_key)
    if there is None:
        place = tables.new_place(root, "raw", f"/{source_key}")
        tables.copy_in(spark, local, place)
        if tables.commit(spark, root, "raw", source_key, {"place": place, "sha256": digest.hexdigest()}):
            return True, digest.hexdigest()
        tables.remove(spark, place.rpartition("/")[0])
        there = tables.manifest(spark, root, "raw", source_key)
    return False, there["sha256"]


def raw_place(spark: SparkSession, root: str, source_key: str) -> str | None:
    """Where the raw store holds a source's archive."""
    there = tables.manifest(spark, root, "raw", source_key)
    return there and there["place"]


def ingest_status(written: bool, stored: str, fetched: str, recorded: bool) -> str:
    """The ledger status of one fetched archive: what exists unrecorded is repaired if its hash is the same."""
    if written or (not recorded and stored == fetched):
        return "succeeded"
    return "skipped_existing" if stored == fetched else "failed"


# Spark starts Python processes beside the driver for this, which do not have the files that are sent to executors: what they need
# is sent by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
