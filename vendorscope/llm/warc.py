"""WARC archives as a PySpark Python data source.

    spark.dataSource.register(WarcSource)
    df.write.format("warc").mode("append").option("path", folder).save()
    spark.read.format("warc").option("path", folder).load().where("record_type = 'response'")

Writing: one ``.warc.gz`` file per task (a new one every ``roll_bytes``), a gzip
member per record. A task writes under a name of its own attempt; the driver's commit
lists the files of the successful attempts in a manifest, and readers only see listed
files, so repeated and lost attempts leave nothing behind that is read. Each member has the ``sl`` extra
field of the WARC specification's annex on gzip (its compressed and plain length), so
a reader can step over a member without inflating it.

Reading: one partition per file. Equality and IN filters on ``record_type`` and on
header columns, and null checks, are taken over by the source; the reader inflates the record header first,
evaluates them, and skips the payload of every record that fails them, and of all
records if the payload isn't asked for (option ``payload`` = ``false``). Archives without a
manifest, plain ``.warc`` files and members without the extra field are read as well.

Files are reached through ``pyarrow.fs``, by the URI's scheme.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter,
                                    In, InputPartition, IsNotNull, IsNull, WriterCommitMessage)
from pyspark.sql.types import StructType

SCHEMA = ("record_id string, record_type string, target_uri string, date string, payload_digest string, "
          "refers_to string, content_length long, payload_length long, payload binary")
FIELDS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
          "date": "WARC-Date", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
NUMBERS = {"content_length": "Content-Length", "payload_length": "X-Payload-Length"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_warc_manifest-"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def member(data: bytes, level: int) -> bytes:
    """A gzip member of ``data`` with the ``sl`` extra field."""
    c = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    size = 12 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body
            + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


def one_line(value: str) -> str:
    """A header value: line breaks would end the header."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(row: dict) -> bytes:
    """The bytes of one record. A revisit has the full payload's digest and length but no payload."""
    payload = (row.get("payload") or b"") if row["record_type"] != "revisit" else b""
    head = b""
    if row["record_type"] in ("response", "revisit"):
        full = row.get("payload_length")
        head = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                f"Content-Length: {len(payload) if full is None else full}\r\n\r\n").encode()
    lines = ["WARC/1.1"]
    for col, name in FIELDS.items():
        if row.get(col) is not None:
            lines.append(f"{name}: {one_line(str(row[col]))}")
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
    if head:
        lines.append("Content-Type: application/http; msgtype=response")
    if row.get("payload_length") is not None:
        lines.append(f"{NUMBERS['payload_length']}: {row['payload_length']}")
    lines.append(f"Content-Length: {len(head) + len(payload)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + head + payload + b"\r\n\r\n"


def parse_header(text: bytes) -> dict:
    """Columns of a record header (names are case-insensitive, continuation lines are joined)."""
    found: dict[str, str] = {}
    last = None
    for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            found[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip().lower()
            found[last] = value.strip()
    row: dict = {c: found.get(n.lower()) for c, n in FIELDS.items()}
    row |= {c: int(found[n.lower()]) if found.get(n.lower(), "").isdigit() else None for c, n in NUMBERS.items()}
    row["http"] = found.get("content-type", "").lower().startswith("application/http")
    return row


class Stream:
    """Bytes of one record after another, plain or gzip member by member, inflated only as far as asked."""

    def __init__(self, file):
        self.file, self.raw, self.plain, self.z, self.next = file, b"", b"", None, None
        self.gzip = file.read(2) == b"\x1f\x8b"
        file.seek(0)

    def more(self) -> bool:
        """Append a block to ``plain``; false at the end of the record's member or the file."""
        block = self.raw or self.file.read(1 << 16)
        self.raw = b""
        if not self.gzip:
            self.plain += block
            return bool(block)
        if self.z is None or self.z.eof or not block:
            self.raw = block
            return False
        self.plain += self.z.decompress(block, 1 << 16)
        self.raw = self.z.unconsumed_tail or (self.z.unused_data if self.z.eof else b"")
        return True

    def open(self) -> bool:
        """Stand at the start of the next record."""
        if not self.gzip:
            while True:
                self.plain = self.plain.lstrip(b"\r\n")
                if self.plain:
                    return True
                if not self.more():
                    return False
        if self.next is not None:
            self.file.seek(self.next)
            self.raw = b""
        elif self.z is not None:
            while not self.z.eof:  # no length known: inflate to the end of the member
                self.plain = b""
                if not self.more():
                    break
        self.plain, self.z, self.next = b"", None, None
        at = self.file.tell() - len(self.raw)
        self.raw = self.raw or self.file.read(1 << 16)
        if not self.raw:
            return False
        if self.raw[3:4] == b"\x04" and self.raw[12:14] == b"sl" and len(self.raw) >= 24:
            self.next = at + struct.unpack("<I", self.raw[16:20])[0]
        self.z = zlib.decompressobj(31)
        return True

    def until(self, mark: bytes) -> bytes:
        """Bytes before ``mark``, which is consumed."""
        while (at := self.plain.find(mark)) < 0:
            if not self.more():
                raise ValueError("record header without an end")
        out, self.plain = self.plain[:at], self.plain[at + len(mark):]
        return out

    def take(self, n: int) -> bytes:
        parts, have = [self.plain], len(self.plain)
        while have < n:
            self.plain = b""
            if not self.more():
                raise ValueError("record is cut off")
            parts.append(self.plain)
            have += len(self.plain)
        data = b"".join(parts)
        self.plain = data[n:]
        return data[:n]

    def skip(self, n: int) -> None:
        """Step over ``n`` bytes of the record's block."""
        if self.gzip:
            self.plain = b""  # ``open`` goes to the next member
            return
        if n > len(self.plain):
            self.file.seek(self.file.tell() + n - len(self.plain))
            self.plain = b""
        else:
            self.plain = self.plain[n:]


@dataclass
class FilePart(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.options, self.columns, self.tests = options, columns, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take over what the record header decides; hand back the rest."""
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in FIELDS or name in NUMBERS:
                if isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None:
                    self.tests.append((name, "in", (f.value,)))
                    continue
                if isinstance(f, In):
                    self.tests.append((name, "in", tuple(v for v in f.value if v is not None)))
                    continue
                if isinstance(f, (IsNull, IsNotNull)):
                    self.tests.append((name, "null" if isinstance(f, IsNull) else "value", ()))
                    continue
            yield f

    def partitions(self) -> list[InputPartition]:
        fs, top = filesystem(self.options["path"])
        files = fs.get_file_info(pafs.FileSelector(top, recursive=True)) if fs.get_file_info(top).type == pafs.FileType.Directory \
            else [fs.get_file_info(top)]
        listed = []
        manifests = [f.path for f in files if f.base_name.startswith(MANIFEST)]
        for m in manifests:
            with fs.open_input_stream(m) as s:
                listed += [f"{top.rstrip('/')}/{x}" for x in json.loads(s.read())]
        if not manifests:
            listed = [f.path for f in files if f.type == pafs.FileType.File and f.path.endswith((".warc", ".warc.gz"))]
        return [FilePart(p) for p in sorted(listed)]

    def passes(self, row: dict) -> bool:
        for name, kind, values in self.tests:
            v = row[name]
            if kind == "null" and v is not None or kind == "value" and v is None or kind == "in" and v not in values:
                return False
        return True

    def read(self, partition: FilePart | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark's stand-in for a folder without archives
            return
        fs, _ = filesystem(self.options["path"])
        wanted = str(self.options.get("payload", "true")).lower() != "false"
        schema = pa.schema([(c, pa.int64() if c in NUMBERS else pa.binary() if c == "payload" else pa.string())
                            for c in self.columns])
        out, held = [], 0
        with fs.open_input_file(partition.path) as file:
            s = Stream(file)
            while s.open():
                row = parse_header(s.until(b"\r\n\r\n"))
                size = row["content_length"] or 0
                if not self.passes(row) or not wanted:
                    s.skip(size)
                    row["payload"] = None
                    if not self.passes(row):
                        continue
                else:
                    block = s.take(size)
                    row["payload"] = block.split(b"\r\n\r\n", 1)[-1] if row["http"] else block
                    held += size
                out.append(row)
                if len(out) >= 1000 or held > 8 << 20:
                    yield pa.RecordBatch.from_pylist([{c: r[c] for c in self.columns} for r in out], schema=schema)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist([{c: r[c] for c in self.columns} for r in out], schema=schema)


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.level = options["path"], int(options.get("level", "4"))
        self.roll = int(options.get("roll_bytes", str(64 << 20)))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, top = filesystem(self.path)
        fs.create_dir(top, recursive=True)
        names, out = [], None
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out = fs.open_output_stream(f"{top.rstrip('/')}/{names[-1]}", compression=None)
                out.write(member(record(row), self.level))
                if out.tell() >= self.roll:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        fs, top = filesystem(self.path)
        fs.create_dir(top, recursive=True)
        names = [n for m in messages if m for n in m.files]
        with fs.open_output_stream(f"{top.rstrip('/')}/{MANIFEST}{uuid.uuid4().hex}", compression=None) as s:
            s.write(json.dumps(names).encode())

    def abort(self, messages: list[Written | None]) -> None:
        fs, top = filesystem(self.path)
        for m in messages:
            for n in m.files if m else []:
                fs.delete_file(f"{top.rstrip('/')}/{n}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options), schema.fieldNames())

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only added to: mode('append')")
        return WarcWriter(dict(self.options))
