"""WARC archives by way of a chunked record table.

Writing: a page is a row for each chunk of its payload, and a task streams its
rows into gzip members, one to a record, never holding more than a chunk.
Reading: each task streams a stretch of an archive into rows (record, chunk
number, bytes, digest so far); the digest of a record is that of its last chunk,
so no record is ever whole in memory. A payload that occurs again is written as a
revisit of the record that keeps it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fits, materialize, shared_dir

#: Bytes of payload in a row; an Arrow batch of rows stays small.
CHUNK = 1 << 14
#: Payload bytes from which equal ones are written once.
LEAST_BYTES = 1000
#: Bytes after which a stretch (what one task reads) and an archive end.
STRETCH, ARCHIVE = 32 << 20, 1 << 30
READ = 1 << 18
#: Tasks that stretches are dealt over at most; beyond them a task reads several, one after the other.
MOST_TASKS = 20_000


def plan(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """pages, __payload (binary), __bytes, __digest (SHA-1, hex), __to (the page that a revisit refers to, else null).

    Digests that repeat are broadcast to the pages if their bytes are few. If not,
    digests and ids alone are joined, whatever one digest's share, and a revisit
    finds its page by its own id: no task gets the payloads of one digest.
    """
    rows = pages.withColumn("__payload", F.coalesce(F.col(payload_col), F.lit("")).cast("binary"))
    rows = rows.withColumns({"__bytes": F.octet_length("__payload").cast("long"), "__digest": F.sha1("__payload")})
    large = rows.where(F.col("__bytes") >= least_bytes)
    many = materialize(large.groupBy(F.col("__digest").alias("__d")).agg(F.count("*").alias("__n"), F.max(id_col).alias("__max")).where("__n > 1").select("__d", "__max"), "payloads")
    keeps = F.col("__max").isNull() | F.col(id_col).eqNullSafe(F.col("__max"))
    if fits(many):
        rows = rows.join(F.broadcast(many), F.col("__digest") == F.col("__d"), "left")
        return rows.withColumn("__to", F.when(~keeps, F.col("__max"))).drop("__d", "__max")
    own = F.concat_ws("|", "__digest", F.col(id_col).cast("string"))  # a null id leaves the digest alone
    narrow = large.select(F.col(id_col), F.col("__digest").alias("__d"), own.alias("__own")).distinct().join(many, "__d")
    again = materialize(narrow.where(~keeps).select("__own", F.col("__max").alias("__to")), "revisits")
    return rows.withColumn("__key", own).join(again, F.col("__key") == F.col("__own"), "left").drop("__key", "__own")


def chunks(planned: DataFrame, id_col: str = "page_id", url_col: str = "url", chunk: int = CHUNK) -> DataFrame:
    """id, url, bytes, digest, to, i, data: a row for each chunk to be written, of a revisit one without data."""
    kept = F.when(F.col("__to").isNull(), F.col("__bytes")).otherwise(F.lit(0))
    return planned.select(
        F.col(id_col).cast("string").alias("id"), F.col(url_col).alias("url"), F.col("__bytes").alias("bytes"), F.col("__digest").alias("digest"), F.col("__to").cast("string").alias("to"),
        "__payload", F.explode(F.sequence(F.lit(0), F.greatest(F.floor((kept - 1) / chunk), F.lit(0)).cast("int"))).alias("i"),
    ).select("id", "url", "bytes", "digest", "to", "i", F.when(F.col("to").isNull(), F.substring("__payload", F.col("i") * chunk + 1, F.lit(chunk))).alias("data"))


def _urn(page: str | None) -> str:
    """A record's name; a null id has one of its own."""
    return "<urn:page>" if pd.isna(page) else f"<urn:page:{quote(page)}>"


def _head(row, kind: str) -> bytes:
    """The WARC header block of a record, and of a response the HTTP header with it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    length = len(http) + (int(row.bytes) if kind == "response" else 0)
    url = "".join(c for c in (row.url or "") if c >= " ") or "urn:page"
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(row.id)}", f"WARC-Target-URI: {url}", "WARC-Date: 2000-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(row.digest)).decode()}", f"X-Payload-Length: {int(row.bytes)}",
    ]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(row.to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}", "", ""]
    return "\r\n".join(lines).encode() + http


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """path, start, end of each stretch of the archives written to folder (any file system that pyarrow opens).

    A task that runs again writes archives of new names; only those named in the result count.
    """

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, name, done, member, size = None, "", [], None, 0

        def close_member():
            nonlocal member, size
            if member is not None:
                tail = member.compress(b"\r\n\r\n") + member.flush()
                out.write(tail)
                size += len(tail)
                member = None

        for frame in frames:
            for row in frame.itertuples(index=False):
                if row.i == 0:
                    close_member()
                    if out is not None and size - done[-1] >= STRETCH:
                        done.append(size)
                    if out is not None and size >= ARCHIVE:
                        out.close()
                        yield pd.DataFrame({"path": name, "start": done[:-1], "end": done[1:]}) if done[-1] == size else pd.DataFrame({"path": name, "start": done, "end": [*done[1:], size]})
                        out = None
                    if out is None:
                        name, size, done = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, [0]
                        out = store.open_output_stream(name, compression=None)
                    member = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = member.compress(_head(row, "response" if pd.isna(row.to) else "revisit"))
                    out.write(data)
                    size += len(data)
                if row.data is not None:
                    data = member.compress(row.data)
                    out.write(data)
                    size += len(data)
        if out is not None:
            close_member()
            out.close()
            done = done if done[-1] < size else done[:-1]
            yield pd.DataFrame({"path": name, "start": done, "end": [*done[1:], size]})

    return materialize(rows.mapInPandas(write, "path string, start long, end long"), "archives")


def _records(stream, length: int) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """Header fields and payload pieces of each gzip member in the next length bytes."""
    left, waiting = length, b""

    def more() -> bytes:
        nonlocal left
        data = stream.read(min(READ, left))
        left -= len(data)
        return data

    while waiting or left:
        unpack = zlib.decompressobj(31)
        buffer = b""

        def more_of_it() -> bytes:
            data = pull()
            if not data:
                raise EOFError("a record is shorter than its header says")
            return data

        def pull() -> bytes:
            """Some bytes of this member; nothing at its end."""
            nonlocal waiting
            while not unpack.eof:
                data = unpack.unconsumed_tail or waiting or more()
                if not data:
                    raise EOFError("an archive ends within a record")
                waiting = b""
                piece = unpack.decompress(data, READ)
                if unpack.eof:
                    waiting = unpack.unused_data
                if piece:
                    return piece
            return b""

        while b"\r\n\r\n" not in buffer:
            buffer += more_of_it()
        head, _, buffer = buffer.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:])
        rest = int(fields["Content-Length"])

        def payload(buffer: bytes, rest: int) -> Iterator[bytes]:
            while b"\r\n\r\n" not in buffer:
                buffer += more_of_it()
            http, _, buffer = buffer.partition(b"\r\n\r\n")
            rest -= len(http) + 4
            while rest:
                buffer = buffer or more_of_it()
                piece, buffer = buffer[:rest], buffer[rest:]
                rest -= len(piece)
                yield piece
            if buffer not in (b"", b"\r\n\r\n"[: len(buffer)]):
                raise ValueError("a record is longer than its header says")

        pieces = payload(buffer, rest)
        yield fields, pieces
        for _ in pieces:
            pass
        while pull():
            pass


def read_chunks(stretches: DataFrame, folder: str, with_data: bool = False, chunk: int = CHUNK) -> DataFrame:
    """The record table: record (path:number), id, url, kind, to, named (digest in the header), length (of the payload,
    from the header), i, bytes, data (null unless with_data), digest (SHA-1 of the chunks up to this one)."""
    schema = "record string, id string, url string, kind string, to string, named string, length long, i long, bytes long, data binary, digest string"
    names = [x.split()[0] for x in schema.split(", ")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = fs.FileSystem.from_uri(folder)
        rows, held = [], 0
        for frame in frames:
            for part in frame.itertuples(index=False):
                with store.open_input_file(part.path) as stream:
                    stream.seek(part.start)
                    for n, (fields, pieces) in enumerate(_records(stream, part.end - part.start)):
                        page = lambda name, fields=fields: unquote(fields[name][10:-1]) if fields.get(name, "").startswith("<urn:page:") else None
                        fixed = (f"{part.path}:{part.start}:{n}", page("WARC-Record-ID"), fields["WARC-Target-URI"], fields["WARC-Type"], page("WARC-Refers-To"), base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex(), int(fields["X-Payload-Length"]))
                        sha, data, i = hashlib.sha1(), b"", 0
                        for piece in pieces:
                            data += piece
                            while len(data) >= chunk:
                                sha.update(data[:chunk])
                                rows.append((*fixed, i, chunk, data[:chunk] if with_data else None, sha.hexdigest()))
                                data, i, held = data[chunk:], i + 1, held + chunk * with_data
                        if data or not i:
                            sha.update(data)
                            rows.append((*fixed, i, len(data), data if with_data else None, sha.hexdigest()))
                            held += len(data) * with_data
                        if len(rows) >= 5000 or held >= 1 << 24:
                            yield pd.DataFrame(rows, columns=names)
                            rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names)

    # a number given keeps each stretch a task of its own, or a few of the very many
    parts = max(1, min(stretches.count(), MOST_TASKS))
    return stretches.repartition(parts, "path", "start").mapInPandas(read, schema)


def records(table: DataFrame) -> DataFrame:
    """id, url, kind, to, payload_bytes, payload_digest of each record; fails on one whose payload isn't what its header names."""
    last = F.max(F.struct("i", "digest"))["digest"]
    whole = table.groupBy("record", "id", "url", "kind", "to", "named", "length").agg(F.sum("bytes").alias("read"), last.alias("digest"))
    sound = (F.col("kind") == "revisit") | ((F.col("named") == F.col("digest")) & (F.col("length") == F.col("read")))
    checked = F.when(sound, F.col("named")).otherwise(F.raise_error(F.concat(F.lit("payload of "), "record", F.lit(" is damaged"))))
    return whole.select("id", "url", "kind", "to", F.col("length").alias("payload_bytes"), checked.alias("payload_digest"))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes pages as archives in the shared folder, reads them back: records() of what is there.

    A null payload is empty and a null id null again; of rows that repeat an id and
    a kept payload each is a response, of equal payloads that of the largest id; a
    payload of any length passes in chunks; an empty table gives no archive and no
    rows. A damaged archive fails the read.
    """
    folder = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    stretches = write_archives(chunks(plan(pages, id_col, payload_col), id_col, url_col), folder)
    kind = pages.schema[id_col].dataType
    found = records(read_chunks(stretches, folder))
    return found.select(F.col("id").cast(kind).alias(id_col), "url", F.col("kind").alias("record_type"), F.col("to").cast(kind).alias("refers_to"), "payload_bytes", "payload_digest")
