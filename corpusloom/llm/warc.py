"""Deterministic WARC archives: sorted records, files rolled by compressed size, committed through temporary names and a manifest.

Each record is one gzip member with a header that is made anew.  Records are range-sorted by page_id; the global running
sum of compressed sizes decides a record's file, so the files depend on the rows alone, not on how they were partitioned.
Files are written by Spark's own writers into a folder with a temporary name; its manifest is written last, and only then does the
folder get its name.  Nothing is opened by a local path, so any store that Spark reaches will do.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.rows import column, in_arrow, materialize

FILE_BYTES = 16_000_000  # compressed, of an archive file; a larger record is a file of its own
DATE = "2020-01-01T00:00:00Z"  # given, not the clock: equal rows give equal files
_NAMES = uuid.UUID("8b1d6c1e-7a58-4f6d-9c39-2f0f6f4f5a11")
GROUPS = 20_000  # of neighbouring files, at most; their first records are known to every task
_PIECE = 1 << 14
_AT_ONCE = 4_000_000  # bytes of records that are handed on together
_KEY = ["page_id", "url", "sha", "length", "nth"]
_KEY_TYPES = "page_id long, url string, sha string, length long, nth long"
REVISIT = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, url: str, nth: int) -> str:
    """The same for the same row; nth counts repeats of a row."""
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id} {nth} {url}')}>"


def record(page_id: int | None, url: str, nth: int, length: int, sha: str, payload: bytes | None, target: tuple[int | None, str] | None) -> bytes:
    """A whole record: a response with its payload, or without one a revisit of the page and address in ``target``."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    block = http + (payload or b"")
    uri = "".join(c for c in url if c > " ") or "urn:none"
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"revisit" if target else b"response"),
        b"WARC-Record-ID: " + record_id(page_id, url, nth).encode(),
        b"WARC-Date: " + DATE.encode(),
        b"WARC-Target-URI: " + uri.encode(),
        b"WARC-Payload-Digest: sha1:" + sha.encode(),
        b"WARC-Block-Digest: sha1:" + digest(block).encode(),
        b"X-Page-ID: " + _number(page_id),
        b"X-Payload-Length: %d" % length,
    ]
    if target:
        head += [b"WARC-Profile: " + REVISIT, b"WARC-Refers-To: " + record_id(*target, 0).encode(), b"X-Refers-To-Page: " + _number(target[0])]
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _number(page_id: int | None) -> bytes:
    return b"" if page_id is None else b"%d" % page_id


def _packed(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def member(data: bytes) -> bytes:
    """``data`` as one gzip member whose last byte is 0: the top byte of the size, for records below 16 MiB.

    A larger record is followed by an empty member, which readers skip.
    """
    out = _packed(data)
    return out if out.endswith(b"\0") else out + _packed(b"")


def _sizes(pages: DataFrame) -> DataFrame:
    """(page_id, url, sha, length, size, copies): the different rows, with the compressed size of their response records."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas, sizes = [], []
            for page_id, url, payload in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), batch.column("payload"), strict=True):
                payload = payload.as_py()
                shas.append(digest(payload))
                sizes.append(len(member(record(page_id, url, 0, len(payload), shas[-1], payload, None))))
            arrays = [batch.column("page_id"), batch.column("url"), pa.array(shas, pa.string()), batch.column("length"), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "sha", "length", "size"])

    sized = in_arrow(pages, step, "page_id long, url string, sha string, length long, size long")
    return materialize(sized.groupBy("page_id", "url", "sha", "length", "size").agg(F.count("*").alias("copies")), "sizes")


def _roles(sizes: DataFrame, least: int) -> DataFrame:
    """``sizes`` with one row per record: nth, response, and target (page_id, url) of a revisit.

    Of equal payloads of at least ``least`` bytes the first by (page_id, url), null ids last, is the response.
    """
    order = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "url")
    shared = sizes.filter(F.col("length") >= least).groupBy("sha").agg(F.min(order).alias("first"), F.sum("copies").alias("rows"))
    shared = shared.filter("rows > 1").select("sha", "first")
    nth = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("nth")
    rows = sizes.join(shared, "sha", "left").select("page_id", "url", "sha", "length", "size", "first", nth)
    own = F.col("page_id").eqNullSafe(F.col("first.page_id")) & (F.col("url") == F.col("first.url")) & (F.col("nth") == 0)
    response = F.col("first").isNull() | own
    return rows.select("page_id", "url", "sha", "length", "size", "nth", response.alias("response"), F.when(~response, F.struct("first.page_id", "first.url")).alias("target"))


def _revisits(rows: DataFrame) -> DataFrame:
    """``rows`` (revisits) with their compressed records ``gz`` and sizes; they need no payload."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                target = (r["target"]["page_id"], r["target"]["url"])
                out.append(member(record(r["page_id"], r["url"], r["nth"], r["length"], r["sha"], None, target)))
            kept = [batch.column(c) for c in _KEY]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(map(len, out), pa.int64()), pa.array(out, pa.binary())], names=[*_KEY, "size", "gz"])

    return in_arrow(rows.select(*_KEY, "target"), step, _KEY_TYPES + ", size long, gz binary")


def _key(page_id: int | None, url: str, sha: str, nth: int) -> tuple:
    """A record's place in the order, comparable like the sorted rows: null ids last, texts by their bytes."""
    return (page_id is None, page_id or 0, url.encode(), sha, nth)


def _with_groups(pages: DataFrame, starts: list[tuple]) -> DataFrame:
    """(page_id, url, sha, length, payload, group): pages in the group of files that their record belongs to.

    ``starts`` are the keys of the groups' first records.  A page goes to several groups only if repeats of it do.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, groups, shas = [], [], []
            for i, (page_id, url, payload) in enumerate(zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), batch.column("payload"), strict=True)):
                sha = digest(payload.as_py())
                first = bisect_right(starts, _key(page_id, url, sha, 0)) - 1
                for group in range(first, bisect_right(starts, _key(page_id, url, sha, 1 << 62))):
                    rows.append(i)
                    groups.append(group)
                    shas.append(sha)
            taken = batch.take(pa.array(rows, pa.int64()))
            arrays = [taken.column("page_id"), taken.column("url"), pa.array(shas, pa.string()), taken.column("length"), taken.column("payload"), pa.array(groups, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "sha", "length", "payload", "group"])

    return in_arrow(pages, step, "page_id long, url string, sha string, length long, payload binary, group int")


def _merged(rows: DataFrame) -> DataFrame:
    """(file, place, gz) from sorted rows, in which a page with its payload (file is null) precedes the records that need it."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, payload, done = None, None, 0
        names = ["file", "place", "gz"]
        for batch in batches:
            files, out, size = [], [], 0
            ids, urls, shas, nths, places = (batch.column(c).to_pylist() for c in ("page_id", "url", "sha", "nth", "file"))
            for i, key in enumerate(zip(ids, urls, shas, strict=True)):
                if places[i] is None:
                    if key != held:
                        held, payload = key, batch.column("payload")[i].as_py()
                    continue
                gz = batch.column("gz")[i].as_py()
                if gz is None:
                    if key != held:
                        raise ValueError(f"no payload for the record of page {key[0]}")
                    gz = member(record(key[0], key[1], nths[i], len(payload), key[2], payload, None))
                files.append(places[i])
                out.append(gz)
                size += len(gz)
                if size > _AT_ONCE:
                    yield pa.RecordBatch.from_arrays([pa.array(files, pa.int64()), pa.array(range(done, done + len(out)), pa.int64()), pa.array(out, pa.binary())], names=names)
                    done += len(out)
                    files, out, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.int64()), pa.array(range(done, done + len(out)), pa.int64()), pa.array(out, pa.binary())], names=names)
            done += len(out)

    return in_arrow(rows, step, "file long, place long, gz binary")


def _files(rows: DataFrame, file_bytes: int) -> DataFrame:
    """``rows`` with file: a record's file is where its first byte falls on a line of all records, cut every ``file_bytes``."""
    order = ["unknown", "page_id", "url", "sha", "nth"]
    ranged = rows.withColumn("unknown", F.col("page_id").isNull()).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = materialize(ranged.withColumn("part", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per partition
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes")).select("part", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"))
    placed = ranged.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(totals, "part")
    place = F.col("bytes_before") + F.col("inside")
    return placed.withColumn("file", F.floor(place / file_bytes).cast("long")).drop("part", "inside", "bytes_before", "unknown")


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, least: int = 0) -> None:
    """Write a WARC record per row of ``pages`` (page_id, url, html) below ``folder``, which must not exist.

    Payloads are html in UTF-8, null counts as empty; a null url as none.  Of equal payloads of at least ``least`` bytes the first row by page_id (null last), then url, is a
    response and the others, repeated rows included, revisit it; smaller payloads are all responses.  Records
    are sorted by page_id, url and digest; a record belongs to the file in which its first byte falls when the sorted
    records are cut every ``file_bytes`` compressed bytes, so a file exceeds that by less than one record.  Equal rows give equal
    files.  An empty table gives an empty archive with a manifest.  Other columns are ignored.

    The files appear under a temporary name next to ``folder``, the manifest (file, records, bytes) after them, and then the
    name is changed; a folder of the final name is therefore whole.
    """
    spark = pages.sparkSession
    html = F.coalesce(column("html"), F.lit(""))
    rows = pages.select(column("page_id").cast("long").alias("page_id"), F.coalesce(column("url"), F.lit("")).alias("url"), html.cast("binary").alias("payload"), F.octet_length(html).cast("long").alias("length"))
    roles = materialize(_roles(_sizes(rows), least), "roles")
    revisits = _revisits(roles.filter("NOT response"))
    responses = roles.filter("response").select(*_KEY, "size", F.lit(None).cast("binary").alias("gz"))
    files = materialize(_files(responses.union(revisits), file_bytes), "files")

    # Groups of neighbouring files: a page knows its group from the groups' first records, so it moves once, and
    # the task of a group has whole files.
    n_files = (files.agg(F.max("file")).first()[0] or 0) + 1
    group = F.floor(F.col("file") / -(-n_files // GROUPS)).cast("int").alias("group")
    unknown = F.col("page_id").isNull().alias("unknown")
    firsts = files.groupBy(group).agg(F.min(F.struct(unknown, "page_id", "url", "sha", "nth")).alias("first")).select("first.*", "group")
    known = {r["group"]: _key(r["page_id"], r["url"], r["sha"], r["nth"]) for r in firsts.collect()}  # at most GROUPS rows
    # A group without a first record (inside of a record larger than a file) starts with the next one.
    numbers = sorted(known)
    starts = [known[n] for n in numbers]
    bundles = spark.createDataFrame([(n, i) for i, n in enumerate(numbers)], "group int, bundle int")
    infos = files.select(*_KEY, "gz", "file", group).join(F.broadcast(bundles), "group").select(*_KEY, "gz", "file", F.lit(None).cast("binary").alias("payload"), F.col("bundle").alias("group"))
    wide = _with_groups(rows, starts).select("page_id", "url", "sha", "length", F.lit(-1).cast("long").alias("nth"), F.lit(None).cast("binary").alias("gz"), F.lit(None).cast("long").alias("file"), "payload", "group")
    order = ["group", unknown, "page_id", "url", "sha", "nth"]
    tasks = max(2 * len(numbers), 1)  # as many as the stored sizes give files, so a task has a few groups at most
    every = _merged(wide.union(infos).repartition(tasks, "group").sortWithinPartitions(*order)).sortWithinPartitions("file", "place")
    # Spark's text writer puts bytes as they are and ends each row with a separator: the 0 that every member ends with.
    bare = F.substring("gz", F.lit(1), F.octet_length("gz") - 1).cast("string").alias("value")
    incoming = f"{folder.rstrip('/')}.incoming-{uuid.uuid4().hex}"
    every.select(bare, "file").write.partitionBy("file").option("lineSep", "\0").text(f"{incoming}/archives")
    written = _stored(spark, f"{incoming}/archives").groupBy("file").agg(F.sum("length").alias("bytes"))
    counted = files.groupBy("file").agg(F.count("*").alias("records"))
    counted.join(written, "file", "left").write.json(f"{incoming}/manifest")
    _rename(spark, incoming, folder)


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    """(file, length, content) of the archive files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.regexp_extract("path", r"/file=(\d+)/[^/]*$", 1).cast("long").alias("file"), "length", "content")


def _rename(spark: SparkSession, source: str, target: str) -> None:
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    old, new = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    store = old.getFileSystem(conf)
    if store.exists(new):
        raise FileExistsError(target)
    if not store.rename(old, new):
        raise OSError(f"cannot rename {source} to {target}")


def _members(data: bytes) -> Iterator[bytes]:
    """The records of an archive file.  It is fed in pieces, as a decompressor copies what it leaves over."""
    view, at = memoryview(data), 0
    while at < len(view):
        d, parts = zlib.decompressobj(31), []
        while not d.eof:
            piece = view[at : at + _PIECE]
            if not piece:
                raise ValueError("an archive file ends inside of a record")
            parts.append(d.decompress(piece))
            at += len(piece) - len(d.unused_data)
        if out := b"".join(parts):
            yield out


def parse(data: bytes) -> dict:
    """Headers and payload of one record; raises if its lengths or digests are wrong."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(": "), "") for line in lines)
    length = int(fields["Content-Length"])
    block = rest[:length]
    payload = block.partition(b"\r\n\r\n")[2]
    if version != "WARC/1.1" or rest[length:] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"broken record {fields.get('WARC-Record-ID')}")
    if fields["WARC-Type"] == "response" and (fields["WARC-Payload-Digest"] != f"sha1:{digest(payload)}" or int(fields["X-Payload-Length"]) != len(payload)):
        raise ValueError(f"wrong payload in {fields['WARC-Record-ID']}")
    return fields | {"payload": payload}


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record below ``folder``: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload, file.

    Lengths and digests are checked; a broken record, or a file that differs in length from the manifest, is an error.  A
    revisit's payload is null.  A file is read as one row, which the size of files bounds.
    """
    manifest = spark.read.schema("file long, records long, bytes long").json(f"{folder}/manifest")
    files = _stored(spark, f"{folder}/archives")
    sizes = files.groupBy("file").agg(F.sum("length").alias("length"))
    wrong = manifest.join(sizes, "file", "full").filter("NOT (bytes <=> length)").count()
    if wrong:
        raise ValueError(f"{wrong} files of {folder} differ from the manifest")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload", "file"]
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                rows: list[tuple] = []
                held = 0
                for data in _members(content.as_py()):
                    f = parse(data)
                    revisit = f["WARC-Type"] == "revisit"
                    number = lambda x: int(x) if x else None
                    rows.append((number(f["X-Page-ID"]), f["WARC-Target-URI"], f["WARC-Type"], int(f["X-Payload-Length"]), f["WARC-Payload-Digest"].removeprefix("sha1:"), number(f.get("X-Refers-To-Page")), None if revisit else f["payload"], file))
                    held += len(data)
                    if held > _AT_ONCE:
                        yield _batch(rows, names)
                        rows, held = [], 0
                yield _batch(rows, names)

    return in_arrow(files.select("file", "content"), step, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, file long")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.int64()]
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
