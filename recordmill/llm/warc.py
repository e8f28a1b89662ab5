"""Web archives compressed with a dictionary: a WARC record per page, each its own Zstandard frame.

An archive starts with a skippable frame that holds the dictionary, built from the archive's own records. Of equal
payloads one record holds the body; the others are revisit records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import file_system, workspace, written

# Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT_BYTES = 1000

# Parameters.
ARCHIVE_BYTES = 16 << 20  # uncompressed records of one archive, and what a task holds
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20  # records the dictionary is built from, spread over the archive
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"  # pages carry no date

PAGE_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}>"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; ``digest`` is the lower-case hex SHA-1 of the full payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Target-URI: {url.translate({13: '%0D', 10: '%0A'})}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> bytes:
    """From whole records spread over the archive; plain content where there is too little to train on."""
    import zstandard

    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    sample = records[::step]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sample)[:DICTIONARY_BYTES]


def archive(records: list[bytes]) -> bytes:
    import zstandard

    own = dictionary(records)
    pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(own))
    return struct.pack("<II", DICTIONARY_MAGIC, len(own)) + own + b"".join(map(pack.compress, records))


def read_archive(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record, one at a time."""
    import zstandard

    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not start with its dictionary")
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stream.read(size)))
    with unpack.stream_reader(stream, read_across_frames=True) as data:
        rest = b""

        def need(enough) -> bool:
            nonlocal rest
            while not enough():
                more = data.read(1 << 18)
                if not more:
                    return False
                rest += more
            return True

        while need(lambda: b"\r\n\r\n" in rest):
            head, _, rest = rest.partition(b"\r\n\r\n")
            lines = head.decode("utf-8", "surrogatepass").split("\r\n")
            headers = dict(x.split(": ", 1) for x in lines[1:])
            length = int(headers["Content-Length"])
            if lines[0] != "WARC/1.1" or not need(lambda: len(rest) >= length + 4):
                raise ValueError("a record is cut off")
            yield headers, rest[:length]
            rest = rest[length + 4 :]


def with_types(pages: DataFrame) -> DataFrame:
    """page_id, url, html and, of the full payload, its bytes, SHA-1, record type and the page it refers to.

    Equal payloads have the same SHA-1 and length. Digests are grouped with partial aggregation before the join, so
    one payload on a third of the pages costs a row per task there, and the join splits it.
    """
    own = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    own = own.select("*", F.octet_length("html").cast("long").alias("payload_bytes"), F.sha1(F.col("html").cast("binary")).alias("payload_digest"))
    large = F.col("payload_bytes") >= MIN_REVISIT_BYTES
    keys = ["payload_digest", "payload_bytes"]
    first = own.where(large).groupBy(*keys).agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return own.join(first.drop("n"), keys, "left").select(
        "page_id", "url", "html", "payload_digest",
        F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("first")), F.col("first")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write the archives into ``folder``; returns one row per archive (path, records).

    A task buffers records up to ``ARCHIVE_BYTES`` and writes them under a name of its own. The list of archives is
    a table written once: it names the files of the tasks that ended well, whatever other attempts left behind.
    """

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[bytes] = []
        size = 0

        def flush() -> pd.DataFrame:
            path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
            fs, local = file_system(path)
            with fs.open_output_stream(local) as out:
                out.write(archive(held))
            return pd.DataFrame({"path": [path], "records": [len(held)]})

        fs, local = file_system(folder)
        fs.create_dir(local, recursive=True)
        for batch in batches:
            ids = [None if pd.isna(x) else int(x) for x in batch["page_id"]]
            refs = [None if pd.isna(x) else int(x) for x in batch["refers_to"]]
            for row in zip(ids, batch["url"], batch["html"], batch["payload_digest"], refs):
                page, url, html, digest, ref = row
                held.append(record(page, url, html.encode("utf-8", "surrogatepass"), digest, ref))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    held.clear()
                    size = 0
        if held:
            yield flush()

    return written(with_types(pages).mapInPandas(put, "path string, records long"), folder, "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """One row per record of the archives, with the columns of ``PAGE_SCHEMA``; bodies are measured and hashed anew."""

    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                fs, local = file_system(path)
                rows = []
                with fs.open_input_stream(local) as stream:
                    for head, block in read_archive(stream):
                        http, _, body = block.partition(b"\r\n\r\n")
                        digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        length = int(http.rpartition(b"Content-Length: ")[2])
                        if head["WARC-Type"] == "response" and (len(body) != length or hashlib.sha1(body).hexdigest() != digest):
                            raise ValueError(f"a body in {path} is not what was written")
                        page, ref = head.get("X-Page-Id"), head.get("X-Refers-To-Page-Id")
                        rows.append((page and int(page), length, digest, head["WARC-Type"], ref and int(ref), head["WARC-Target-URI"]))
                out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"], dtype=object)
                yield out.astype({"page_id": "Int64", "payload_bytes": "int64", "refers_to": "Int64"})

    spread = archives.select("path").repartition(max(1, archives.sparkSession.sparkContext.defaultParallelism), "path")
    return spread.mapInPandas(get, PAGE_SCHEMA)


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` (page_id, url, html; other columns are not read) as archives and read them back.

    A null html is an empty payload, a null url an empty one. Of equal payloads of at least 1,000 bytes the record
    with the largest page_id is the response; repeated rows with that very id are all responses, and rows without
    an id revisit it. An empty table gives an empty table.
    """
    return read_archives(write_archives(pages, workspace(pages.sparkSession, "warc")))
