"""WARC archives, index first.

Writing: each task appends gzip-member WARC records to a file of its own in the
shared folder and returns an index row for each record (file, offset, length,
URL, digest). The index is written as a table, and only files that it names
count: a task that ran twice leaves an unnamed file and nothing else.
Reading: the wanted index rows are sorted by file and offset, neighbouring byte
ranges are coalesced into one read, and the records are parsed and verified.

Records of equal payload of at least ``min_bytes`` bytes are stored once, by
the smallest page_id; the others are revisit records that name it.

Every record has a WARC-Record-ID (rows that repeat both id and payload share one; a revisit and a row
without an id have one of their place in the archive) and, with a URL, a WARC-Target-URI.

Defined results: null html is the empty payload; a null page_id or URL stays
null; rows that repeat the smallest page_id of a payload are responses too; a
null page_id never is the one referred to unless no other row has the payload
(then all are responses); an empty table makes an empty index.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinion_spark.llm.common import scratch, table, written

INDEX = ("file string, offset long, length long, url string, payload_digest string, page_id long, record_type string")
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")
#: A file is closed at this size; ranges closer than GAP are read together, up to SPAN bytes at once.
FILE_BYTES, GAP, SPAN = 1 << 30, 1 << 16, 8 << 20
#: A reading task takes about so many bytes of archive.
TASK_BYTES = 64 << 20


def classify(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """``page_id, url, html`` with ``payload_bytes, payload_digest, record_type, refers_to``."""
    base = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    base = base.withColumns({"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": F.sha2("html", 256)})
    firsts = (base.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
              .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > 1).drop("_n"))
    revisit = F.coalesce(F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first")), F.lit(False))
    return (base.join(firsts, "payload_digest", "left")
            .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(revisit, F.col("_first"))).drop("_first"))


def _urn(name: str) -> str:
    """A record's name: of the page and its payload, or of its place in an archive."""
    import uuid

    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _member(page_id, url, html, digest, kind, first, n_bytes, date, place: str) -> bytes:
    import zlib
    from urllib.parse import quote

    named = kind == "response" and page_id is not None  # what a revisit can refer to
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {date}", "WARC-Record-ID: " + _urn(f"{page_id}:{digest}" if named else place)]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe=";/?:@&=+$,-_.!~*'()#[]%"))
        if "%" in url:  # any text survives the trip through the header
            head.append("X-Target-Quoted: " + quote(url, safe=""))
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {n_bytes}"]
    body = b""
    if kind == "revisit":
        head += ["WARC-Refers-To: " + _urn(f"{first}:{digest}"), f"X-Refers-To-Page: {first}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    else:
        body = html.encode("utf-8", "surrogatepass")
        head.append("Content-Type: text/html; charset=utf-8")
    head.append(f"Content-Length: {len(body)}")
    z = zlib.compressobj(1, wbits=31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + z.flush()


def _writer(folder: str, date: str, file_bytes: int):
    def run(batches: Iterator) -> Iterator:
        import uuid

        import pandas as pd
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(folder)
        out = name = None
        at = 0
        none = lambda x: None if x is None else int(x)  # noqa: E731  (ids come as text: exact with nulls)
        for b in batches:
            rows = []
            for pid, url, html, digest, kind, first, n in zip(b.page_id, b.url, b.html, b.payload_digest, b.record_type, b.refers_to, b.payload_bytes):
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    fs.create_dir(root, recursive=True)
                    name, at = f"{root}/{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(name, compression=None)
                m = _member(none(pid), url, html, digest, kind, none(first), n, date, f"{name}#{at}")
                out.write(m)
                rows.append((name, at, len(m), url, digest, none(pid), kind))
                at += len(m)
            out_rows = pd.DataFrame(rows, columns=["file", "offset", "length", "url", "payload_digest", "page_id", "record_type"], dtype=object)
            yield out_rows.astype({"offset": "int64", "length": "int64", "page_id": "Int64"})
        if out is not None:
            out.close()

    return run


def write_warc(typed: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archive ``classify``'s rows under ``folder``; returns the index, written as a table."""
    cols = ["page_id", "url", "html", "payload_digest", "record_type", "refers_to", "payload_bytes"]
    rows = typed.select(*cols).withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return written(rows.mapInPandas(_writer(folder, date, file_bytes), INDEX), "warc-index")


def _parse(data: bytes) -> tuple:
    import hashlib
    import zlib
    from urllib.parse import unquote

    raw = zlib.decompress(data, wbits=31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    h = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    body = rest[: int(h["Content-Length"])]
    page = lambda k: int(h[k]) if k in h else None
    url = h.get("X-Target-Quoted", h.get("WARC-Target-URI"))
    digest, n = h["WARC-Payload-Digest"].removeprefix("sha256:"), int(h["X-Payload-Length"])
    if h["WARC-Type"] == "response":
        n = len(body)
        if hashlib.sha256(body).hexdigest() != digest:
            raise ValueError(f"payload of record {h.get('WARC-Record-ID')} does not match its digest")
    return page("X-Page-ID"), None if url is None else unquote(url), n, digest, h["WARC-Type"], page("X-Refers-To-Page")


def _reader(folder: str, gap: int, span: int):
    def run(batches: Iterator) -> Iterator:
        import pandas as pd
        import pyarrow.fs as pafs

        fs, _ = pafs.FileSystem.from_uri(folder)
        is_open, src = None, None
        for b in batches:
            rows, group = [], []

            def fetch():
                nonlocal is_open, src
                name, start = group[0][0], group[0][1]
                if is_open != name:
                    if src is not None:
                        src.close()
                    src, is_open = fs.open_input_file(name), name
                data = src.read_at(group[-1][1] + group[-1][2] - start, start)
                rows.extend(_parse(data[o - start: o - start + n]) for _, o, n in group)
                group.clear()

            for x in zip(b.file, b.offset, b.length):
                if group and (x[0] != group[0][0] or x[1] < group[-1][1] or x[1] > group[-1][1] + group[-1][2] + gap
                              or x[1] + x[2] - group[0][1] > span):
                    fetch()
                group.append(x)
            if group:
                fetch()
            out = pd.DataFrame(rows, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"], dtype=object)
            yield out.astype({"page_id": "Int64", "payload_bytes": "int64", "refers_to": "Int64"})
        if src is not None:
            src.close()

    return run


def read_warc(index: DataFrame, folder: str, gap: int = GAP, span: int = SPAN) -> DataFrame:
    """The records that ``index`` selects, by coalesced reads in file order.

    The number of tasks follows from the bytes to read, not from the index rows' size.
    """
    tasks = max(2, math.ceil((index.agg(F.sum("length")).first()[0] or 0) / (TASK_BYTES)))
    ranges = (index.select("file", "offset", "length", F.floor(F.col("offset") / F.lit(4 * span)).alias("_span"))
              .repartition(tasks, "file", "_span").sortWithinPartitions("file", "offset").drop("_span"))
    return ranges.mapInPandas(_reader(folder, gap, span), RECORD)


def query(spark, sf_dir):
    """op9: every page archived and read back."""
    folder = scratch(spark, "warc")
    index = write_warc(classify(table(spark, sf_dir, "pages")), folder)
    return read_warc(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, url, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, d.payload_digest,
       CASE WHEN first_id IS NULL OR first_id IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id IS NOT DISTINCT FROM page_id THEN NULL ELSE first_id END AS refers_to, url
FROM d LEFT JOIN f USING (payload_digest)
"""
