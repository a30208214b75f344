"""Web captures as WARC archives, with one index merged from the archives' sorted runs."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscore.llm.shared import open_uri
from subscore.session import scratch_path

#: Bytes of payload after which a task begins its next archive.
ARCHIVE_BYTES = 256 << 20
#: Bytes of an archive that are written at once.
BUFFER_BYTES = 4 << 20

INDEX = (
    "archive string, urlkey string, timestamp long, place long, offset long, length long, "
    "record_type string, page_id long"
)
RECORD = (
    "page_id long, url string, timestamp long, payload binary, payload_bytes long, "
    "payload_digest string, record_type string, refers_to long"
)


class LoserTree:
    """Merges k sorted iterators: each step replays one leaf's matches up to the root."""

    def __init__(self, runs: list[Iterator], key: Callable):
        self.runs, self.key = runs, key
        self.size = len(runs)
        self.heads = [next(run, None) for run in runs]
        self.keys = [None if head is None else key(head) for head in self.heads]
        self.losers = [-1] * max(1, self.size)
        for leaf in range(self.size):
            self._replay(leaf)

    def _before(self, a: int, b: int) -> bool:
        """True if the head of run a comes before that of run b; ended runs come last."""
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and (self.keys[a] is not None or a < b)
        return (self.keys[a], a) < (self.keys[b], b)

    def _replay(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.size) // 2
        while node > 0:
            loser = self.losers[node]
            if loser < 0:  # while building: the first to arrive waits for its opponent
                self.losers[node] = winner
                return
            if self._before(loser, winner):
                self.losers[node], winner = winner, loser
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        while self.size and self.heads[winner := self.losers[0]] is not None:
            yield self.heads[winner]
            head = self.heads[winner] = next(self.runs[winner], None)
            self.keys[winner] = None if head is None else self.key(head)
            self._replay(winner)


def page_uri(page_id: int | None) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def page_number(uri: str) -> int | None:
    number = uri.strip("<>").rpartition(":")[2]
    return None if number == "none" else int(number)


def record_bytes(page: dict) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP head only."""
    payload = page["payload"] or b""
    digest = base64.b32encode(bytes.fromhex(page["digest"])).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n"
    seconds = page["timestamp"]
    revisit = page["record_type"] == "revisit"
    block = head.encode() + (b"" if revisit else payload)
    fields = [
        "WARC/1.1",
        f"WARC-Type: {page['record_type']}",
        f"WARC-Record-ID: <{page_uri(page['page_id'])}>",
        f"WARC-Date: {_date(seconds)}",
        *([f"WARC-Target-URI: {_header(page['url'])}"] if page["url"] is not None else []),
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        fields += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{page_uri(page['refers_to'])}>",
        ]
    fields += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_record(data: bytes) -> dict:
    """The page of one record; the payload of a response is hashed again."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"not a whole WARC record: {fields.get('WARC-Record-ID')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload: {fields['WARC-Record-ID']}")
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": page_number(fields["WARC-Record-ID"]),
        "url": None if url is None else _unheader(url),
        "timestamp": _seconds(fields["WARC-Date"]),
        "payload": None if revisit else payload,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": page_number(fields["WARC-Refers-To"]) if revisit else None,
    }


def _header(text: str) -> str:
    """A URL on one line, with what would break the record escaped."""
    return "".join(f"%{ord(c):02X}" if c in "%\r\n" else c for c in text)


def _unheader(text: str) -> str:
    for escaped, plain in (("%0D", "\r"), ("%0A", "\n"), ("%25", "%")):
        text = text.replace(escaped, plain)
    return text


def _date(seconds: int) -> str:
    from datetime import UTC, datetime

    return datetime.fromtimestamp(seconds, UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def _seconds(date: str) -> int:
    from datetime import UTC, datetime

    return int(datetime.strptime(date, "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=UTC).timestamp())


def with_revisits(pages: DataFrame, least: int) -> DataFrame:
    """Pages with ``digest``, ``record_type`` and ``refers_to``.

    Of equal payloads of at least ``least`` bytes, those with the largest id are responses.
    """
    hashed = pages.withColumn("digest", F.sha1("payload"))
    shared = (
        hashed.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("digest", "refers_to")
    )
    # A payload that a third of all pages share must not meet in one task.
    salts = 16
    salted = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    found = hashed.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int")).join(
        salted, ["digest", "salt"], "left"
    )
    revisit = F.col("refers_to").isNotNull() & ~F.col("refers_to").eqNullSafe(F.col("page_id"))
    return found.drop("salt").withColumn(
        "record_type", F.when(revisit, "revisit").otherwise("response")
    ).withColumn("refers_to", F.when(revisit, F.col("refers_to")))


def write_archives(
    pages: DataFrame,
    folder: str,
    timestamp: Column,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = 1000,
) -> DataFrame:
    """Write every page as a WARC record below ``folder``; returns the archives' sorted runs.

    Each task sorts its captures by URL key and time and writes them as gzip members, one for
    each record, to archives of its own: every archive is a sorted run. The rows returned say
    where each record is. They are written to ``folder`` as a table before they are returned,
    so an archive that a lost or repeated task left behind is never referred to.

    A null payload is an empty one, a null URL has the empty key, a null id is kept as such.
    Pages with the same id and payload are all responses. Rows repeat as often as they came
    in; an empty table gives no archives.
    """
    read = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        timestamp.cast("long").alias("timestamp"),
        F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    host = F.lower(F.regexp_extract("url", r"://([^/?#]*)", 1))
    # The host's labels from last to first, then the rest of the URL: ``org,example)/a?b``.
    key = F.when(
        F.instr("url", "://") > 0,
        F.concat(
            F.array_join(F.reverse(F.split(host, r"\.")), ","),
            F.lit(")"),
            F.regexp_extract("url", r"(?s)://[^/?#]*(.*)$", 1),
        ),
    ).otherwise(F.coalesce("url", F.lit("")))
    sorted_runs = (
        with_revisits(read, least)
        .withColumn("urlkey", key)
        .sortWithinPartitions("urlkey", "timestamp", "page_id")
        .select("urlkey", "page_id", "url", "timestamp", "payload", "digest", "record_type", "refers_to")
    )

    def write(batches):
        out = name = None
        offset = place = size = 0
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            rows = []
            for at in range(batch.num_rows):
                page = {name: column[at].as_py() for name, column in columns.items()}
                if out is None or size > ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    system, path = open_uri(name)
                    system.create_dir(path.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(path, compression=None, buffer_size=BUFFER_BYTES)
                    offset = place = size = 0
                packer = zlib.compressobj(3, zlib.DEFLATED, 31)
                member = packer.compress(record_bytes(page)) + packer.flush()
                out.write(member)
                rows.append(
                    (name, page["urlkey"], page["timestamp"], place, offset, len(member),
                     page["record_type"], page["page_id"])
                )
                offset += len(member)
                place += 1
                size += len(page["payload"] or b"")
            yield _rows(rows)
        if out is not None:
            out.close()

    spark = pages.sparkSession
    table = f"{folder}/runs"
    sorted_runs.mapInArrow(write, INDEX).write.parquet(table)
    return spark.read.parquet(table)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    text, number = pa.string(), pa.int64()
    types = [text, text, number, number, number, number, text, number]
    names = [part.split()[0] for part in INDEX.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, types)], names=names
    )


def merged_index(runs: DataFrame, parts: int) -> DataFrame:
    """The capture history: all rows of ``runs`` in the order of URL key and timestamp.

    ``runs`` are the sorted runs of the archives. Ranges of keys are dealt to ``parts`` tasks;
    each merges its stretch of every run with a loser tree, so that the parts, one after the
    other, are one sorted index. Keys that very many captures share are divided by time,
    archive and place.
    """
    stretches = runs.repartitionByRange(parts, "urlkey", "timestamp", "archive", "place")
    stretches = stretches.sortWithinPartitions("archive", "place")

    def merge(batches):
        stored = list(batches)
        held: dict[str, list[tuple[int, int]]] = {}
        for number, batch in enumerate(stored):
            names = batch.column(0).to_pylist()
            for at, name in enumerate(names):
                held.setdefault(name, []).append((number, at))
        keys = [
            list(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(0).to_pylist(), b.column(3).to_pylist()))
            for b in stored
        ]
        # UTF-8 order, as the executors sort.
        order = LoserTree(
            [iter(places) for places in held.values()],
            lambda at: (keys[at[0]][at[1]][0].encode(), *keys[at[0]][at[1]][1:]),
        )
        starts = [0]
        for batch in stored:
            starts.append(starts[-1] + batch.num_rows)
        if stored:
            whole = pa.Table.from_batches(stored).combine_chunks()
            taken = whole.take(pa.array([starts[number] + at for number, at in order], pa.int64()))
            yield from taken.to_batches(max_chunksize=10_000)

    return stretches.mapInArrow(merge, INDEX)


def read_archives(index: DataFrame, parts: int) -> DataFrame:
    """The pages of all records that ``index`` lists, read from the archives at their offsets."""
    dealt = index.select("archive", "offset", "length").repartitionByRange(parts, "archive", "offset")
    dealt = dealt.sortWithinPartitions("archive", "offset")

    def read(batches):
        name = file = None
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                rows = []
                for archive, offset, length in zip(*(column.to_pylist() for column in part.columns)):
                    if archive != name:
                        system, path = open_uri(archive)
                        name, file = archive, system.open_input_file(path)
                    file.seek(offset)
                    rows.append(read_record(zlib.decompress(file.read(length), 31)))
                yield _pages(rows)

    return dealt.mapInArrow(read, RECORD)


def _pages(rows: list[dict]) -> pa.RecordBatch:
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [field.split() for field in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([row[name] for row in rows], types[kind]) for name, kind in fields],
        names=[name for name, _ in fields],
    )


def archive_round_trip(
    pages: DataFrame,
    timestamp: Column,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = 1000,
) -> DataFrame:
    """Write ``pages`` as WARC archives in the shared folder, merge their index, read all back.

    See ``write_archives`` for what happens to nulls, repeats and empty tables.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    runs = write_archives(pages, folder, timestamp, page_id, url, payload, least)
    parts = max(1, len(runs.inputFiles()))
    path = f"{folder}/index"
    merged_index(runs, parts).write.parquet(path)
    return read_archives(spark.read.parquet(path), parts)
