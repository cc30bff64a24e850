"""Reference sets from a service that gives records by pages.

A search says how many records there are; each page of them is a partition of its own, fetched where its task runs and
tried again after a failure, so a lost executor costs its pages only. A set that has been written is not fetched again.
"""

from __future__ import annotations

import re
import time
import urllib.parse
import urllib.request
import uuid
from collections.abc import Iterator
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sievemark.operators import records
from sievemark.sources import files, tools

PAGE = 500
ATTEMPTS = 3


class Client(Protocol):
    """A service of records; it goes to every task."""

    def search(self, term: str) -> tuple[int, str]:
        """How many records a term has, and a name by which pages of them can be asked for."""

    def page(self, token: str, start: int, size: int) -> str:
        """Records start, start + 1, ... as FASTA."""


class HttpClient:
    """Pages over HTTP: {base}/search?term= answers 'count token', {base}/page?token=&start=&size= a FASTA text."""

    def __init__(self, base: str, timeout: float = 60.0):
        self.base, self.timeout = base.rstrip("/"), timeout

    def _get(self, path: str, **query: object) -> str:
        with urllib.request.urlopen(f"{self.base}/{path}?{urllib.parse.urlencode(query)}", timeout=self.timeout) as answer:
            return answer.read().decode("utf-8")

    def search(self, term: str) -> tuple[int, str]:
        count, token = self._get("search", term=term).split(maxsplit=1)
        return int(count), token.strip()

    def page(self, token: str, start: int, size: int) -> str:
        return self._get("page", token=token, start=start, size=size)


def tried(attempts: int, pause: float, call, *args):
    """The call's result, or its last error after so many attempts; the pauses between them double."""
    for left in range(attempts - 1, -1, -1):
        try:
            return call(*args)
        except OSError:
            if not left:
                raise
            time.sleep(pause)
            pause *= 2


def records_of(text: str) -> Iterator[tuple[str, str]]:
    """(header, sequence in capitals) of a FASTA text; what stands before the first '>' is ignored."""
    for piece in re.split(r"(?m)^>", "\n" + text)[1:]:
        header, _, body = piece.partition("\n")
        yield header.strip(), re.sub(r"\s+", "", body).upper()


class _Page(InputPartition):
    def __init__(self, start: int, size: int):
        self.start, self.size = start, size


class _Reader(DataSourceReader):
    def __init__(self, client: Client, token: str, count: int, page: int, attempts: int, pause: float):
        self.client, self.token, self.count, self.page, self.attempts, self.pause = client, token, count, page, attempts, pause

    def partitions(self) -> list[InputPartition]:
        return [_Page(at, min(self.page, self.count - at)) for at in range(0, self.count, self.page)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        text = tried(self.attempts, self.pause, self.client.page, self.token, partition.start, partition.size)
        for i, (header, sequence) in enumerate(records_of(text)):
            yield partition.start + i, header, sequence


def search_term(protein: str, strain: str, shortest: int, longest: int) -> str:
    """Records of a protein and strain; the service compares their lengths."""
    return f"{protein} {strain} AND {shortest}:{longest}[SLEN]"


def scan_pages(spark: SparkSession, client: Client, term: str, page: int = PAGE, attempts: int = ATTEMPTS, pause: float = 1.0) -> DataFrame:
    """(ord, header, sequence) of all records of a term, in the service's order from 0; a term without records is an error."""
    count, token = tried(attempts, pause, client.search, term)
    if not count:
        raise ValueError(f"no records for {term}")
    name = f"pages_{uuid.uuid4().hex}"

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "ord long, header string, sequence string"

        def reader(self, schema) -> DataSourceReader:
            return _Reader(client, token, count, page, attempts, pause)

    spark.dataSource.register(Source)
    return spark.read.format(name).load()


def fetch_reference_set(spark: SparkSession, client: Client, protein: str, strain: str, length: int, folder: str, margin: int = 50, **how) -> DataFrame:
    """(ord, accession, sequence) of the records of a protein and strain of about its length: without ambiguous ones, the first of equals.

    The set and where it comes from are tables in the folder; a set that is there is read and not fetched. If
    nothing is left of it, that is an error.
    """
    slug = re.sub(r"[^A-Za-z0-9]+", "_", f"{protein}_{strain}").strip("_")
    path = f"{folder}/{slug}"
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        term = search_term(protein, strain, max(1, length - margin), length + margin)
        found = scan_pages(spark, client, term, **how).select("ord", F.split("header", r"\s+")[0].alias("accession"), "sequence")
        raw = f"{path}.raw"
        found.write.mode("overwrite").parquet(raw)
        found = spark.read.parquet(raw)
        kept, counts = records.filter_reference(found)
        if kept.isEmpty():
            raise ValueError(f"no record of {term} can be used")
        said = [F.lit(x).alias(n) for n, x in (("protein", protein), ("strain", strain), ("term", term))]
        tools.sink_provenance(counts.select(*said, "n", "n_ambiguous", "n_repeated", "n_kept"), f"{path}.provenance-{uuid.uuid4().hex}")
        kept.select("ord", "accession", "sequence").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def sink_reference_set(rows: DataFrame, path: str, width: int = 80) -> None:
    """rows (ord, accession, sequence) as one FASTA file, in order."""
    files.sink_fasta_file(rows.select("ord", F.col("accession").alias("header"), "sequence"), ["ord"], path, width)
