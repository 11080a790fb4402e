"""Queries to a remote store over HTTP, read in ranges as a Spark data source.

The store answers a query text with one JSON object a line. Every task asks for one range of a
whole-number column and parses the answer as it arrives, in blocks of whole lines, so no answer
is held as a whole. How bytes are fetched is a function given by the caller.
"""

from __future__ import annotations

import io
import sys
import urllib.request
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.json
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of whole lines that are parsed at a time.
BLOCK = 1 << 20
Transport = Callable[[str, str], Iterable[bytes]]


def post(url: str, query: str) -> Iterator[bytes]:
    """Chunks of the answer to a query in the body of a request; other than 200 raises."""
    request = urllib.request.Request(url, data=query.encode(), method="POST")
    with urllib.request.urlopen(request, timeout=600) as answer:
        while chunk := answer.read(BLOCK):
            yield chunk


def whole_lines(chunks: Iterable[bytes], size: int = BLOCK) -> Iterator[bytes]:
    """Blocks of about ``size`` bytes that end with a line; a last line may lack its end."""
    held: list[bytes] = []
    length = 0
    for chunk in chunks:
        held.append(chunk)
        length += len(chunk)
        if length >= size and b"\n" in chunk:
            data = b"".join(held)
            cut = data.rindex(b"\n") + 1
            yield data[:cut]
            held, length = [data[cut:]], len(data) - cut
    if b"".join(held).strip():
        yield b"".join(held)


def ranges(low: int, high: int, parts: int) -> list[tuple[int, int]]:
    """At most ``parts`` ranges [a, b) of about equal width that cover low … high."""
    if low > high:
        return []
    edges = sorted({low + (high + 1 - low) * i // parts for i in range(parts + 1)})
    return list(zip(edges, edges[1:]))


def range_query(query: str, column: str, a: int, b: int, first: bool) -> str:
    """The query cut down to a range; the first range also has the rows without a number."""
    inside = f"{column} >= {a} AND {column} < {b}"
    return f"SELECT * FROM ({query}) AS part WHERE {f'({inside}) OR {column} IS NULL' if first else inside}"


def arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def told_schema(schema: pa.Schema) -> pa.Schema:
    """Dates and times arrive as text and are cast afterwards."""
    text = lambda t: pa.types.is_date(t) or pa.types.is_timestamp(t) or pa.types.is_decimal(t)
    return pa.schema([(f.name, pa.string() if text(f.type) else f.type) for f in schema])


class Range(InputPartition):
    def __init__(self, query: str):
        self.query = query


def query_source(transport: Transport = post, name: str = "http_query") -> type[DataSource]:
    """A data source class for ``spark.dataSource.register`` that fetches with ``transport``."""
    class Reader(DataSourceReader):
        def __init__(self, schema: StructType, options: dict[str, str]):
            self.schema, self.options = schema, dict(options)

        def partitions(self) -> list[InputPartition]:
            query, column = self.options["query"], self.options.get("column")
            if column is None:
                return [Range(query)]
            bounds = (int(self.options[k]) for k in ("low", "high", "parts"))
            return [Range(range_query(query, column, a, b, i == 0)) for i, (a, b) in enumerate(ranges(*bounds))]

        def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
            schema = arrow_schema(self.schema)
            parse = pyarrow.json.ParseOptions(explicit_schema=told_schema(schema), unexpected_field_behavior="error")
            for block in whole_lines(transport(self.options["url"], partition.query)):
                table = pyarrow.json.read_json(io.BytesIO(block), parse_options=parse)
                yield from table.select(schema.names).cast(schema).combine_chunks().to_batches()

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> StructType:
            raise ValueError("give the schema of the answer")

        def reader(self, schema: StructType) -> DataSourceReader:
            return Reader(schema, self.options)

    return Source


def read_query(
    spark: SparkSession, url: str, query: str, schema: StructType | str, column: str | None = None,
    low: int = 0, high: int = 0, parts: int = 1, transport: Transport = post,
) -> DataFrame:
    """Rows of a remote query; with ``column``, in ranges from ``low`` to ``high`` read in parallel.

    The bounds cover the column's values, both included; rows outside them are not asked for,
    rows without a number are. A field that the schema lacks fails the job, a missing field is
    null. A task that is repeated asks again, so the query should read data that stays.
    """
    spark.dataSource.register(query_source(transport))
    options = {"url": url, "query": query}
    if column is not None:
        options |= {"column": column, "low": str(low), "high": str(high), "parts": str(parts)}
    return spark.read.format("http_query").schema(schema).options(**options).load()
