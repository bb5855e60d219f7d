"""What urls lead to, as a column. What fetches a url is a parameter."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from .paged import PAUSE, attempt

#: Replies that a task holds at a time.
AT_ONCE = 16
REPLY = "struct<body: binary, charset: string, encoding: string, content_type: string>"


class Reply(NamedTuple):
    """A body and what its header says of it."""

    body: bytes
    charset: str | None = None
    encoding: str | None = None
    content_type: str | None = None


def fetched(rows: DataFrame, fetch: Callable[[str], Reply | None], attempts: int = 1, pause: float = PAUSE) -> DataFrame:
    """rows, which have a url, with its reply: null where every attempt raises OSError, or there is none.

    Fetching twice may give two replies: whoever reads the result more than once writes it first.
    """
    at = rows.columns.index("url")
    kind = pa.struct([("body", pa.binary()), ("charset", pa.string()), ("encoding", pa.string()), ("content_type", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(lo, AT_ONCE)
                found = [attempt(fetch, url, attempts=attempts, pause=pause) if url else None for url in part.column(at).to_pylist()]
                replies = pa.array([None if r is None else r._asdict() for r in found], kind)
                yield pa.RecordBatch.from_arrays([*part.columns, replies], names=[*part.schema.names, "reply"])

    return rows.mapInArrow(run, rows.selectExpr("*", f"cast(null as {REPLY}) AS reply").schema)
