"""A model behind an HTTP endpoint, as a scorer of batches."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronicle.operators.segment import Scorer

#: Sends a body, gives the answer's; raises urllib.error.HTTPError or URLError.
Post = Callable[[str, bytes, Mapping[str, str], float], bytes]


def over_http(url: str, body: bytes, headers: Mapping[str, str], timeout: float) -> bytes:
    with urllib.request.urlopen(urllib.request.Request(url, data=body, headers=dict(headers)), timeout=timeout) as got:
        return got.read()


@dataclass
class Endpoint:
    """Asks for `chunk` values at a time, several times if need be.

    A status under 500 is the asker's fault and raised at once; others, and connections that fail, are tried
    `tries` times with pauses of 1, 2, 4 ... seconds. An answer of another length than the question is an error.
    Values are word lists under `tokens`, answers the probabilities of their joins.
    """

    url: str
    token: str
    header: str = "x-token"
    chunk: int = 256
    tries: int = 3
    timeout: float = 600
    post: Post = over_http
    pause: Callable[[float], None] = field(default=time.sleep)
    asks: str = "tokens"

    def _asked(self, values: list) -> dict:
        body = json.dumps({self.asks: values}).encode()
        for attempt in range(self.tries):
            try:
                return json.loads(self.post(self.url, body, {"content-type": "application/json", self.header: self.token}, self.timeout))
            except urllib.error.HTTPError as e:
                if e.code < 500 or attempt == self.tries - 1:
                    raise
            except urllib.error.URLError:
                if attempt == self.tries - 1:
                    raise
            self.pause(2**attempt)
        raise ValueError("tries must be at least 1")

    def revision(self) -> str:
        """What the endpoint serves now: the answer to a question without values."""
        return self._asked([]).get("revision", "unknown")

    def answers(self, batch: list) -> list[tuple[Any, str | None, str | None]]:
        """Each value's answer with the revision and the model that gave it, as that very answer says: a service may change between two."""
        out: list[tuple[Any, str | None, str | None]] = []
        for i in range(0, len(batch), self.chunk):
            part = batch[i : i + self.chunk]
            said = self._asked(part)
            found = said["results"]
            if len(found) != len(part):
                raise ValueError(f"asked for {len(part)} values, got {len(found)}")
            out += [(x, said.get("revision"), said.get("model")) for x in found]
        return out

    def __call__(self, batch: list[list[str]]) -> list[list[float]]:
        return [x for x, _, _ in self.answers(batch)]


@dataclass
class Segmenter(Endpoint):
    """A service that segments whole texts: asked for `keywords`, it answers with the terms and sizes of each."""

    header: str = "x-tagger-token"
    asks: str = "keywords"


SEGMENTED = "terms array<string>, sizes array<int>, model string, revision string"


def segmented(values: DataFrame, column: str, service: Segmenter) -> DataFrame:
    """(column, terms, sizes, model, revision) of distinct texts, by a service that segments them itself; null texts aren't asked."""
    given = values.select(column).where(F.col(column).isNotNull()).distinct()
    kind = pa.struct([("terms", pa.list_(pa.string())), ("sizes", pa.list_(pa.int32())), ("model", pa.string()), ("revision", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = service.answers(batch.column(0).to_pylist())
            rows = pa.array([{"terms": x["terms"], "sizes": x["group_sizes"], "model": model, "revision": revision} for x, revision, model in told], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), *rows.flatten()], [column, "terms", "sizes", "model", "revision"])

    return given.mapInArrow(run, f"`{column}` string, {SEGMENTED}")


def configured(url: str | None, token: str | None, **options) -> Scorer | None:
    """The endpoint, if both its address and its token are given; without, nothing is scored and terms stay null."""
    return Endpoint(url, token, **options) if url and token else None
