"""HTTP at the edge: never part of a query.  ``fetch`` is for a driver program
that fills the table of page snapshots; one partition for each host keeps the
delay between two requests to it."""

from __future__ import annotations

import http.client
import time
import urllib.request
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions import urls

DELAY_S, TIMEOUT_S, DEADLINE_S, ATTEMPTS = 0.5, 30, 90, 3


def fetch_one(url: str, delay: float = DELAY_S, attempts: int = ATTEMPTS) -> tuple[int, str, bytes, str]:
    """(status, media type, body, error); waits 2^attempt seconds after a failure."""
    error = ""
    for attempt in range(attempts):
        try:
            began = time.monotonic()
            with urllib.request.urlopen(url, timeout=TIMEOUT_S) as r:
                body = b""
                while piece := r.read(1 << 16):
                    body += piece
                    if time.monotonic() - began > DEADLINE_S:
                        raise TimeoutError("body deadline")
                return r.status, r.headers.get_content_type(), body, ""
        except (OSError, ValueError, http.client.HTTPException) as e:
            error = f"{type(e).__name__}: {e}".replace("\n", " ")[:500]
            if attempt + 1 < attempts:
                time.sleep(delay * 2**attempt)
    return 0, "", b"", error


def fetch(wanted: DataFrame, delay: float = DELAY_S) -> DataFrame:
    """url, fetched_at, status, mime, body, error of the wanted URLs (url)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for url in pdf.url:
                rows.append((url, pd.Timestamp.now("UTC").tz_localize(None), *fetch_one(url, delay)))
                time.sleep(delay)
            yield pd.DataFrame(rows, columns=["url", "fetched_at", "status", "mime", "body", "error"])

    by_host = wanted.select("url").distinct().withColumn("host", urls.host(F.col("url")))
    return by_host.repartition("host").select("url").mapInPandas(run, "url string, fetched_at timestamp, status int, mime string, body binary, error string")
