"""Bibliographies from a reference-extraction service over HTTP, as TEI text.

A document gets null where the service is down, fails or answers with no XML,
and text, perhaps without entries, where it answers: the two are different.
"""

from __future__ import annotations

import urllib.error
import urllib.request
import uuid
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

# Where the service listens, what it is asked, and how long to wait.
URL = "http://localhost:8070"
ALIVE, PROCESS = "/api/isalive", "/api/processReferences"
ALIVE_SECONDS, FETCH_SECONDS = 2.0, 60.0
CONSOLIDATE = "1"


def is_available(url: str = URL, timeout: float = ALIVE_SECONDS) -> bool:
    """Whether the service answers with status 200."""
    try:
        with urllib.request.urlopen(url + ALIVE, timeout=timeout) as answer:
            return answer.status == 200
    except (urllib.error.URLError, OSError):
        return False


def fetch(pdf: bytes, url: str = URL, timeout: float = FETCH_SECONDS) -> str | None:
    """The TEI text of a PDF's references, or None."""
    mark = uuid.uuid4().hex
    part = lambda head, body: f"--{mark}\r\nContent-Disposition: form-data; {head}\r\n\r\n".encode() + body + b"\r\n"
    body = part('name="input"; filename="paper.pdf"', pdf) + part('name="consolidateCitations"', CONSOLIDATE.encode()) + f"--{mark}--\r\n".encode()
    request = urllib.request.Request(url + PROCESS, body, {"Content-Type": f"multipart/form-data; boundary={mark}", "Accept": "application/xml"})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            text = answer.read().decode("utf-8")
        ET.fromstring(text)
    except (urllib.error.URLError, OSError, ET.ParseError, UnicodeDecodeError):
        return None
    return text


def with_tei(files: DataFrame, url: str = URL, timeout: float = FETCH_SECONDS) -> DataFrame:
    """files: (paper_id, source, content), such as of format binaryFile.  (paper_id, source, tei_xml), one request a file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        alive = None
        for batch in batches:
            alive = is_available(url) if alive is None else alive
            rows = [(p, s, fetch(bytes(c), url, timeout) if alive and c is not None else None) for p, s, c in zip(batch["paper_id"], batch["source"], batch["content"])]
            yield pd.DataFrame(rows, columns=["paper_id", "source", "tei_xml"])

    return files.select("paper_id", "source", "content").mapInPandas(run, "paper_id string, source string, tei_xml string")
